"""Problem 6: template residue, filler, error pages and script notices in place of content.

Method: hashed character trigram models of filler, error notices and script notices are compared with one
of natural prose. The mean likelihood ratio over a sliding window marks each character as residue or not;
a value is excluded by its coverage with such windows, so a text that only speaks of error pages stays. Prose is
counted over all texts; the other models start from the written examples below and grow by the lines of the corpus that they are sure of. Slots of templates are short: their windows are the bracketed or marked spans, compared
under n-gram models of slots and of brackets used in their own right.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..cluster import cut
from .arrowtext import batches, code_points
from .codepages import Decoder
from .corpus import SOURCE
from .pages import weight

KINDS = ["filler", "error_page", "script_notice"]
BITS = 18
WINDOW = 16
#: Mean log-likelihood ratio of a window that is residue; coverage from which a value is; share of a line that is filler.
RATIO, COVERAGE, LINE_SHARE = 0.42, 0.38, 0.6

# Written examples of general wording; what the corpus itself holds is learnt from there.
EXAMPLES = {
    "filler": """Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua. Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat.
Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur. Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum.
Sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium, totam rem aperiam eaque ipsa quae ab illo inventore veritatis et quasi architecto beatae vitae dicta sunt explicabo.
Cum sociis natoque penatibus et magnis dis parturient montes, nascetur ridiculus mus. Pellentesque habitant morbi tristique senectus et netus et malesuada fames ac turpis egestas. Vestibulum ante ipsum primis in faucibus orci luctus et ultrices posuere cubilia curae. Nunc sapien lorem, tincidunt ut magnis sed, elementum in velit. Maecenas sed diam eget risus varius blandit sit amet non magna. Aenean lacinia bibendum nulla sed consectetur. Donec id elit non mi porta gravida at eget metus. Nullam quis risus eget urna mollis ornare vel eu leo. Nemo enim ipsam voluptatem quia voluptas sit aspernatur aut odit aut fugit, sed quia consequuntur magni dolores eos qui ratione voluptatem sequi nesciunt. Neque porro quisquam est, qui dolorem ipsum quia dolor sit amet.
Sample text. Sample text goes here. Your text here. Text goes here. Text here. This is placeholder text. This is dummy text. Replace this text. Please replace this dummy text with your own text. Replace with your own words and content.
Text to follow. Your heading here. Headline goes here. Title here. Article title. Title of the page. Body text goes here. Body copy. Copy to come. Copy to be supplied by the author. Insert content here. Paragraph goes here. Sample paragraph for the layout.
Dummy copy for layout purposes only. Layout test. Content coming soon. Content goes here. To be supplied. Text text text. Placeholder placeholder placeholder.
示例文字。这里是示例文本。此处填写示例文字。请替换此处文字。请替换。正文内容待补充。待补充内容。内容待定，待补充。此处为标题。标题文字。此处为正文。占位文字。占位文本，请替换。在此输入文字。
Hier steht Beispieltext. Dies ist ein Blindtext. Blindtext bitte ersetzen. Mustertext. Platzhaltertext. Hier kommt Ihr Text hin. Überschrift hier.
Texte d’exemple. Ceci est un texte factice. Texte à remplacer. Faux texte. Votre texte ici. Titre de l’article.
Texto de ejemplo. Este es un texto de relleno. Reemplace este texto. Su texto aquí. Título del artículo.
Texto de exemplo. Este é um texto provisório. Substitua este texto. Seu texto aqui. Título do artigo.
Пример текста. Это текст-заполнитель. Замените этот текст. Здесь будет текст. Текст для примера. Заголовок статьи.""",
    "error_page": """404 Not Found. Page not found. The page you requested was not found on this server. The requested URL could not be found on the server. The page cannot be found. The page could not be found. The document could not be found on this server. The file was not found on this server.
502 Bad Gateway. 503 Service Unavailable. 500 Internal Server Error. 504 Gateway Timeout. 403 Forbidden. Internal server error: unhandled exception. Fatal error: null pointer on line 0. Null reference in module.
Access denied. Access to this page is denied. Your request was blocked by the firewall. Your request has been blocked. You do not have permission to view this page. Error reference number.
Error 0: the service is unavailable. The server is temporarily unavailable. The service is temporarily out of service. Please try again later. Try again in a few minutes. Too many connections. Too many attempts. Too many requests from your address. Please wait 0 seconds before you retry. Wait a moment before retrying. Rate limit exceeded.
Oops! Something went wrong. Sorry, something went wrong while loading the page. Error code 0. An unexpected error occurred while loading. Session expired. The session has expired. Please log in again. You must log in again to continue. Your login has expired.
The account is suspended. This site has been suspended. Account suspended by the host. Please contact the hosting provider. Contact the site host. Bandwidth limit exceeded. Database connection failed. Connection timed out.
页面不存在（404）您访问的页面已被删除或移走。页面未找到。服务器繁忙，请稍后重试。系统忙，请稍后再试一次。错误代码：0。登录已过期。会话已过期，请重新登录。您没有权限访问。您没有权限查看该页面。请求编号0。服务器内部错误。网络异常，请稍后重试。
Fehler 404: Die Seite wurde nicht gefunden. Der Dienst ist nicht erreichbar. Der Server ist zurzeit überlastet. Bitte versuchen Sie es später erneut. Zugriff verweigert. Interner Serverfehler.
Erreur 404 : la page est introuvable. Le service est indisponible. Service momentanément interrompu. Code 0. Accès refusé. Veuillez réessayer plus tard. Erreur interne du serveur.
Error 404: no se encontró la página. El servicio no está disponible en este momento. Inténtelo de nuevo más tarde. Acceso denegado. Error interno del servidor.
Erro 404: a página não foi encontrada. O serviço está indisponível. Código 0. Tente novamente mais tarde. Acesso negado.
Ошибка 404: страница не найдена. Сервис недоступен. Сервер временно не отвечает. Код 0. Доступ запрещён. Попробуйте позже. Внутренняя ошибка сервера.""",
    "script_notice": """Please enable JavaScript. Please enable JavaScript in your browser to view this site. JavaScript is disabled in your browser. JavaScript is blocked by an extension. JavaScript is required. Some parts of this page will not work without JavaScript.
This page needs scripts. This site requires scripts to be turned on. Turn on scripts in your browser and reload the page. You must allow scripts and cookies. Allow cookies and scripts to continue. Enable JavaScript and cookies to continue.
Checking your browser before accessing. Checking your browser… Scripts must be active. Verifying you are human. This may take a few seconds. Your browser does not support JavaScript.
请启用JavaScript后再访问。您的浏览器未启用脚本。浏览器未开启JavaScript，无法显示。正在检查您的浏览器，请稍候。请打开浏览器的脚本功能。本站需要启用脚本。
Bitte aktivieren Sie JavaScript, um die Seite anzuzeigen. Diese Seite benötigt JavaScript. Ihr Browser wird geprüft.
Veuillez activer JavaScript pour afficher la page. Ce site nécessite JavaScript. Vérification de votre navigateur.
Active JavaScript en su navegador para ver la página. Este sitio necesita JavaScript. Comprobando su navegador.
Ative o JavaScript no navegador para ver a página. Este site precisa de JavaScript. Verificando seu navegador.
Включите JavaScript, чтобы открыть страницу. Для работы сайта нужен JavaScript. Проверка браузера.""",
}
#: Spans that may be a slot.
SPAN = re.compile(
    r"\{\{[^{}\n]{0,80}\}\}|\$\{[^{}\n]{0,80}\}|\{%[^%\n]{0,80}%\}|<%[^%\n]{0,80}%>|\[\[[^\[\]\n]{0,80}\]\]|%\([^()\n]{0,60}\)[sd]|__[A-Za-z0-9_]{2,60}?__|#[A-Z][A-Z_]{1,40}#|\$[A-Z][A-Z_]{1,40}\$|%[A-Z][A-Z_]{1,40}%"
    r"|\{[^{}\n]{1,60}\}|\[[^\[\]\n]{1,80}\]|【[^【】\n]{1,60}】|<[^<>\n]{1,80}>|\b(?:TODO|FIXME|TBD|TBA|XXX)\b[: ]?[^\n.,;!?]{0,24}|\b(?:TODO|FIXME|TBD|TBA|XXX)_[A-Z_]+"
)
SLOTS = """{{name}} {{ page.name }} {{ item }} {{ user.email }} {{#if}} {{content}} ${name} ${user.name} ${date} ${title} {% block %} {% if %} <%= name %> <%= title %> [[title]] [[section_1]] [[name]] %(name)s %(count)d %(title)s __NAME__ __TITLE__ __DATE_1__ #TITLE# #DATE# #CITY# $NAME$ $DATE$ %NAME% {name} {text} {min_value} {max_value} {1} {city_name} {heading} {body}
[INSERT NAME HERE] [INSERT TEXT] [INSERT LINK] [YOUR NAME] [Your Name] [Company Name] [your text here] [Name] [TITLE] [insert link] [add example here] [placeholder] [image] [TBD] [TODO] <YOUR TEXT> <INSERT TITLE> <your name here> <company> <NAME> <insert text>
[Text hier einfügen] [Name einsetzen] [Ihr Name] [Titel einfügen] [insérer le texte] [votre nom] [insérer ici] [titre à compléter] [insertar texto aquí] [su nombre] [escriba el título] [inserir texto aqui] [seu nome] [inserir título] [вставьте текст] [ваше имя] [вставить название]
【请填写】 【标题】 【此处填写内容】 【待补充】 【在此插入文字】 【您的姓名】 [请填写] [此处插入图片] <请填写> TODO: write this TODO: fill in TODO FIXME: check this TBD TBD_SUMMARY TBA XXX TODO_TITLE""".replace("\n", " ")
OWN_RIGHT = """[1] [3] [345] [a] [b] [sic!] […] [ … ] [....] [1, 2] [3–5] [citation needed] [p. 12] [note] [note 3] [Fig. 2] {a, b} {x, y} {a, b, c, d} {1, 2, 3} {x | x > 0} {a} {n} <open> <shut> <geschlossen> <offen> <fermé> <ouvert> <cerrado> <abierto> <fechado> <aberto> <закрыто> <открыто> <营业中> <已关闭> <b> <i> <br> <p> </p> <em> [原文如此] 【原文】 【关闭】 【注意】 【1】 [注1] 【点击查看】 【查看大图】 [Click here] [View larger] [so] [sic, p. 3] [thus] [так в оригинале] [так!] [así] [así en el original] [assim] [assim no original] [so im Original] [laughs] [Applause] [emphasis added] [их] [the mill] [the river] [die Mühle] [le moulin] <k 3> <10 m> < 5 > [x] [  ] [0, 1] [A]"""


def _spans(s: str) -> list[str]:
    out = [m.group().strip() for m in SPAN.finditer(s)]
    return out


class NGrams:
    """Additive character n-gram model (orders 1 to 3) of short spans, letters kept, digits alike."""

    def __init__(self, spans: list[str]):
        self.counts: dict[str, int] = {}
        self.n = [0, 0, 0, 0]
        for s in spans:
            for k, g in self._grams(s):
                self.counts[g] = self.counts.get(g, 0) + 1
                self.n[k] += 1

    @staticmethod
    def _grams(s: str):
        t = "^" + re.sub(r"\d+", "0", s) + "$"
        for k in (1, 2, 3):
            for i in range(len(t) - k + 1):
                yield k, t[i : i + k]

    def score(self, s: str) -> float:
        size = (0, 100, 2000, 8000)
        return sum((0.4, 0.7, 1.0)[k - 1] * np.log((self.counts.get(g, 0) + 0.3) / (self.n[k] + 0.3 * size[k])) for k, g in self._grams(s))


def _one_scrap(v: str) -> bool:
    """Half of the pieces are the same one: junk, whatever the models make of it."""
    w = v.split()
    return len(w) > 12 and 2 * Counter(w).most_common(1)[0][1] > len(w)


class Slots:
    def __init__(self):
        self.slot, self.own = NGrams(_spans(SLOTS)), NGrams(_spans(OWN_RIGHT))
        self.memo: dict[str, bool] = {}

    def is_slot(self, span: str) -> bool:
        """Whether a span is a slot rather than brackets in their own right; a caption of one word or a number never is."""
        hit = self.memo.get(span)
        if hit is None:
            if len(self.memo) > 50_000:
                self.memo.clear()
            hit = self.memo[span] = self.slot.score(span) - self.own.score(span) > 0
        return hit

    def found(self, text: str) -> bool:
        return any(self.is_slot(m.group().strip()) for m in SPAN.finditer(text))


def _trigrams(cps: np.ndarray) -> np.ndarray:
    c = np.where((cps >= 48) & (cps <= 57), np.uint32(48), cps)
    lower = (c >= 65) & (c <= 90)
    c = np.where(lower, c + np.uint32(32), c)
    h = (c[:-2] * np.uint32(0x9E3779B1) ^ c[1:-1] * np.uint32(0x85EBCA6B) + np.uint32(0x27D4EB2F)) * np.uint32(0xC2B2AE35) ^ c[2:] * np.uint32(0x165667B1)
    h ^= h >> np.uint32(13)
    return (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def _counts(lines: list[str]) -> np.ndarray:
    cps = np.frombuffer("\n".join(lines).encode("utf-32-le"), np.uint32)
    return np.bincount(_trigrams(cps), minlength=1 << BITS).astype(np.float64) if len(cps) > 2 else np.zeros(1 << BITS)


class ResidueModel:
    """Log-likelihood ratio of each trigram bucket against prose, per kind (under 2 MB).

    A kind's model is half the written examples and half what the corpus holds of it, so that neither drowns in the other at any size."""

    def __init__(self, prose: np.ndarray, grown: np.ndarray | None = None):
        self.ratio = np.zeros((len(KINDS), 1 << BITS), np.float16)
        back = 1.0 / 30_000
        p = np.log((prose + 0.5) / (prose.sum() + 0.5 / back))
        share = lambda n: (n + 0.05) / (n.sum() + 0.05 / back)
        for i, kind in enumerate(KINDS):
            seed = _counts(EXAMPLES[kind].split("\n"))
            more = grown[i] if grown is not None and grown[i].sum() > 0 else None
            known = seed if more is None else seed + more
            ratio = np.log(share(seed) if more is None else 0.5 * share(seed) + 0.5 * share(more)) - p
            # a trigram that the kind's model doesn't know is no sign of it, however rare it is in prose
            self.ratio[i] = np.clip(np.where(known == 0, np.minimum(ratio, 0.0), ratio), -1.2, 4)
        self.slots = Slots()

    def line_means(self, cps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(kinds x lines: mean ratio, first and last character of each line) of code points with lines between line feeds."""
        at = np.flatnonzero(cps == 10)
        first, last = np.concatenate([[0], at + 1]), np.concatenate([at, [len(cps)]])
        long = last - first >= 8
        first, last = first[long], last[long]
        if not len(first):
            return np.zeros((len(KINDS), 0)), first, last
        t = _trigrams(cps)
        means = []
        for r in self.ratio:
            c = np.concatenate([[0.0], np.cumsum(r[t].astype(np.float64))])
            means.append((c[last - 2] - c[first]) / (last - 2 - first))
        return np.stack(means), first, last

    def windows(self, cps: np.ndarray) -> np.ndarray:
        """kinds x characters: the mean ratio of the window around each character."""
        if len(cps) < 3:
            return np.zeros((len(KINDS), len(cps)), np.float32)
        t = _trigrams(cps)
        out = np.zeros((len(KINDS), len(cps)), np.float32)
        for i in range(len(KINDS)):
            c = np.concatenate([[0.0], np.cumsum(self.ratio[i][t].astype(np.float64))])
            lo = np.clip(np.arange(len(cps)) - WINDOW // 2, 0, len(t) - 1)
            hi = np.clip(lo + WINDOW, 1, len(t))
            out[i] = (c[hi] - c[lo]) / (hi - lo)
        return out

    def kinds(self, col) -> list[str | None]:
        """The kind of residue of each value of an Arrow column, or None."""
        cps, offs = code_points(col)
        n = len(offs) - 1
        w = self.windows(cps)
        solid = (cps > 32) & (cps != 0x3000)
        rows = np.repeat(np.arange(n), np.diff(offs))
        total = np.maximum(np.bincount(rows[solid], minlength=n), 1)
        top = w.argmax(axis=0) if len(cps) else np.zeros(0, np.int64)
        marked = solid & (w.max(axis=0) > RATIO) if len(cps) else solid
        cover = np.stack([np.bincount(rows[marked & (top == k)], minlength=n) / total for k in range(len(KINDS))]) if len(cps) else np.zeros((3, n))
        # filler may stand in for single paragraphs: the share of each line
        line = np.cumsum(np.concatenate([[0], (cps[:-1] == 10) | (rows[1:] != rows[:-1])])) if len(cps) else rows
        lines = np.bincount(line[solid], minlength=(line[-1] + 1) if len(cps) else 0)
        filled = np.bincount(line[marked & (top == 0)], minlength=len(lines)) / np.maximum(lines, 1)
        row_of_line = np.zeros(len(lines), np.int64)
        row_of_line[line] = rows
        full = np.zeros(n, np.bool_)
        full[row_of_line[(filled >= LINE_SHARE) & (lines >= LEAST_FILLER)]] = True
        values = col.to_pylist()
        out: list[str | None] = []
        for i in range(n):
            v = values[i]
            if not v:
                out.append(None)
            elif cover[1, i] + cover[2, i] >= COVERAGE and not _one_scrap(v):
                out.append(KINDS[1 + int(cover[2, i] > cover[1, i])])
            elif full[i] or cover[0, i] >= COVERAGE:
                out.append("filler")
            elif any(c in v for c in "{[【<$%_#TFX") and self.slots.found(v):
                out.append("placeholder")
            else:
                out.append(None)
        return out


#: Weight of a text from which its lines count as prose; notices are shorter.
PROSE = 180
#: Rounds in which the kinds' models grow from the corpus, and the mean ratio of a short text, or of a line of filler in a long one, that they grow by.
ROUNDS, GROW = 2, 0.35
#: Characters from which a line of a long text may be filler.
LEAST_FILLER = 24


def is_prose(text: str) -> bool:
    return len(text) >= PROSE or 3 * len(text) >= PROSE and weight(text) >= PROSE


def residue_model(texts: DataFrame) -> ResidueModel:
    """Prose is counted over all texts of some length; the kinds' models start from the written examples and grow, in rounds, by the
    distinct short contents (filler: any content's lines) that the present model is sure of.

    What reaches the driver are counts of trigram buckets."""
    shape = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("n", pa.float64())])

    def emitted(counts: dict[int, np.ndarray]):
        for k, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k), pa.int32()), pa.array(at, pa.int32()), pa.array(n[at])], schema=shape)

    def collected(counts: DataFrame) -> np.ndarray:
        t = counts.groupBy("kind", "bucket").agg(F.sum("n").alias("n")).toArrow()
        out = np.zeros((len(KINDS) + 1, 1 << BITS))
        out[np.asarray(t["kind"]), np.asarray(t["bucket"])] = np.asarray(t["n"])
        return out

    def prose(it):
        n = np.zeros(1 << BITS)
        for b in batches(it, ["text"], 4 << 20):
            n += _counts([v for v in b.column(0).to_pylist() if is_prose(v)])
        yield from emitted({len(KINDS): n})

    text = texts.select("text")
    counts = collected(text.mapInArrow(prose, "kind int, bucket int, n double"))
    base = counts[-1]
    model = ResidueModel(base)

    def candidates(it):
        for b in batches(it, ["text"], 4 << 20):
            values = b.column(0).to_pylist()
            long = [is_prose(v) for v in values]
            out = [(v, True) for v, y in zip(values, long) if not y and len(v.strip()) > 8]
            cps = np.frombuffer("\n".join([v for v, y in zip(values, long) if y]).encode("utf-32-le"), np.uint32)
            m, first, last = model.line_means(cps)
            for j in np.flatnonzero((m[0] > GROW / 2) & (last - first >= LEAST_FILLER)):
                out.append((cps[first[j] : last[j]].tobytes().decode("utf-32-le"), False))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.string()), pa.array([y for _, y in out])], names=["line", "brief"])

    lines = cut(texts.where(F.col("kind") != SOURCE).select("text").mapInArrow(candidates, "line string, brief boolean").groupBy("line").agg(F.max("brief").alias("brief")))
    for _ in range(ROUNDS):

        def grow(it, model=model):
            n = np.zeros((len(KINDS) + 1, 1 << BITS))
            for b in batches(it, ["line"], 4 << 20):
                values = b.column(0).to_pylist()
                cps = np.frombuffer("\n".join(values).encode("utf-32-le"), np.uint32)
                owner = np.repeat(np.arange(len(values)), [x.count("\n") + 1 for x in values])
                m, first, last = model.line_means(cps)
                if not m.shape[1]:
                    continue
                owner = owner[np.cumsum(cps == 10)[np.minimum(first, len(cps) - 1)]]
                size = (last - first).astype(float)
                # a short text as a whole tells its kind, and all of its lines that lean to it help to learn it
                whole = np.stack([np.bincount(owner, k * size, len(values)) for k in m]) / np.maximum(np.bincount(owner, size, len(values)), 1)
                kind = whole.argmax(axis=0)[owner]
                brief = np.array(b.column(1).to_pylist(), np.bool_)[owner]
                own = m[kind, np.arange(len(owner))]
                sure = (whole.max(axis=0)[owner] > GROW) & np.where(brief, own > 0, kind == 0)
                t = _trigrams(cps)
                for j in np.flatnonzero(sure):
                    np.add.at(n[kind[j]], t[first[j] : last[j] - 2], 1)
                    if not brief[j]:
                        np.add.at(n[-1], t[first[j] : last[j] - 2], 1)
            yield from emitted(dict(enumerate(n)))

        got = collected(lines.mapInArrow(grow, "kind int, bucket int, n double"))
        model = ResidueModel(np.maximum(base - got[-1], 0.0), got[:-1])
    return model


def residues(records: DataFrame, model: ResidueModel, decoder: Decoder) -> DataFrame:
    """(uid, kind) of every record whose content holds residue; wrongly decoded content is restored first.

    Null and empty contents have no row; a record delivered twice has one."""

    def run(it):
        for b in batches(it, ["content"], 1 << 20):
            content = b.column(1)
            flags = np.flatnonzero(decoder.suspicious_rows(content))
            if len(flags):
                values = content.to_pylist()
                for i in flags:
                    values[i] = decoder.text(values[i])
                content = pa.array(values, pa.string())
            kinds = model.kinds(content)
            keep = [i for i, k in enumerate(kinds) if k]
            if keep:
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep)), pa.array([kinds[i] for i in keep])], names=["uid", "kind"])

    return records.where("content is not null and content <> ''").select("uid", "content").mapInArrow(run, "uid string, kind string").dropDuplicates(["uid"])
