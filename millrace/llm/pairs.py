"""Problem 7: defective question-answer pairs.

Method: pairs are cut out of the content by their labels. Tokens of answer and question stem are aligned by
shingle containment and longest common subsequence to flag copies; answers are aligned with refusal templates
by shingles to flag refusals; language comes from the centroids of problem 1, quotes left out. An answer that
isn't closed is truncated unless it is one of the options, a figure, or of a shape (names and figures masked)
that unclosed answers have again and again in the corpus; these shapes are counted over all records, equal ones once.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import corpus
from .arrowtext import batches
from .corpus import BODY, KEY
from .langid import LANGUAGES, Identifier
from .pages import HAN, closed

LABEL = re.compile(r"(?:^|\n)[ \t　]*(?:Question\s*[:：]|问题\s*[:：])")
ANSWER = re.compile(r"(?:Answer\s*[:：]|答案\s*[:：])")
OPTION = re.compile(r"^\s*\(?([A-Fa-fＡ-Ｆ])[.)、：:．]\s*(.+?)\s*$", re.M)
MARK = re.compile(r"(?:\s*[\[(（【]\s*(?:…+|\.{3,})\s*[\])）】]|…+|\.{3,})\s*$")
QUOTED = re.compile(r"“[^”]*”|«[^»]*»|„[^“”]*[“”]|\"[^\"]*\"|「[^」]*」|『[^』]*』")
# Stand-ins for an empty answer.
NOTHING = {"n/a", "na", "null", "none", "nil", "nan", "undefined", "无", "空", "暂无", "нет данных", "tbd", "(empty)", "[empty]", "(none)", "<null>"}
# Written templates of refusals; further wordings of the corpus are learnt from there.
REFUSALS = """Sorry, I can't help with this.|I cannot provide the answer to that request.|I can't give details about this.|I am unable to discuss that. Please ask about something else.|I'm unable to talk about this topic.|As an AI, I am not able to answer that.|As an AI language model, I cannot answer this question.|I'm sorry, but I am not comfortable answering this.|I apologize, but I must decline.|Unfortunately I cannot assist with that.|This is not something I can help with.|I must decline to answer that.|I won't be able to help with this request.|I am not able to comply with this request.|I'm not allowed to share that information.
抱歉，我不能回答这个问题。|非常抱歉，我无法提供答案。|对不起，我不方便回答。|作为人工智能，我不能提供这方面的内容。|作为人工智能模型，我无法回答。|根据相关规定，我无法作答。|根据使用政策，我不能回答这个问题。|对不起，我不能回答这个问题。|很抱歉，我无法提供帮助。|这个问题我不便回答。|作为一个语言模型，我无法回答该问题。|这个请求我无法协助。|这个我没办法帮忙。
Es tut mir leid, dabei kann ich Ihnen nicht helfen.|Als KI-Modell kann ich dazu nichts sagen.|Als Sprachmodell kann ich die Frage nicht beantworten.|Leider kann ich dazu keine Angaben machen.|Dazu darf ich keine Auskunft erteilen.|Zu diesem Thema äußere ich mich nicht.|Ich kann diese Anfrage nicht bearbeiten.|Tut mir leid, das kann ich nicht beantworten.
Désolé, je ne peux pas vous aider.|Je regrette, je ne peux pas aider.|Cette demande dépasse ce que je peux traiter.|Je ne suis pas autorisé à traiter cette demande.|Je ne peux pas répondre à cela.|En tant que modèle d’IA, je ne peux pas répondre.|Je ne suis pas en mesure de répondre à cette question.
Lo siento, no puedo ayudarle con eso.|Como modelo de lenguaje no puedo responder.|Como modelo de IA no puedo contestar la pregunta.|No puedo proporcionar una respuesta a esa solicitud.|Lamentablemente no puedo hablar de este tema.|No estoy autorizado a dar esa información.
Desculpe, não posso ajudar com isso.|Como modelo de IA, não posso responder a esta pergunta.|Infelizmente não posso falar sobre esse assunto.|Não posso fornecer uma resposta a esse pedido.|Não estou autorizado a dar essa informação.
Извините, я не могу помочь с этим.|К сожалению, я не могу с этим помочь.|Как модель ИИ, я не могу ответить.|Я не могу обсуждать этот вопрос.|Я не буду обсуждать эту тему.|К сожалению, я не могу предоставить ответ.|Я не вправе отвечать на этот запрос."""
#: Times, and share of all unclosed answers, that a shape must have to be that of whole answers.
LEAST, SHARE = 3, 3e-4
ALIGNED, COVERED, REFUSED = 0.9, 0.6, 0.55
#: A sentence of answers without figures that aligns this well with a written template, and stands in so many distinct bodies and this share of them, is one more template; an answer must then be nearly that.
LIKE, TIMES, OF_BODIES, NEARLY = 0.36, 4, 1e-4, 0.75
#: Shingles that such a sentence has at least.
LEAST_SHINGLES = 12


def _grams(s: str, k: int = 4) -> set[str]:
    t = re.sub(r"[\W\d_]+", "", s.lower())
    k = 2 if HAN.search(t) else k
    return {t[i : i + k] for i in range(len(t) - k + 1)}


SENTENCE = re.compile(r"[^.!?。！？\n]+[.!?。！？]*")


class Refusals:
    """Aligns the sentences of an answer, and neighbouring ones together, with the written templates and those of the corpus by shingles."""

    def __init__(self, more: list[str] = ()):
        self.templates = [g for t in re.split(r"[\n|]", REFUSALS) if len(g := _grams(t)) >= 4]
        self.more = [_grams(t) for t in more]
        self.every = set().union(*self.templates, *self.more)
        self.shortest = min(map(len, self.templates))

    def sentences(self, answer: str) -> list[set[str]]:
        if len(_grams(answer) & self.every) < 3:
            return []
        s = [g for x in SENTENCE.findall(QUOTED.sub(" ", answer)) if (g := _grams(x))]
        return [g for g in [*s, *(a | b for a, b in zip(s, s[1:]))] if len(g) >= 4 and len(g & self.every) >= 3]

    def is_like(self, sentence: str) -> bool:
        """Whether a sentence of some length has LIKE of its shingles, or of a written template's if these are fewer, in common with the template."""
        g = _grams(sentence)
        if len(g & self.every) < LIKE * min(len(g), self.shortest) or len(g) * (2 if HAN.search(sentence) else 1) < LEAST_SHINGLES:
            return False
        return any(len(g & t) >= LIKE * min(len(g), len(t)) for t in self.templates)

    def __call__(self, answer: str) -> bool:
        return any(len(g & t) >= REFUSED * min(len(g), len(t)) for g in self.sentences(answer) for t in self.templates) or any(len(g & t) >= NEARLY * max(len(g), len(t)) for g in self.sentences(answer) for t in self.more)


@lru_cache(1)
def written() -> Refusals:
    return Refusals()


def refusals(texts: DataFrame) -> Refusals:
    """The written templates, and the sentences that the corpus has for the same: near a template, and in several bodies each.

    At most 1 / OF_BODIES sentences reach the driver, whatever the corpus."""

    def run(it):
        known: dict[str, bool] = {}
        for b in batches(it, ["text"], 4 << 20):
            out = []
            for c in b.column(0).to_pylist():
                like = set()
                for _, a in split_pairs(c, None):
                    for x in SENTENCE.findall(QUOTED.sub(" ", a)):
                        x = x.strip()
                        if x not in known:
                            if len(known) > 50_000:
                                known.clear()
                            known[x] = not re.search(r"\d", x) and written().is_like(x)
                        if known[x]:
                            like.add(x)
                out += like
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["s"])

    bodies = texts.where(F.col("kind") == BODY)
    least = max(TIMES, OF_BODIES * bodies.count())
    got = bodies.select("text").mapInArrow(run, "s string").groupBy("s").count().where(F.col("count") >= least).orderBy("s").collect()
    return Refusals([r.s for r in got])


def split_pairs(content: str, source: str | None) -> list[tuple[str, str]]:
    """(question, answer) in the order of content. The labels are searched after the source text where content begins with it; a question without an answer label has the answer ''."""
    body = content[len(source) :] if source and content.startswith(source) else content
    at = [m for m in LABEL.finditer(body)]
    out = []
    for i, m in enumerate(at):
        block = body[m.end() : at[i + 1].start() if i + 1 < len(at) else len(body)]
        a = ANSWER.search(block)
        out.append((block[: a.start()].strip(), block[a.end() :].strip()) if a else (block.strip(), ""))
    return out


def stem_and_options(question: str) -> tuple[str, list[str]]:
    first = OPTION.search(question)
    if not first:
        return question, []
    return question[: first.start()].strip(), [m.group(2) for m in OPTION.finditer(question)]


def tokens(s: str) -> list[str]:
    return re.findall(r"[㐀-鿿]|[^\W_㐀-鿿]+", s.lower())


def _lcs(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence; whole texts, one row of the table at a time."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            keep = row[j]
            row[j] = last + 1 if x == y else max(row[j], row[j - 1])
            last = keep
    return row[-1]


def is_copy(stem: str, answer: str) -> bool:
    q, a = tokens(stem), tokens(answer)
    if not a or not q:
        return False
    qs = set(zip(q, q[1:])) | {(x,) for x in q}
    shingles = list(zip(a, a[1:])) or [(a[0],)]
    if sum(s in qs for s in shingles) < ALIGNED * len(shingles):
        return False
    # a verdict: the answer opens with one of the alternatives the stem offers, and not with the offer itself
    offer = re.match(r"[^:：]{2,40}[:：]", stem)
    if offer:
        o = tokens(offer.group())
        if a[0] in o[0:1] + o[2:] and a[: len(o)] != o:
            return False
        if a[0] in o and a[: len(o)] != o:
            return False
        statement = q[len(o) :]
        if statement and _lcs(statement, a) >= ALIGNED * len(statement) and a[0] not in o:
            return True
    return _lcs(q, a) >= COVERED * len(q)


def is_nothing(answer: str) -> bool:
    a = answer.strip(" \t\n　 ​").strip("\"'“”«»[]()").lower().rstrip(".")
    return a in NOTHING or not re.search(r"\w", a)


def shape(answer: str) -> str:
    """An unclosed answer with figures and names masked: capitalized words after the first, and of Chinese all but its ends."""
    s = re.sub(r"\d+(?:[.,]\d+)*", "0", answer.strip())
    if HAN.search(s):
        return f"{s[:1]}~{s[-2:]}" if len(s) <= 14 else f"{s[:3]}~{s[-4:]}"
    w = s.split()
    return " ".join([*w[:1], *("X" if x[:1].isupper() or x[:1] in "“«\"" else x for x in w[1:])])


def key64(key: str) -> int:
    return int.from_bytes(hashlib.blake2b(key.encode(), digest_size=8).digest(), "little", signed=True)


def usual(counts: DataFrame, least: int, share: float) -> frozenset[int]:
    """The keys of (key, n) that make up at least `least` and at least `share` of all: 1 / share of them at most, or 1 / (least * share) where there are few."""
    total = counts.agg(F.sum("n").alias("s")).first()["s"] or 0
    return frozenset(r.key for r in counts.where(F.col("n") >= max(least, share * total)).select("key").collect())


def open_shapes(body: str) -> list[int]:
    """Keys of the shapes of the answers that aren't closed, empty or marked as cut."""
    return [key64(shape(a)) for _, a in split_pairs(body, None) if not is_nothing(a) and not closed(a) and not MARK.search(a)]


def open_answers(texts: DataFrame) -> DataFrame:
    """(key, n): the shape of every answer that isn't closed, empty, or marked as cut, and how many there are, each distinct body counting once:
    copies of one cut answer don't make its shape a usual one."""

    def run(it):
        out: Counter = Counter()
        for b in batches(it, ["text"], 4 << 20):
            for c in b.column(0).to_pylist():
                out.update(open_shapes(c))
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.int64())], names=["key", "n"])

    return texts.where(F.col("kind") == BODY).select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


class PairModel:
    def __init__(self, identifier: Identifier, shapes: frozenset[int], is_refusal: Refusals):
        self.identifier, self.shapes, self.is_refusal = identifier, shapes, is_refusal

    def is_truncated(self, question: str, answer: str) -> bool:
        a = answer.strip()
        if MARK.search(a):
            return True
        if closed(a):
            return False
        _, options = stem_and_options(question)
        bare = re.sub(r"^\(?[A-Fa-fＡ-Ｆ][.)、：:．]\s*", "", a).strip().lower()
        if re.search(r"[.!?]\s+\S|[。！？][^”」』）]", bare):
            return True
        if any(bare == o.strip().lower() or a.lower() == o.strip().lower() for o in options) or re.fullmatch(r"[A-FＡ-Ｆ]", a):
            return False
        return key64(shape(a)) not in self.shapes

    def defects(self, pairs: list[tuple[str, str]], record: list[int] | None = None) -> list[str | None]:
        """The defect of each pair, or None. `record` numbers the record of each pair: its questions together tell their language."""
        record = record or [0] * len(pairs)
        out: list[str | None] = []
        stems, ask, where = [], [], []
        for q, a in pairs:
            stem, _ = stem_and_options(q)
            stems.append(stem)
            if is_nothing(a):
                out.append("empty_answer")
            elif self.is_refusal(a):
                out.append("refusal")
            elif is_copy(stem, a):
                out.append("copied_question")
            else:
                out.append("truncated_answer" if self.is_truncated(q, a) else None)
                bare = QUOTED.sub(" ", a)
                if len(re.findall(r"[^\W\d_]", bare)) >= 2:
                    where.append(len(out) - 1)
                    ask.append(bare)
        if not ask:
            return out
        asked = self.identifier.centroids.cosines(stems)
        for j, s in enumerate(stems):  # one script, one vote
            if (sc := _script(s)) != "latin":
                asked[j] *= 0.0
                asked[j, LANGUAGES.index("zh" if sc == "han" else "ru")] = 1.0 if sc else 0.0
        total: dict[int, np.ndarray] = {}
        for r, c in zip(record, asked):
            total[r] = total.get(r, 0) + c
        cos = self.identifier.centroids.cosines(ask)
        size, _, _ = self.identifier._figures(ask)
        latin = [k for k, x in enumerate(LANGUAGES) if x not in ("zh", "ru")]
        for i, k in enumerate(where):
            ql, ca, n = int(total[record[k]].argmax()), cos[i], size[i]
            script = _script(ask[i])
            own = {"zh": "han", "ru": "cyrillic"}.get(LANGUAGES[ql], "latin")
            if script != own:
                if n >= 6 and not (script == "latin" and _names_only(ask[i])):
                    out[k] = "other_language"
            elif script == "latin":
                al = max(latin, key=lambda x: ca[x])
                lead = (ca[al] - ca[ql]) / (ca[al] + 1e-9)
                if al != ql and ((n >= 14 and lead >= 0.2) or (n >= 40 and lead >= 0.12)):
                    out[k] = "other_language"
        return out


def _script(s: str) -> str:
    han, cyr = len(HAN.findall(s)) * 2, len(re.findall(r"[Ѐ-ӿ]", s))
    latin = len(re.findall(r"[A-Za-zÀ-ɏ]", s))
    top = max(han, cyr, latin)
    return "" if top == 0 else "han" if top == han else "cyrillic" if top == cyr else "latin"


def _names_only(s: str) -> bool:
    return all(w[:1].isupper() for w in re.findall(r"[^\W\d_]+", s))


def defective_pairs(records: DataFrame, texts: DataFrame, model: PairModel) -> DataFrame:
    """(uid, pair_no, defect) of every defective pair of the qa records, each with one defect.

    Null and empty contents and contents without a label have no pairs; a record delivered twice has each row once. Every distinct body is read once."""
    decoder = model.identifier.decoder

    def run(it):
        for b in batches(it, ["text"], 1 << 20):
            pairs, h, g, no, record = [], [], [], [], []
            for r, (x, y, c) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), decoder.texts(b.column(2).to_pylist()))):
                p = split_pairs(c, None)
                pairs += p
                record += [r] * len(p)
                h += [x] * len(p)
                g += [y] * len(p)
                no += range(1, len(p) + 1)
            d = model.defects(pairs, record)
            keep = [i for i, x in enumerate(d) if x]
            if keep:
                yield pa.RecordBatch.from_arrays([*[pa.array([c[i] for i in keep], pa.int64()) for c in (h, g, no)], pa.array([d[i] for i in keep])], names=[*KEY, "pair_no", "defect"])

    found = texts.where(F.col("kind") == BODY).select(*KEY, "text").mapInArrow(run, "h long, g long, pair_no long, defect string")
    return corpus.keyed(records, "uid", kinds=(BODY,)).dropDuplicates(["uid"]).join(found, KEY).select("uid", "pair_no", "defect")


def pair_model(texts: DataFrame, identifier: Identifier) -> PairModel:
    return PairModel(identifier, usual(open_answers(texts), LEAST, SHARE), refusals(texts))
