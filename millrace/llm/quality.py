"""Problem 4: text figures per document, and prose told from lists, tables and junk.

Method: each text gets its figures (words, word length, lines, symbols, line ends, common words, shares of
item and row lines, repetition, sense under the bigram model), page furniture left aside. A Gaussian mixture is
fitted by expectation-maximization on the standardized figures of all distinct texts; its E step runs where the rows are, and only
sums per component reach the driver. The components start at the inspected examples below and get their kind from
them. Wrongly decoded lines are restored before; values that are template residue are no cases.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import corpus
from .arrowtext import batches
from .codepages import LOST, Decoder
from .corpus import KEY, REWRITE, SOURCE
from .langid import letters
from .pages import HAN, MARKER, LineModel, cells, closed, data_row, weight

KINDS = ["prose", "list", "table", "junk"]
FEATURES = ["item_share", "row_share", "closed_share", "sense", "variety", "log_words", "mean_word_length", "symbol_ratio", "common_word_share", "closed_line_share"]
#: Ends of the features' ranges. Beyond them a feature tells nothing more: any sense over -3 is language, and pieces of which three in ten are distinct are no scrap.
RANGE = np.array([(0, 1), (0, 1), (0, 1), (-5, -3), (0, 0.3), (0, 5), (0, 12), (0, 0.3), (0, 0.5), (0, 1)], float)
#: Rounds of EM at most, and the gain in mean log-likelihood under which it ends.
ROUNDS, LEAST_GAIN = 12, 2e-3
#: Share of all texts with whose weight an example holds its component.
HELD = 0.006
#: Common words kept: those that most texts hold, of at most so many letters.
COMMON, LONGEST = 400, 24
#: Signs that rows and items of words and figures hardly have.
ODD = re.compile(r"[^\w\s|;,.:\"'’“”()«»·/$%°±×、，。：（）《》„•*>–-]", re.UNICODE)
#: Words of letters and figures at once, as codes have them.
MIXED = re.compile(r"\b(?=\w*\d)(?=\w*[A-Za-z])\w{3,}\b")
DIGIT = re.compile(r"\d")
PIECE = re.compile(r"[,;、；·•]")
PIECES = re.compile(PIECE.pattern + r"\s*")
ENDS = re.compile(r"[.!?](?=\s|$)|[。！？]")
SIGN = re.compile(r"[^\w\s.,;:!?'\"“”«»„’()，。；：！？、（）《》-]", re.UNICODE)
# Examples that were inspected and named by hand.
EXAMPLES = {
    "prose": [
        "磨坊在河边立了许多年。春天水涨的时候，人们把水轮抬起来，打开水闸，好让船只通过。没有人知道是谁付的钱。\n冬天，工人修好了屋顶，又粉刷了大门。据说费用不高，村里的人后来把它保存了很久。",
        "磨坊在河边立了许多年，冬天修过两次。",
        "Мельница стояла у реки много лет. Весной, когда вода поднималась, колесо убирали, чтобы лодки могли пройти. Никто не знает, кто заплатил за работу.\nЗимой починили крышу и покрасили двери.",
        "Le moulin est resté au bord de la rivière pendant des années. Quand l’eau montait au printemps, on levait la roue pour que les bateaux puissent passer. Personne ne sait qui a payé.",
        "O moinho ficou muitos anos junto ao rio. No inverno consertaram o telhado e pintaram as portas. Ninguém sabe quem pagou a obra.\nA aldeia guardou-o durante muito tempo.",
        "The mill stood by the river for many years. In winter the men repaired the roof and painted the do",
        "The mill stood by the river for many years. When the water rose in spring, the wheel was lifted and the sluice was opened, so that the boats could pass.\nIn winter the men repaired the roof and painted the doors. Nobody remembers who paid for the work.",
        "Die Mühle stand viele Jahre am Fluss. Als das Wasser im Frühling stieg, wurde das Rad gehoben, damit die Boote vorbeifahren konnten.\nIm Winter wurde das Dach erneuert.",
        "El molino estuvo muchos años junto al río. En invierno se reparó el techo. Se llevaron tres cosas:\n- la rueda\n- dos puertas\nNadie recuerda quién pagó la obra, pero el pueblo la guardó durante mucho tiempo y la mostró a los viajeros que llegaban por el camino de la costa en verano.",
        "The mill stood by the river for many years and was repaired twice.\nRiver | 12 | 40\nMill | 9 | 31\nWhen the water rose in spring, the wheel was lifted, so that the boats could pass without harm. In winter the men repaired the roof and painted the doors of the house.",
    ],
    "list": [
        "Many things can be seen in the valley all year.\n- The mill\n- Two boats\n- The old bridge\n- Harbour house, 1890\n- The river council (12)\n- A set of maps\n- The snow fences\n- The town clock\n- The salt store\n- The school orchard\n- The stone wharf",
        "The mill, Two boats, The old bridge, Harbour house, 1890, The river council, A set of maps, The snow fences, The town clock, The salt store, The school orchard",
        "- The mill\n- Two boats\n- The old bridge\n- Harbour house, 1890\n- The river council (12)\n- A set of maps\n- The snow fences\n- The town clock",
        "1. Die Mühle\n2. Zwei Boote\n3. Die alte Brücke\n4. Steinbach, 1890\n5. Das Hafenamt (12)\n6. Eine Reihe von Karten\n7. Das Glasdach",
        "Things to see in the valley\n(a) The mill\n(b) Two boats\n(c) The old bridge\n(d) Harbour house, 1890\n(e) The river council (12)\n(f) A set of maps",
        "• Мельница\n• Две лодки\n• Старый мост\n• Озёрск, 1890\n• Речной совет (12)\n• Набор карт",
    ],
    "table": [
        "Place | Year | Count\nMill | 1890 | 12\nBridge | 1905 | 7\nHarbour | | 31\nTower | n/a | 4\nWharf | 1911 | 9",
        "Ort;Jahr;Zahl\nMühle;1890;12\nBrücke;;7\nHafen;1905;\nTurm;1911;4.50\nSteg;;9.10",
        "Place,\"Name\",Year,Count\nMill,\"The old mill\",1890,12\nBridge,\"A stone bridge\",,7\nHarbour,\"The north wharf\",1905,\nTower,\"A tower\",1911,4.50",
        "Place        Year      Count\nMill         1890      12\nBridge       1905      7\nHarbour      1911      31\nTower        1920      4.50",
        "| Город | Год | Число |\n| --- | --- | --- |\n| Озёрск | 1890 | 12 |\n| Камск | | 7 |\n| Лесной | 1905 | |",
    ],
    "junk": [
        "ab12 9f3c 77de 01ac b4e2 9f0a 55cd e3f1 aa07 1b2c d9e8 4f5a 6b7c 8d9e 0f1a 2b3c 4d5e 6f70 8192 77aa 01bc de45 8f9a bb12 c3d4 e5f6 0a1b 2c3d 4e5f 6071 8293 a4b5 c6d7",
        "qzx vbnwk plrtzz kkqj wvx zzpqr mnbvt xqjk wlkpz ttrvb qqzm xnvb wkzzt plqr vbxzk qjwmn zzkt pqqlw mxxn vvbzk rtqp wwxz kljhg qpzm xxvn bqwk zzpl trwq mnxz kqqv",
        "qzx vbnwk plrtzz kkqj wvx zzpqr mnbvt xqjk wlkpz ttrvb qqzm xnvb wkzzt plqr vbxzk qjwmn zzkt",
        "ab12 9f3c 77de 01ac b4e2 9f0a 55cd e3f1 aa07 1b2c d9e8 4f5a 6b7c 8d9e 0f1a 2b3c 4d5e 6f70 8192",
        "la. la. la. la. la. la. la. la. la. la. la. la. la. la. la. la. la. la. la. la. la. 4412",
        "哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦. 哦.",
        "#*~;^%$ @!&*( )_+= |\\/<> ?~`# ^&* %$#@ !~* ()_ +-= {}[] |;: <>? /.,\n~!@#$ %^&*() _+ {}|:<>? -=[];',./",
        "aGVsbG8gd29ybGQgdGhpcyBpcyBqdW5r+QmFzZTY0/ZW5jb2RlZCB0ZXh0IHRoYXQgbm9ib2R5\nY2FuIHJlYWQgd2l0aG91dCB0b29scw+Xk9d82Lq0Zb7Vn3Rt6Yw1Pz",
        "1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
        "so so. so so. so so. so so. so so. so so. so so. so so. so so. so so. so so. so so. so so.",
    ],
}


#: The classes of characters that are counted, each of one character.
CLASSES = {"digit": DIGIT, "sign": SIGN, "odd": ODD, "han": HAN, "piece": PIECE, "letter": re.compile(r"[^\W\d_]"), "space": re.compile(r"\s"), "blank": re.compile("[ \t\u3000]")}


@lru_cache(1)
def classes() -> np.ndarray:
    """One bit per class of CLASSES for every code point, as its pattern has it."""
    cps = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    every = "".join(map(chr, cps))
    out = np.zeros(0x110000, np.uint8)
    for i, p in enumerate(CLASSES.values()):
        for m in re.finditer(f"{p.pattern}+", every):
            out[cps[m.start() : m.end()]] |= 1 << i
    return out


class Figures:
    """Computes the figures of values; travels with a task."""

    def __init__(self, decoder: Decoder, lines: LineModel, common: frozenset[str], full: bool = True):
        """full: all figures; otherwise only those of the mixture."""
        self.decoder, self.lines, self.common, self.full = decoder, lines, common, full

    def one(self, value: str) -> dict[str, float]:
        return self.many([value])[0]

    def many(self, values: list[str]) -> list[dict[str, float]]:
        """All figures of each value; an empty or blank one has zeros, and no sense."""
        if not values:
            return []
        texts = [re.sub(LOST + r"+[?？]?", "", t) if LOST in t else t for t in self.decoder.texts(values)]  # lost characters tell nothing of the kind
        n, of_lines = self._counts(texts)
        out, bare, first = [], [], 0
        for i, (v, t, words) in enumerate(zip(values, texts, self._words(texts))):
            last = first + n["lines"][i]
            f, b = self._all_but_sense(v, t, words, {k: x[i] for k, x in n.items()}, *(x[first:last] for x in of_lines))
            out.append(f)
            bare.append(b)
            first = last
        for f, x in zip(out, self._senses(bare)):
            f["sense"] = x
        return out

    @staticmethod
    def _counts(texts: list[str]) -> tuple[dict[str, list[int]], tuple[list[int], ...]]:
        """(per text its lines, pieces between blanks, and characters of some classes; per line its odd signs, ideographs, and signs between pieces). All at once."""
        cps = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le"), np.uint32)
        has = dict(zip(CLASSES, (1 << np.arange(len(CLASSES))).astype(np.uint8)))
        of = classes()[cps]
        ends = np.flatnonzero(cps == 10)  # that before the first line, and of each line the one behind it
        at = np.cumsum([0, *map(len, texts)]) + np.arange(len(texts) + 1)  # the line feeds before and behind each text
        counted = lambda where, by: np.diff(np.searchsorted(where, by))
        where = {k: np.flatnonzero(of & has[k]) for k in ("digit", "sign", "odd", "han", "piece", "blank")}
        out = {k: counted(where[k], at).tolist() for k in ("digit", "sign", "han", "blank")}
        out["lines"] = counted(ends, at).tolist()
        space = (of & has["space"]) > 0
        out["pieces"] = counted(np.flatnonzero(space[:-1] & ~space[1:]) + 1, at).tolist()
        return out, tuple(counted(where[k], ends).tolist() for k in ("odd", "han", "piece"))

    @staticmethod
    def _words(texts: list[str]) -> list[str]:
        """The words of each text in small letters, a blank for every other character."""
        cps = np.frombuffer("\x00".join([t.replace("\x00", " ") for t in texts]).lower().encode("utf-32-le"), np.uint32)
        letter = classes()[cps] & np.uint8(1 << list(CLASSES).index("letter"))
        return np.where((letter > 0) | (cps == 0), cps, np.uint32(32)).astype("<u4").tobytes().decode("utf-32-le").split("\x00")

    def _all_but_sense(self, value: str, text: str, words: str, n: dict[str, int], odd: list[int], han: list[int], pieces: list[int]) -> tuple[dict[str, float], str]:
        """words, n, odd, han, pieces: what _words() and _counts() have of the text and of its lines."""
        kept = []
        for x, signs, ideographs, p in zip(text.split("\n"), odd, han, pieces):
            if s := x.strip():
                w = len(s) + 2 * ideographs  # weight(s)
                c = cells(x)
                row = data_row(x, c)
                if self.lines.verdict(x, row, w) != "furniture":
                    kept.append((s, w, c, row, MARKER.match(s), closed(s), signs, p + 1))
        total = sum(w for _, w, *_ in kept) or 1
        rows, items, closes, n_closed = 0, 0, 0, 0
        for i, (s, w, c, row, marker, end, signs, p) in enumerate(kept):
            if end:
                n_closed += 1
            if i == 0 and len(kept) > 3 and not end and w < 130 and not marker and not row:
                total -= w  # a title is neither item nor row
            elif p >= 8 and self._enumeration(s):
                items += w
            elif signs > 0.12 * len(s):
                pass  # mostly signs: no item and no row
            elif (c >= 2 and (row or w < 160)) and not (end and w >= 60):
                rows += w
            elif w < 110 and (marker and not (end and w >= 60) or not end):
                items += w
            elif end or w >= 110:
                closes += w
        bare = [s[marker.end() :] if marker else s for s, _, _, _, marker, *_ in kept]
        variety = self._variety(" ".join(bare))
        coded = 3 * n["digit"] >= n["pieces"] and 3 * len(MIXED.findall(text)) >= n["pieces"]
        total = max(total, 1)
        n_letters = len(words) - words.count(" ")
        words = words.split()
        solid = max(len(text) - n["blank"] - (n["lines"] - 1), 1)
        out = {
            "item_share": items / total, "row_share": rows / total, "closed_share": closes / total, "variety": variety, "restored": float(text != value),
            "log_words": math.log1p(len(words) if not n["han"] else n_letters / 2) / math.log(10), "mean_word_length": n_letters / len(words) if words else 0.0,
            "symbol_ratio": n["sign"] / solid, "common_word_share": sum(map(self.common.__contains__, words)) / len(words) if words else 0.0, "closed_line_share": n_closed / max(len(kept), 1),
        }
        if self.full:
            out |= {"words": float(len(words)), "lines": float(len(kept)), "digit_ratio": n["digit"] / solid, "han_share": n["han"] / solid, "letter_share": n_letters / solid}
        return out, "" if coded else "\n".join(bare).replace("\x00", " ")

    @staticmethod
    def _enumeration(s: str) -> bool:
        """A list on one line: many short pieces between commas or semicolons, and at most one sentence end."""
        p = PIECES.split(s)
        return len(p) >= 8 and weight(s) / len(p) < 36 and len(ENDS.findall(s)) <= 1

    @staticmethod
    def _variety(text: str) -> float:
        """Distinct pieces over pieces; a piece is a word with its signs, or a pair of characters where blanks are few. 1 for under 12 pieces."""
        p = text.split(None, 120)
        if len(p) > 120 and len(set(p[:120])) >= 60:
            return 1.0
        p = text.split()
        if len(p) < 12:
            s = "".join(p)
            p = [s[i : i + 2] for i in range(len(s) - 1)]
        return min(1.0, len(set(p)) / min(len(p), 60)) if len(p) >= 12 else 1.0

    def _senses(self, texts: list[str]) -> np.ndarray:
        """Mean log-probability of the pairs of letters of each text; -9 where there are hardly any. All at once."""
        cps = np.frombuffer("\x00".join(texts).encode("utf-32-le"), np.uint32)
        if len(cps) < 2:
            return np.full(len(texts), -9.0)
        row = np.cumsum(cps == 0)
        is_letter = letters()[np.minimum(cps, 0x1FFFF)]
        at = np.flatnonzero(is_letter[1:] & is_letter[:-1])
        c = np.minimum(cps, 0x1FFFF)
        s = self.decoder.lm.of_pairs(c[at], c[at + 1])
        n = np.bincount(row[at], minlength=len(texts))
        mean = np.bincount(row[at], s, len(texts)) / np.maximum(n, 1)
        return np.where(n >= 10, np.clip(mean, -9, -1), -9.0)


KIND = ["restored"]
ALL = ["words", "lines", "digit_ratio", "han_share", "letter_share"]


def common_words(texts: DataFrame) -> frozenset[str]:
    """The COMMON words that most texts hold, counted over all of them; ties go by the alphabet."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    n = texts.select(F.explode(words).alias("w")).where(F.length("w").between(1, LONGEST)).groupBy("w").count()
    return frozenset(r.w for r in n.orderBy(F.desc("count"), "w").limit(COMMON).collect())


def figures(texts: DataFrame, fig: Figures, rewrites: bool = True) -> DataFrame:
    """(kind_of_text, h, g, figures ...; restored is 1 for a wrongly decoded text) of every distinct source text and, unless left out, every rewrite. Blank ones have no row."""
    names = [*(ALL if fig.full else []), *KIND, *FEATURES]

    def run(it):
        for b in batches(it, ["text"], 1 << 20):
            found = fig.many(b.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *[pa.array([f[k] for f in found], pa.float64()) for k in names]], names=["kind_of_text", *KEY, *names])

    kinds = [SOURCE, REWRITE] if rewrites else [SOURCE]
    asked = texts.where(F.col("kind").isin(kinds) & F.col("text").rlike(r"\S")).select("kind", *KEY, "text")
    return asked.mapInArrow(run, "kind_of_text int, h long, g long, " + ", ".join(f"{n} double" for n in names))


def of_records(records: DataFrame, named: DataFrame) -> DataFrame:
    """(uid, field, figures ...) of the records that hold the texts; a record delivered twice has one row per field."""
    keys = corpus.keyed(records, "uid", kinds=(SOURCE, REWRITE)).dropDuplicates(["uid", "kind"]).withColumnRenamed("kind", "kind_of_text")
    field = F.when(F.col("kind_of_text") == SOURCE, F.lit("_source_text")).otherwise(F.lit("content")).alias("field")
    return keys.join(named, ["kind_of_text", *KEY]).select("uid", field, *[c for c in named.columns if c not in ("kind_of_text", *KEY)])


class Mixture:
    """A Gaussian mixture with diagonal covariances over the standardized figures, and the kind of each component."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, at: np.ndarray):
        """Components start at the rows of `at`, the examples."""
        self.mean, self.scale = mean, scale
        self.mu = np.unique((at - mean) / scale, axis=0)
        self.var = np.full_like(self.mu, 0.5)
        self.start = np.concatenate([np.ones((len(self.mu), 1)), self.mu, self.mu**2 + 0.25], axis=1)
        self.pi = np.full(len(self.mu), 1 / len(self.mu))
        self.kind = None

    def expected(self, x: np.ndarray, w: np.ndarray | float = 1.0) -> np.ndarray:
        """E step over rows x: per component its weight, the sums and the sums of squares of each feature, and in the last row the log-likelihood."""
        z = (x - self.mean) / self.scale
        p, like = self._posterior(z)
        r = p * np.broadcast_to(w, len(z))[:, None]
        out = np.concatenate([r.sum(axis=0)[:, None], r.T @ z, r.T @ z**2], axis=1)
        return np.concatenate([out, np.full((1, out.shape[1]), float((like * w).sum()))])

    def maximize(self, s: np.ndarray, held: float) -> None:
        """M step; each component is held at its example as by `held` texts, so that it doesn't drift to another kind."""
        k = self.mu.shape[1]
        s = np.concatenate([s[:-1] + held * self.start, s[-1:]])
        n = s[:-1, :1] + 1e-9
        self.pi = (n / n.sum())[:, 0]
        self.mu = np.where(n > 1e-6, s[:-1, 1 : k + 1] / n, self.mu)
        self.var = np.where(n > 1e-6, np.maximum(s[:-1, k + 1 :] / n - self.mu**2, 0.02), self.var)

    def _posterior(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # a product of matrices: nothing of rows x components x features is ever held
        inv = 1 / self.var
        lp = np.log(self.pi + 1e-12) - 0.5 * (z**2 @ inv.T - 2 * z @ (self.mu * inv).T + (self.mu**2 * inv + np.log(self.var)).sum(axis=1))
        top = lp.max(axis=1, keepdims=True)
        p = np.exp(lp - top)
        total = p.sum(axis=1, keepdims=True)
        return p / total, (top + np.log(total))[:, 0]

    def name(self, x: np.ndarray, kinds: list[str]) -> None:
        """Components get the kind of the examples that they explain best, and those without one that of the nearest example."""
        z = (x - self.mean) / self.scale
        p, _ = self._posterior(z)
        self.kind = []
        for j in range(len(self.mu)):
            score = {k: sum(p[i, j] for i in range(len(kinds)) if kinds[i] == k) for k in KINDS}
            best = max(score, key=score.get)
            if score[best] < 0.5:
                best = kinds[int(np.argmin(((z - self.mu[j]) ** 2).sum(axis=1)))]
            self.kind.append(best)

    def kinds(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """(kind, its posterior) of each row."""
        p, _ = self._posterior((x - self.mean) / self.scale)
        by = np.stack([p[:, [j for j in range(len(self.kind)) if self.kind[j] == k]].sum(axis=1) for k in KINDS], axis=1)
        return [KINDS[i] for i in by.argmax(axis=1)], by.max(axis=1)


def in_range(x: np.ndarray) -> np.ndarray:
    return np.clip(x, *RANGE.T)


def _rows(b: pa.RecordBatch) -> np.ndarray:
    return in_range(np.stack([np.asarray(b.column(b.schema.get_field_index(c))) for c in FEATURES], axis=1))


def fit_mixture(figs: DataFrame, fig: Figures) -> Mixture:
    """EM over the figures of all texts, from the examples.

    The E step of each round runs where the rows are; a task sends its sums (components x features), whatever the corpus."""
    ex = in_range(np.array([[fig.one(v)[c] for c in FEATURES] for k in KINDS for v in EXAMPLES[k]]))
    names = [k for k in KINDS for _ in EXAMPLES[k]]
    x = [F.least(F.greatest(F.col(c), F.lit(float(lo))), F.lit(float(hi))) for c, (lo, hi) in zip(FEATURES, RANGE)]
    m = figs.agg(F.count("*").alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(x)]).first()
    n = m["n"]
    mean = np.array([m[f"m{i}"] or 0.0 for i in range(len(FEATURES))])
    scale = np.array([m[f"s{i}"] or 0.0 for i in range(len(FEATURES))]) + 1e-2
    mix = Mixture(mean, scale, ex)
    last = None
    for _ in range(ROUNDS if n else 0):

        def expect(it, mix=mix):
            total = np.zeros((len(mix.mu) + 1, 2 * len(FEATURES) + 1))
            for b in it:
                if b.num_rows:
                    total += mix.expected(_rows(b))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], names=["i", "v"])

        got = figs.select(*FEATURES).mapInArrow(expect, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
        s = np.zeros((len(mix.mu) + 1) * (2 * len(FEATURES) + 1))
        s[np.asarray(got["i"])] = np.asarray(got["v"])
        s = s.reshape(len(mix.mu) + 1, -1)
        mix.maximize(s, max(1.0, HELD * n))
        like = s[-1, 0] / n
        if last is not None and like - last < LEAST_GAIN:
            break
        last = like
    mix.name(ex, names)
    return mix


def named(figs: DataFrame, mixture: Mixture) -> DataFrame:
    """figs with kind and its posterior."""
    names = figs.columns

    def run(it):
        for b in it:
            if b.num_rows:
                k, p = mixture.kinds(_rows(b))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(k), pa.array(p)], names=[*names, "kind", "posterior"])

    return figs.mapInArrow(run, figs.withColumn("kind", F.lit("")).withColumn("posterior", F.lit(0.0)).schema)
