"""Problem 10: one form for texts that look the same.

Method: Arrow text becomes a numpy code-point array; a lookup table over all of Unicode deletes,
replaces or expands code points by gathers and expansion offsets; combining marks are reordered
and composed by searches in a sorted pair table. No string call is made per row.

Taken as equal: full- and half-width forms, composed and decomposed accents, invisible characters,
kinds of blanks and of hyphens, ligatures, variant ideographs (compatibility ideographs, radicals,
variation selectors) and look-alike letters of other scripts. Kept apart: case, missing accents,
super- and subscripts, dashes longer than a hyphen, emoji sequences joined by a joiner.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrowtext import batches, code_points, strings

# Letters of other scripts that are drawn like a Latin letter.
LOOKALIKES = {
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Ӏ": "I",
    "а": "a", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ү": "y", "ѵ": "v",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    "ο": "o", "ν": "v", "ρ": "p", "υ": "u", "χ": "x", "α": "a", "ι": "i", "ϲ": "c", "ϳ": "j",
    # Armenian, Latin extensions
    "Ս": "U", "Օ": "O", "օ": "o", "ս": "u", "հ": "h", "ց": "g", "ո": "n", "ɡ": "g", "ɑ": "a", "ℓ": "l",
}
#: Blanks of any width that stay on the line; all become U+0020.
BLANKS = [0x09, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000]
#: Signs drawn as a short hyphen; all become U+002D.
HYPHENS = [0x2010, 0x2011, 0x2043, 0x02D7, 0x2CBA, 0xFE63, 0xFF0D]
INVISIBLE = [0x034F, 0x115F, 0x1160, 0x3164, 0xFFA0, 0x17B4, 0x17B5, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)]
ZWNJ, ZWJ = 0x200C, 0x200D
#: Scripts in which joiners change the look: Arabic, Syriac, the Indic blocks, Mongolian.
JOINING = [(0x0600, 0x0780), (0x07C0, 0x0800), (0x0840, 0x0DFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1800, 0x18AF)]
EMOJI = [(0x2190, 0x2BFF), (0x1F000, 0x1FAFF)]
TOP = 0x110000
_MAX_EXPANSION = 18


@lru_cache(1)
def tables() -> dict[str, np.ndarray]:
    """Built from the Unicode database; the sizes are fixed by Unicode, about 6 MB."""
    one = np.arange(TOP, dtype=np.int32)  # code point, or -1 deleted, or -2-k for expansion k
    wide: list[str] = []
    special = {c: " " for c in BLANKS} | {c: "-" for c in HYPHENS} | {c: "" for c in INVISIBLE}

    def folded(ch: str) -> str:
        d = unicodedata.decomposition(ch)
        if d.startswith(("<wide>", "<narrow>", "<noBreak>")) or (d.startswith("<compat>") and (0xFB00 <= ord(ch) <= 0xFB4F or 0x2E80 <= ord(ch) <= 0x2FDF or ch in "ĲĳŉǄǅǆǇǈǉǊǋǌǱǲǳﬅſ" or ord(ch) in (0x132, 0x133))):
            return "".join(folded(chr(int(x, 16))) for x in d.split()[1:])
        d = unicodedata.normalize("NFD", ch)
        return ch if d == ch else "".join(folded(x) for x in d)

    for c in range(0x80, 0x323B0):
        if 0xD800 <= c < 0xE000 or 0x4E00 <= c < 0xA000 or 0xAC00 <= c < 0xD7A4 or 0x3400 <= c < 0x4DB6 or 0x20000 <= c < 0x2F800:
            continue
        ch = chr(c)
        if c in special:
            continue
        if unicodedata.category(ch) == "Cf" and c not in (ZWNJ, ZWJ):
            special[c] = ""
            continue
        to = "".join(special.get(ord(x), LOOKALIKES.get(x, x)) for x in folded(ch))
        if to != ch:
            special[c] = to
    special |= {c: "" for c in range(0xE0000, 0xE0080)} | {c: "" for c in range(0xE0100, 0xE01F0)}
    for c, to in special.items():
        if len(to) == 1:
            one[c] = ord(to)
        elif not to:
            one[c] = -1
        else:
            one[c] = -2 - len(wide)
            wide.append(to)
    lengths = np.array([len(w) for w in wide], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    flat = np.array([ord(x) for w in wide for x in w], np.uint32)
    ccc = np.zeros(TOP, np.uint8)
    pairs = []
    for c in range(0xA0, 0x1E000):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        if k := unicodedata.combining(ch):
            ccc[c] = k
        d = unicodedata.decomposition(ch)
        if d and d[0] != "<" and len(x := d.split()) == 2 and unicodedata.normalize("NFC", ch) == ch:
            a, b = (int(y, 16) for y in x)
            a = ord(LOOKALIKES.get(chr(a), chr(a)))
            pairs.append(((a << 21) | b, ord(unicodedata.normalize("NFC", chr(a) + chr(b))[0]) if len(unicodedata.normalize("NFC", chr(a) + chr(b))) == 1 else c))
    pairs = sorted(dict(pairs).items())
    marks = np.zeros(TOP, np.bool_)
    marks[[k & 0x1FFFFF for k, _ in pairs]] = True
    visible_joiner = np.zeros(TOP, np.bool_)
    for lo, hi in JOINING + EMOJI:
        visible_joiner[lo : hi + 1] = True
    return {"one": one, "lengths": lengths, "starts": starts, "flat": flat, "ccc": ccc, "marks": marks, "joins": visible_joiner,
            "keys": np.array([k for k, _ in pairs], np.int64), "to": np.array([v for _, v in pairs], np.uint32)}


def fold(cps: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The one form of every row, as code points and row bounds."""
    t = tables()
    row_of = np.repeat(np.arange(len(offs) - 1, dtype=np.int64), np.diff(offs))
    n = len(cps)
    if n == 0:
        return cps, offs
    first = np.zeros(n, np.bool_)
    first[offs[:-1][np.diff(offs) > 0]] = True
    m = t["one"][cps]
    # joiners are invisible unless they bind emoji or letters of a joining script on both sides
    j = np.flatnonzero((cps == ZWJ) | (cps == ZWNJ))
    if len(j):
        before = np.where(j > 0, cps[np.maximum(j - 1, 0)], 0)
        after = np.where(j + 1 < n, cps[np.minimum(j + 1, n - 1)], 0)
        before = np.where((before == 0xFE0F) & (j > 1), cps[np.maximum(j - 2, 0)], before)
        emoji = np.zeros(len(j), np.bool_)
        indic = np.zeros(len(j), np.bool_)
        for lo, hi in EMOJI:
            emoji |= (before >= lo) & (before <= hi) & (after >= lo) & (after <= hi)
        for lo, hi in JOINING:
            indic |= (before >= lo) & (before <= hi)
        keep = np.where(cps[j] == ZWJ, emoji | indic, indic) & ~first[j]
        m[j[~keep]] = -1
    # CR before LF, or alone, is a line end
    cr = np.flatnonzero(cps == 13)
    if len(cr):
        lf = (cr + 1 < n) & (cps[np.minimum(cr + 1, n - 1)] == 10)
        m[cr] = np.where(lf, -1, 10)
    size = np.ones(n, np.int64)
    size[m == -1] = 0
    ex = np.flatnonzero(m < -1)
    if len(ex):
        size[ex] = t["lengths"][-2 - m[ex]]
    ends = np.cumsum(size)
    out = np.zeros(ends[-1], np.uint32)
    plain = m >= 0
    out[ends[plain] - 1] = m[plain]
    if len(ex):
        k = -2 - m[ex]
        ln = t["lengths"][k]
        inner = np.arange(ln.sum()) - np.repeat(np.cumsum(ln) - ln, ln)
        out[np.repeat(ends[ex] - ln, ln) + inner] = t["flat"][np.repeat(t["starts"][k], ln) + inner]
    row = np.repeat(row_of, size)
    out, row = _order_marks(out, row, t)
    return _compose(out, row, len(offs) - 1, t)


def _order_marks(cps, row, t):
    """Canonical order of neighbouring marks, by one stable sort of the affected runs."""
    c = t["ccc"][cps]
    if not (len(c) and ((c[1:] > 0) & (c[:-1] > c[1:])).any()):
        return cps, row
    run = np.cumsum((c == 0) | np.concatenate([[True], row[1:] != row[:-1]]))
    order = np.lexsort((c, run))
    return cps[order], row[order]


def _compose(cps, row, rows, t):
    """Each mark joins its base where a composed letter exists, mark by mark."""
    for _ in range(_MAX_EXPANSION):
        at = np.flatnonzero(t["marks"][cps[1:]] & (row[1:] == row[:-1])) + 1 if len(cps) > 1 else np.zeros(0, np.int64)
        if not len(at):
            break
        key = (cps[at - 1].astype(np.int64) << 21) | cps[at]
        i = np.minimum(np.searchsorted(t["keys"], key), len(t["keys"]) - 1)
        hit = t["keys"][i] == key
        at, to = at[hit], t["to"][i[hit]]
        if len(at):  # of overlapping hits the first goes first
            ok = np.concatenate([[True], np.diff(at) > 1])
            at, to = at[ok], to[ok]
        if not len(at):
            break
        cps = cps.copy()
        cps[at - 1] = to
        keep = np.ones(len(cps), np.bool_)
        keep[at] = False
        cps, row = cps[keep], row[keep]
    return cps, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int64)


def fold_array(col: pa.Array) -> pa.Array:
    out = strings(*fold(*code_points(col)))
    if col.null_count:
        import pyarrow.compute as pc

        out = pc.if_else(pc.is_valid(col), out, pa.scalar(None, pa.large_string()))
    return out.cast(pa.string())


def with_one_form(df: DataFrame, text: str = "text", out: str = "one_form") -> DataFrame:
    """Every row of df with `out`, the one form of `text`. Null stays null, empty stays empty; a column `out` of df is replaced."""
    cols = [c for c in df.columns if c != out]
    schema = df.select(*cols).withColumn(out, F.lit("")).schema
    schema = type(schema)([*schema.fields[:-1], type(schema.fields[-1])(out, schema.fields[-1].dataType, True)])

    def run(it):
        for b in batches(it, [text], 4 << 20):
            yield pa.RecordBatch.from_arrays([*b.columns, fold_array(b.column(b.schema.get_field_index(text)))], names=[*b.schema.names, out])

    return df.select(*cols).mapInArrow(run, schema)


def equal_looking_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id, text_id): documents of one class look the same; of one text_id they are the same.

    Null and blank texts have no row. Both ids are 128-bit digests, so only ids are shuffled."""
    f = with_one_form(docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).where("_t is not null"), "_t", "_f")
    return f.where(~F.col("_f").rlike(r"\A\s*\z")).select(F.col("_k").alias(key), F.md5("_f").alias("class_id"), F.md5("_t").alias("text_id"))


def equal_looking_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = 2000, salts: int = 64) -> DataFrame:
    """(key_a, key_b), the smaller first: documents that look the same and differ in code points.

    Classes in which all texts are the same leave before the join, whatever their size. A class of more than
    `hot` documents is spread over `salts` tasks. Ids that occur twice count once."""
    c = equal_looking_classes(docs, key, text).dropDuplicates().persist()
    mixed = c.groupBy("class_id", "text_id").agg(F.count("*").alias("n")).groupBy("class_id").agg(F.sum("n").alias("n"), F.count("*").alias("texts")).where("texts > 1").select("class_id", "n")
    c = c.join(mixed, "class_id")
    a = c.select("class_id", F.col(key).alias(f"{key}_a"), F.col("text_id").alias("ta"), F.when(F.col("n") > hot, F.pmod(F.xxhash64(key), F.lit(salts))).otherwise(F.lit(0)).cast("int").alias("salt"))
    b = c.select("class_id", F.col(key).alias(f"{key}_b"), F.col("text_id").alias("tb"), F.explode(F.when(F.col("n") > hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    return a.join(b, ["class_id", "salt"]).where((F.col("ta") != F.col("tb")) & (F.col(f"{key}_a") < F.col(f"{key}_b"))).select(f"{key}_a", f"{key}_b").distinct()
