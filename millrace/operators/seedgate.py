"""Seed gates. A gate never drops a row: it gives a reason, and the caller filters; counts come for free.

Every function works row by row on columns, so the plan is one scan without a shuffle, except where dedup and
limits need one. Null texts count as empty and fail the length gate.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions import patterns as P
from ..functions.text import bind, count_of, first_text, raw_lines, rstrip_u, sentences, split_lines, strip_u, stripped_lines

MIN_CHARS, MAX_CHARS = 500, 8000


def seed_text(df: DataFrame, out: str = "text") -> DataFrame:
    """`out` from _source_text, content or text, whichever is there first (missing columns are skipped)."""
    have = [F.col(c) for c in ("_source_text", "content", "text") if c in df.columns]
    return df.withColumn(out, first_text(*have) if have else F.lit(""))


def is_tail_context(c: Column) -> Column:
    return c.rlike(P.TAIL_CONTEXT)


def tail_marker(line: Column) -> Column:
    """The first marker of the list that the line holds, else the name of a pattern, else null."""
    tests = []
    for m in P.TAIL_MARKERS:
        hit = F.contains(line, F.lit(m))
        tests.append(F.when(hit & ~line.rlike(P.TAIL_MARKER_EXCEPTION) if m == "阅读原文" else hit, F.lit(m)))
    return F.coalesce(*tests, *[F.when(line.rlike(p), F.lit(name)) for p, name in P.TAIL_PATTERNS])


def edit_head(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """struct(text, removed): the page without wrapper lines at its head.

    Among the first 14 lines (within 900 characters) a wrapper line goes if no body line came yet or it is one of the first
    8; a body line has 45 characters and no wrapper words. Nothing goes if less than min_chars would be left."""
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("before"), F.lit(False).alias("body"), F.array().cast("array<string>").alias("kept"), F.array().cast("array<string>").alias("removed"))

    def step(a: Column, line: Column) -> Column:
        raw, s = line["raw"], line["s"]
        head = (a["i"] < 14) & (a["before"] <= 900)
        body = a["body"] | (head & (F.length(s) >= 45) & ~is_tail_context(s))
        gone = head & s.rlike(P.HEAD_NOISE) & (~body | (a["i"] < 8))
        return F.struct(
            (a["i"] + 1).alias("i"), (a["before"] + F.length(raw) + 1).alias("before"), body.alias("body"),
            F.when(gone, a["kept"]).otherwise(F.array_append(a["kept"], raw)).alias("kept"),
            F.when(gone, F.array_append(a["removed"], F.when(F.length(s) > 0, F.left(s, F.lit(24))).otherwise(F.lit("blank")))).otherwise(a["removed"]).alias("removed"))

    def whole(lines: Column) -> Column:
        top = F.transform(F.slice(lines, 1, 14), lambda x: F.struct(x.alias("raw"), strip_u(x).alias("s")))
        rest = F.when(F.size(lines) > 14, F.slice(lines, 15, F.greatest(F.size(lines), F.lit(1)))).otherwise(F.array().cast("array<string>"))
        done = F.aggregate(top, start, step, lambda a: F.struct(strip_u(F.array_join(F.concat(a["kept"], rest), "\n")).alias("left"), a["removed"].alias("removed")))
        return bind(done, finish)

    def finish(a: Column) -> Column:
        use = (F.size(a["removed"]) > 0) & (F.length(a["left"]) >= min_chars)
        return F.struct(F.when(use, a["left"]).otherwise(text).alias("text"), F.when(use, F.slice(a["removed"], 1, 3)).otherwise(F.array().cast("array<string>")).alias("removed"))

    return bind(split_lines(text), whole)


def edit_tail(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """struct(text, marker): the page cut before the first line with a tail marker that stands late enough and leaves min_chars."""
    n = F.length(text)
    start = F.struct(F.lit(0).alias("pos"), F.lit(-1).alias("cut"), F.lit(None).cast("string").alias("marker"))

    def step(a: Column, line: Column) -> Column:
        raw, s, m = line["raw"], line["s"], line["m"]
        late = (a["pos"] >= n * 0.45) | (n - a["pos"] <= 1400)
        fits = (F.length(s) <= 90) | m.isin(P.TAIL_STRONG) | is_tail_context(s)
        hit = (a["cut"] < 0) & m.isNotNull() & late & fits & (F.length(strip_u(F.left(text, a["pos"]))) >= min_chars)
        return F.struct((a["pos"] + F.length(raw)).alias("pos"), F.when(hit, a["pos"]).otherwise(a["cut"]).alias("cut"), F.when(hit, m).otherwise(a["marker"]).alias("marker"))

    lines = F.transform(raw_lines(text), lambda x: F.struct(x.alias("raw"), strip_u(x).alias("s")))
    lines = F.transform(lines, lambda x: F.struct(x["raw"].alias("raw"), x["s"].alias("s"), tail_marker(x["s"]).alias("m")))
    return F.aggregate(lines, start, step, lambda a: F.struct(F.when(a["cut"] >= 0, strip_u(F.left(text, a["cut"]))).otherwise(text).alias("text"), a["marker"].alias("marker")))


def with_edits(df: DataFrame, text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """text edited at head and tail, edit_reason ('head:...;tail:...', or 'unchanged')."""
    d = df.withColumn(text, strip_u(F.col(text))).withColumn("_head", edit_head(F.col(text), min_chars))
    d = d.withColumn("_tail", edit_tail(F.col("_head.text"), min_chars))
    head = F.when(F.size("_head.removed") > 0, F.concat(F.lit("head:"), F.array_join("_head.removed", ",")))
    tail = F.when(F.col("_tail.marker").isNotNull(), F.concat(F.lit("tail:"), F.col("_tail.marker")))
    reason = F.when(F.length(text) == 0, F.lit("empty")).otherwise(F.coalesce(F.nullif(F.concat_ws(";", head, tail), F.lit("")), F.lit("unchanged")))
    return d.withColumn("edit_reason", reason).withColumn(text, F.col("_tail.text")).drop("_head", "_tail")


RANGE_REASON = ArrayType(StructType([StructField(n, StringType()) for n in ("label", "match", "left", "right")]))
_DATE, _RANGE, _TIME = re.compile(P.DATE_LIKE), re.compile(P.NUMBER_RANGE), re.compile(P.TIME_RANGE)
_CODE = re.compile("(?:" + "|".join(f"{c}(?:/T)?" if c not in ("ISO", "ASTM", "DIN", "EN", "JIS") else c for c in P.STANDARD_CODES) + r")\s*$", re.IGNORECASE)


def descending_ranges(text: str) -> list[dict[str, str]]:
    """Ranges whose right number is under the left one. Dates are blanked out first; numbers after the name of a standard, and
    times and dates of whole numbers within 16 characters, are none."""
    scan = _DATE.sub(" ", text)
    out = []
    for m in _RANGE.finditer(scan):
        low, high = m.groups()
        if float(high) >= float(low) or _CODE.search(scan[max(0, m.start() - 24) : m.start()]):
            continue
        whole = "." not in low and "." not in high
        if whole and _TIME.search(scan[max(0, m.start() - 16) : m.end() + 16]):
            continue
        out.append({"label": "descending_numeric_range", "match": m.group(), "left": low, "right": high})
    return out


@F.pandas_udf(RANGE_REASON)
def _range_reasons(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: descending_ranges(t or ""))


def numeric_reasons(text: Column) -> Column:
    """The descending ranges of a text; Python sees only the few texts in which the JVM finds a range at all."""
    maybe = F.coalesce(text, F.lit("")).rlike("(?U)" + P.NUMBER_RANGE)
    return F.when(maybe, _range_reasons(F.when(maybe, text))).otherwise(F.array().cast(RANGE_REASON))


def ocr_reason(text: Column) -> Column:
    return F.when(count_of(text, P.OCR_PUNCT) * 100 / F.greatest(F.length(text), F.lit(1)) >= 1.5, F.lit("ocr_garble_punct"))


def low_density_reason(text: Column) -> Column:
    """The first structural reason that applies, else null: empty, OCR, links, marketing, short lines, repeated lines."""

    def figures(d: Column) -> Column:
        return F.struct(d.alias("d"), stripped_lines(d).alias("lines"), sentences(d).alias("sents"))

    def counts(x: Column) -> Column:
        lines = x["lines"]
        long_lines = F.array_sort(F.filter(lines, lambda v: F.length(v) >= 6))
        return F.struct(
            x["d"].alias("d"), F.size(lines).alias("n"), F.size(x["sents"]).alias("sents"), F.size(F.filter(x["sents"], lambda v: F.length(v) >= 30)).alias("long"), F.size(F.filter(lines, lambda v: F.length(v) < 12)).alias("short"),
            F.size(F.filter(lines, lambda v: v.rlike(P.LINK_LINE) | (F.contains(v, F.lit(" | ")) & (F.length(v) < 80)) | v.rlike(P.NAV_LINE))).alias("links"),
            F.size(F.filter(lines, is_tail_context)).alias("talk"), bind(long_lines, repeats).alias("repeated"))

    def repeats(s: Column) -> Column:
        # repeated lines lie side by side once sorted: n log n, not n squared
        return F.size(F.filter(F.transform(s, lambda v, i: F.coalesce(v == F.get(s, i - 1), F.lit(False)) | F.coalesce(v == F.get(s, i + 1), F.lit(False))), lambda v: v))

    def reason(x: Column) -> Column:
        n = F.greatest(x["n"], F.lit(1))
        return F.coalesce(
            F.when(F.length(x["d"]) == 0, F.lit("empty")), ocr_reason(x["d"]),
            F.when((x["n"] >= 8) & (x["links"] / n > 0.7), F.lit("pure_link_navigation")),
            F.when((x["n"] >= 6) & (x["talk"] / n > 0.6) & (x["long"] < 2), F.lit("pure_marketing_conversion")),
            F.when((x["short"] / n > 0.75) & (x["long"] < 2) & (F.length(x["d"]) < 1200), F.lit("short_line_low_density")),
            F.when((x["sents"] >= 8) & (x["repeated"] / n > 0.45) & (x["long"] < 3), F.lit("repetitive_low_density")))

    return bind(bind(bind(strip_u(F.coalesce(text, F.lit(""))), figures), counts), reason)


def english_labels(text: Column) -> Column:
    """Risk labels of an English seed, each once, in fixed order."""

    def first(t: Column) -> Column:
        tail = rstrip_u(t)
        low = F.lower(t)
        return F.struct(t.alias("t"), low.alias("low"), stripped_lines(low).alias("lines"), count_of(low, P.EN_URL).alias("urls"), count_of(t, r"\p{L}").alias("letters"), count_of(t, P.NON_LATIN).alias("foreign"), tail.alias("tail"), F.regexp_extract(tail, r"(?U)(\S*)\z", 1).alias("last"))

    return bind(bind(F.coalesce(text, F.lit("")), first), _english_labels)


def _english_labels(x: Column) -> Column:
    t, low, lines, urls, letters, foreign, tail, last = (x[k] for k in ("t", "low", "lines", "urls", "letters", "foreign", "tail", "last"))
    n = F.length(t)
    open_end = (n >= 300) & (count_of(tail, "[.!?]") >= 3) & ~tail.rlike(P.EN_SENTENCE_END)
    lows = F.regexp_extract_all(t, F.lit(P.EN_RANGE), F.lit(1))
    highs = F.regexp_extract_all(t, F.lit(P.EN_RANGE), F.lit(2))
    falling = F.exists(F.zip_with(lows, highs, lambda a, b: F.coalesce(b.try_cast("double") < a.try_cast("double"), F.lit(False))), lambda x: x)
    tests = [
        ("web_wrapper_noise", (count_of(low, P.EN_WRAPPER) >= 2) | F.exists(lines, lambda x: x.rlike(P.EN_WRAPPER_LINE)) | low.rlike(P.EN_ACCOUNT)),
        ("url_link_heavy", (urls >= 3) | ((urls >= 1) & (urls * 80 > n))),
        ("html_artifact", low.rlike(P.HTML)),
        ("encoding_artifact", t.rlike(P.ENCODING) | t.rlike(P.EN_MOJIBAKE)),
        ("non_english_text", ((letters >= 200) & (count_of(t, "[A-Za-z]") / F.greatest(letters, F.lit(1)) < 0.65)) | (foreign >= 40) | (foreign / F.greatest(n, F.lit(1)) > 0.05)),
        ("forum_personal_fragment", low.rlike(P.EN_FORUM) | low.rlike(P.EN_PERSONAL)),
        ("ecommerce_affiliate_promotion", low.rlike(P.EN_PROMO_SINGLE) | (count_of(low, P.EN_PROMO) >= 2) | (count_of(low, P.EN_SOFT_PROMO) >= 2) | (low.rlike(P.EN_SERVICE_DOMAIN) & (count_of(low, P.EN_SERVICE_WORDS) >= 5))),
        ("bibliographic_metadata_fragment", low.rlike(P.EN_BIBLIOGRAPHIC)),
        ("course_listing_fragment", low.rlike(P.EN_COURSE) & (F.size(lines) <= 30)),
        ("abrupt_truncation", open_end & (((F.length(last) <= 5) & tail.rlike(P.EN_TAIL)) | ((F.length(tail) >= 7900) & last.rlike(r"\A[A-Za-z]{1,12}\z")))),
        ("corrupted_numeric_range", falling),
    ]
    return F.array_compact(F.array(*[F.when(test, F.lit(label)) for label, test in tests]))


def gate(df: DataFrame, text: str = "text", min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> DataFrame:
    """The loader's chain: length, clip, edits, length, numbers, density. Adds drop_reason (null: kept) and edit_reason; `text` becomes the edited text."""
    d = df.withColumn(text, strip_u(F.coalesce(F.col(text), F.lit("")))).withColumn("_short", F.length(text) < min_chars)
    d = d.withColumn(text, F.left(F.col(text), F.lit(max_chars)))
    d = with_edits(d, text, min_chars)
    # through an explode of one: a filter on the reason would be pushed into the edits, where Spark plans no Python function
    d = d.withColumn("_edited", F.explode(F.array(F.struct(F.col(text).alias("text"), "edit_reason"))))
    d = d.withColumn(text, F.col("_edited.text")).withColumn("edit_reason", F.col("_edited.edit_reason")).drop("_edited")
    d = d.withColumn("_ranges", numeric_reasons(F.col(text)))
    reason = F.coalesce(
        F.when(F.col("_short"), F.lit("too_short")), F.when(F.length(text) < min_chars, F.lit("too_short_after_edit")),
        F.when(F.size("_ranges") > 0, F.lit("descending_numeric_range")), low_density_reason(F.col(text)))
    return d.withColumn("drop_reason", reason).drop("_short", "_ranges")


def dedup(df: DataFrame, text: str = "text", pos: str = "seed_pos", max_chars: int | None = MAX_CHARS, compat: bool = False) -> DataFrame:
    """The first row by pos of each text clipped to max_chars. compat keeps every row over max_chars, as a collector does that
    looks for the whole text among clipped ones. Texts meet by their digest; a frequent text is first reduced to one row per task."""
    d = df.withColumn("_clipped", rstrip_u(F.left(F.col(text), F.lit(max_chars))) if max_chars else F.col(text)).withColumn("_key", F.sha2("_clipped", 256))
    first = d.groupBy("_key").agg(F.min(pos).alias(pos))
    # the pair (text, position) is never hot, however many rows hold the text
    kept = d.join(first, ["_key", pos], "left_semi")
    if compat and max_chars:
        over = F.length(text) > max_chars
        kept = kept.where(F.coalesce(~over, F.lit(True))).unionByName(d.where(over))
    return kept.withColumn(text, F.col("_clipped")).drop("_clipped", "_key").select(*df.columns)


def first_n(df: DataFrame, n: int, pos: str = "seed_pos") -> DataFrame:
    """The first n rows by pos (a top-n sort, not a full one)."""
    return df.orderBy(pos).limit(n)


def collect(df: DataFrame, text: str = "text", pos: str = "seed_pos", min_chars: int | None = None, max_chars: int | None = None, english: bool = False, limit: int | None = None, max_scan: int | None = None, compat: bool = False) -> DataFrame:
    """The collector: empties and repeats out, short ones out, clip, English labels, first `limit` by pos."""
    d = df if max_scan is None else first_n(df, max_scan, pos)
    d = d.where(F.length(F.coalesce(F.col(text), F.lit(""))) >= max(min_chars or 1, 1))
    if english:
        clipped = rstrip_u(F.left(F.col(text), F.lit(max_chars))) if max_chars else F.col(text)
        d = d.where(F.size(english_labels(clipped)) == 0)
    d = dedup(d, text, pos, max_chars, compat)
    return d if limit is None else first_n(d, limit, pos)


def collect_stats(df: DataFrame, text: str = "text", min_chars: int | None = None, max_chars: int | None = None, english: bool = False) -> DataFrame:
    """One row of counts over the distinct texts that the collector sees: scanned, candidates, clipped, short, quality drops."""
    n = F.length(F.coalesce(F.col(text), F.lit("")))
    clipped = rstrip_u(F.left(F.col(text), F.lit(max_chars))) if max_chars else F.col(text)
    bad = (F.size(english_labels(clipped)) > 0) if english else F.lit(False)
    long_enough = n >= (min_chars or 1)
    return df.agg(
        F.count("*").alias("seed_scanned"), F.count_if(long_enough & (n > 0)).alias("seed_candidates_ge_min_chars"),
        F.count_if(long_enough & (n > (max_chars or 1 << 30))).alias("seed_truncated_to_max_chars"), F.count_if((n > 0) & ~long_enough).alias("seed_dropped_short"),
        F.count_if((n > 0) & long_enough & bad).alias("seed_dropped_quality"))
