"""Reports: schema and length checks, call performance, scores, weak samples, anchors, samples, corpus profile.

Rates and means stay unrounded; rounding belongs to whoever prints them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import patterns as P
from ..functions.text import clip, count_of, is_zh, nonblank, snippet, split_lines, strip_u


def positional(df: DataFrame, by: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """Per group the element at int(p * (n - 1)) of the sorted values, for each named p: counted by value first, so a hot
    group is added up from one row per distinct value."""
    c = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*by).orderBy(value)
    c = c.withColumn("_to", F.sum("_n").over(w)).withColumn("_all", F.sum("_n").over(Window.partitionBy(*by)))
    at = lambda p: F.floor(F.lit(p) * (F.col("_all") - 1))
    inside = lambda p: (at(p) < F.col("_to")) & (at(p) >= F.col("_to") - F.col("_n"))
    return c.groupBy(*by).agg(*[F.max(F.when(inside(p), F.col(value))).alias(name) for name, p in points.items()])


def min_length(style: Column, internal: Column) -> Column:
    table = lambda m: F.create_map(*[F.lit(x) for kv in m.items() for x in kv])
    by_internal = F.coalesce(F.try_element_at(table(P.MIN_LENGTH_INTERNAL), internal), F.lit(P.DEFAULT_MIN_LENGTH))
    by_style = F.coalesce(F.try_element_at(table(P.MIN_LENGTH), style), F.lit(P.DEFAULT_MIN_LENGTH))
    return F.when(internal.isNotNull() & (internal != ""), by_internal).otherwise(by_style)


def l0_report(records: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts and rates of the artifact checks, one row, or one per group of `by`. Null content counts as empty."""
    by = by or []
    c = F.coalesce(F.col("content"), F.lit(""))
    style, internal = F.col("style"), F.col("_internal_style") if "_internal_style" in records.columns else F.lit(None).cast("string")
    fields = F.col("uid").isNotNull() & F.col("content").isNotNull() & F.col("style").isNotNull()
    present = lambda ms, t: sum((F.contains(t, F.lit(m)).cast("int") for m in ms), F.lit(0))
    n = F.greatest(F.count("*"), F.lit(1))
    leaks = any(x.startswith("_") for x in records.columns)
    return records.groupBy(*by).agg(
        F.count("*").alias("n"), (F.count_if(fields) / n).alias("field_complete_rate"), F.lit(set(records.columns) == {"uid", "content", "style"}).alias("official_schema_exact"),
        (F.count_if(F.coalesce(style.isin(P.VALID_STYLES), F.lit(False))) / n).alias("style_valid_rate"), (F.count_if(nonblank(c)) / n).alias("nonempty_rate"),
        F.when(F.lit(leaks), F.count("*")).otherwise(F.lit(0)).alias("underscore_field_leak_count"), F.coalesce(F.sum(present(P.QA_MARKERS, c)), F.lit(0)).alias("qa_marker_hit_count"),
        F.coalesce(F.sum(present(P.STYLE_MARKERS, F.lower(c))), F.lit(0)).alias("internal_style_marker_hit_count"),
        F.count_if(c.rlike(P.ENCODING)).alias("encoding_artifact_hit_count"), F.count_if(F.lower(c).rlike(P.HTML)).alias("html_artifact_hit_count"),
        F.count_if(F.length(c) < min_length(style, internal)).alias("len_warning_below_min"), F.count_if(F.length(c) > P.LONG).alias("len_above_9000"))


def l0_lengths(records: DataFrame, by: list[str]) -> DataFrame:
    """len_p05, len_p50, len_p95 per group, positional."""
    return positional(records.withColumn("_len", F.length(F.coalesce("content", F.lit("")))), by, "_len", {"len_p05": 0.05, "len_p50": 0.5, "len_p95": 0.95})


def export(records: DataFrame) -> DataFrame:
    """Only the public columns."""
    return records.select(*[c for c in records.columns if not c.startswith("_")])


def official(records: DataFrame) -> DataFrame:
    return records.select("uid", "content", "style")


def performance(calls: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals and averages of calls; token totals are null where no call has tokens."""
    ok = F.coalesce(F.col("ok"), F.lit(False))
    n = F.count("*")
    per = lambda c: c / F.greatest(n, F.lit(1))
    return calls.groupBy(*(by or [])).agg(
        n.alias("calls"), F.count_if(ok).alias("ok_calls"), per(F.count_if(ok)).alias("success_rate"), F.sum("api_attempts").alias("api_attempts"), F.count_if(F.col("api_attempts") > 1).alias("retried_calls"),
        F.sum("elapsed_seconds").alias("elapsed_seconds"), F.avg("elapsed_seconds").alias("mean_elapsed_seconds"), F.max("elapsed_seconds").alias("max_elapsed_seconds"), F.sum("retry_sleeps_seconds").alias("retry_sleeps_seconds"),
        F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"), F.sum("total_tokens").alias("total_tokens"), F.count("total_tokens").alias("calls_with_usage"),
        F.sum("input_chars").alias("input_chars"), F.sum("output_chars").alias("output_chars"), F.avg("output_chars").alias("mean_output_chars"),
        F.count_if(F.col("finish_reason") == "length").alias("length_finishes"))


def counter(df: DataFrame, value: str, out: str = "n") -> DataFrame:
    """Values (or array items) and how often they occur."""
    kind = dict(df.dtypes)[value]
    d = df.select(F.explode(value).alias(value)) if kind.startswith("array") else df.select(value).where(F.col(value).isNotNull())
    return d.groupBy(value).agg(F.count("*").alias(out))


def most_common(df: DataFrame, value: str, k: int, pos: str) -> DataFrame:
    """The k most frequent values, ties by first occurrence."""
    return df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"), F.min(pos).alias("first")).orderBy(F.desc("n"), "first").limit(k)


def score_summary(df: DataFrame, fields: list[str], by: list[str] | None = None) -> DataFrame:
    """One row per field: n, mean, median and distribution (map score -> count) of the scores there are."""
    by = by or []
    long = df.select(*by, F.explode(F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f).cast("double"))])).alias("field", "score")).where("score is not null")
    dist = long.groupBy(*by, "field", "score").agg(F.count("*").alias("n")).groupBy(*by, "field").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("score").cast("string"), "n")))).alias("distribution"))
    return long.groupBy(*by, "field").agg(F.count("*").alias("n"), F.avg("score").alias("mean"), F.median("score").alias("median")).join(dist, [*by, "field"])


def flag_counts(df: DataFrame, flags: list[str], by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(*[F.count_if(F.col(f)).alias(f) for f in flags])


def map_scores(df: DataFrame, scores: str = "scores") -> DataFrame:
    """Mean and number of each key of a score map."""
    return df.select(F.explode(scores).alias("key", "score")).groupBy("key").agg(F.avg("score").alias("mean"), F.count("score").alias("n_judged"))


def blind_match_rate(df: DataFrame, guessed: str, true: str) -> DataFrame:
    """Share of the judged rows whose guessed style is the true one, case aside."""
    judged = df.where(F.col(guessed).isNotNull())
    return judged.agg(F.avg((F.lower(strip_u(F.col(guessed))) == F.lower(strip_u(F.col(true)))).cast("double")).alias("style_blind_match_rate"), F.count("*").alias("n"))


def weakest(df: DataFrame, order: list[str], k: int = 12, missing: float = 99.0) -> DataFrame:
    """The k lowest rows by the given columns; a missing score sorts as 99."""
    kinds = dict(df.dtypes)
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    keys = [F.coalesce(F.col(c).cast("double"), F.lit(missing)) if kinds[c] in numeric else F.col(c) for c in order]
    return df.orderBy(*keys).limit(k)


def per_flag(df: DataFrame, flags: list[str], order: list[str], k: int = 5) -> DataFrame:
    """Up to k rows of each set flag, lowest first: one explode and one ranked window, which stops at k per flag."""
    long = df.withColumn("flag", F.explode(F.array_compact(F.array(*[F.when(F.col(f), F.lit(f)) for f in flags]))))
    w = Window.partitionBy("flag").orderBy(*order)
    return long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def round_robin(df: DataFrame, style: str, order: list[str], styles: list[str], k: int = 30) -> DataFrame:
    """The first of each style, then the second of each, to k rows. The rank within a style is cut at k, so the window keeps k rows a style."""
    rank = F.row_number().over(Window.partitionBy(style).orderBy(*order))
    place = F.array_position(F.array(*[F.lit(s) for s in styles]), F.col(style))
    d = df.where(F.col(style).isin(styles)).withColumn("rank_in_style", rank).where(F.col("rank_in_style") <= k)
    return d.withColumn("style_rank", place.cast("int")).orderBy("rank_in_style", "style_rank").limit(k)


def quantile_anchors(df: DataFrame, text: str, pos: str, count: int = 8, limit: int = 450) -> DataFrame:
    """Rows at evenly spaced length quantiles from 0.03 to 0.97, each once, the text clipped.

    Lengths are counted first; only the rows of the chosen (length, rank) places are read again."""
    d = df.where(F.col(text).isNotNull()).withColumn("_len", F.length(text))
    hist = d.groupBy("_len").agg(F.count("*").alias("_n"))
    hist = hist.withColumn("_to", F.sum("_n").over(Window.orderBy("_len"))).withColumn("_all", F.sum("_n").over(Window.partitionBy()))
    step = (0.97 - 0.03) / max(count - 1, 1)
    spots = F.transform(F.array(*[F.lit(0.03 + i * step) for i in range(count)]), lambda p: F.bround(p * (F.col("_all") - 1)).cast("long"))
    place = hist.withColumn("_at", F.explode(F.array_distinct(spots))).where((F.col("_at") < F.col("_to")) & (F.col("_at") >= F.col("_to") - F.col("_n"))).select("_len", (F.col("_at") - (F.col("_to") - F.col("_n")) + 1).alias("_k"), (F.col("_at") + 1).alias("place"))
    ranked = d.join(F.broadcast(place.select("_len").distinct()), "_len", "left_semi").withColumn("_k", F.row_number().over(Window.partitionBy("_len").orderBy(pos)).cast("long"))
    return ranked.join(F.broadcast(place), ["_len", "_k"]).select(pos, "place", F.col("_len").alias("length"), clip(F.col(text), limit).alias("anchor"))


def sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows by the order of a seeded hash of the key: the same for the same rows, whatever the partitions."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)


def mean_interval(df: DataFrame, value: str, by: list[str] | None = None, z: float = 1.96) -> DataFrame:
    """n, mean and the normal 95 % interval of the mean."""
    half = F.lit(z) * F.stddev_samp(value) / F.sqrt(F.count(value))
    return df.groupBy(*(by or [])).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), (F.avg(value) - half).alias("low"), (F.avg(value) + half).alias("high"))


def paired(a: DataFrame, b: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Per field means of both versions and of the difference, over the keys that both have."""
    j = a.select(key, *[F.col(f).alias(f"a_{f}") for f in fields]).join(b.select(key, *[F.col(f).alias(f"b_{f}") for f in fields]), key)
    long = j.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"a_{f}").cast("double").alias("a"), F.col(f"b_{f}").cast("double").alias("b")) for f in fields])).alias("x")).select("x.*")
    return long.where("a is not null and b is not null").groupBy("field").agg(F.count("*").alias("n"), F.avg("a").alias("mean_a"), F.avg("b").alias("mean_b"), F.avg(F.col("b") - F.col("a")).alias("delta"))


def question_type(q: Column) -> Column:
    """what, which, who, when, where, why, how, choice, true_false or other, by the question's wording."""
    t = F.lower(strip_u(F.coalesce(q, F.lit(""))))
    first = [("true_false", r"\A(?:true or false|判断题|vrai ou faux|richtig oder falsch|verdadero o falso|verdadeiro ou falso|верно или неверно)"), ("choice", r"(?m)^\s*a[.．、)]|以下哪|下列哪"),
             ("how_many", r"\A(?:how many|how much|combien|wie viele|cuántos|quantos|сколько)|多少"), ("what", r"\A(?:in )?what\b|什么"), ("which", r"\A(?:in )?which\b|哪"), ("who", r"\Awho\b|谁"),
             ("when", r"\Awhen\b|何时|哪一年"), ("where", r"\Awhere\b|哪里"), ("why", r"\Awhy\b|为什么"), ("how", r"\Ahow\b|怎样|如何")]
    return F.coalesce(*[F.when(t.rlike(p), F.lit(n)) for n, p in first], F.lit("other"))


def corpus_profile(df: DataFrame, text: str, by: list[str] | None = None) -> DataFrame:
    """Interpolated percentiles of characters and words, paragraph, list and heading counts."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.size(F.filter(F.split(t, r"(?U)\s+"), lambda x: x != ""))
    lines = split_lines(t)
    has = lambda p: F.size(F.filter(lines, lambda x: x.rlike(p)))
    d = df.select(*(by or []), F.length(t).alias("_c"), words.alias("_w"), F.size(F.filter(F.split(t, r"\n\s*\n"), nonblank)).alias("_p"), has(r"^\s*[-*•]\s").alias("_b"), has(r"^\s*\d+[.)]\s").alias("_n"), has(r"^#{1,6}\s").alias("_h"))
    pts = [0.05, 0.25, 0.5, 0.75, 0.95]
    names = ["p5", "p25", "p50", "p75", "p95"]
    out = d.groupBy(*(by or [])).agg(F.count("*").alias("rows"), F.percentile("_c", F.array(*map(F.lit, pts))).alias("_pc"), F.percentile("_w", F.array(*map(F.lit, pts))).alias("_pw"),
                                     F.avg("_p").alias("avg_paragraphs"), F.count_if(F.col("_b") > 0).alias("rows_with_bullets"), F.count_if(F.col("_n") > 0).alias("rows_with_numbers"), F.count_if(F.col("_h") > 0).alias("rows_with_headings"))
    return out.select(*(by or []), "rows", *[F.col("_pc")[i].alias(f"chars_{n}") for i, n in enumerate(names)], *[F.col("_pw")[i].alias(f"words_{n}") for i, n in enumerate(names)], "avg_paragraphs", "rows_with_bullets", "rows_with_numbers", "rows_with_headings")


def keyword_profile(df: DataFrame, text: str, key: str, words: list[str], samples: int = 5) -> DataFrame:
    """Rows hit, occurrences and the first keys of each keyword."""
    t = F.lower(F.coalesce(F.col(text), F.lit("")))
    hit = df.select(F.col(key).alias("_k"), F.explode(F.array(*[F.struct(F.lit(w).alias("word"), count_of(t, r"\Q" + w.lower() + r"\E").alias("c")) for w in words])).alias("x")).select("_k", "x.*").where("c > 0")
    first = hit.withColumn("_r", F.row_number().over(Window.partitionBy("word").orderBy("_k"))).where(F.col("_r") <= samples).groupBy("word").agg(F.array_sort(F.collect_list("_k")).alias("sample_keys"))
    return hit.groupBy("word").agg(F.count("*").alias("rows_hit"), F.sum("c").alias("occurrences")).join(first, "word")


def extremes(df: DataFrame, text: str, key: str, k: int = 10) -> DataFrame:
    """The k longest and k shortest texts with a one-line snippet."""
    d = df.where(F.col(text).isNotNull()).select(key, F.length(text).alias("length"), snippet(F.col(text)).alias("snippet"))
    return d.orderBy(F.desc("length"), key).limit(k).withColumn("end", F.lit("longest")).unionByName(d.orderBy("length", key).limit(k).withColumn("end", F.lit("shortest")))


def language_of_label(text: Column) -> Column:
    return F.when(is_zh(text), F.lit("zh")).otherwise(F.lit("en"))
