"""Queries of the core operators over the tables of TESTDATA.md, and their SQL where SQL can say the same.

Every query reads whole tables; limits are there only where they are the operator (top-k, first n, samples)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .cluster import cut, ship, spread
from .functions import jsonish, patterns as P
from .functions.text import first_text, snippet, trigram_support
from .operators import evaluate as E, joins as J, judging, qapairs as Q, runs as R, seedgate as S
from .plans import generate as G

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in ("seed_docs", "documents", "sample_5") else df


#: str.strip() for DuckDB: the blanks of functions.text.BLANK.
_WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


_SEED = f"SELECT seed_pos, {sql_strip("coalesce(nullif(_source_text, ''), nullif(content, ''), nullif(text, ''), '')")} AS t FROM seed_docs"

# ---------------------------------------------------------------- seeds


@query(f"SELECT seed_pos, t AS seed_text FROM ({_SEED})")
def seed_text_fallback(spark, d):
    return S.seed_text(table(spark, d, "seed_docs"), "seed_text").select("seed_pos", "seed_text")


@query(f"SELECT CASE WHEN length(t) < 500 THEN 'too_short' WHEN length(t) > 8000 THEN 'clipped' ELSE 'kept' END AS fate, count(*) AS n, sum(least(length(t), 8000))::BIGINT AS chars FROM ({_SEED}) GROUP BY 1")
def seed_length_gate(spark, d):
    t = S.seed_text(table(spark, d, "seed_docs"), "t")
    n = F.length("t")
    fate = F.when(n < S.MIN_CHARS, "too_short").when(n > S.MAX_CHARS, "clipped").otherwise("kept")
    return t.groupBy(fate.alias("fate")).agg(F.count("*").alias("n"), F.sum(F.least(n, F.lit(S.MAX_CHARS))).alias("chars"))


@query()
def seed_gate(spark, d):
    """The loader's whole chain: every seed with its reason (null: kept), edit and gated text."""
    return S.gate(S.seed_text(table(spark, d, "seed_docs"))).select("seed_pos", "drop_reason", "edit_reason", "text")


@query()
def seed_gate_reasons(spark, d):
    t = S.gate(S.seed_text(table(spark, d, "seed_docs")))
    return t.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason"), (F.col("edit_reason") != "unchanged").alias("edited")).agg(F.count("*").alias("n"))


@query()
def seed_edits(spark, d):
    t = S.with_edits(S.seed_text(table(spark, d, "seed_docs")))
    return t.select("seed_pos", "edit_reason", F.length("text").alias("chars"))


@query()
def numeric_ranges(spark, d):
    """Descending ranges of all documents, one row each."""
    t = table(spark, d, "documents").select("doc_id", F.explode(S.numeric_reasons(F.col("text"))).alias("r"))
    return t.select("doc_id", "r.label", F.col("r.match").alias("match"), F.col("r.left").alias("left_number"), F.col("r.right").alias("right_number"))


@query()
def numeric_guard_decisions(spark, d):
    t = table(spark, d, "documents").withColumn("_r", S.numeric_reasons(F.col("text")))
    return t.groupBy("lang", F.when(F.size("_r") > 0, "reject").otherwise("keep").alias("decision")).agg(F.count("*").alias("n"), F.sum(F.size("_r")).alias("ranges"))


_LINES = "list_filter(list_transform(regexp_split_to_array(t, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}]'), lambda x: " + sql_strip("x") + "), lambda x: x <> '')"
_SENTS = "list_filter(list_transform(regexp_split_to_array(t, '[。？！；;!?\\n\\r]'), lambda x: " + sql_strip("x") + "), lambda x: x <> '')"


@query(f"""
WITH base AS (SELECT lang, {sql_strip("coalesce(text, '')")} AS t FROM documents),
p AS (SELECT lang, t, {_LINES} AS lines, {_SENTS} AS sents FROM base),
f AS (SELECT lang, t, lines, sents, greatest(len(lines), 1) AS n, len(list_filter(sents, lambda x: length(x) >= 30)) AS long,
  len(list_filter(lines, lambda x: length(x) < 12)) AS short,
  len(regexp_extract_all(t, '[。，、；]{{2,}}|[。，、；]{_WS}+[。，、；]|[。，、；]。')) * 100.0 / greatest(length(t), 1) AS weird,
  len(list_filter(lines, lambda x: regexp_matches(x, 'https?://|www\\.|上一篇|下一篇|相关阅读|点击文字即可阅读|^[-*•▶←]') OR (contains(x, ' | ') AND length(x) < 80) OR regexp_full_match(x, '首页|登录|注册|导航|菜单|快速链接|更多|返回|查看详情'))) AS links,
  len(list_filter(lines, lambda x: regexp_matches(x, '二维码|扫码|扫一扫|公众号|朋友圈|转发|在看|点赞|客服|添加微信|福利|回复关键词|点击阅读|阅读原文|相关阅读|相关推荐|往期|推荐|赞赏|投稿|联系方式'))) AS talk,
  len(list_filter(lines, lambda x: length(x) >= 6)) AS long_lines, list_filter(lines, lambda x: length(x) >= 6) AS ll FROM p),
g AS (SELECT *, coalesce(list_sum(list_transform(map_values(list_histogram(ll)), lambda c: CASE WHEN c > 1 THEN c ELSE 0 END)), 0) AS repeated FROM f)
SELECT lang, CASE WHEN length(t) = 0 THEN 'empty' WHEN weird >= 1.5 THEN 'ocr_garble_punct' WHEN len(lines) >= 8 AND links / n > 0.7 THEN 'pure_link_navigation'
  WHEN len(lines) >= 6 AND talk / n > 0.6 AND long < 2 THEN 'pure_marketing_conversion' WHEN short / n > 0.75 AND long < 2 AND length(t) < 1200 THEN 'short_line_low_density'
  WHEN len(sents) >= 8 AND repeated / n > 0.45 AND long < 3 THEN 'repetitive_low_density' ELSE 'ok' END AS reason, count(*) AS n FROM g GROUP BY 1, 2""")
def low_density_reasons(spark, d):
    t = table(spark, d, "documents")
    return t.groupBy("lang", F.coalesce(S.low_density_reason(F.col("text")), F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"SELECT min(seed_pos) AS seed_pos, clipped FROM (SELECT seed_pos, rtrim(left(t, 8000)) AS clipped FROM ({_SEED})) WHERE clipped <> '' GROUP BY clipped")
def seed_dedup(spark, d):
    t = S.seed_text(table(spark, d, "seed_docs"), "clipped").where("clipped <> ''").select("seed_pos", "clipped")
    return S.dedup(t, "clipped")


@query(f"WITH s AS (SELECT seed_pos, t, left(t, 700) AS c FROM ({_SEED}) WHERE t <> ''), f AS (SELECT regexp_replace(c, '{_WS}+$', '') AS c, min(seed_pos) AS first FROM s GROUP BY 1) SELECT seed_pos FROM s JOIN f ON regexp_replace(s.c, '{_WS}+$', '') = f.c WHERE seed_pos = first OR length(t) > 700")
def seed_dedup_compat(spark, d):
    """The collector's quirk: texts over the limit (700 here, so that there are some) are all kept."""
    t = S.seed_text(table(spark, d, "seed_docs"), "t").where("t <> ''").select("seed_pos", "t")
    return S.dedup(t, "t", max_chars=700, compat=True).select("seed_pos")


@query(f"SELECT seed_pos, length(t) AS chars FROM ({_SEED}) WHERE length(t) >= 500 ORDER BY seed_pos LIMIT 200")
def seed_first_n(spark, d):
    t = S.seed_text(table(spark, d, "seed_docs"), "t").where(F.length("t") >= S.MIN_CHARS)
    return S.first_n(t.select("seed_pos", F.length("t").alias("chars")), 200)


@query()
def english_labels(spark, d):
    """Risk labels of every English document."""
    t = table(spark, d, "documents").where("lang = 'en'")
    # through an explode of one, so that the filter isn't pushed into a second evaluation of the labels
    return t.select("doc_id", F.explode(F.array(S.english_labels(F.col("text")))).alias("labels")).where(F.size("labels") > 0)


@query(r"""SELECT label, count(*) AS n FROM (
  SELECT unnest(list_filter([CASE WHEN u >= 3 OR (u >= 1 AND u * 80 > length(t)) THEN 'url_link_heavy' END, CASE WHEN regexp_matches(t, '<(?:/?(?:p|div|br|h[1-6]|a|script|style))\b|&(?:[a-zA-Z][a-zA-Z0-9]+|#\d+|#x[0-9A-Fa-f]+);', 'i') THEN 'html_artifact' END,
    CASE WHEN regexp_matches(t, '\x{fffd}|\x{9225}|\x{e2}[\x{80}-\x{9f}\x{20ac}]|\x{c3}[\x{80}-\x{bf}]|\x{c2}[\x{80}-\x{bf}]') OR regexp_matches(t, '[\x{5e90}\x{6845}\x{8133}\x{87fa}-\x{87ff}\x{9220}-\x{923f}\x{9500}-\x{953f}]') THEN 'encoding_artifact' END,
    CASE WHEN (l >= 200 AND a / greatest(l, 1) < 0.65) OR f >= 40 OR f / greatest(length(t), 1) > 0.05 THEN 'non_english_text' END], lambda x: x IS NOT NULL)) AS label
  FROM (SELECT t, len(regexp_extract_all(t, '(?i)https?://|www\.')) AS u, len(regexp_extract_all(t, '\p{L}')) AS l, len(regexp_extract_all(t, '[A-Za-z]')) AS a,
          len(regexp_extract_all(t, '[\x{0400}-\x{04ff}\x{0590}-\x{05ff}\x{0600}-\x{06ff}\x{3040}-\x{30ff}\x{3400}-\x{9fff}]')) AS f FROM (SELECT coalesce(text, '') AS t FROM documents))) GROUP BY 1""")
def english_label_counts(spark, d):
    """The labels that SQL can count too, over all documents."""
    t = table(spark, d, "documents").select(F.explode(S.english_labels(F.col("text"))).alias("label"))
    return t.where(F.col("label").isin("url_link_heavy", "html_artifact", "encoding_artifact", "non_english_text")).groupBy("label").agg(F.count("*").alias("n"))


@query(f"SELECT count(*) AS seed_scanned, count(*) FILTER (length(t) >= 500) AS seed_candidates_ge_min_chars, count(*) FILTER (length(t) > 8000) AS seed_truncated_to_max_chars, count(*) FILTER (t <> '' AND length(t) < 500) AS seed_dropped_short, 0::BIGINT AS seed_dropped_quality FROM ({_SEED})")
def seed_collect_stats(spark, d):
    return S.collect_stats(S.seed_text(table(spark, d, "seed_docs")), min_chars=S.MIN_CHARS, max_chars=S.MAX_CHARS)


@query()
def seed_collect(spark, d):
    t = S.seed_text(table(spark, d, "seed_docs")).select("seed_pos", "text")
    return S.collect(t, min_chars=S.MIN_CHARS, max_chars=S.MAX_CHARS, english=True)


# ---------------------------------------------------------------- pairs


def _qa(spark, d):
    """The record of each uid, once."""
    t = table(spark, d, "sample_5").where("style = 'qa'")
    return J.first_per_document(t, "uid", ["row_id"])


@query()
def qa_split(spark, d):
    """Every qa record split by the labels of its source's script."""
    t = _qa(spark, d)
    s = F.when(F.col("content").rlike(P.LABELS["zh"][0]), Q.split(F.col("content"), "zh")).otherwise(Q.split(F.col("content"), "en"))
    return t.select("uid", s.alias("s")).select("uid", F.length("s.seed_text").alias("seed_chars"), F.size("s.pairs").alias("n_pairs"), "s.failure_reason")


@query()
def qa_pairs(spark, d):
    t = _qa(spark, d)
    s = F.when(F.col("content").rlike(P.LABELS["zh"][0]), Q.split(F.col("content"), "zh")).otherwise(Q.split(F.col("content"), "en"))
    return t.select("uid", F.posexplode(Q.normalized(s["pairs"])).alias("pos", "p")).select("uid", (F.col("pos") + 1).alias("pair_no"), "p.question", "p.answer")


_PRE = "SELECT uid, coalesce(_source_text, '') AS src, unnest(_qa_prefilter_pairs) AS p, generate_subscripts(_qa_prefilter_pairs, 1) AS pos FROM (SELECT * FROM sample_5 WHERE _qa_prefilter_pairs IS NOT NULL QUALIFY row_number() OVER (PARTITION BY uid ORDER BY row_id) = 1)"


def _prefilter(spark, d):
    return J.first_per_document(table(spark, d, "sample_5").where("_qa_prefilter_pairs is not null"), "uid", ["row_id"])


@query()
def qa_filter_pairs(spark, d):
    """The cascade over every pair taken before filtering: repaired pair, reason or null."""
    return Q.filter_pairs(_prefilter(spark, d), "uid", "_source_text", "_qa_prefilter_pairs").withColumn("adjusted", F.array_join("adjusted", ","))


@query()
def qa_filter_reasons(spark, d):
    p = Q.filter_pairs(_prefilter(spark, d), "uid", "_source_text", "_qa_prefilter_pairs")
    return p.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query()
def qa_filter_documents(spark, d):
    p = Q.filtered_documents(Q.filter_pairs(_prefilter(spark, d), "uid", "_source_text", "_qa_prefilter_pairs"), "uid", 8)
    return p.select("uid", F.size("qa_pairs").alias("kept"), F.array_join("removed", ",").alias("removed"), F.array_join("adjusted", ",").alias("adjusted"))


@query()
def qa_assemble_roundtrip(spark, d):
    """Records whose pairs come back after assembling and splitting, by label language."""
    t = _prefilter(spark, d).where(F.size("_qa_prefilter_pairs") > 0)
    pairs = Q.normalized(F.col("_qa_prefilter_pairs"))
    return t.select(E.language_of_label(F.col("_source_text")).alias("labels"), F.when(E.language_of_label(F.col("_source_text")) == "zh", Q.roundtrip_ok(F.col("_source_text"), pairs, "zh")).otherwise(Q.roundtrip_ok(F.col("_source_text"), pairs, "en")).alias("ok")).groupBy("labels", "ok").agg(F.count("*").alias("n"))


@query(f"""WITH k AS (SELECT regexp_replace(lower(p.answer), '[^\\p{{L}}\\p{{N}}]+', '', 'g') AS a, regexp_replace(lower(src), '[^\\p{{L}}\\p{{N}}]+', '', 'g') AS s, uid, pos FROM ({_PRE}))
SELECT uid, pos::INT AS pos, CASE WHEN length(a) < 3 OR s = '' THEN 0.0::DOUBLE ELSE len(list_filter(range(1, length(a) - 1), lambda i: contains(s, substring(a, i, 3)))) / (length(a) - 2)::DOUBLE END AS support FROM k WHERE a IS NOT NULL""")
def pair_support(spark, d):
    """Trigram support of every answer by its source text."""
    t = _prefilter(spark, d).select("uid", "_source_text", F.posexplode("_qa_prefilter_pairs").alias("pos", "p"))
    return t.select("uid", (F.col("pos") + 1).alias("pos"), trigram_support(F.col("p.answer"), F.col("_source_text")).alias("support"))


@query("SELECT unnest(_qa_filter_removed) AS reason, count(*) AS n FROM sample_5 GROUP BY 1")
def removed_reason_counts(spark, d):
    return E.counter(table(spark, d, "sample_5").withColumnRenamed("_qa_filter_removed", "reason"), "reason")


@query("SELECT unnest(_qa_filter_adjusted) AS adjustment, count(*) AS n FROM sample_5 GROUP BY 1")
def adjustment_counts(spark, d):
    return E.counter(table(spark, d, "sample_5").withColumnRenamed("_qa_filter_adjusted", "adjustment"), "adjustment")


@query("SELECT reason, n, first FROM (SELECT reason, count(*) AS n, min(row_id) AS first FROM (SELECT row_id, unnest(_qa_filter_removed) AS reason FROM sample_5) GROUP BY 1 ORDER BY n DESC, first LIMIT 5)")
def top_removed_reasons(spark, d):
    t = table(spark, d, "sample_5").select("row_id", F.explode("_qa_filter_removed").alias("reason"))
    return E.most_common(t, "reason", 5, "row_id")


_KINDS = [("true_false", r"\A(?:true or false|判断题|vrai ou faux|richtig oder falsch|verdadero o falso|verdadeiro ou falso|верно или неверно)"), ("choice", r"(?m)^\s*a[.．、)]|以下哪|下列哪"), ("how_many", r"\A(?:how many|how much|combien|wie viele|cuántos|quantos|сколько)|多少"),
          ("what", r"\A(?:in )?what\b|什么"), ("which", r"\A(?:in )?which\b|哪"), ("who", r"\Awho\b|谁"), ("when", r"\Awhen\b|何时|哪一年"), ("where", r"\Awhere\b|哪里"), ("why", r"\Awhy\b|为什么"), ("how", r"\Ahow\b|怎样|如何")]


@query("SELECT kind, n, n / sum(n) OVER ()::DOUBLE AS share FROM (SELECT CASE " + " ".join(f"WHEN regexp_matches(q, '{p}') THEN '{k}'" for k, p in _KINDS) + f" ELSE 'other' END AS kind, count(*) AS n FROM (SELECT lower({sql_strip("coalesce(p.question, '')")}) AS q FROM ({_PRE})) GROUP BY 1)")
def question_types(spark, d):
    t = _prefilter(spark, d).select(F.explode("_qa_prefilter_pairs.question").alias("q"))
    n = t.groupBy(E.question_type(F.col("q")).alias("kind")).agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("_all")))).select("kind", "n", (F.col("n") / F.col("_all")).alias("share"))


# ---------------------------------------------------------------- reports


@query("""SELECT style, _internal_style, count(*) AS n, count(*) FILTER (uid IS NOT NULL AND content IS NOT NULL AND style IS NOT NULL) / greatest(count(*), 1)::DOUBLE AS field_complete_rate, false AS official_schema_exact,
 count(*) FILTER (style IN ('qa', 'multi_style')) / greatest(count(*), 1)::DOUBLE AS style_valid_rate, count(*) FILTER (length(""" + sql_strip("c") + """) > 0) / greatest(count(*), 1)::DOUBLE AS nonempty_rate, count(*) AS underscore_field_leak_count,
 sum(contains(c, 'Question:')::INT + contains(c, 'Answer:')::INT + contains(c, '问题：')::INT + contains(c, '答案：')::INT)::BIGINT AS qa_marker_hit_count,
 sum(contains(lower(c), 'encyclopedia style')::INT + contains(lower(c), 'textbook style')::INT + contains(lower(c), 'blog style')::INT + contains(lower(c), 'abstract style')::INT + contains(lower(c), '_internal_style')::INT)::BIGINT AS internal_style_marker_hit_count,
 count(*) FILTER (regexp_matches(c, '\\x{fffd}|\\x{9225}|\\x{e2}[\\x{80}-\\x{9f}\\x{20ac}]|\\x{c3}[\\x{80}-\\x{bf}]|\\x{c2}[\\x{80}-\\x{bf}]')) AS encoding_artifact_hit_count,
 count(*) FILTER (regexp_matches(c, '<(?:/?(?:p|div|br|h[1-6]|a|script|style))\\b|&(?:[a-zA-Z][a-zA-Z0-9]+|#\\d+|#x[0-9A-Fa-f]+);', 'i')) AS html_artifact_hit_count,
 count(*) FILTER (length(c) < CASE WHEN _internal_style IN ('encyclopedia', 'textbook', 'blog') THEN 490 WHEN _internal_style = 'abstract' THEN 150 WHEN coalesce(_internal_style, '') <> '' THEN 500 WHEN style = 'multi_style' THEN 490 ELSE 500 END) AS len_warning_below_min,
 count(*) FILTER (length(c) > 9000) AS len_above_9000 FROM (SELECT *, coalesce(content, '') AS c FROM sample_5) GROUP BY 1, 2""")
def l0_report(spark, d):
    return E.l0_report(table(spark, d, "sample_5"), ["style", "_internal_style"])


@query("""WITH r AS (SELECT style, _internal_style, length(coalesce(content, '')) AS l, row_number() OVER (PARTITION BY style, _internal_style ORDER BY length(coalesce(content, ''))) AS i, count(*) OVER (PARTITION BY style, _internal_style) AS n FROM sample_5)
SELECT style, _internal_style, max(l) FILTER (i = floor(0.05 * (n - 1)) + 1) AS len_p05, max(l) FILTER (i = floor(0.5 * (n - 1)) + 1) AS len_p50, max(l) FILTER (i = floor(0.95 * (n - 1)) + 1) AS len_p95 FROM r GROUP BY 1, 2""")
def l0_lengths(spark, d):
    return E.l0_lengths(table(spark, d, "sample_5"), ["style", "_internal_style"])


@query("SELECT uid, content, style FROM sample_5")
def official_records(spark, d):
    return E.official(table(spark, d, "sample_5"))


_PERF = """count(*) AS calls, count(*) FILTER (ok) AS ok_calls, count(*) FILTER (ok) / greatest(count(*), 1)::DOUBLE AS success_rate, sum(api_attempts)::BIGINT AS api_attempts, count(*) FILTER (api_attempts > 1) AS retried_calls,
 sum(elapsed_seconds) AS elapsed_seconds, avg(elapsed_seconds) AS mean_elapsed_seconds, max(elapsed_seconds) AS max_elapsed_seconds, sum(retry_sleeps_seconds) AS retry_sleeps_seconds,
 sum(prompt_tokens)::BIGINT AS prompt_tokens, sum(completion_tokens)::BIGINT AS completion_tokens, sum(total_tokens)::BIGINT AS total_tokens, count(total_tokens) AS calls_with_usage,
 sum(input_chars)::BIGINT AS input_chars, sum(output_chars)::BIGINT AS output_chars, avg(output_chars) AS mean_output_chars, count(*) FILTER (finish_reason = 'length') AS length_finishes"""


@query(f"SELECT internal_style, {_PERF.replace('sum(elapsed_seconds) AS', 'round(sum(elapsed_seconds), 3) AS').replace('avg(elapsed_seconds) AS', 'round(avg(elapsed_seconds), 6) AS')} FROM (SELECT DISTINCT * EXCLUDE (loaded_at) FROM perf_calls) GROUP BY 1")
def perf_by_style(spark, d):
    """Call performance per style; exact repeats of a call count once."""
    t = table(spark, d, "perf_calls")
    t = t.drop("loaded_at").distinct()
    p = E.performance(t, ["internal_style"])
    return p.withColumn("elapsed_seconds", F.round("elapsed_seconds", 3)).withColumn("mean_elapsed_seconds", F.round("mean_elapsed_seconds", 6))


@query("""WITH r AS (SELECT internal_style, output_chars AS l, row_number() OVER (PARTITION BY internal_style ORDER BY output_chars) AS i, count(*) OVER (PARTITION BY internal_style) AS n FROM perf_calls WHERE output_chars IS NOT NULL)
SELECT internal_style, max(l) FILTER (i = floor(0.05 * (n - 1)) + 1) AS p05, max(l) FILTER (i = floor(0.5 * (n - 1)) + 1) AS p50, max(l) FILTER (i = floor(0.9 * (n - 1)) + 1) AS p90 FROM r GROUP BY 1""")
def perf_lengths(spark, d):
    return E.positional(table(spark, d, "perf_calls"), ["internal_style"], "output_chars", {"p05": 0.05, "p50": 0.5, "p90": 0.9})


@query("SELECT task, _internal_style, reason, count(*) AS n FROM failures GROUP BY 1, 2, 3")
def failure_counts(spark, d):
    return table(spark, d, "failures").groupBy("task", "_internal_style", "reason").agg(F.count("*").alias("n"))


@query()
def failure_parses(spark, d):
    """What the parsers make of each broken output: parsed, salvaged length or nothing."""
    t = table(spark, d, "failures")
    raw = jsonish.after_reasoning(F.col("raw_prefix"))
    return t.select("idx", "task", F.size(jsonish.pairs_of(raw)).alias("n_pairs"), F.length(jsonish.content_of(raw)).alias("content_chars"), snippet(F.col("raw_prefix"), 80).alias("head"))


@query("SELECT internal_style, count(*) AS n, avg(output_chars) AS mean, avg(output_chars) - 1.96 * stddev_samp(output_chars) / sqrt(count(output_chars)) AS low, avg(output_chars) + 1.96 * stddev_samp(output_chars) / sqrt(count(output_chars)) AS high FROM perf_calls WHERE output_chars IS NOT NULL GROUP BY 1")
def length_interval(spark, d):
    t = table(spark, d, "perf_calls").where("output_chars is not null")
    return E.mean_interval(t, "output_chars", ["internal_style"])


@query("SELECT lang, source, count(*) AS n, count(DISTINCT md5(text)) AS texts FROM documents GROUP BY 1, 2")
def distinct_sources(spark, d):
    return table(spark, d, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"), F.count_distinct(F.md5("text")).alias("texts"))


@query("""WITH q AS (SELECT lang, length(coalesce(text, '')) AS c, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\s\\x0b\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+'), lambda x: x <> '')) AS w FROM documents)
SELECT lang, count(*) AS rows, quantile_cont(c, 0.05) AS chars_p5, quantile_cont(c, 0.25) AS chars_p25, quantile_cont(c, 0.5) AS chars_p50, quantile_cont(c, 0.75) AS chars_p75, quantile_cont(c, 0.95) AS chars_p95,
 quantile_cont(w, 0.05) AS words_p5, quantile_cont(w, 0.25) AS words_p25, quantile_cont(w, 0.5) AS words_p50, quantile_cont(w, 0.75) AS words_p75, quantile_cont(w, 0.95) AS words_p95 FROM q GROUP BY 1""")
def corpus_profile(spark, d):
    p = E.corpus_profile(table(spark, d, "documents"), "text", ["lang"])
    return p.select("lang", "rows", *[c for c in p.columns if c.startswith(("chars_", "words_"))])


@query("""WITH t AS (SELECT lang, style, coalesce(text, '') AS t FROM documents), l AS (SELECT lang, style, t, regexp_split_to_array(t, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}]') AS lines FROM t)
SELECT lang, style, count(*) AS rows, avg(len(list_filter(regexp_split_to_array(t, '\\n\\s*\\n'), lambda x: length(""" + sql_strip("x") + """) > 0))) AS avg_paragraphs, count(*) FILTER (len(list_filter(lines, lambda x: regexp_matches(x, '^\\s*[-*•]\\s'))) > 0) AS rows_with_bullets,
 count(*) FILTER (len(list_filter(lines, lambda x: regexp_matches(x, '^\\s*\\d+[.)]\\s'))) > 0) AS rows_with_numbers, count(*) FILTER (len(list_filter(lines, lambda x: regexp_matches(x, '^#{1,6}\\s'))) > 0) AS rows_with_headings FROM l GROUP BY 1, 2""")
def corpus_structure(spark, d):
    p = E.corpus_profile(table(spark, d, "documents"), "text", ["lang", "style"])
    return p.select("lang", "style", "rows", "avg_paragraphs", "rows_with_bullets", "rows_with_numbers", "rows_with_headings")


@query("SELECT w AS word, count(*) AS rows_hit, sum(c)::BIGINT AS occurrences FROM (SELECT w, (length(lower(text)) - length(replace(lower(text), w, ''))) // length(w) AS c FROM documents, (SELECT unnest(['bridge', 'harbour', 'salt', '供暖', 'мельница']) AS w)) WHERE c > 0 GROUP BY 1")
def keyword_profile(spark, d):
    return E.keyword_profile(table(spark, d, "documents"), "text", "doc_id", ["bridge", "harbour", "salt", "供暖", "мельница"]).drop("sample_keys")


@query("(SELECT doc_id, length(text) AS length, 'longest' AS \"end\" FROM documents WHERE text IS NOT NULL ORDER BY length(text) DESC, doc_id LIMIT 10) UNION ALL (SELECT doc_id, length(text) AS length, 'shortest' AS \"end\" FROM documents WHERE text IS NOT NULL ORDER BY length(text), doc_id LIMIT 10)")
def corpus_extremes(spark, d):
    return E.extremes(table(spark, d, "documents"), "text", "doc_id").drop("snippet")


@query("SELECT _internal_style, count(*) AS n, avg(length(content)) AS mean_chars, quantile_cont(length(content), 0.9) AS p90_chars, avg(length(content) / length(_source_text)) AS mean_ratio, quantile_cont(length(content) / length(_source_text), 0.5) AS median_ratio FROM sample_5 WHERE style = 'multi_style' AND length(_source_text) > 0 AND content IS NOT NULL GROUP BY 1")
def rewrite_ratios(spark, d):
    return R.rewrite_ratios(table(spark, d, "sample_5"), ["_internal_style"])


@query("""SELECT qa_ok, rewrite_ok, source_docs, pairs_removed, pairs_adjusted, content_chars, qa_failed, rewrite_failed, doc_failed, qa_ok / greatest(qa_ok + qa_failed, 1)::DOUBLE AS qa_success_rate, rewrite_ok / greatest(rewrite_ok + rewrite_failed, 1)::DOUBLE AS rewrite_success_rate FROM
 (SELECT count(*) FILTER (style = 'qa') AS qa_ok, count(*) FILTER (style = 'multi_style') AS rewrite_ok, count(DISTINCT _source_text) AS source_docs, sum(coalesce(len(_qa_filter_removed), 0))::BIGINT AS pairs_removed, sum(coalesce(len(_qa_filter_adjusted), 0))::BIGINT AS pairs_adjusted, sum(length(content))::BIGINT AS content_chars FROM sample_5),
 (SELECT count(*) FILTER (task = 'qa') AS qa_failed, count(*) FILTER (task = 'rewrite') AS rewrite_failed, count(*) FILTER (task = 'doc') AS doc_failed FROM failures)""")
def run_stats(spark, d):
    return R.run_stats(table(spark, d, "sample_5"), table(spark, d, "failures"))


@query("SELECT internal_style, coalesce(try_cast(prompt_tokens AS BIGINT), 0) AS tokens, count(*) AS n FROM perf_calls WHERE ok IS NOT NULL GROUP BY 1, 2")
def prompt_token_counts(spark, d):
    t = table(spark, d, "perf_calls").where("ok is not null")
    return t.groupBy("internal_style", R.token_field(t, "prompt_tokens", "input_tokens").alias("tokens")).agg(F.count("*").alias("n"))


@query("SELECT _internal_style, field, avg(v) AS mean, median(v) AS median, count(v) AS n FROM (SELECT _internal_style, unnest(['content_chars', 'source_chars']) AS field, unnest([length(content), length(_source_text)])::DOUBLE AS v FROM sample_5) WHERE v IS NOT NULL GROUP BY 1, 2")
def field_summary(spark, d):
    """The score summary (mean, median, n per field and group), over lengths as scores."""
    t = table(spark, d, "sample_5").select("_internal_style", F.length("content").alias("content_chars"), F.length("_source_text").alias("source_chars"))
    return E.score_summary(t.na.fill({"_internal_style": "none"}), ["content_chars", "source_chars"], ["_internal_style"]).select(F.nullif("_internal_style", F.lit("none")).alias("_internal_style"), "field", "mean", "median", "n")


@query("SELECT internal_style, count(*) FILTER (NOT ok) AS failed, count(*) FILTER (api_attempts > 1) AS retried FROM perf_calls GROUP BY 1")
def call_flags(spark, d):
    t = table(spark, d, "perf_calls").select("internal_style", (~F.col("ok")).alias("failed"), (F.col("api_attempts") > 1).alias("retried"))
    return E.flag_counts(t, ["failed", "retried"], ["internal_style"])


# ---------------------------------------------------------------- joins, top-k, samples


@query("SELECT c.call_id, c.uid, CASE WHEN s.uid IS NULL THEN 'missing_local_record' ELSE 'matched' END AS status, s.style AS local_style, length(s.content) AS content_chars FROM perf_calls c LEFT JOIN (SELECT uid, style, content FROM sample_5 QUALIFY row_number() OVER (PARTITION BY uid ORDER BY row_id DESC) = 1) s ON c.uid = s.uid")
def calls_with_records(spark, d):
    """Calls left-joined to the last record of their uid."""
    local = table(spark, d, "sample_5").select("uid", "row_id", "style", "content")
    j = J.by_uid(table(spark, d, "perf_calls").select("call_id", "uid"), local, "row_id")
    return j.select("call_id", "uid", "status", "local_style", F.length("local_content").alias("content_chars"))


@query(f"SELECT s.row_id, d.seed_pos FROM sample_5 s JOIN (SELECT t, max(seed_pos) AS seed_pos FROM (SELECT seed_pos, coalesce(nullif(_source_text, ''), nullif(content, ''), nullif(text, '')) AS t FROM seed_docs) GROUP BY t) d ON s._source_text = d.t WHERE length(s._source_text) > 0")
def records_with_seeds(spark, d):
    """Records joined to the last seed of the same text."""
    seeds = table(spark, d, "seed_docs").select("seed_pos", F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("_source_text", "content", "text")]).alias("t"))
    j = J.by_text(table(spark, d, "sample_5").select("row_id", "_source_text"), seeds, "_source_text", "t", "seed_pos")
    return j.select("row_id", F.col("r_seed_pos").alias("seed_pos"))


@query("SELECT style, len(list_filter(a, lambda x: x <> style)) AS n_examples FROM (SELECT DISTINCT _internal_style AS style FROM sample_5 WHERE _internal_style IS NOT NULL), (SELECT list(DISTINCT _internal_style) AS a FROM sample_5 WHERE _internal_style IS NOT NULL)")
def anchors_of_others(spark, d):
    styles = table(spark, d, "sample_5").where("_internal_style is not null").select(F.col("_internal_style").alias("style")).distinct()
    return J.other_anchors(styles, styles, "style").select("style", F.size("reference_examples").alias("n_examples"))


@query("WITH o AS (SELECT row_id, length(content) AS l, row_number() OVER (ORDER BY length(content), row_id) AS i, count(*) OVER () AS n FROM sample_5 WHERE content IS NOT NULL AND style = 'multi_style'), p AS (SELECT DISTINCT round_even((0.03 + k * 0.94 / 7) * (n - 1), 0)::BIGINT + 1 AS place FROM (SELECT max(n) AS n FROM o), range(8) t(k)) SELECT row_id, place, l AS length FROM o JOIN p ON i = place")
def length_anchors(spark, d):
    t = table(spark, d, "sample_5").where("style = 'multi_style'")
    return E.quantile_anchors(t, "content", "row_id").select("row_id", "place", "length")


@query("SELECT row_id, _internal_style, rank_in_style FROM (SELECT row_id, _internal_style, row_number() OVER (PARTITION BY _internal_style ORDER BY row_id) AS rank_in_style, list_position(['encyclopedia', 'textbook', 'blog', 'abstract'], _internal_style) AS s FROM sample_5 WHERE _internal_style IN ('encyclopedia', 'textbook', 'blog', 'abstract')) ORDER BY rank_in_style, s LIMIT 30")
def style_round_robin(spark, d):
    t = table(spark, d, "sample_5").select("row_id", "_internal_style")
    return E.round_robin(t, "_internal_style", ["row_id"], P.STYLES).drop("style_rank")


@query("SELECT call_id, output_chars, elapsed_seconds FROM perf_calls QUALIFY row_number() OVER (ORDER BY coalesce(output_chars, 99), coalesce(elapsed_seconds, 99), call_id, loaded_at) <= 12")
def weakest_calls(spark, d):
    """The 12 lowest calls, a missing figure sorting as 99."""
    return E.weakest(table(spark, d, "perf_calls"), ["output_chars", "elapsed_seconds", "call_id", "loaded_at"]).select("call_id", "output_chars", "elapsed_seconds")


@query("SELECT flag, call_id, rank FROM (SELECT flag, call_id, row_number() OVER (PARTITION BY flag ORDER BY call_id, loaded_at) AS rank FROM (SELECT call_id, loaded_at, unnest(list_filter([CASE WHEN api_attempts > 1 THEN 'retried' END, CASE WHEN NOT ok THEN 'failed' END, CASE WHEN finish_reason = 'length' THEN 'cut' END], lambda x: x IS NOT NULL)) AS flag FROM perf_calls)) WHERE rank <= 5")
def examples_per_flag(spark, d):
    t = table(spark, d, "perf_calls").select("call_id", "loaded_at", (F.col("api_attempts") > 1).alias("retried"), (~F.col("ok")).alias("failed"), (F.col("finish_reason") == "length").alias("cut"))
    return E.per_flag(t, ["retried", "failed", "cut"], ["call_id", "loaded_at"]).select("flag", "call_id", "rank")


@query("SELECT field, count(*) AS n, avg(a) AS mean_a, avg(b) AS mean_b, avg(b - a) AS delta FROM (SELECT unnest([{'field': 'chars', 'a': a.c, 'b': b.c}], recursive := true) FROM (SELECT _source_text, max(length(content))::DOUBLE AS c FROM sample_5 WHERE _internal_style = 'blog' GROUP BY 1) a JOIN (SELECT _source_text, max(length(content))::DOUBLE AS c FROM sample_5 WHERE _internal_style = 'abstract' GROUP BY 1) b USING (_source_text)) GROUP BY 1")
def paired_styles(spark, d):
    """Blog against abstract lengths over the source texts that have both."""
    t = table(spark, d, "sample_5").where("_source_text is not null").withColumn("k", F.sha2("_source_text", 256))
    one = lambda s: t.where(F.col("_internal_style") == s).groupBy("k").agg(F.max(F.length("content")).alias("chars"))
    return E.paired(one("blog"), one("abstract"), "k", ["chars"])


@query()
def seeded_sample(spark, d):
    """50 rewrites by the order of a seeded hash: the sampling operator."""
    return E.sample(table(spark, d, "sample_5").where("style = 'multi_style'").select("row_id", "uid"), "uid", 50)


@query(f"SELECT seed_pos, s AS internal_style, i::INT AS style_pos FROM seed_docs, (SELECT unnest(['encyclopedia', 'textbook', 'blog', 'abstract']) AS s, unnest(range(4)) AS i)")
def rewrite_jobs(spark, d):
    return J.jobs(table(spark, d, "seed_docs").select("seed_pos"), P.STYLES).select("seed_pos", "internal_style", "style_pos")


# ---------------------------------------------------------------- judges (fixtures) and generation


def _judge_rows():
    import json

    good = {f: 4 for f in judging.PAIRWISE["scores"]} | {f: False for f in judging.PAIRWISE["flags"]} | {f: "x" for f in judging.PAIRWISE["texts"]}
    cases = {"good": good, "zero": good | {"coverage_score": 0}, "six": good | {"coverage_score": 6}, "float": good | {"coverage_score": 4.5}, "true_as_1": good | {"coverage_score": True},
             "string": good | {"coverage_score": "4"}, "flag_text": good | {"local_too_verbose": "no"}, "blank_text": good | {"main_gap": "  "}, "two_bad": good | {"faithfulness_score": 9, "main_gap": ""}}
    rows = [(k, json.dumps(v)) for k, v in cases.items()]
    rows += [("missing", json.dumps({k: v for k, v in good.items() if k != "focus_similarity"})), ("array", "[1]"), ("none", None)]
    return rows


@query("SELECT * FROM (VALUES ('good', NULL), ('zero', 'invalid_score:coverage_score'), ('six', 'invalid_score:coverage_score'), ('float', 'invalid_score:coverage_score'), ('true_as_1', NULL), ('string', 'invalid_score:coverage_score'), ('flag_text', 'invalid_bool:local_too_verbose'), ('blank_text', 'invalid_text:main_gap'), ('two_bad', 'invalid_score:faithfulness_score'), ('missing', 'invalid_score:focus_similarity'), ('array', 'invalid_score:faithfulness_score'), ('none', 'judge_output_not_object')) t(k, failure_reason)")
def judge_validation(spark, d):
    return judging.validate_pairwise(spark.createDataFrame(_judge_rows(), "k string, json string")).select("k", "failure_reason")


@query()
def generated_records(spark, d):
    """Requests of all gated seeds, answered by the offline generator, parsed, filtered and assembled."""
    seeds = S.gate(S.seed_text(table(spark, d, "seed_docs"))).where("drop_reason is null")
    docs = cut(seeds.select(F.col("seed_pos").alias("doc_pos"), F.col("text").alias("source_text")))
    reqs = G.requests(docs, "offline", "Give JSON qa_pairs.\n{document}\n{min_pairs} to {max_pairs}", "", {s: "Rewrite.\n{document}" for s in P.STYLES})
    recs, _ = G.records(docs, cut(G.run(reqs, G.offline_generator)), "offline")
    return recs.select("uid", "style", "_internal_style", F.length("content").alias("chars"))
