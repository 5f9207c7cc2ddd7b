"""Figures of a run: call rows, counters, rewrite ratios, and small reports as Markdown or JSON."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F


def token_field(df: DataFrame, *names: str) -> Column:
    """The first of the named columns that is there and not null, as a number; providers name them differently. 0 if there is none."""
    have = [F.col(n).try_cast("long") for n in names if n in df.columns]
    return F.coalesce(*have, F.lit(0).cast("long"))


def perf_rows(responses: DataFrame, docs: DataFrame) -> DataFrame:
    """One flat row per rewrite call: attempts, times, tokens, characters, ok and why not."""
    r = responses.where("task = 'rewrite'").join(docs.select("doc_pos", F.length("source_text").alias("input_chars")), "doc_pos", "left")
    ok = F.col("error").isNull() & (F.length(F.trim(F.coalesce("raw", F.lit("")))) > 0)
    return r.select(
        "request_key", F.col("doc_pos").alias("doc_index"), "internal_style", "api_attempts", "elapsed_seconds", "process_cpu_seconds", "retry_sleeps_seconds", "temperature_omitted", "finish_reason",
        token_field(r, "prompt_tokens", "input_tokens").alias("prompt_tokens"), token_field(r, "completion_tokens", "output_tokens").alias("completion_tokens"), token_field(r, "total_tokens").alias("total_tokens"),
        "input_chars", F.length(F.coalesce("raw", F.lit(""))).alias("output_chars"), ok.alias("ok"), F.when(~ok, F.coalesce("error", F.lit("empty_response"))).alias("failure_reason"))


def run_stats(records: DataFrame, failures: DataFrame) -> DataFrame:
    """One row: records and failures per task, success rates over both (0 where there was nothing), pairs removed and adjusted."""
    good = records.agg(
        F.count_if(F.col("style") == "qa").alias("qa_ok"), F.count_if(F.col("style") == "multi_style").alias("rewrite_ok"), F.count_distinct(F.sha2("_source_text", 256)).alias("source_docs"),
        F.coalesce(F.sum(F.coalesce(F.size("_qa_filter_removed"), F.lit(0))), F.lit(0)).alias("pairs_removed"), F.coalesce(F.sum(F.coalesce(F.size("_qa_filter_adjusted"), F.lit(0))), F.lit(0)).alias("pairs_adjusted"),
        F.sum(F.length("content")).alias("content_chars"))
    bad = failures.agg(F.count_if(F.col("task") == "qa").alias("qa_failed"), F.count_if(F.col("task") == "rewrite").alias("rewrite_failed"), F.count_if(F.col("task") == "doc").alias("doc_failed"))
    d = good.crossJoin(bad)  # one row each
    rate = lambda k: F.col(f"{k}_ok") / F.greatest(F.col(f"{k}_ok") + F.col(f"{k}_failed"), F.lit(1))
    return d.withColumns({"qa_success_rate": rate("qa"), "rewrite_success_rate": rate("rewrite")})


def rewrite_ratios(records: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Lengths of rewrites against their sources: n, mean and 90th percentile of length, mean and median of the ratio. Rewrites without a source text are left out."""
    r = records.where("style = 'multi_style' and length(_source_text) > 0 and content is not null").withColumn("_l", F.length("content")).withColumn("_r", F.length("content") / F.length("_source_text"))
    return r.groupBy(*(by or [])).agg(F.count("*").alias("n"), F.avg("_l").alias("mean_chars"), F.percentile("_l", F.lit(0.9)).alias("p90_chars"), F.avg("_r").alias("mean_ratio"), F.median("_r").alias("median_ratio"))


def low_samples(results: DataFrame, local: DataFrame, order: list[str], k: int = 12) -> DataFrame:
    """The k weakest judged rows beside the heads of their source and rewrite; rows without a record keep nulls."""
    from ..functions.text import snippet
    from .evaluate import weakest

    w = weakest(results, [*order, "uid"], k)
    heads = local.select("uid", snippet(F.col("_source_text"), 220).alias("source_head"), snippet(F.col("content"), 260).alias("rewrite_head"))
    return w.join(heads.dropDuplicates(["uid"]), "uid", "left")


def markdown(df: DataFrame, title: str, digits: int = 4, limit: int = 200) -> str:
    """A small aggregate as a Markdown table, rounded here and nowhere before; more than `limit` rows are an error."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a report of more than {limit} rows")
    show = lambda v: "" if v is None else str(round(v, digits)) if isinstance(v, float) else str(v).replace("|", "\\|").replace("\n", " ")
    head = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join([f"## {title}", "", *head, *("| " + " | ".join(show(v) for v in r) + " |" for r in rows)]) + "\n"


def summary_json(df: DataFrame, limit: int = 200) -> str:
    """The same as JSON text, keys sorted."""
    rows = [r.asDict(recursive=True) for r in df.limit(limit + 1).collect()]
    if len(rows) > limit:
        raise ValueError(f"a summary of more than {limit} rows")
    return json.dumps(rows, ensure_ascii=False, sort_keys=True, indent=2, default=str)
