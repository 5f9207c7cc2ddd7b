"""Generation: requests, a pluggable generator run per partition, persisted responses, and the pure stages after them."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import patterns as P
from ..functions.jsonish import after_reasoning, content_of, pairs_of
from ..functions.text import clip, fill_template
from ..operators.joins import jobs
from ..operators.qapairs import assemble, filter_pairs, filtered_documents, normalized

RESPONSE = "request_key string, doc_pos long, task string, internal_style string, raw string, finish_reason string, prompt_tokens long, completion_tokens long, total_tokens long, api_attempts int, elapsed_seconds double, process_cpu_seconds double, retry_sleeps_seconds double, temperature_omitted boolean, error string"

#: generator(system, user, temperature or None) -> (text, finish_reason, usage dict)
Generator = Callable[[str, str, float | None], tuple[str, str | None, dict]]


class TemperatureRejected(ValueError):
    """The endpoint doesn't take a temperature; the call is repeated without one."""


def record_uid(run_id: str, *parts: Column) -> Column:
    """A uid that a rerun gives again: a digest of the run, the position and the request in the form of a uuid."""
    h = F.sha2(F.concat_ws("\x1f", F.lit(run_id), *[p.cast("string") for p in parts]), 256)
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def requests(docs: DataFrame, run_id: str, qa_template: str | None, system: str, style_templates: dict[str, str], min_pairs: int = 3, max_pairs: int = 8, qa_system: str = "") -> DataFrame:
    """(request_key, doc_pos, task, internal_style, source_text, system, user) from docs (doc_pos, source_text)."""
    base = docs.select("doc_pos", "source_text")
    out = None
    if qa_template is not None:
        user = fill_template(F.lit(qa_template), [("document", F.col("source_text")), ("min_pairs", F.lit(str(min_pairs))), ("max_pairs", F.lit(str(max_pairs)))])
        out = base.select("*", F.lit("qa").alias("task"), F.lit(None).cast("string").alias("internal_style"), F.lit(qa_system).alias("system"), user.alias("user"))
    if style_templates:
        table = F.create_map(*[F.lit(x) for kv in style_templates.items() for x in kv])
        r = jobs(base, list(style_templates)).select("doc_pos", "source_text", F.lit("rewrite").alias("task"), "internal_style", F.lit(system).alias("system"), fill_template(F.element_at(table, F.col("internal_style")), [("document", F.col("source_text"))]).alias("user"))
        out = r if out is None else out.unionByName(r)
    return out.withColumn("request_key", record_uid(run_id, F.col("doc_pos"), F.col("source_text"), F.col("task"), F.coalesce("internal_style", F.lit(""))))


def pending(reqs: DataFrame, done: DataFrame | None) -> DataFrame:
    """Requests without a written response: the resume of a run that stopped."""
    return reqs if done is None else reqs.join(done.where("error is null").select("request_key"), "request_key", "left_anti")


def call(generator: Generator, system: str, user: str, temperature: float | None, retries: int = 3, sleep=time.sleep) -> dict:
    """One request with back-off of 1, 2, 4 ... seconds; the response or the last error, with its metrics."""
    began, cpu = time.perf_counter(), time.process_time()
    out = {"raw": None, "finish_reason": None, "api_attempts": 0, "retry_sleeps_seconds": 0.0, "temperature_omitted": False, "error": None, "prompt_tokens": None, "completion_tokens": None, "total_tokens": None}
    for attempt in range(retries):
        while True:
            out["api_attempts"] += 1
            try:
                text, finish, usage = generator(system, user, None if out["temperature_omitted"] else temperature)
                out |= {"raw": text or "", "finish_reason": finish, "error": None, "prompt_tokens": usage.get("prompt_tokens", usage.get("input_tokens")), "completion_tokens": usage.get("completion_tokens", usage.get("output_tokens")), "total_tokens": usage.get("total_tokens")}
            except TemperatureRejected as e:
                out["error"] = str(e)
                if not out["temperature_omitted"]:
                    out["temperature_omitted"] = True
                    continue
            except Exception as e:
                out["error"] = f"{type(e).__name__}: {e}"
            break
        if out["error"] is None:
            break
        sleep(2**attempt)
        out["retry_sleeps_seconds"] += float(2**attempt)
    return out | {"elapsed_seconds": time.perf_counter() - began, "process_cpu_seconds": time.process_time() - cpu}


def run(reqs: DataFrame, factory: Callable[[], Generator], temperature: float | None = 0.7, retries: int = 3) -> DataFrame:
    """Responses of the requests; the client is made once per partition. Write the result before reading it twice."""
    names = [c.split()[0] for c in RESPONSE.split(", ")]

    def part(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generator = None
        for rows in it:
            generator = generator or factory()
            out = [{"request_key": r.request_key, "doc_pos": r.doc_pos, "task": r.task, "internal_style": r.internal_style} | call(generator, r.system, r.user, temperature, retries) for r in rows.itertuples()]
            yield pd.DataFrame(out, columns=names).astype({c: "Int64" for c in ("prompt_tokens", "completion_tokens", "total_tokens")})

    return reqs.select("request_key", "doc_pos", "task", "internal_style", "system", "user").mapInPandas(part, RESPONSE)


def offline_generator() -> Generator:
    """A deterministic stand-in: pairs or a rewrite out of the request's own sentences."""
    import json
    import re

    def answer(system: str, user: str, temperature: float | None):
        pieces = [s.strip() for s in re.split(r"(?<=[.!?。！？])\s*", user) if len(s.strip()) > 20]
        if "qa_pairs" in user or "qa_pairs" in system:
            out = {"qa_pairs": [{"question": f"What does sentence {i + 1} say?", "answer": s} for i, s in enumerate(pieces[:3])]}
        else:
            out = {"content": " ".join(pieces)}
        text = json.dumps(out, ensure_ascii=False)
        return text, "stop", {"prompt_tokens": len(user) // 4, "completion_tokens": len(text) // 4, "total_tokens": len(user) // 4 + len(text) // 4}

    return answer


def records(docs: DataFrame, responses: DataFrame, run_id: str, max_pairs: int | None = 8, labels: str = "auto") -> tuple[DataFrame, DataFrame]:
    """(records, failures) of written responses: parse, filter, assemble. Each failure names its reason and keeps the first 500 characters."""
    r = responses.join(docs.select("doc_pos", "source_text"), "doc_pos")
    qa = r.where("task = 'qa'").withColumn("_pairs", pairs_of(after_reasoning(F.col("raw"))))
    cascade = filtered_documents(filter_pairs(qa.where("_pairs is not null").select("request_key", "source_text", F.col("_pairs").alias("pairs")), "request_key"), "request_key", max_pairs)
    qa = qa.join(cascade, "request_key", "left")
    good = F.coalesce(F.size("qa_pairs"), F.lit(0)) > 0
    blank = lambda c: F.when(F.size(c) > 0, F.col(c))
    qa_records = qa.where(good).select(record_uid(run_id, F.col("request_key")).alias("uid"), assemble(F.col("source_text"), F.col("qa_pairs"), labels).alias("content"), F.lit("qa").alias("style"), F.lit(None).cast("string").alias("_internal_style"), F.col("source_text").alias("_source_text"), blank("removed").alias("_qa_filter_removed"), blank("adjusted").alias("_qa_filter_adjusted"), normalized(F.col("_pairs")).alias("_qa_prefilter_pairs"))
    rw = r.where("task = 'rewrite'").withColumn("_content", content_of(after_reasoning(F.col("raw"))))
    none = lambda t: F.lit(None).cast(t)
    fine = F.coalesce(F.length(F.trim("_content")), F.lit(0)) > 0
    rw_records = rw.where(fine).select(record_uid(run_id, F.col("request_key")).alias("uid"), F.col("_content").alias("content"), F.lit("multi_style").alias("style"), F.col("internal_style").alias("_internal_style"), F.col("source_text").alias("_source_text"), none("array<string>").alias("_qa_filter_removed"), none("array<string>").alias("_qa_filter_adjusted"), none("array<struct<question:string,answer:string>>").alias("_qa_prefilter_pairs"))
    why = lambda parsed: F.when(F.col("error").isNotNull(), F.concat(F.lit("call_failed: "), F.col("error"))).when(~parsed, F.lit("parse_failed")).otherwise(F.lit("no_pairs_after_filter"))
    head = F.left(F.coalesce("raw", F.lit("")), F.lit(500)).alias("raw_prefix")
    failed = qa.where(~good).select(F.col("doc_pos").cast("int").alias("idx"), "task", F.col("internal_style").alias("_internal_style"), head, why(F.col("_pairs").isNotNull()).alias("reason"), normalized(F.col("_pairs")).alias("_qa_prefilter_pairs"))
    failed = failed.unionByName(rw.where(~fine).select(F.col("doc_pos").cast("int").alias("idx"), "task", F.col("internal_style").alias("_internal_style"), head, why(F.lit(False)).alias("reason"), none("array<struct<question:string,answer:string>>").alias("_qa_prefilter_pairs")))
    return qa_records.unionByName(rw_records), failed


def judge_requests(rows: DataFrame, system: str, run_id: str, source_limit: int = 5000, text_limit: int = 3500) -> DataFrame:
    """Requests of a judge from rows (doc_pos, source_text, content, internal_style), texts clipped head and tail."""
    user = F.concat_ws("\n\n", F.concat(F.lit("SOURCE\n"), clip(F.col("source_text"), source_limit)), F.concat(F.lit("STYLE\n"), F.coalesce("internal_style", F.lit(""))), F.concat(F.lit("TEXT\n"), clip(F.col("content"), text_limit)))
    d = rows.select("doc_pos", "source_text", F.lit("judge").alias("task"), "internal_style", F.lit(system).alias("system"), user.alias("user"))
    return d.withColumn("request_key", record_uid(run_id, F.col("doc_pos"), F.col("user"), F.lit("judge")))


STYLES = P.STYLES
