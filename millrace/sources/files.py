"""Reading and writing: JSON lines, seed sources, uid lists, run folders, fan-out sinks."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.seedgate import seed_text

SEED_SCHEMA = "_source_text string, content string, text string, doc_id string, uid string"
RECORD_SCHEMA = "uid string, content string, style string, _internal_style string, _source_text string, _qa_filter_removed array<string>, _qa_filter_adjusted array<string>, _qa_prefilter_pairs array<struct<question:string,answer:string>>"


def read_jsonl(spark: SparkSession, path, schema: str) -> DataFrame:
    """JSON lines of a known schema; a line that is no object of it fails the job. Blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_checked(spark: SparkSession, path, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines as path, line text): for callers that report what is wrong instead of failing. Values that are no object are bad lines."""
    raw = spark.read.text(path).where(F.length(F.trim("value")) > 0).select(F.input_file_name().alias("path"), "value")
    v = raw.withColumn("_v", F.try_parse_json("value")).withColumn("_object", F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)))
    rows = v.where("_object").select(F.from_json("value", schema).alias("r")).select("r.*")
    return rows, v.where("not _object").select("path", "value")


def write_jsonl(df: DataFrame, path: str, sort_keys: bool = False) -> None:
    """JSON lines with null fields kept."""
    cols = sorted(df.columns) if sort_keys else df.columns
    df.select(*cols).write.option("ignoreNullFields", "false").mode("overwrite").json(path)


def read_parquet_first(spark: SparkSession, *paths: str) -> DataFrame:
    """The first path that is there."""
    error = None
    for p in paths:
        try:
            return spark.read.parquet(p)
        except Exception as e:  # not found or not readable: the next one may be
            error = e
    raise FileNotFoundError(f"none of {paths}: {error}")


def seeds(spark: SparkSession, mode: str, path, limit: int | None = None) -> DataFrame:
    """(seed_pos, text, ...) from one of the seed sources: existing (texts of an earlier run), jsonl, parquet.

    Positions follow file and line, so they are those of the input."""
    if mode == "existing":
        df = read_jsonl(spark, path, RECORD_SCHEMA).select("uid", "_source_text")
    elif mode == "jsonl":
        df = read_jsonl(spark, path, SEED_SCHEMA)
    elif mode == "parquet":
        df = read_parquet_first(spark, *([path] if isinstance(path, str) else path))
    else:
        raise ValueError(f"seed source {mode!r}")
    df = seed_text(df, "seed_text")
    if "seed_pos" not in df.columns:
        df = df.withColumn("seed_pos", F.monotonically_increasing_id())  # rises with file part and line
    return df if limit is None else df.orderBy("seed_pos").limit(limit)


def uid_list(spark: SparkSession, path: str) -> DataFrame:
    """(pos, uid) of a small list file: a JSON array, or one uid a line with # comments."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    try:
        items = [str(x) for x in json.loads(text)]
    except ValueError:
        items = [x for line in text.splitlines() if (x := line.split("#", 1)[0].strip())]
    return spark.createDataFrame(list(enumerate(items)), "pos long, uid string")


def latest_run(spark: SparkSession, pattern: str, k: int = 5) -> DataFrame:
    """The k best files of a glob by rows, distinct source texts and time of change."""
    d = spark.read.schema(RECORD_SCHEMA).json(pattern).select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("changed"))
    return d.groupBy("path").agg(F.count("*").alias("rows"), F.count_distinct(F.sha2("_source_text", 256)).alias("sources"), F.max("changed").alias("changed")).orderBy(F.desc("rows"), F.desc("sources"), F.desc("changed")).limit(k)


def file_sha256(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))


def fan_out(records: DataFrame, failures: DataFrame, folder: str) -> None:
    """The five outputs of a run: public and full records of both kinds, and failures. records should be a written table."""
    public = records.select("uid", "content", "style")
    for style, name in (("qa", "qa"), ("multi_style", "multi_style")):
        own = F.col("style") == style
        write_jsonl(public.where(own), f"{folder}/{name}_synthetic.jsonl")
        write_jsonl(records.where(own), f"{folder}/{name}_full.jsonl")
    write_jsonl(failures, f"{folder}/failures.jsonl")


def output_tag(path: str) -> str:
    """A name for reports from the folder of a run file."""
    import re

    parent = path.rstrip("/").replace("\\", "/").split("/")[-2:-1]
    return re.sub(r"[^A-Za-z0-9_.-]+", "_", parent[0] if parent else "run").strip("_") or "run"


def text_sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
