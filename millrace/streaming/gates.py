"""The stateless gates over a stream of seed files: no watermark and no state, each micro-batch is written as it is gated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.seedgate import gate, seed_text
from ..sources.files import SEED_SCHEMA


def gated_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Seeds of JSON line files as they arrive, with drop_reason."""
    return gate(seed_text(spark.readStream.schema(SEED_SCHEMA).json(folder)))


def write_gated(spark: SparkSession, folder: str, out: str, checkpoint: str):
    """Kept and rejected seeds as Parquet, partitioned by fate; ends when the present files are done."""
    d = gated_stream(spark, folder).selectExpr("*", "drop_reason is null as kept")
    return d.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).partitionBy("kept").trigger(availableNow=True).start()
