"""Joins of records, references and anchors. Long texts meet by their digest of 256 bits; the right text never leaves its task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def last_by(df: DataFrame, key: str, pos: str) -> DataFrame:
    """The last row by pos of each key, whole; ties by the row's digest. max_by aggregates before the shuffle."""
    cols = df.columns
    row = F.struct(*cols)
    d = df.groupBy(key).agg(F.max_by(row, F.struct(F.col(pos), F.xxhash64(*[F.col(c).cast("string") for c in cols]))).alias("_row"))
    return d.select(*[F.col(f"_row.{c}").alias(c) for c in cols])


def by_uid(reference: DataFrame, local: DataFrame, local_pos: str, key: str = "uid", prefix: str = "local_") -> DataFrame:
    """Left join of reference rows to the last local row of their uid; status 'missing_local_record' where there is none."""
    own = last_by(local, key, local_pos)
    own = own.select(F.col(key), *[F.col(c).alias(prefix + c) for c in own.columns if c != key], F.lit(True).alias("_there"))
    return reference.join(own, key, "left").withColumn("status", F.when(F.col("_there"), F.lit("matched")).otherwise(F.lit("missing_local_record"))).drop("_there")


def by_text(left: DataFrame, right: DataFrame, left_text: str, right_text: str, right_pos: str, prefix: str = "r_") -> DataFrame:
    """Inner join by equal text. Of equal texts on the right the last by right_pos counts; null and empty texts match nothing."""
    k = lambda c: F.sha2(F.col(c), 256)
    r = last_by(right.where(F.length(right_text) > 0).withColumn("_k", k(right_text)).drop(right_text), "_k", right_pos)
    r = r.select("_k", *[F.col(c).alias(prefix + c) for c in r.columns if c != "_k"])
    j = left.where(F.length(left_text) > 0).withColumn("_k", k(left_text)).join(r, "_k")
    return j.withColumn(prefix + right_text, F.col(left_text)).drop("_k")


def listed(df: DataFrame, uids: DataFrame, key: str = "uid", pos: str = "pos") -> tuple[DataFrame, DataFrame]:
    """(rows of the listed uids with the list's pos, listed uids that df lacks)."""
    return df.join(uids.select(key, pos), key), uids.join(df.select(key), key, "left_anti")


def other_anchors(rows: DataFrame, anchors: DataFrame, key: str = "uid", limit: int = 64) -> DataFrame:
    """Each row with the anchors of other uids as an array. The anchors are a chosen few; more than `limit` is an error, not a plan."""
    few = anchors.limit(limit + 1).groupBy().agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("uid"), *[c for c in anchors.columns if c != key]))).alias("_a"))
    few = few.withColumn("_a", F.when(F.size("_a") <= limit, F.col("_a")).otherwise(F.raise_error(F.lit(f"more than {limit} anchors"))))
    j = rows.crossJoin(F.broadcast(few))  # one row, of `limit` anchors at most
    return j.withColumn("reference_examples", F.filter("_a", lambda a: ~a["uid"].eqNullSafe(F.col(key)))).drop("_a")


def in_input_order(results: DataFrame, pos: str) -> DataFrame:
    return results.orderBy(pos)


def jobs(docs: DataFrame, styles: list[str]) -> DataFrame:
    """One row per document and style, in the styles' order: an explode of a literal, no join."""
    return docs.select("*", F.posexplode(F.array(*[F.lit(s) for s in styles])).alias("style_pos", "internal_style"))


def first_per_document(df: DataFrame, doc: str, order: list[str]) -> DataFrame:
    w = Window.partitionBy(doc).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
