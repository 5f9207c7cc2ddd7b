"""The distinct texts of the records: what the models of problems 1 to 7 are counted on, and what their kernels read.

A text is read once, however many records hold it and wherever they lie: texts meet by a digest of 128 bits, one of each
task's, so a text that a third of all rows hold is one row per task. Results go back to the records by the digest alone.
So neither the layout of the table nor its size nor the number of cores changes a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..cluster import cut

#: The kinds of texts: source texts, rewrites, and what a qa record holds behind its source text.
SOURCE, REWRITE, BODY = 0, 1, 2
#: Columns of a text's digest.
KEY = ["h", "g"]


def body_of(content: str = "content", source: str = "_source_text") -> Column:
    """The content behind its source text, where it begins with it: the part with the pairs."""
    c, s = F.col(content), F.coalesce(F.col(source), F.lit(""))
    return F.when(F.startswith(c, s), F.substring(c, F.length(s) + 1, F.length(c))).otherwise(c)


def _items(kinds) -> list[Column]:
    style = F.coalesce(F.col("style"), F.lit("")) if set(kinds) - {SOURCE} else None
    value = {SOURCE: lambda: F.col("_source_text"), REWRITE: lambda: F.when(style != "qa", F.col("content")), BODY: lambda: F.when(style == "qa", body_of())}
    return [F.struct(F.lit(k).alias("kind"), value[k]().alias("text")) for k in kinds]


def _exploded(records: DataFrame, kinds, *columns) -> DataFrame:
    v = records.select(*columns, F.explode(F.array(*_items(kinds))).alias("v"))
    v = v.select(*[c if isinstance(c, str) else v.columns[i] for i, c in enumerate(columns)], "v.*").where("text is not null and text <> ''")
    return v.withColumn("h", F.xxhash64("text")).withColumn("g", F.xxhash64(F.lit(7), "text"))


def keyed(records: DataFrame, *columns, kinds=(SOURCE, REWRITE, BODY)) -> DataFrame:
    """(columns, kind, h, g): which texts each record holds; null and empty ones have no row."""
    return _exploded(records, kinds, *columns).drop("text")


def texts(records: DataFrame, kinds=(SOURCE, REWRITE, BODY)) -> DataFrame:
    """(kind, h, g, text): every distinct text once, written to the shared folder, since models take several passes over them."""
    return cut(_exploded(records, kinds).groupBy("kind", *KEY).agg(F.first("text").alias("text")))


def labelled_sample(records: DataFrame, found: DataFrame, label: Column, rows: int) -> list[tuple[str, str]]:
    """(label, source text) of at most `rows` texts of each label: those of the least digests, so every part of the table has the same chance.

    Only digests are compared and ranked; a rank ends at `rows` in each task, so a label with a third of all rows is no burden."""
    keys = keyed(records, label.alias("label"), kinds=(SOURCE,)).where("label is not null").select("label", *KEY).distinct()
    order = Window.partitionBy("label").orderBy(F.xxhash64("g", "h"), "h", "g")
    keys = keys.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= rows).drop("_n")
    got = found.where(F.col("kind") == SOURCE).join(F.broadcast(keys), KEY).select("label", "text", *KEY).collect()
    return [(r.label, r.text) for r in sorted(got, key=lambda r: (r.label, r.h, r.g))]
