"""Problem 9: documents drawn from several sources so that each has its target share of all tokens.

Method: cube-method balanced sampling. A source's documents share one rate r, its wanted tokens over its
tokens; each is taken floor(r) times for sure and once more with probability r - floor(r). Within blocks of
bounded size, large documents first, the flight phase moves these probabilities through the null space of the constraints (tokens and
documents per block) until at most two stay between 0 and 1; those of all blocks of a source fly once more,
and what is left, two documents a source, lands on the rounding nearest to the wanted tokens.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .bpe import token_counts

#: Documents in a block of the flight phase.
BLOCK = 4000
_EPS = 1e-9


def flight(p: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move inclusion probabilities p at random to 0 or 1, keeping sum(p) and sum(p * x), until at most two are left inside (0, 1)."""
    p = p.astype(float).copy()
    inside = [i for i in range(len(p)) if _EPS < p[i] < 1 - _EPS]
    p[p <= _EPS], p[p >= 1 - _EPS] = 0.0, 1.0
    draws = rng.random(len(inside) + 1)
    live: list[int] = []
    nxt = used = 0
    while True:
        while len(live) < 3 and nxt < len(inside):
            live.append(inside[nxt])
            nxt += 1
        if len(live) < 3:
            return p
        a, b, c = live
        xa, xb, xc = x[a], x[b], x[c]
        u = (xb - xc, xc - xa, xa - xb)  # the null space of the two constraints over three units
        if abs(u[0]) + abs(u[1]) + abs(u[2]) < 1e-12:
            u = (1.0, -1.0, 0.0)  # equal sizes: both constraints hold for any exchange
        up = down = np.inf
        for i, v in zip(live, u):
            if v > 0:
                up, down = min(up, (1 - p[i]) / v), min(down, p[i] / v)
            elif v < 0:
                up, down = min(up, p[i] / -v), min(down, (1 - p[i]) / -v)
        step = up if draws[used % len(draws)] * (up + down) < down else -down
        used += 1
        rest = []
        for i, v in zip(live, u):
            q = p[i] + step * v
            p[i] = 0.0 if q <= _EPS else 1.0 if q >= 1 - _EPS else q
            if 0.0 < p[i] < 1.0:
                rest.append(i)
        live = rest


def land(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Round the few probabilities left (at most two, after a flight) so that sum(x) misses its wanted value least; ties go to fewer documents."""
    left = np.flatnonzero((p > 0) & (p < 1))
    want = float((p[left] * x[left]).sum())
    best = None
    for k in range(1 << len(left)):
        pick = [(k >> i) & 1 for i in range(len(left))]
        miss = (round(abs(float(np.dot(pick, x[left])) - want), 9), sum(pick))
        if best is None or miss < best[0]:
            best = (miss, pick)
    p = p.copy()
    p[left] = best[1] if best else []
    return p


def rates(docs: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """(source, target_weight, max_repeats, n_docs, tokens_available, wanted_tokens, rate) of each target.

    The total is the largest at which no source with documents would repeat one more than max_repeats times, or
    `total`, if given; then a source's rate ends at max_repeats, and its actual share falls short. Weights of targets
    that have no documents (or no tokens) are spread over the others in proportion. Targets that are null or not positive draw nothing."""
    have = docs.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("tokens").alias("tokens_available"))
    t = targets.groupBy("source").agg(F.max("target_weight").alias("target_weight"), F.max("max_repeats").alias("max_repeats"))
    t = t.join(have, "source", "left").withColumns({
        "target_weight": F.greatest(F.coalesce("target_weight", F.lit(0.0)), F.lit(0.0)), "max_repeats": F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)),
        "n_docs": F.coalesce("n_docs", F.lit(0)), "tokens_available": F.coalesce("tokens_available", F.lit(0))})
    usable = (F.col("tokens_available") > 0) & (F.col("max_repeats") > 0) & (F.col("target_weight") > 0)
    weight = F.when(usable, F.col("target_weight")).otherwise(0.0)
    sums = t.agg(F.sum(weight).alias("_w"), F.min(F.when(usable, F.col("max_repeats") * F.col("tokens_available") / F.col("target_weight"))).alias("_cap"))
    t = t.crossJoin(F.broadcast(sums))  # one row beside each target
    wanted = weight * F.col("_cap") if total is None else weight / F.col("_w") * F.lit(float(total))
    return t.withColumn("wanted_tokens", F.coalesce(wanted, F.lit(0.0))).withColumn(
        "rate", F.when(usable, F.least(F.col("wanted_tokens") / F.col("tokens_available"), F.col("max_repeats").cast("double"))).otherwise(0.0)).drop("_w", "_cap")


def draws(docs: DataFrame, targets: DataFrame, key: str = "doc_id", total: float | None = None, seed: int = 0) -> DataFrame:
    """(key, source, tokens, repeats) of the documents drawn. docs: key, source, tokens; sizes of 0 tokens are never drawn.

    Blocks are cut by a hash of the key within the source, so a source with a third of all rows is spread over many tasks."""
    docs = docs.where("tokens > 0 and source is not null").select(F.col(key).alias("_k"), "source", F.col("tokens").cast("double").alias("tokens"))
    r = rates(docs, targets, total).where("rate > 0").select("source", "rate", F.ceil(F.col("n_docs") / BLOCK).alias("blocks"))
    d = docs.join(r, "source").withColumn("block", F.pmod(F.xxhash64("_k", F.lit(seed)), F.col("blocks")))
    fields = "_k long, source string, tokens double, base double, p double"

    def fly(keys, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["tokens", "_k"], ascending=[False, True])  # so that small documents are left over
        rng = np.random.default_rng([seed, *map(ord, str(keys[0])), int(keys[1])])
        base = np.floor(rows["rate"].to_numpy() + _EPS)
        rows = rows.assign(base=base, p=flight(np.clip(rows["rate"].to_numpy() - base, 0, 1), rows["tokens"].to_numpy(), rng))
        return rows[["_k", "source", "tokens", "base", "p"]]

    flown = d.groupBy("source", "block").applyInPandas(fly, fields).persist()
    left = flown.where("p > 0 and p < 1")  # two rows a block at most

    def again(keys, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["tokens", "_k"], ascending=[False, True])
        rng = np.random.default_rng([seed, 1, *map(ord, str(keys[0]))])
        x = rows["tokens"].to_numpy()
        return rows.assign(p=land(flight(rows["p"].to_numpy(), x, rng), x))

    landed = left.groupBy("source").applyInPandas(again, fields)
    every = flown.where("p <= 0 or p >= 1").unionByName(landed)
    return every.select(F.col("_k").alias(key), "source", F.col("tokens").cast("long").alias("tokens"), F.round(F.col("base") + F.col("p")).cast("int").alias("repeats")).where("repeats > 0")


def shares(drawn: DataFrame, docs: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """One row per target: wanted and actual share, documents and tokens there and drawn, the highest repeat."""
    got = drawn.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens_drawn"), F.count("*").alias("docs_drawn"), F.max("repeats").alias("top_repeats"))
    r = rates(docs.where("tokens > 0 and source is not null"), targets, total).join(got, "source", "left").na.fill(0, ["tokens_drawn", "docs_drawn", "top_repeats"])
    return r.crossJoin(F.broadcast(r.agg(F.sum("tokens_drawn").alias("_all"), F.sum("wanted_tokens").alias("_want")))).select(
        "source", F.col("target_weight").alias("wanted_share"), F.when(F.col("_want") > 0, F.col("wanted_tokens") / F.col("_want")).otherwise(0.0).alias("reachable_share"),
        F.when(F.col("_all") > 0, F.col("tokens_drawn") / F.col("_all")).otherwise(0.0).alias("actual_share"),
        "max_repeats", "top_repeats", "n_docs", "docs_drawn", "tokens_available", "tokens_drawn")


def sized(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, source, tokens) of each document, sizes by the public tokenizer of problem 8."""
    return token_counts(documents, [key, "source"])
