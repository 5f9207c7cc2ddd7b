import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing as M


def test_flight_keeps_totals_and_leaves_two():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 50, 700):
        p, x = rng.random(n), rng.integers(1, 900, n).astype(float)
        q = M.flight(p, x, rng)
        left = (q > 0) & (q < 1)
        assert left.sum() <= 2 and abs(q.sum() - p.sum()) < 1e-6 and abs((q * x).sum() - (p * x).sum()) < 1e-4 * max(1, x.sum())
    assert M.land(M.flight(np.array([0.0, 1.0, 0.5, 0.5]), np.ones(4), rng), np.ones(4)).sum() == 2


def test_inclusion_is_unbiased():
    p, x = np.array([0.2, 0.5, 0.8, 0.4, 0.6]), np.array([3.0, 9.0, 4.0, 7.0, 5.0])
    mean = np.mean([M.flight(p, x, np.random.default_rng(s)) for s in range(4000)], axis=0)
    assert np.abs(mean - p).max() < 0.03


def docs(spark):
    rows = [(i, "abc"[i % 3], 10 + i % 90) for i in range(900)] + [(1000 + i, "d", 5) for i in range(3)] + [(2000, None, 9), (2001, "a", 0), (2002, "untargeted", 50)]
    return spark.createDataFrame(rows, "doc_id long, source string, tokens long")


def targets(spark, rows):
    return spark.createDataFrame(rows, "source string, target_weight double, max_repeats int")


def test_shares_caps_and_keys(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 60)
    t = targets(spark, [("a", 0.5, 2), ("b", 0.25, 3), ("c", 0.2, 1), ("none", 0.05, 2), ("d", 0.0, 4)])
    d = docs(spark)
    got = M.draws(d, t).persist()
    assert got.count() == got.select("doc_id").distinct().count() and got.where("source not in ('a', 'b', 'c')").count() == 0
    s = {r.source: r for r in M.shares(got, d, t).collect()}
    for k in "abc":
        assert s[k].top_repeats <= s[k].max_repeats and s[k].actual_share == pytest.approx(s[k].reachable_share, abs=0.004)
    assert s["none"].n_docs == 0 and s["none"].actual_share == 0 and s["d"].tokens_drawn == 0
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, M.draws(d.repartition(5), t).collect()))  # the same for the same rows


def test_total_beyond_the_caps_falls_short(spark):
    t = targets(spark, [("a", 0.5, 1), ("b", 0.5, 3)])
    s = {r.source: r for r in M.shares(M.draws(docs(spark), t, total=80_000), docs(spark), t, total=80_000).collect()}
    assert s["a"].tokens_drawn == s["a"].tokens_available and s["b"].actual_share > 0.5


def test_empty(spark):
    t = targets(spark, [("a", 0.5, 1), (None, 0.5, 1)])
    e = docs(spark).limit(0)
    assert M.draws(e, t).count() == 0 and [r.actual_share for r in M.shares(M.draws(e, t), e, t).collect()] == [0.0, 0.0]
    assert M.draws(docs(spark), t.limit(0)).count() == 0 and docs(spark).where(F.col("tokens") > 0).count() == 905
