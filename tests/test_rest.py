import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import jsonish as X
from millrace.operators import evaluate as E, joins as J, judging
from millrace.plans import generate as G
from millrace.sources import files


def test_objects():
    f = X.parse_object
    assert f('```json\n{"a": 1}\n```') == {"a": 1} and f('so: {"a": 1} ok') == {"a": 1} and f('{"a": "x\ny\t"}') == {"a": "x\ny\t"}
    assert f('{"a": 1, "a": 2}') == {"a": 2} and f("[1]") is None and f("{") is None and f("") is None and f(None) is None


def test_pairs_are_all_or_nothing():
    ok = {"qa_pairs": [{"question": "q", "answer": "a", "more": 1}]}
    assert X.parse_pairs(json.dumps(ok)) == [{"question": "q", "answer": "a"}]
    for bad in ([{"question": 1, "answer": "a"}], None, "x", [{"question": "q"}], ["x"]):
        assert X.parse_pairs(json.dumps({"qa_pairs": bad})) is None
    assert X.parse_pairs('{"qa_pairs": []}') == []


def test_salvage_and_prose():
    assert X.parse_rewrite('{"content": "one\\ntwo \\u4e2d') == "one\ntwo 中"
    assert X.parse_rewrite('{"content": "say "hi" now", "x": 1') == 'say "hi" now'
    assert X.parse_rewrite('{"other": 1}') is None and X.parse_rewrite("中" * 80) == "中" * 80 and X.parse_rewrite("中" * 79) is None
    assert X.parse_rewrite("English prose " * 20) is None and X.parse_rewrite("抱歉" + "中" * 90) is None


def test_reasoning_and_judge(spark):
    d = spark.createDataFrame([("a</think>b</think>c",), ("x",)], "t string").select(X.after_reasoning(F.col("t")).alias("t"))
    assert [r.t for r in d.collect()] == ["c", "x"]
    assert json.loads(X.parse_judge('{"a": “x”, "b": 2}')) == {"a": "x", "b": 2} and X.parse_judge("no") is None


def test_rewrite_scores(spark):
    good = {f: 4 for f in judging.REWRITE["scores"]} | {f: False for f in judging.REWRITE["flags"]} | {f: "x" for f in judging.REWRITE["texts"]}
    cases = [good, good | {"overall_score": 4.5}, good | {"overall_score": 4.0}, good | {"overall_score": True}, good | {"overall_score": 0.4}, good | {"overall_score": "4"}]
    d = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(cases)], "i int, json string")
    r = judging.normalize_rewrite(d).orderBy("i").collect()
    assert [x.failure_reason for x in r] == [None, None, None, "invalid_score:overall_score", "invalid_score:overall_score", "invalid_score:overall_score"]
    assert r[1].notes == ["overall_score:4.5->5"] and r[2].notes == [] and r[1].scores["overall_score"] == 5


@pytest.mark.parametrize("n", [0, 1, 2, 20, 21])
def test_positional_percentile(spark, n):
    vals = [(v * 7) % 23 for v in range(n)]
    r = E.positional(spark.createDataFrame([(v,) for v in vals], "v int"), [], "v", {"a": 0.05, "b": 0.5, "c": 0.95}).first()
    s = sorted(vals)
    want = tuple(s[int(p * (n - 1))] for p in (0.05, 0.5, 0.95)) if n else (None,) * 3
    assert tuple(r) == want


def test_joins(spark):
    ref = spark.createDataFrame([("a",), ("b",), (None,)], "uid string")
    local = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), (None, 3, "x")], "uid string, pos int, v string")
    r = {x.uid: (x.status, x.local_v) for x in J.by_uid(ref, local, "pos").collect()}
    assert r == {"a": ("matched", "new"), "b": ("missing_local_record", None), None: ("missing_local_record", None)}
    t = spark.createDataFrame([("t", 1), ("t", 2), ("", 3), (None, 4)], "t string, pos int")
    assert [x.r_pos for x in J.by_text(t.select("t").limit(1), t, "t", "t", "pos").collect()] == [2]
    a = spark.createDataFrame([("a", "1"), ("b", "2")], "uid string, v string")
    assert {x.uid: len(x.reference_examples) for x in J.other_anchors(ref, a).collect()} == {"a": 1, "b": 1, None: 2}
    with pytest.raises(Exception):
        J.other_anchors(ref, a, limit=1).collect()
    got, missing = J.listed(local, spark.createDataFrame([(0, "a"), (1, "z")], "pos long, uid string").withColumnRenamed("pos", "place"), pos="place")
    assert got.count() == 2 and [x.uid for x in missing.collect()] == ["z"]


def test_tops_and_anchors(spark):
    d = spark.createDataFrame([(i, "ab"[i % 2], "x" * (i + 1)) for i in range(50)], "i int, s string, t string")
    assert [x.i for x in E.round_robin(d, "s", ["i"], ["b", "a"], 4).collect()] == [1, 0, 3, 2]
    got = sorted(x.i for x in E.quantile_anchors(d, "t", "i", 4, 10).collect())
    assert got == sorted({round(49 * p) for p in (0.03, 0.03 + 0.94 / 3, 0.03 + 2 * 0.94 / 3, 0.97)})
    assert E.sample(d, "i", 7).collect() == E.sample(d.repartition(3), "i", 7).collect()
    m = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y"), (4, "x"), (5, None)], "p int, v string")
    assert [(x.v, x.n) for x in E.most_common(m, "v", 1, "p").collect()] == [("x", 2)]
    s = spark.createDataFrame([(1, None), (2, 5.0), (3, 1.0)], "k int, score double")
    assert [x.k for x in E.weakest(s, ["score", "k"], 3).collect()] == [3, 2, 1]


def test_reports(spark):
    d = spark.createDataFrame([("u", "Question: x &amp; Ã©", "qa", None), ("v", None, "multi_style", "abstract"), (None, "z" * 9001, "other", "blog")], "uid string, content string, style string, _internal_style string")
    r = E.l0_report(d).first()
    assert (r.n, r.qa_marker_hit_count, r.encoding_artifact_hit_count, r.html_artifact_hit_count, r.len_above_9000, r.len_warning_below_min) == (3, 1, 1, 1, 1, 2)
    assert r.field_complete_rate == pytest.approx(1 / 3) and not r.official_schema_exact and E.l0_report(E.official(d)).first().official_schema_exact
    assert E.l0_report(d.limit(0)).first().n == 0 and E.export(d).columns == ["uid", "content", "style"]
    s = spark.createDataFrame([(1, 5), (3, None), (3, 1)], "a int, b int")
    got = {x.field: x for x in E.score_summary(s, ["a", "b"]).collect()}
    assert got["a"].mean == pytest.approx(7 / 3) and got["a"].median == 3 and got["b"].n == 2 and got["a"].distribution == {"1.0": 1, "3.0": 2}


def test_calls_back_off_and_temperature():
    seen, slept = [], []

    def flaky(system, user, temperature):
        seen.append(temperature)
        if temperature is not None:
            raise G.TemperatureRejected("no temperature")
        if len(seen) < 4:
            raise RuntimeError("busy")
        return "ok", "stop", {"input_tokens": 3}

    r = G.call(flaky, "", "", 0.7, sleep=slept.append)
    assert r["raw"] == "ok" and r["temperature_omitted"] and r["prompt_tokens"] == 3 and r["api_attempts"] == 4 and slept == [1, 2]
    bad = G.call(lambda *a: 1 / 0, "", "", 0.7, retries=2, sleep=slept.append)
    assert bad["raw"] is None and bad["error"].startswith("ZeroDivisionError") and bad["retry_sleeps_seconds"] == 3.0


def test_generation_end_to_end(spark):
    docs = spark.createDataFrame([(0, "The mill stood by the river for years. It was repaired every single winter. Nobody knows who paid."), (1, "短。")], "doc_pos long, source_text string")
    reqs = G.requests(docs, "r", "qa_pairs {document}", "", {"blog": "{document}"})
    assert reqs.select("request_key").distinct().count() == 4
    res = G.run(reqs, G.offline_generator).persist()
    recs, failed = G.records(docs, res, "r", 2)
    got = {(x.style, x._source_text[:2]): x for x in recs.collect()}
    assert got[("qa", "Th")].content.count("Question:") == 2 and ("multi_style", "Th") in got
    assert {(x.idx, x.task, x.reason) for x in failed.collect()} == {(1, "qa", "no_pairs_after_filter"), (1, "rewrite", "parse_failed")}
    assert G.pending(reqs, res).count() == 0 and G.pending(reqs, res.where("task = 'qa'")).count() == 2


def test_files(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"uid": "u", "content": "c"}\n\n[1]\nbroken\n', encoding="utf-8")
    rows, bad = files.read_jsonl_checked(spark, str(p), files.SEED_SCHEMA)
    assert [x.uid for x in rows.collect()] == ["u"] and sorted(x.value for x in bad.collect()) == ["[1]", "broken"]
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(p), files.SEED_SCHEMA).collect()
    for text in ('["a", "b"]', "# list\na\n b # second\n\n"):
        (tmp_path / "uids").write_text(text)
        assert [x.uid for x in files.uid_list(spark, str(tmp_path / "uids")).orderBy("pos").collect()] == ["a", "b"]
    out = str(tmp_path / "out")
    files.write_jsonl(spark.createDataFrame([("u", None)], "uid string, content string"), out)
    assert "null" in "".join(x.value for x in spark.read.text(out).collect())
    assert files.output_tag("/runs/a b/multi.jsonl") == "a_b"
    assert files.read_parquet_first(spark, str(tmp_path / "no"), "/root/testdata/sf0.001/documents.parquet").count() == 100


def test_stream(spark, tmp_path):
    from millrace.streaming.gates import write_gated

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text(json.dumps({"content": "The old mill by the river was repaired in the spring. " * 20}) + "\n" + json.dumps({"content": "short"}) + "\n")
    q = write_gated(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert {x.kept: x["count"] for x in spark.read.parquet(str(tmp_path / "out")).groupBy("kept").count().collect()} == {"true": 1, "false": 1}


def test_run_figures(spark):
    from millrace.operators import runs as R

    docs = spark.createDataFrame([(0, "The mill stood by the river for years. It was repaired every winter."), (1, "")], "doc_pos long, source_text string")
    res = G.run(G.requests(docs, "r", None, "", {"blog": "{document}"}), G.offline_generator)
    rows = {r.doc_index: r for r in R.perf_rows(res, docs).collect()}
    assert rows[0].ok and rows[0].input_chars == 68 and rows[0].total_tokens > 0 and rows[1].input_chars == 0
    recs, failed = G.records(docs, res, "r")
    s = R.run_stats(recs, failed).first()
    assert (s.rewrite_ok, s.rewrite_failed, s.qa_ok, s.qa_success_rate) == (1, 1, 0, 0.0) and s.rewrite_success_rate == 0.5
    assert R.rewrite_ratios(recs).first().n == 1 and R.run_stats(recs.limit(0), failed.limit(0)).first().qa_ok == 0
    text = R.markdown(spark.createDataFrame([("a|b", 1.23456)], "k string, v double"), "T")
    assert text.splitlines()[-1] == "| a\\|b | 1.2346 |"
    with pytest.raises(ValueError):
        R.markdown(spark.range(5), "T", limit=3)
    assert json.loads(R.summary_json(spark.range(1))) == [{"id": 0}]
    low = R.low_samples(spark.createDataFrame([("u", 1), ("v", None)], "uid string, score int"), recs.select(F.lit("u").alias("uid"), "_source_text", "content"), ["score"])
    assert {r.uid: r.source_head is None for r in low.collect()} == {"u": False, "v": True}


def test_config(tmp_path):
    from millrace.plans import config

    p = tmp_path / "c.json"
    p.write_text(json.dumps({"seed": {"language": "en", "n_docs": 5}, "synthesis": {"styles": ["blog"]}}))
    c = config.load(str(p))
    assert c.seed.english_labels and c.seed.n_docs == 5 and c.seed.min_chars == 500 and c.synthesis.styles == ["blog"] and c.llm.retries == 3
    p.write_text(json.dumps({"seed": {"nope": 1}}))
    with pytest.raises(ValueError):
        config.load(str(p))


def test_generated_pairs(spark):
    from millrace.operators import qapairs as Q

    d = spark.createDataFrame([("a", ("x" * 120 + "\n\nQuestion: q Answer: a ",)), ("b", None)], "uid string, generated_record struct<content:string>")
    r = {x.uid: x for x in Q.generated_pairs(d, "en").collect()}
    assert [tuple(p) for p in r["a"].pairs] == [("q", "a")] and r["b"].failure_reason == "empty_content"


def test_spread_and_cut(spark, small):
    from millrace.cluster import cut, spread

    d = spark.read.parquet(f"{small}/documents.parquet")
    s = spread(d, "source")
    assert s.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and s.exceptAll(d).count() == 0 == d.exceptAll(s).count()
    assert spread(d, small=10).rdd.getNumPartitions() == d.rdd.getNumPartitions() and spread(spark.range(3)).count() == 3
    c = cut(d.select("doc_id"))
    assert c.count() == 100 and "documents.parquet" not in c._jdf.queryExecution().toString()


def test_every_core_query_runs(spark, small):
    from millrace import queries

    for name, q in queries.QUERIES.items():
        if name != "generated_records":
            assert q(spark, small).schema is not None, name
