import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import patterns as P
from millrace.operators import qapairs as Q

SRC = "水渠在东门附近，长三十米。" * 12


def brute_split(c, language):
    """Brute force: the earliest label from which everything reads as pairs."""
    ql, al = P.LABELS[language]

    def parse(t):
        out = []
        while t:
            t = t[len(ql) :]
            if al not in t:
                return "missing_answer_marker"
            q, t = t.split(al, 1)
            a, sep, rest = t.partition(ql)
            if not q.strip():
                return "empty_question"
            if not a.strip():
                return "empty_answer"
            out.append((q, a))
            t = sep + rest
        return out

    if not c:
        return "empty_content"
    at = [i for i in range(len(c)) if c.startswith(ql, i)]
    if not at:
        return "no_question_marker"
    results = [(i, parse(c[i:])) for i in at]
    good = [(i, r) for i, r in results if not isinstance(r, str)]
    if not good:
        return results[0][1]
    return "seed_too_short" if len(c[: good[0][0]].strip()) < 100 else good[0]


@pytest.mark.parametrize("language", ["zh", "en"])
def test_split_against_brute_force(spark, language):
    rng = random.Random(5)
    ql, al = P.LABELS[language]
    cases = [None, "", "x", SRC]
    for _ in range(250):
        cases.append((SRC if rng.random() < 0.8 else "") + "".join(rng.choice([ql, al, " ", "x", "\n\n", "y z"]) for _ in range(rng.randrange(1, 14))))
    got = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string").select("i", Q.split(F.col("c"), language).alias("s")).orderBy("i").collect()
    for c, r in zip(cases, got):
        want = brute_split(c, language)
        if isinstance(want, str):
            assert r.s.failure_reason == want, c
        else:
            assert r.s.failure_reason is None and r.s.seed_text == c[: want[0]] and [(p.question, p.answer) for p in r.s.pairs] == want[1], c


def test_assemble_labels_and_roundtrip(spark):
    d = spark.createDataFrame([(SRC, [("长多少？", "三十米。")]), ("The mill. " * 12, [("Who?", "The mill."), ("Q2", "A2")]), (None, [("q", "a")])], "s string, p array<struct<question:string,answer:string>>")
    r = d.select(Q.assemble(F.col("s"), F.col("p")).alias("c"), Q.roundtrip_ok(F.col("s"), F.col("p"), "en").alias("ok")).collect()
    assert r[0].c == SRC + "\n\n问题： 长多少？ 答案： 三十米。" and r[1].c.endswith("Question: Who? Answer: The mill.\n\nQuestion: Q2 Answer: A2") and r[1].ok
    assert r[2].c == "Question: q Answer: a"


def reasons(spark, pairs, source=SRC):
    d = spark.createDataFrame([("d", source, pairs)], "k string, source_text string, pairs array<struct<question:string,answer:string>>")
    return [(r.question, r.answer, r.reason, r.adjusted) for r in Q.filter_pairs(d, "k").orderBy("pos").collect()]


CASES = [
    ("empty_pair", ("", "x")), ("empty_pair", ("q", None)), ("choice_options_misplaced", ("下列哪一项正确？", "甲 A. 一 B. 二 C. 三")), ("noise_pair", ("请扫码", "好的")), ("source_noise_block", ("水渠多长", "热心网友说三十米")),
    ("reasoning_leak_answer", ("水渠多长", "通常指三十米，个人认为如此")), ("question_answer_identical", ("水渠在哪里", "水渠在哪里。")), ("unanchored_pronoun_question", ("前者是什么", "水渠")), ("meta_question", ("这属于一道选择题吗", "是")),
    ("meta_discourse_answer", ("水渠多长", "让我们换一个更清晰的题")), ("test_meta_reference", ("题目3中问的是什么", "水渠")), ("choice_missing_options", ("下列哪项正确", "甲")),
    ("choice_not_unique", ("下列哪项正确 A. 甲 B. 乙 C. 丙 D. 丁", "均可")), ("unsupported_external_expansion", ("水渠有何典故", "典出庄子逍遥游一篇")), (None, ("水渠在哪里", "水渠在东门附近")),
    (None, ("水渠有何典故", "原文没有说明典故")),
]


def test_each_early_rule(spark):
    got = [reasons(spark, [p])[0][2] for _, p in CASES]
    assert got == [want for want, _ in CASES]


def test_profile_rules(spark):
    exam = "第1题 填空题 ___\n第2题 简答题 甲乙丙丁"
    assert reasons(spark, [("水的沸点是多少度", "一百摄氏度左右的温度")], exam)[0][2] == "unsupported_exam_solution"
    assert reasons(spark, [("属于什么行业", "销售各种家用电器产品")], "联系人：甲\n微信\n地址")[0][2] == "unsupported_contact_inference"
    assert reasons(spark, [("readonly 字段有何特点", "只能在构造函数中赋值")], "readonly 字段说明。构造函数")[0][2] != "unsupported_readonly_or_contrast_expansion"
    ocr = "扬程1倍。5倍，压力35．4MP"
    assert reasons(spark, [("压力多大", "压力为20MP")], ocr)[0][2] == "unsupported_ocr_numeric"
    assert reasons(spark, [("压力多大", "压力为35．4MP")], ocr)[0][2] is None


def test_duplicate_rule_looks_at_kept_pairs_only(spark):
    bad, good = ("水渠在哪里？", "热心网友"), ("水渠在哪里", "水渠在东门附近")
    assert [r[2] for r in reasons(spark, [bad, good, good])] == ["source_noise_block", None, "duplicate_question"]
    late = ("水渠在哪里", "典出庄子逍遥游")
    assert [r[2] for r in reasons(spark, [late, good, late])] == ["unsupported_external_expansion", None, "duplicate_question"]


def test_repairs(spark):
    q, a, reason, adj = reasons(spark, [("水渠在下列哪一项", "东门\nB. 西门\nC. 南门\nD. 北门\n正确答案是A。水渠在东门附近")])[0]
    assert q.endswith("\nA. 东门\nB. 西门\nC. 南门\nD. 北门") and a.startswith("东门。") and reason is None and "choice_options_moved_to_question" in adj
    q, a, reason, adj = reasons(spark, [("水渠在哪里", "正确选项：A. 水渠在东门")])[0]
    assert a == "水渠在东门" and adj == ["choice_answer_label_removed"] * 2
    assert reasons(spark, [("水渠在哪里", "C、D。两者")])[0][1] == "C、D。两者"
    q, a, reason, adj = reasons(spark, [("水渠多长", "水渠在东门附近。因此推动了工业革命的深刻发展")])[0]
    assert a == "水渠在东门附近。" and adj == ["unsupported_tail_trimmed"]


def test_documents_and_empty(spark):
    d = spark.createDataFrame([("a", SRC, [("q1", "水渠"), ("q2", "东门"), ("q1", "水渠")]), ("b", None, [("", "")]), ("c", SRC, []), ("d", SRC, None)], "k string, source_text string, pairs array<struct<question:string,answer:string>>")
    r = {x.k: x for x in Q.filtered_documents(Q.filter_pairs(d, "k"), "k", 1).collect()}
    assert [p.question for p in r["a"].qa_pairs] == ["q1"] and r["a"].removed == ["duplicate_question"] and r["a"].adjusted == ["over_max_trimmed:2->1"]
    assert r["b"].qa_pairs == [] and r["b"].removed == ["empty_pair"] and set(r) == {"a", "b"}
