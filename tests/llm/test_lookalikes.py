import unicodedata

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from millrace.llm import lookalikes as L


def fold(*texts):
    return L.fold_array(pa.array(texts, pa.string())).to_pylist()


SAME = [("ｆｕｌｌ　１", "full 1"), ("é", "é"), ("q̣̇", "q̣̇"), ("ﬁne ﬀ", "fine ff"), ("⼀⼩⽔", "一小水"), ("раура1", "paypa1"), ("Αν", "Av"), ("a​b­c﻿", "abc"), ("a‑b‐c", "a-b-c"),
        ("a\xa0b c　d", "a b c d"), ("й ё", "й ё"), ("豈豈"[1:], "豈"), ("x\r\ny", "x\ny"), ("葛󠄀", "葛"), ("ﾊﾞ", "バ")]
APART = [("a", "A"), ("e", "é"), ("x2", "x²"), ("a-b", "a–b"), ("👩🔬", "👩‍🔬"), ("a b", "a  b"), ("ß", "ss"), ("1", "l")]


@pytest.mark.parametrize("a,b", SAME)
def test_same_look(a, b):
    x, y = fold(a, b)
    assert x == y


@pytest.mark.parametrize("a,b", APART)
def test_apart(a, b):
    x, y = fold(a, b)
    assert x != y


def test_null_empty_and_long():
    assert fold(None, "", "x" * 300_000, "é" * 5000)[:2] == [None, ""]
    assert fold("é" * 5000) == ["é" * 5000] and fold() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x3FF, exclude_categories=["Cs"]), max_size=20), min_size=1, max_size=8))
def test_composed_and_decomposed_agree_and_folding_is_stable(texts):
    a = fold(*texts)
    assert a == fold(*[unicodedata.normalize("NFD", t) for t in texts]) == fold(*[unicodedata.normalize("NFC", t) for t in texts])
    assert fold(*a) == a


def brute(rows):
    f = dict(zip([i for i, _ in rows], fold(*[t for _, t in rows])))
    t = dict(rows)
    return {(a, b) for a in t for b in t if a < b and t[a] is not None and t[b] is not None and f[a] == f[b] and f[a].strip() and t[a] != t[b]}


@pytest.mark.parametrize("hot", [2000, 2])
def test_pairs_against_brute_force(spark, hot):
    rows = [(1, "café"), (2, "café"), (3, "café"), (4, "cafe"), (5, None), (6, " "), (7, "　"), (8, ""), (9, "ｃafé"), (10, "x"), (11, "x")]
    d = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, class_id string")
    got = [tuple(r) for r in L.equal_looking_pairs(d, hot=hot).collect()]
    assert sorted(got) == sorted(brute(rows)) and len(got) == len(set(got))
    assert L.equal_looking_pairs(d.limit(0)).count() == 0


def test_column_keeps_others(spark):
    d = spark.createDataFrame([(1, "ﬁ", "old"), (2, None, "old")], "k int, text string, one_form string")
    assert [tuple(r) for r in L.with_one_form(d).orderBy("k").collect()] == [(1, "ﬁ", "fi"), (2, None, None)]
