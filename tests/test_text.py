from pyspark.sql import functions as F

from millrace.functions import text as T


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(f(F.col("t")).alias("r")).first()["r"]


def test_strip_is_pythons(spark):
    for s in ["　 a b 　", "\x1c\x1fx\x85", "", "\n\t", "a", " x "]:
        assert one(spark, s, T.strip_u) == s.strip()


def test_lines_are_pythons(spark):
    for s in ["a\nb", "a\r\nb\r", "a\x85b c\x1dd", "", "\n", "a\n\nb\n", "\x0bx"]:
        assert one(spark, s, T.split_lines) == s.splitlines()
        assert one(spark, s, T.raw_lines) == s.splitlines(True)


def test_compact_key(spark):
    assert one(spark, "A_b １ 中文，é!", T.compact_key) == "ab１中文é"
    assert one(spark, None, T.compact_key) == ""


def support(a, s):
    import re

    k = lambda x: re.sub(r"[\s\W_]+", "", (x or "").lower())
    a, s = k(a), k(s)
    if len(a) < 3 or not s:
        return 0.0
    c = [a[i : i + 3] for i in range(len(a) - 2)]
    return sum(x in s for x in c) / len(c)


def test_trigram_support(spark):
    rows = [("The mill stood", "a mill stood there"), ("ab", "abc"), ("水渠很长", "这条水渠很长。"), (None, "x"), ("abc", None), ("abcabc", "abc"), ("", "")]
    got = spark.createDataFrame(rows, "a string, s string").select(T.trigram_support(F.col("a"), F.col("s")).alias("r")).collect()
    assert [r["r"] for r in got] == [support(*x) for x in rows]


def test_first_text_takes_the_first_that_is_there_then_strips(spark):
    d = spark.createDataFrame([("", "　x ", "y"), (" ", "x", "y"), (None, None, None)], "a string, b string, c string")
    assert [r["r"] for r in d.select(T.first_text(F.col("a"), F.col("b"), F.col("c")).alias("r")).collect()] == ["x", "", ""]


def test_clip_and_snippet(spark):
    assert one(spark, "abcdefgh", lambda c: T.clip(c, 4)) == "ab" + T.CUT_MARK + "gh"
    assert one(spark, "abcd", lambda c: T.clip(c, 4)) == "abcd"
    assert one(spark, " a \n b  c ", lambda c: T.snippet(c, 3)) == "a b..."


def test_template_fills_in_order(spark):
    r = one(spark, "doc with {min_pairs}", lambda c: T.fill_template(F.lit("{document}/{min_pairs}"), [("document", c), ("min_pairs", F.lit("3"))]))
    assert r == "doc with 3/3"
