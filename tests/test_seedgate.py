from pyspark.sql import functions as F

from millrace.operators import seedgate as S

BODY = "The old mill by the river was repaired in the spring and painted again in autumn. " * 8


def gated(spark, texts, **kw):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seed_pos long, text string")
    return {r.seed_pos: r for r in S.gate(d, **kw).collect()}


def test_lengths_and_clip(spark):
    r = gated(spark, ["x" * 499, "word " * 99 + "abcde", None, "", "y" * 9000])
    assert r[0].drop_reason == "too_short" and r[1].drop_reason is None
    assert r[2].drop_reason == r[3].drop_reason == "too_short" and len(r[4].text) == 8000


def test_head_wrappers(spark):
    lines = ["首页 | 登录", "扫码关注我们"] + ["The old mill by the river was repaired in the spring."] * 3
    d = spark.createDataFrame([("\n".join(lines),)], "text string")
    r = S.with_edits(d, min_chars=50).first()
    assert r.text == "\n".join(lines[2:]) and r.edit_reason == "head:首页 | 登录,扫码关注我们"
    assert S.with_edits(d, min_chars=500).first().edit_reason == "unchanged"
    late = spark.createDataFrame([("\n".join([lines[2]] * 8 + ["扫码关注我们"] + [lines[2]]),)], "text string")
    assert "head" not in S.with_edits(late, min_chars=5000).first().edit_reason


def test_tail_cut(spark):
    text = BODY + "\n阅读原文\nmore"
    r = S.with_edits(spark.createDataFrame([(text,), (BODY + "\n阅读原文献说明\nmore",)], "text string")).collect()
    assert r[0].text == BODY.strip() and r[0].edit_reason == "tail:阅读原文"
    assert r[1].edit_reason == "unchanged"


def test_descending_ranges():
    f = S.descending_ranges
    assert [x["match"] for x in f("温度 30~20 度")] == ["30~20"]
    for sep in "~～—–-至到":
        assert f(f"9{sep}3") and not f(f"3{sep}9") and not f(f"3{sep}3")
    assert not f("2024-05-03") and not f("GB/T 1234-98") and not f("10:30-9:45") and not f("1234567-3")
    assert f("0.22~0.2") and not f("")


def test_numeric_column_is_the_function(spark):
    texts = ["9~3 and 3~9", "GB 50-20", None, "", "a 12.5-3.5 b"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(F.size(S.numeric_reasons(F.col("t"))).alias("n")).collect()
    assert [r.n for r in got] == [len(S.descending_ranges(t or "")) for t in texts]


def test_filter_on_the_reason(spark):
    texts = [BODY + "It holds 9-5 kg.", BODY + "It holds 5-9 kg.", "首页 | 登录\n" + BODY + "\n5-9\n阅读原文\nmore", "short 5-9"]
    d = spark.createDataFrame(list(enumerate(texts)), "seed_pos long, text string")
    kept = S.gate(d).where("drop_reason is null").select("seed_pos", "text").collect()
    assert {r.seed_pos: r.text for r in kept} == {1: texts[1], 2: BODY + "\n5-9"}
    assert [r.seed_pos for r in S.gate(d).where("drop_reason = 'descending_numeric_range'").select("seed_pos").collect()] == [0]


def test_low_density(spark):
    rows = {
        "empty": "  ", "ocr_garble_punct": "文字。。文，，字。、" * 5, "pure_link_navigation": "\n".join(["https://a.b/c"] * 8),
        "pure_marketing_conversion": "\n".join(["扫码关注公众号"] * 5 + ["end"]), "short_line_low_density": "\n".join(["ab"] * 4),
        "repetitive_low_density": "\n".join(["same line here. it is;"] * 9), None: BODY,
    }
    got = spark.createDataFrame([(v,) for v in rows.values()], "t string").select(S.low_density_reason(F.col("t")).alias("r")).collect()
    assert [r.r for r in got] == list(rows)


def labels(spark, *texts):
    return [r.r for r in spark.createDataFrame([(t,) for t in texts], "t string").select(S.english_labels(F.col("t")).alias("r")).collect()]


def test_english_labels(spark):
    got = labels(
        spark, "plain text", "a\nSubscribe\nb", "please share", "http://a http://b http://c " + BODY, "<div>x</div> &amp;", "cafÃ©", "ж" * 40 + BODY, "posted by me", "buy now with coupon",
        "one discount only", "proceedings of the day", "from 9 to 3", "range 3-9", None, "",
    )
    assert got == [[], ["web_wrapper_noise"], [], ["url_link_heavy"], ["html_artifact"], ["encoding_artifact"], ["non_english_text"], ["forum_personal_fragment"], ["ecommerce_affiliate_promotion"],
                   [], ["bibliographic_metadata_fragment"], ["corrupted_numeric_range"], [], [], []]
    assert "abrupt_truncation" in labels(spark, BODY + "It was in the")[0] and not labels(spark, BODY)[0]


def test_dedup_modes(spark):
    rows = [(3, "b" * 12), (1, "a"), (2, "a"), (5, "b" * 11), (4, "c")]
    d = spark.createDataFrame(rows, "seed_pos long, text string")
    keep = lambda **k: sorted(r.seed_pos for r in S.dedup(d, max_chars=10, **k).collect())
    assert keep() == [1, 3, 4] and keep(compat=True) == [1, 3, 4, 5]


def collector(rows, min_chars, max_chars):
    """Brute force of the collector with its quirk."""
    seen, out = set(), []
    for pos, t in sorted(rows):
        if not t or t in seen or len(t) < min_chars:
            continue
        t = t[:max_chars].rstrip() if len(t) > max_chars else t
        seen.add(t)
        out.append(pos)
    return out


def test_collect_against_brute_force(spark):
    import random

    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randrange(0, 9)))) for i in range(120)] + [(999, None)]
    d = spark.createDataFrame(rows, "seed_pos long, text string")
    got = sorted(r.seed_pos for r in S.collect(d, min_chars=2, max_chars=5, compat=True).collect())
    assert got == collector(rows, 2, 5)


def test_empty_table_and_clashing_columns(spark):
    d = spark.createDataFrame([], "seed_pos long, text string, _short string, drop_reason string")
    assert S.gate(d.drop("_short", "drop_reason")).count() == 0
    assert S.seed_text(spark.createDataFrame([(1,)], "k int")).first()["text"] == ""
