"""Problems 1 to 7 on small fixtures, with models fitted on the smallest tables or on their own sentences."""

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import codepages as C, corpus, langid, pages, pairs, quality, residue, truncation

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def records(spark):
    return spark.read.parquet(f"{DIR}/sample_5.parquet")


@pytest.fixture(scope="session")
def texts(records):
    return corpus.texts(records)


@pytest.fixture(scope="session")
def ident(records, texts):
    return langid.identifier(records, texts)


def records_of(spark, rows, columns):
    """Rows as records of both styles: the columns that are missing are null, `style` is a rewrite."""
    d = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    for c in ("uid", "source", "lang", "_source_text", "content"):
        d = d if c in d.columns else d.selectExpr("*", f"cast(null as string) as {c}")
    return d if "style" in d.columns else d.selectExpr("*", "'multi_style' as style")


def pairs_model(d, ident):
    return pairs.pair_model(corpus.texts(d), ident)


@pytest.fixture(scope="session")
def decoder(ident):
    return ident.decoder


@pytest.fixture(scope="session")
def clean(records, decoder):
    """Lines that hold nothing suspicious."""
    lines = {x for r in records.select("_source_text").collect() if r[0] for x in r[0].split("\n") if len(x) > 40}
    return sorted(x for x in lines if not decoder.is_suspicious(x))


SWAPS = [("utf-8", "cp1252"), ("utf-8", "mac_roman"), ("utf-8", "cp437"), ("utf-8", "cp1250"), ("utf-8", "cp1251"), ("koi8_r", "cp1251"), ("cp1251", "cp866"), ("cp1251", "cp1252"), ("gbk", "cp1252")]


@pytest.mark.parametrize("true,shown", SWAPS)
def test_round_trip_of_swaps(clean, decoder, true, shown):
    done = right = 0
    for x in clean:
        wide = sum(ord(c) > 127 for c in x)
        if wide < 3 or (true in ("koi8_r", "cp1251") and not any("а" <= c <= "я" for c in x)) or (true == "gbk" and not any(c > "一" for c in x)):
            continue
        try:
            bad = x.encode(true).decode(shown)
        except UnicodeError:
            continue
        done += 1
        right += decoder.line(bad)[0] == x
        if done == 40:
            break
    assert done and right >= 0.9 * done, (right, done)


def test_clean_lines_stay(clean, decoder):
    assert sum(decoder.line(x)[0] != x for x in clean) <= 0.002 * len(clean)


def test_garbled_rows(spark, decoder):
    good = "Le musée local a décrit l’entrepôt de sel près de la porte est."
    rows = [("a", "s", good, None), ("b", "s", good.encode().decode("cp1252", "replace"), good), ("b", "s", good.encode().decode("cp1252", "replace"), good), ("c", None, None, "caf� noir"), ("d", "s", "", " ")]
    d = records_of(spark, rows, ["uid", "source", "_source_text", "content"])
    got = {(r.uid, r.field): r for r in C.garbled(d, corpus.texts(d), decoder).collect()}
    assert set(got) == {("b", "_source_text"), ("c", "content")} and got["c", "content"].swap is None and got["b", "_source_text"].restored == good
    assert C.garbled(d.limit(0), corpus.texts(d.limit(0)), decoder).count() == 0


def test_garbled_content_includes_its_source_text(spark, decoder):
    good = "Le musée local a décrit l’entrepôt de sel près de la porte est."
    bad, tail = good.encode().decode("cp1252", "replace"), "\n\nQuestion: Why? Answer: It was sold."
    d = records_of(spark, [("a", "qa", bad, bad + tail), ("b", "qa", "Other.", bad + tail)], ["uid", "style", "_source_text", "content"])
    got = {(r.uid, r.field): r.restored for r in C.garbled(d, corpus.texts(d), decoder).collect()}
    assert got == {("a", "_source_text"): good, ("a", "content"): good + tail, ("b", "content"): good + tail}


def test_a_page_of_no_list_is_learnt(spark, records, decoder):
    """Russian texts in a page that no table knows: a byte mapping shaken at random, shown in Greek and Armenian letters."""
    import random

    lines = sorted({x for r in records.where("lang in ('ru', 'RU', 'rus')").select("_source_text").collect() if r[0] for x in r[0].split("\n") if len(x) > 60 and 2 * sum("а" <= c <= "я" for c in x) > len(x) and not decoder.is_suspicious(x)})[:150]
    small = [chr(c) for c in range(0x430, 0x450)]
    shown = [chr(c) for c in range(0x561, 0x561 + 32)]
    random.Random(3).shuffle(shown)
    table = {ord(a): b for a, b in zip(small, shown)}
    rows = [(f"u{i}", f"s{i % 2}", "multi_style", x.lower().translate(table)) for i, x in enumerate(lines)]
    d = records_of(spark, rows, ["uid", "source", "style", "_source_text"])
    got = {r.uid: r for r in C.garbled(d, corpus.texts(d), decoder).collect()}
    right = sum(a == b for i, x in enumerate(lines) if f"u{i}" in got for a, b in zip(got[f"u{i}"].restored, x.lower()))
    assert len(got) >= 0.95 * len(lines) and right >= 0.9 * sum(map(len, lines)), (len(got), len(lines), right / sum(map(len, lines)))


@pytest.mark.parametrize("name", ["p1_found", "p2_found", "p3_found", "p4_found", "p5_found", "p6_found", "p7_found"])
def test_layout_changes_nothing(spark, records, tmp_path, name):
    """One file, and files that scatter the copies of a text, give the same rows."""
    from millrace.llm import queries

    want = None
    for i, d in enumerate((records.coalesce(1), records.repartition(9, "row_id"))):
        d.write.mode("overwrite").parquet(f"{tmp_path}/{i}/sample_5.parquet")
        got = sorted(map(tuple, queries.queries()[name](spark, f"{tmp_path}/{i}").collect()))
        want = want or got
        assert got == want and len(got) == len(set(got)) > 0


def test_labels():
    f = langid.code_of
    assert [f(x) for x in ("EN", "en-US", "zho", "zh_Hans", "Português", "English", "German (Austria)")] == ["en", "en", "zh", "zh", "pt", "en", "de"]
    assert [f(x) for x in (None, "", " ", "??", "und", "xx", "n/a", "it", "ja")] == [None] * 9


def test_label_column_is_the_function(spark):
    from pyspark.sql import functions as F

    xs = ["EN", "en-US", "zh_Hans", "Português", " fr ", None, "", "??", "German (Austria)", "it"]
    got = [r.c for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, l string").select("i", langid.label_code(F.col("l")).alias("c")).orderBy("i").collect()]
    assert got == [langid.code_of(x) for x in xs]


def test_language_accuracy_on_held_out_rows(records, ident):
    rows = records.where("row_id >= 700").select("lang", "_source_text").distinct().collect()
    by = {}
    for r in rows:
        if langid.code_of(r.lang) and r._source_text:
            by.setdefault(r._source_text, []).append(langid.code_of(r.lang))
    agree = [(ident.texts([t])[0] or [(0, None, 0)])[0][1] for t in by]
    hits = [a in ls for a, ls in zip(agree, by.values()) if a]
    assert len(hits) > 100 and np.mean(hits) > 0.85  # labels themselves are wrong for part of the rows


def test_segments_and_unreadable(spark, ident):
    en = "The river council repaired the old stone wharf before the harvest of that year.\nNobody knows who financed the glass roof of the old observatory."
    mixed = en + "\nDas Landesarchiv ordnete nach der langen Dürre eine Sammlung von Samen und Karten.\n据石渡介绍，铜矿在东门附近记录了两艘破损的船。"
    rows = [("a", "en", mixed), ("a", "en", mixed), ("b", "", en), ("c", "en", None), ("d", "en", ""), ("e", "en", "zz. " * 60), ("f", "en", "d393 4153 3abb 5f1c 390f e278 2d26 484b")]
    d = records_of(spark, rows, ["uid", "lang", "_source_text"])
    got = sorted((r.uid, r.seg_no, r.lang) for r in langid.languages(d, corpus.texts(d), ident).collect())
    assert got == [("a", 0, "en"), ("a", 3, "de"), ("a", 4, "zh"), ("b", 0, "en")]


@pytest.fixture(scope="session")
def lines(texts, decoder):
    return pages.line_model(texts, decoder)


def test_furniture(lines):
    body = ["The river council repaired the old stone wharf before the harvest of that year, and nobody knows who financed the roof. " * 2] * 2
    text = ["Home", "Contact", "About us", "A short history of the stone wharf", *body, "Related articles", "- A short history of the town clock", "> How the brick kiln sold the old census", "Back to top"]
    got = lines.furniture_lines("\n".join(text))
    assert set(got) >= {1, 2, 10} and not set(got) & {4, 5, 6} and {8, 9} <= set(got)
    assert lines.furniture_lines("\n".join(body)) == [] and lines.furniture_lines("") == []


def test_scattered_copies_of_a_text_count_once(spark):
    text = "The stone wharf was sold to the river council.\nPhoto: Larby archive"
    d = spark.createDataFrame([(f"u{i}", "multi_style", text, "A rewrite.") for i in range(24)], "uid string, style string, _source_text string, content string").repartition(6)
    got = pages.path_statistics(corpus.texts(d)).agg({"texts": "max", "rewrites": "max"}).first()
    assert tuple(got) == (1, 1)


def test_furniture_rows(spark, lines):
    d = records_of(spark, [("a", "Home\nContact\nAbout us\n" + "Long body text of the page goes on here. " * 6), ("b", None), ("c", "")], ["uid", "_source_text"])
    f = pages.furniture(d.unionByName(d), corpus.texts(d), lines)
    assert {r.uid for r in f.collect()} <= {"a"} and f.count() == f.distinct().count()
    m = {r.uid: r for r in pages.main_text(d, f).collect()}
    assert m["c"].main_text == "" and m["c"].dropped_lines == [] and "Long body" in m["a"].main_text


def test_kinds(spark, decoder, lines):
    fig = quality.Figures(decoder, lines, frozenset(["the"]))
    f = [fig.one(v) for k in quality.KINDS for v in quality.EXAMPLES[k]]
    names = [k for k in quality.KINDS for _ in quality.EXAMPLES[k]]
    m = quality.fit_mixture(spark.createDataFrame([tuple(float(a[c]) for c in quality.FEATURES) for a in f], quality.FEATURES), fig)
    x = quality.in_range(np.array([[a[c] for c in quality.FEATURES] for a in f]))
    assert np.mean([a == b for a, b in zip(m.kinds(x)[0], names)]) > 0.9
    assert fig.one("")["words"] == 0 and fig.one(" \n ")["lines"] == 0 and fig.one("a b. " * 40000)["words"] == 80000


def odd_texts():
    """Characters of every kind, at random and between words: signs, digits and ideographs of all planes, blanks, zeros, letters whose small form is longer."""
    import random

    rng = random.Random(7)
    some = [*"aZé. ,;、；|·>•\t\n\r\x00\x1c\x85\u2028\u3000_0٣９²½İΣßЖ中㐀龥\u9fff\ua000𠀀😀\u0301\U000e0001«»–#*()", "The mill ", "- ", "1. ", "（a）", "ΟΔΟΣ ", "Café ", "据石渡", "5 | 7 | ", "a; b, c; "]
    return ["", "\n", " \n\n x", "\x00", *["".join(rng.choice(some) if rng.random() < 0.8 else chr(rng.choice([rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(rng.randrange(1, 90))) for _ in range(400)]]


def test_counts_of_a_batch_are_those_of_the_patterns():
    texts = odd_texts()
    n, of_lines = quality.Figures._counts(texts)
    assert n["digit"] == [len(quality.DIGIT.findall(t)) for t in texts] and n["sign"] == [len(quality.SIGN.findall(t)) for t in texts] and n["han"] == [len(quality.HAN.findall(t)) for t in texts]
    assert n["pieces"] == [len(t.split()) for t in texts] and n["lines"] == [t.count("\n") + 1 for t in texts] and n["blank"] == [sum(map(t.count, " \t\u3000")) for t in texts]
    lines = [x for t in texts for x in t.split("\n")]
    for got, p in zip(of_lines, (quality.ODD, quality.HAN, quality.PIECE)):
        assert got == [len(p.findall(x)) for x in lines]
    assert [w.split() for w in quality.Figures._words(texts)] == [quality.re.findall(r"[^\W\d_]+", t.lower()) for t in texts]
    assert list(pages.line_ideographs(texts)) == [len(pages.HAN.findall(x)) for x in lines]
    assert all(pages.paths(x.strip(), len(pages.HAN.findall(x))) == pages.paths(x.strip()) for x in lines)
    assert [quality.Figures._variety(t) for t in texts] == [min(1.0, len(set(p)) / min(len(p), 60)) if len(p := t.split() if len(t.split()) >= 12 else [s[i : i + 2] for s in ["".join(t.split())] for i in range(len(s) - 1)]) >= 12 else 1.0 for t in texts]


def test_figures_scan_no_text_character_by_character(decoder, lines, monkeypatch):
    """What p4_found has to count in every text is counted for a batch at once; the patterns run over no whole text."""
    quality.Figures(decoder, lines, frozenset()).one("The first call may build the table of classes.")

    class Never:
        def findall(self, _):
            raise AssertionError("a pattern ran over a text")

        search = findall

    for name in ("SIGN", "ODD", "DIGIT"):
        monkeypatch.setattr(quality, name, Never())
    f = quality.Figures(decoder, lines, frozenset(["the"]), True).one("The mill – 12 boats.\n- The bridge; 7 §")
    assert (f["words"], f["lines"]) == (5, 2) and f["digit_ratio"] == 3 / 29 and f["symbol_ratio"] == 2 / 29 and f["common_word_share"] == 2 / 5


def test_e_step_against_loops():
    rng = np.random.default_rng(1)
    x, at = rng.random((40, 10)), rng.random((3, 10))
    m = quality.Mixture(x.mean(axis=0), x.std(axis=0), at)
    z = (x - m.mean) / m.scale
    dens = np.array([[m.pi[k] * np.prod(np.exp(-0.5 * (r - m.mu[k]) ** 2 / m.var[k]) / np.sqrt(m.var[k])) for k in range(3)] for r in z])
    post = dens / dens.sum(axis=1, keepdims=True)
    assert np.allclose(m._posterior(z)[0], post) and np.allclose(m.expected(x)[:-1, 0], post.sum(axis=0)) and np.allclose(m.expected(x)[:-1, 1:11], post.T @ z)


def test_residue(texts):
    m = residue.residue_model(texts)
    prose = "The river council repaired the old stone wharf before the harvest. Nobody knows who financed the glass roof of the old observatory, but the ferry crew sold it. "
    cases = {
        None: [prose, prose + "The course explains how JavaScript runs in a browser.", prose + "In the notation {a, b, c} the braces hold a set [2].", prose + "The ticket cost $4 [sic], the sign read <closed>.", "", None],
        "placeholder": [prose + "{{ page.title }}", prose + "TODO: add example here", prose + "[INSERT DATE]", prose + "${topic}", "实际上，【请填写标题】水渠在东门附近。"],
        "error_page": ["404 Not Found\nThe page Harbour-9 could not be found on this server.", "系统繁忙，请稍后再试。错误代码：77", "Fehler 404: Die Seite Neustadt wurde nicht gefunden."],
        "script_notice": ["Please enable JavaScript to view this page.", "请启用JavaScript后再访问北镇。"],
        "filler": ["Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt.", "此处为示例文字，请替换。此处为示例文字，请替换。"],
    }
    for kind, values in cases.items():
        assert m.kinds(pa.array(values, pa.string())) == [kind] * len(values), kind


def test_residue_rows(spark, texts, decoder):
    m = residue.residue_model(texts)
    d = spark.createDataFrame([("a", "Please enable JavaScript to view this page."), ("a", "Please enable JavaScript to view this page."), ("b", None), ("c", "")], "uid string, content string")
    assert [tuple(r) for r in residue.residues(d, m, decoder).collect()] == [("a", "script_notice")]


def test_split_and_defects(texts, ident):
    m = pairs.pair_model(texts, ident)
    q = "Why is the town clock mentioned?"
    cases = [
        ((q, ""), "empty_answer"), ((q, "N/A"), "empty_answer"), ((q, " — "), "empty_answer"), ((q, "..."), "empty_answer"),
        ((q, "I'm sorry, but I can't help with that."), "refusal"), (("Was steht im Text?", "Als KI-Modell kann ich diese Frage nicht beantworten."), "refusal"), (("是哪一年？", "抱歉，我无法回答这个问题。"), "refusal"),
        ((q, "Why is the town clock mentioned"), "copied_question"), ((q, "“why is the town clock mentioned?”"), "copied_question"), (("True or false: the mill sold the old census.", "True or false: the mill sold the old census."), "copied_question"),
        ((q, "Because the choir school repaired the old census near the eas"), "truncated_answer"), ((q, "The town clock was sold. After that the river co"), "truncated_answer"), ((q, "Because the choir school repaired the…"), "truncated_answer"),
        ((q, "Weil das Landesarchiv nach der langen Dürre eine Sammlung von Samen ordnete."), "other_language"), ((q, "因为铜矿在东门附近记录了两艘破损的船。"), "other_language"),
        ((q, "Because the choir school repaired it."), None), (("True or false: the mill sold the old census.", "False; the kiln sold the old census."), None), (("Which?\nA. the mill\nB. the kiln\nC. the roof\nD. the old census", "D. the old census"), None),
        (("What did Larby say?", "“I'm sorry, the bridge is closed,” Larby said late in 1915."), None), ((q, "The words “Zutritt verboten”, painted outside Ornby."), None), ((q, "The text does not say."), None),
    ]
    for (a, b), want in cases:
        got = m.defects([(a, b), (q, "It is mentioned because the seed bank sold it.")] if a.isascii() else [(a, b)])[0]
        assert got == want, (a, b, got)
    text = "Source text.\n\nQuestion: one? Answer: 1.\n\nQuestion: two?\nAnswer: 2."
    assert pairs.split_pairs(text, "Source text.") == [("one?", "1."), ("two?", "2.")] and pairs.split_pairs("", None) == []
    assert pairs.split_pairs("x\n\n问题： 甲？ 答案： 乙。\n\n问题： 丙？", None) == [("甲？", "乙。"), ("丙？", "")]


def test_lcs_against_brute_force():
    import random

    rng = random.Random(2)

    def brute(a, b):
        return 0 if not a or not b else (1 + brute(a[1:], b[1:]) if a[0] == b[0] else max(brute(a[1:], b), brute(a, b[1:])))

    for _ in range(80):
        a, b = ([rng.choice("abc") for _ in range(rng.randrange(7))] for _ in range(2))
        assert pairs._lcs(a, b) == brute(a, b)


def test_pair_rows(spark, texts, ident):
    m = pairs.pair_model(texts, ident)
    rows = [("a", "qa", "S.\n\nQuestion: Why? Answer: N/A", "S."), ("a", "qa", "S.\n\nQuestion: Why? Answer: N/A", "S."), ("b", "qa", None, "S."), ("c", "qa", "no pairs", None), ("d", "multi_style", "Question: x Answer: ", None)]
    d = spark.createDataFrame(rows, "uid string, style string, content string, _source_text string")
    assert [tuple(r) for r in pairs.defective_pairs(d, corpus.texts(d), m).collect()] == [("a", 1, "empty_answer")]


def test_copies_of_a_cut_answer_count_once(spark, ident):
    body = "Question: Why? Answer: Because the ferry crew of Larby quietly bor"
    rows = [(f"c{i}", "qa", body, None) for i in range(40)] + [(f"r{i}", "qa", f"Question: How many {i}? Answer: 7 boats\n\nQuestion: And {i}? Answer: 8 boats", None) for i in range(3)]
    d = spark.createDataFrame(rows, "uid string, style string, content string, _source_text string").repartition(4)
    got = {tuple(r) for r in pairs.defective_pairs(d, corpus.texts(d), pairs_model(d, ident)).collect()}
    assert got == {(f"c{i}", 1, "truncated_answer") for i in range(40)}
    assert sorted(r.n for r in pairs.open_answers(corpus.texts(d)).collect()) == [1, 6]


def test_censored_fit_finds_limits():
    rng = np.random.default_rng(4)
    full = np.exp(rng.normal(6.5, 0.5, 6000)).astype(int)
    seen = np.where(full > 800, 800, full)
    lengths, counts = np.unique(seen, return_counts=True)
    mu, sd, lim = truncation.censored_fit(lengths, counts)
    assert set(lim) == {800} and lim[800] > 0.95 and abs(mu - 6.5) < 0.1 and abs(sd - 0.5) < 0.1
    lengths, counts = np.unique(full, return_counts=True)
    assert not truncation.censored_fit(lengths, counts)[2]


def test_neighbours_check_the_curve_at_every_size():
    lengths = np.concatenate([np.arange(1, 21001), np.arange(100000, 110000)])
    assert not truncation.censored_fit(lengths, np.full(len(lengths), 6))[2]


def test_strong_limit_outweighs_a_known_ending(spark):
    rng = np.random.default_rng(5)
    whole = np.exp(rng.normal(6.0, 0.4, 1500)).astype(int)
    rows = [(f"w{i}", "s", "content", int(n), int(n), i, "known" if i % 40 == 0 else "closed") for i, n in enumerate(whole) if n != 900]
    rows += [(f"c{i}", "s", "content", 900, 900, 10_000 + i, "open" if i else "known") for i in range(150)] + [("k", "s", "content", 700, 700, 20_000, "known")]
    v = truncation.truncated(spark.createDataFrame(rows, "uid string, source string, field string, chars int, bytes int, h long, ending string"))
    got = {r.uid for r in v.where("log_odds > 0").collect()}
    assert got == {f"c{i}" for i in range(150)}


def test_limits_overrule_known_endings():
    rows = [("known", 0.0, 300), ("known", 0.99, 20), ("open", 0.99, 400), ("open", 0.0, 100), ("short_unknown", 0.99, 60), ("short_unknown", 0.0, 25)]
    ratio, base = truncation.learn_ratios([e for e, _, _ in rows], np.array([p for _, p, _ in rows]), np.array([float(n) for *_, n in rows]))
    assert ratio["known"] + np.log(0.999 / 0.001) > 0 > ratio["known"] + base and ratio["open"] + base > 0


@pytest.fixture(scope="session")
def ends(texts, ident):
    return truncation.endings(texts, ident)


def test_whole_open_answers_leave_room_for_a_limit(ends):
    e, _ = ends
    options = "Question: Which?\nA. the mill\nB. the kiln\nAnswer: "
    assert e.of_pairs(options + "B. the kiln") == "known" and e.of_pairs(options + "B. the kiln.") == "closed"


def test_endings(ends):
    e, _ = ends
    body = "The river council repaired the old stone wharf before the harvest of that year. Nobody knows who financed the glass roof. "
    want = {"closed": [body, body + "\n\n", ""], "open": [body + "After the long drought the choir of Larby sold the ol"], "mark": [body + "After the long drou…", body + "After [...]"], "junk": ["zz " * 50]}
    for kind, values in want.items():
        assert [e.of_text(v)[0] for v in values] == [kind] * len(values)
    assert e.of_text(body + "\nBack to top")[0] == "known" and e.of_pairs("Question: a? Answer: It was sol") == "open" and e.of_pairs("Question: a? Answer: It was sold.") == "closed"


def test_truncated_rows(spark, ends):
    cut = "The river council repaired the old stone wharf. After the long drought the choir of Larby sold the ol"
    rows = [("a", "s", "multi_style", "Fine.", cut), ("a", "s", "multi_style", "Fine.", cut), ("b", None, "qa", "S.\n\nQuestion: a? Answer: It was sol", "S."), ("c", "s", "qa", None, ""), ("d", "s", "multi_style", " ", None)]
    d = spark.createDataFrame(rows, "uid string, source string, style string, content string, _source_text string")
    v = truncation.truncated(truncation.measured(d, corpus.texts(d), *ends))
    assert sorted((r.uid, r.field) for r in v.where("log_odds > 0").collect()) == [("a", "_source_text"), ("b", "content")]
    assert {r.source: r.cut for r in truncation.cut_shares(v).collect()} == {"s": 1, "": 0}
    assert truncation.truncated(truncation.measured(d.limit(0), corpus.texts(d.limit(0)), *ends)).count() == 0


def test_every_query_runs(spark):
    from millrace.llm import queries

    for name in ("p1_found", "p2_shares", "p3_found", "p5_main_text", "p9_shares", "p10_one_form"):
        assert queries.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
