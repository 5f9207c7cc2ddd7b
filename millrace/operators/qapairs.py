"""Question-answer pairs: assembling records, splitting them again, and the ordered rule cascade over pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import patterns as P
from ..functions.text import bind, compact_key, count_of, is_zh, share_of, strip_u, stripped_lines, trigram_support

PAIRS = "array<struct<question:string,answer:string>>"
MIN_SEED = 100


def normalized(pairs: Column) -> Column:
    """Both sides as text, stripped; null becomes ''."""
    return F.transform(pairs, lambda p: F.struct(strip_u(F.coalesce(p["question"], F.lit(""))).alias("question"), strip_u(F.coalesce(p["answer"], F.lit(""))).alias("answer")))


def assemble(source: Column, pairs: Column, labels: str = "auto") -> Column:
    """Source text, then one block per pair, blank lines between. Labels by the source's script, or 'zh' or 'en'."""
    zh = is_zh(source) if labels == "auto" else F.lit(labels == "zh")
    q = F.when(zh, F.lit(P.LABELS["zh"][0])).otherwise(F.lit(P.LABELS["en"][0]))
    a = F.when(zh, F.lit(P.LABELS["zh"][1])).otherwise(F.lit(P.LABELS["en"][1]))
    blocks = F.transform(pairs, lambda p: F.concat(q, F.lit(" "), p["question"], F.lit(" "), a, F.lit(" "), p["answer"]))
    return strip_u(F.array_join(F.concat(F.array(strip_u(F.coalesce(source, F.lit("")))), blocks), "\n\n"))


def split(content: Column, language: str, min_seed: int = MIN_SEED) -> Column:
    """struct(seed_text, pairs, failure_reason): the inverse of assemble for one label language.

    Both sides keep their exact characters. The pairs are the longest suffix that reads as question-answer pairs with neither side empty; one fold from the right over the
    pieces between question labels, linear in the text. A piece without an answer label belongs to the question after it."""
    ql, al = P.LABELS[language]
    c = F.coalesce(content, F.lit(""))
    return bind(F.struct(c.alias("c"), F.split(c, ql, -1).alias("pieces")), lambda x: _split_by_scan(x["c"], x["pieces"], ql, al, min_seed))


def _split_by_scan(c: Column, pieces: Column, ql: str, al: str, min_seed: int) -> Column:
    """One right fold over the pieces between question labels."""
    n = F.size(pieces) - 1
    empty = F.array().cast(PAIRS)
    # Reading forward from a label: everything up to the first answer label is the question, with any labels inside it; the answer
    # runs to the next question label after that. So from the right: p_* is the parse from the label just right of here on,
    # r_* the parse of what follows the answer that is still without its question's beginning.
    init = F.struct(
        F.lit(True).alias("p_ok"), empty.alias("p_pairs"), F.lit("").alias("p_why"), F.lit("").alias("q"), F.lit("").alias("a"), F.lit(False).alias("has"),
        F.lit(True).alias("r_ok"), empty.alias("r_pairs"), F.lit("").alias("r_why"), F.lit(0).alias("i"), F.lit(0).alias("good"), empty.alias("good_pairs"))

    def fold(s: Column, piece: Column) -> Column:
        at = F.instr(piece, al)
        own = at > 0
        q = F.when(own, F.left(piece, at - 1)).when(s["i"] == 0, piece).otherwise(F.concat(piece, F.lit(ql), s["q"]))
        a = F.when(own, F.substring(piece, at + F.lit(len(al)), F.length(piece))).otherwise(s["a"])
        has = own | s["has"]
        r_ok = F.when(own, s["p_ok"]).otherwise(s["r_ok"])
        r_pairs = F.when(own, s["p_pairs"]).otherwise(s["r_pairs"])
        r_why = F.when(own, s["p_why"]).otherwise(s["r_why"])
        why = F.when(~has, F.lit("missing_answer_marker")).when(F.length(strip_u(q)) == 0, F.lit("empty_question")).when(F.length(strip_u(a)) == 0, F.lit("empty_answer")).when(~r_ok, r_why).otherwise(F.lit(""))
        ok = why == ""
        pairs = F.when(ok, F.concat(F.array(F.struct(q.alias("question"), a.alias("answer"))), r_pairs)).otherwise(empty)
        return F.struct(
            ok.alias("p_ok"), pairs.alias("p_pairs"), why.alias("p_why"), q.alias("q"), a.alias("a"), has.alias("has"), r_ok.alias("r_ok"), r_pairs.alias("r_pairs"), r_why.alias("r_why"),
            (s["i"] + 1).alias("i"), F.when(ok, s["i"] + 1).otherwise(s["good"]).alias("good"), F.when(ok, pairs).otherwise(s["good_pairs"]).alias("good_pairs"))

    done = F.aggregate(F.reverse(F.slice(pieces, 2, F.greatest(n, F.lit(1)))), init, fold)
    prefix = lambda s: F.array_join(F.slice(pieces, 1, n + 1 - s["good"]), ql)
    none = F.lit(None).cast("string")

    def result(seed: Column, pairs: Column, reason: Column) -> Column:
        return F.struct(seed.alias("seed_text"), pairs.alias("pairs"), reason.alias("failure_reason"))

    def judge(s: Column) -> Column:
        seed = prefix(s)
        return F.when(s["good"] == 0, result(none, empty, s["p_why"])).when(F.length(strip_u(seed)) < min_seed, result(none, empty, F.lit("seed_too_short"))).otherwise(result(seed, s["good_pairs"], none))

    held = bind(done, judge)
    return F.when(F.length(c) == 0, result(none, empty, F.lit("empty_content"))).when(n == 0, result(none, empty, F.lit("no_question_marker"))).otherwise(held)


def roundtrip_ok(source: Column, pairs: Column, language: str) -> Column:
    """Whether assembling and splitting gives the same pairs again."""
    return F.coalesce(normalized(split(assemble(source, pairs, language), language)["pairs"]) == normalized(pairs), F.lit(False))


def generated_pairs(df: DataFrame, language: str, record: str = "generated_record") -> DataFrame:
    """pairs (stripped) and failure_reason of the content of a generated record; a missing record has the reason 'empty_content'."""
    s = split(F.col(f"{record}.content"), language)
    return df.withColumn("_s", s).withColumn("pairs", normalized(F.col("_s.pairs"))).withColumn("failure_reason", F.col("_s.failure_reason")).drop("_s")


# ---------------------------------------------------------------- the cascade


def distinct_options(c: Column) -> Column:
    return F.size(F.array_distinct(F.regexp_extract_all(c, F.lit(P.QA_OPTION), F.lit(1))))


def source_profile(df: DataFrame, source: str = "source_text", out: str = "profile") -> DataFrame:
    """The kinds of page a source text may be, once per document and before its pairs are exploded."""
    t = F.coalesce(F.col(source), F.lit(""))
    return df.withColumn(out, bind(F.struct(t.alias("t"), stripped_lines(t).alias("lines")), lambda x: _profile(x["t"], x["lines"])))


def _profile(t: Column, lines: Column) -> Column:
    short = share_of(lines, lambda x: F.length(x) <= 30)
    ask = lambda x: (x.rlike(P.NUMBERED) & x.rlike("[？?]")) | ((F.length(x) <= 50) & x.rlike(r"[?？]\z"))
    n = F.size(lines)
    return F.struct(
        ((n >= 4) & (share_of(lines, lambda x: x.rlike(P.TOC_NUMBER) | x.rlike(P.TOC_HEAD)) >= 0.45)).alias("toc"),
        ((n >= 2) & (t.rlike(P.ASK_VERB) | (share_of(lines, ask) >= 0.4))).alias("questions"),
        (t.rlike(P.EXERCISE) | (t.rlike(P.EXERCISE_PAIR) & t.rlike(P.EXERCISE_CHARS))).alias("exercise"),
        (t.rlike(P.EXAM) & ~t.rlike(P.EXAM_ANSWERED) & (n >= 2) & (F.size(F.filter(lines, lambda x: x.rlike(P.EXAM_LINE))) >= 2)).alias("exam"),
        ((n >= 3) & (share_of(lines, lambda x: x.rlike(P.CONTACT)) >= 0.25)).alias("contact"),
        ((count_of(t, P.SYMBOLS) >= 6) | ((n >= 6) & (short >= 0.6) & t.rlike(P.SYMBOLS))).alias("symbolic"),
        t.rlike(P.VISUAL_TITLE).alias("visual"), F.array_distinct(F.regexp_extract_all(t, F.lit(P.OCR_NUMBER), F.lit(0))).alias("ocr_numbers"))


def move_options(q: Column, a: Column) -> Column:
    """struct(question, answer, moved): options that stand in the answer go to the question, if the answer names the right one."""
    block = lambda i: F.regexp_extract(a, P.QA_OPTION_BLOCK, i)
    rest = strip_u(block(5))
    letter = F.translate(F.regexp_extract(rest, P.QA_VERDICT, 1), "ＡＢＣＤ", "ABCD")
    options = [strip_u(block(i)) for i in range(1, 5)]
    ok = (distinct_options(q) < 4) & a.rlike(P.QA_OPTION_BLOCK) & rest.rlike(P.QA_VERDICT) & reduce(lambda x, y: x & y, [F.length(o) > 0 for o in options])
    verdict = F.regexp_extract(rest, P.QA_VERDICT, 0)
    evidence = strip_u(F.regexp_replace(F.substring(rest, F.instr(rest, verdict) + F.length(verdict), F.length(rest)), r"\A[。.：: 、，,]+", ""))
    right = F.element_at(F.create_map(*[x for k, o in zip("ABCD", options) for x in (F.lit(k), o)]), letter)
    moved_q = F.concat(strip_u(q), F.lit("\n"), F.concat_ws("\n", *[F.concat(F.lit(f"{k}. "), o) for k, o in zip("ABCD", options)]))
    moved_a = F.concat(right, F.lit("。"), evidence)
    return F.struct(F.when(ok, moved_q).otherwise(q).alias("question"), F.when(ok, moved_a).otherwise(a).alias("answer"), F.coalesce(ok, F.lit(False)).alias("moved"))


def clean_label(a: Column) -> Column:
    """struct(answer, times): the label words of an answer taken off, a letter only where the answer isn't a choice of several."""
    one = strip_u(F.regexp_replace(strip_u(a), P.QA_LABEL, ""))
    two = strip_u(F.regexp_replace(one, P.QA_LETTER, ""))
    letter = (two != one) & ~one.rlike(P.QA_MULTI)
    return F.struct(F.when(letter, two).otherwise(one).alias("answer"), ((one != strip_u(a)).cast("int") + letter.cast("int")).alias("times"))


def trim_tail(a: Column, source: Column) -> Column:
    """struct(answer, trimmed): only the first sentence, if the source holds it and not the speculation after it."""
    t = strip_u(a)
    parts = F.struct(strip_u(F.regexp_extract(t, P.QA_FIRST_SENTENCE, 1)).alias("first"), strip_u(F.regexp_extract(t, P.QA_FIRST_SENTENCE, 2)).alias("tail"))
    return bind(parts, lambda x: _trim_tail(a, t, source, x["first"], x["tail"]))


def _trim_tail(a: Column, t: Column, source: Column, first: Column, tail: Column) -> Column:
    key = compact_key(F.regexp_replace(first, P.QA_VERDICT_WORD, ""))
    cut = t.rlike(P.QA_FIRST_SENTENCE) & (F.length(key) >= 2) & F.contains(compact_key(source), key) & (trigram_support(tail, source) < 0.25) & tail.rlike(P.QA_RISKY_TAIL)
    return F.struct(F.when(cut, first).otherwise(a).alias("answer"), F.coalesce(cut, F.lit(False)).alias("trimmed"))


def rules(q: Column, a: Column, src: Column, doc: Column, support: Column) -> tuple[list[tuple[str, Column]], list[tuple[str, Column]]]:
    """(reason, condition) in order: those before the duplicate rule, and those after it."""
    qa = F.concat_ws(" ", q, a)
    qk, ak = compact_key(q), compact_key(a)
    absent = a.rlike(P.QA_ABSENT)
    leaks = count_of(a, P.QA_REASONING)
    choice = q.rlike(P.QA_CHOICE)
    options = distinct_options(q)
    ids = F.regexp_extract_all(qa, F.lit(P.SECTION_ID), F.lit(0))
    before = [
        ("empty_pair", (F.length(q) == 0) | (F.length(a) == 0)),
        ("choice_options_misplaced", (options < 4) & (distinct_options(a) >= 3)),
        ("noise_pair", q.rlike(P.QA_NOISE) | a.rlike(P.QA_NOISE)),
        ("source_noise_block", a.rlike(P.QA_SOURCE_NOISE)),
        ("reasoning_leak_answer", (leaks >= 1) & ((leaks >= 2) | (F.length(a) >= 80))),
        ("question_answer_identical", (F.length(qk) > 0) & (F.length(ak) > 0) & ((qk == ak) | ((F.length(qk) >= 10) & (F.length(ak) >= 10) & (F.contains(qk, ak) | F.contains(ak, qk))))),
        ("unanchored_pronoun_question", q.rlike(P.QA_PRONOUN) & ~q.rlike("[“”‘’\"'《》]")),
        ("meta_question", qa.rlike(P.QA_META) & ~(doc["exam"] & q.rlike(P.EXAM_TYPE))),
        ("meta_discourse_answer", a.rlike(P.QA_DISCOURSE)),
        ("test_meta_reference", strip_u(q).rlike(P.QA_TEST_REFERENCE)),
        ("choice_missing_options", choice & (options < 4)),
        ("choice_not_unique", choice & (options >= 4) & a.rlike(P.QA_NOT_UNIQUE)),
    ]
    claim = qa.rlike(P.VISUAL_CLAIM) | (qa.rlike(P.VISUAL_HIDDEN) & ~qa.rlike(P.VISUAL_HIDDEN_FRAMED))
    after = [
        ("unsupported_external_expansion", qa.rlike(P.QA_EXTERNAL) & ~absent & (support < 0.35)),
        ("unsupported_ocr_numeric", (F.size(doc["ocr_numbers"]) > 0) & ~qa.rlike(P.OCR_DISCLAIMER) & ~F.exists(doc["ocr_numbers"], lambda f: F.contains(a, f)) & qa.rlike(P.NUMBER_UNIT)),
        ("unsupported_readonly_or_contrast_expansion", qa.rlike(P.READONLY) & ~absent & qa.rlike(P.RUNTIME) & ~src.rlike(P.RUNTIME_IN_SOURCE)),
        ("unsupported_profile_inference", (doc["toc"] | doc["questions"]) & q.rlike(P.QA_INFERENTIAL) & (support < 0.35)),
        ("unsupported_exam_solution", doc["exam"] & ~q.rlike(P.EXAM_STRUCTURAL) & (support < 0.55)),
        ("unsupported_contact_inference", doc["contact"] & (support < 0.45) & qa.rlike(P.CONTACT_INFERENCE)),
        ("unsupported_word_exercise_semantic", doc["exercise"] & qa.rlike(P.WORD_SEMANTIC) & qa.rlike(P.WORD_TOPIC)),
        ("unsupported_symbolic_inference", doc["symbolic"] & F.when(qa.rlike(P.SYMBOL_RELATION) & src.rlike(P.SYMBOL_SIGNS), True).when(qa.rlike(P.SYMBOL_LITERAL) & ~qa.rlike(P.SYMBOL_SEMANTIC), False).when(support >= 0.55, False).otherwise(qa.rlike(P.SYMBOL_INFERENCE))),
        ("unsupported_symbolic_section_mismatch", doc["symbolic"] & qa.rlike(P.SECTION_WORDS) & (F.size(ids) > 0) & F.forall(ids, lambda x: ~F.contains(src, x))),
        ("unsupported_visual_inference", doc["visual"] & ~absent & F.when(qa.rlike(P.VISUAL_WRAPPER), True).when(qa.rlike(P.VISUAL_FRAMED) & ~claim, False).when(support >= 0.55, False).otherwise(qa.rlike(P.VISUAL_INFERENCE))),
    ]
    topic, shift, anchor = P.CASE_SCHOOL
    guests, games, own = P.CASE_GUESTS
    pump, why, smooth, seal = P.CASE_PUMP
    case_rules = [
        ("unsupported_subject_shift", (F.contains(q, F.lit(topic)) & qa.rlike(shift) & F.contains(src, F.lit(anchor))) | (qa.rlike(guests) & F.contains(src, F.lit(games)) & ~src.rlike(own))),
        ("unsupported_exception_overgeneralization", F.contains(src, F.lit(P.CASE_NATURAL[0])) & qa.rlike(P.CASE_NATURAL[1])),
        ("unsupported_tech_causal_mix", F.contains(src, F.lit(pump)) & qa.rlike(why) & qa.rlike(smooth) & qa.rlike(seal)),
    ]
    return before, after + case_rules


def filter_pairs(df: DataFrame, key: str, source: str = "source_text", pairs: str = "pairs", case_rules: bool = True) -> DataFrame:
    """One row per pair: key, pos (from 1), question and answer after repairs, adjusted, reason (null: kept).

    `key` is unique per document. The duplicate rule looks at the pairs that all other rules keep, so it is one window over the
    document's pairs, keyed by document and question. Null sources count as empty; a null or empty pair list gives no rows."""
    d = df.select(F.col(key), F.coalesce(F.col(source), F.lit("")).alias("_src"), F.col(pairs).alias("_pairs"))
    d = source_profile(d, "_src", "_doc").select(key, "_src", "_doc", F.posexplode("_pairs").alias("_pos", "_p"))
    d = d.withColumn("_m", move_options(strip_u(F.coalesce("_p.question", F.lit(""))), strip_u(F.coalesce("_p.answer", F.lit("")))))
    d = d.withColumn("_l", clean_label(F.col("_m.answer"))).withColumn("_t", trim_tail(F.col("_l.answer"), F.col("_src")))
    d = d.select(key, (F.col("_pos") + 1).alias("pos"), F.col("_m.question").alias("question"), F.col("_t.answer").alias("answer"), "_src", "_doc",
                 F.array_compact(F.concat(F.array(F.when(F.col("_m.moved"), F.lit("choice_options_moved_to_question"))), F.array_repeat(F.lit("choice_answer_label_removed"), F.col("_l.times")), F.array(F.when(F.col("_t.trimmed"), F.lit("unsupported_tail_trimmed"))))).alias("adjusted"))
    d = d.withColumn("_support", trigram_support(F.col("answer"), F.col("_src")))
    before, after = rules(F.col("question"), F.col("answer"), F.col("_src"), F.col("_doc"), F.col("_support"))
    first_of = lambda rs: F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for r, c in rs])
    d = d.select(key, "pos", "question", "answer", "adjusted", compact_key(F.col("question")).alias("_qk"), first_of(before).alias("_pre"), first_of(after if case_rules else after[:-3]).alias("_post"))
    w = Window.partitionBy(key, "_qk")
    d = d.withColumn("_kept", F.min(F.when(F.col("_pre").isNull() & F.col("_post").isNull(), F.col("pos"))).over(w))
    reason = F.coalesce(F.col("_pre"), F.when(F.col("pos") > F.col("_kept"), F.lit("duplicate_question")), F.col("_post"))
    return d.select(key, "pos", "question", "answer", F.when(reason.isNull(), F.col("adjusted")).otherwise(F.array().cast("array<string>")).alias("adjusted"), reason.alias("reason"))


def filtered_documents(pairs: DataFrame, key: str, max_pairs: int | None = None) -> DataFrame:
    """One row per document of filter_pairs: pairs kept in order, removed reasons, adjustments, note of pairs over max_pairs."""
    kept = F.when(F.col("reason").isNull(), F.struct("pos", "question", "answer"))
    d = pairs.groupBy(key).agg(
        F.array_sort(F.collect_list(kept)).alias("_kept"), F.array_sort(F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("pos", "reason")))).alias("_removed"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "adjusted"))), lambda x: x["adjusted"])).alias("adjusted"))
    d = d.withColumn("qa_pairs", F.transform("_kept", lambda x: F.struct(x["question"].alias("question"), x["answer"].alias("answer"))))
    removed = F.transform("_removed", lambda x: x["reason"])
    d = d.withColumn("removed", F.when((F.size("_kept") == 0) & (F.size("_removed") == 0), F.array(F.lit("no_pairs_after_filter"))).otherwise(removed))
    if max_pairs is not None:
        n = F.size("qa_pairs")
        note = F.concat(F.lit("over_max_trimmed:"), n.cast("string"), F.lit(f"->{max_pairs}"))
        d = d.withColumn("adjusted", F.when(n > max_pairs, F.array_append("adjusted", note)).otherwise(F.col("adjusted"))).withColumn("qa_pairs", F.slice("qa_pairs", 1, max_pairs))
    return d.select(key, "qa_pairs", "removed", "adjusted")
