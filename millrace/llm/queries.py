"""Queries of the llm operators over the tables of TESTDATA.md, each with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..cluster import cut, ship, spread
from . import bpe, codepages, corpus, langid, lookalikes, mixing, pages, pairs, quality, residue, truncation


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name == "documents" else df


def _records(spark, sf_dir, kinds=(corpus.SOURCE, corpus.REWRITE, corpus.BODY)) -> tuple[DataFrame, DataFrame]:
    """(sample_5, its distinct texts)."""
    t = _table(spark, sf_dir, "sample_5")
    return t, corpus.texts(t, kinds)


def p1_labels(spark, sf_dir):
    """(uid, label, seg_no, lang, confidence) of every source text (seg_no 0) and of its lines in another language."""
    t, texts = _records(spark, sf_dir, (corpus.SOURCE,))
    return langid.languages(t, texts, langid.identifier(t, texts))


def p1_found(spark, sf_dir):
    """(uid, seg_no, lang_found): labels that are missing or name another language, and lines of another language."""
    found = p1_labels(spark, sf_dir)
    code = langid.label_code(F.col("label"))
    return found.where((F.col("seg_no") > 0) | code.isNull() | (code != F.col("lang"))).select("uid", "seg_no", F.col("lang").alias("lang_found"))


def _truncation(spark, sf_dir) -> DataFrame:
    t, texts = _records(spark, sf_dir)
    ident = langid.Identifier(codepages.fit(texts), None)  # only its decoder is needed here
    values = truncation.truncated(truncation.measured(t, texts, *truncation.endings(texts, ident)))
    # error pages, script notices and filler end as they end: of the contents found, those with such residue are whole
    found = values.where("field = 'content' and log_odds > 0").select("uid")
    left = residue.residues(t.join(found, "uid", "left_semi"), residue.residue_model(texts), ident.decoder)
    left = left.where("kind <> 'placeholder'").select("uid", F.lit("content").alias("field"), F.lit(True).alias("_left"))
    return values.join(left, ["uid", "field"], "left").withColumn("log_odds", F.when(F.col("_left"), F.lit(truncation.NEVER)).otherwise(F.col("log_odds"))).drop("_left")


def p2_values(spark, sf_dir):
    """(uid, source, field, chars, bytes, ending, limit_posterior, log_odds) of every source text and content."""
    return _truncation(spark, sf_dir)


def p2_found(spark, sf_dir):
    """(uid, field): values that end inside a word or sentence because their rest was lost."""
    return _truncation(spark, sf_dir).where("log_odds > 0").select("uid", "field")


def p2_shares(spark, sf_dir):
    """(source, texts, cut, share): how often each source's texts are cut."""
    return truncation.cut_shares(_truncation(spark, sf_dir))


def p3_found(spark, sf_dir):
    """(uid, field): values that show characters of a wrong decoding."""
    t, texts = _records(spark, sf_dir)
    return codepages.affected(t, texts, codepages.fit(texts)).select("uid", "field")


def p3_restored(spark, sf_dir):
    """(uid, source, field, swap, gain, restored, lost): the affected values and their text as it was, where that is possible."""
    t, texts = _records(spark, sf_dir)
    return codepages.garbled(t, texts, codepages.fit(texts))


def _named_figures(texts: DataFrame, decoder, lines, rewrites: bool, full: bool = False) -> DataFrame:
    fig = quality.Figures(decoder, lines, quality.common_words(texts), full)
    figs = cut(quality.figures(texts, fig, rewrites))
    return quality.named(figs, quality.fit_mixture(figs, fig))


def p4_figures(spark, sf_dir):
    """(uid, field, the figures, kind, posterior) of every source text and rewrite."""
    t, texts = _records(spark, sf_dir, (corpus.SOURCE, corpus.REWRITE))
    decoder = codepages.fit(texts)
    return quality.of_records(t, _named_figures(texts, decoder, pages.line_model(texts, decoder), True, full=True))


def p4_found(spark, sf_dir):
    """(uid, field, kind): values that are a list, a table or junk; template residue and wrongly decoded prose are none."""
    t, texts = _records(spark, sf_dir, (corpus.SOURCE, corpus.REWRITE))
    decoder = codepages.fit(texts)
    named = _named_figures(texts, decoder, pages.line_model(texts, decoder), True).where("kind <> 'prose' and not (kind = 'junk' and restored > 0)")
    found = cut(quality.of_records(t, named).select("uid", "field", "kind"))
    asked = t.where("style <> 'qa'").join(found.where("field = 'content'").select("uid"), "uid", "left_semi")
    left = residue.residues(asked, residue.residue_model(texts), decoder).select("uid", F.lit("content").alias("field"))
    return found.join(left, ["uid", "field"], "left_anti")


def p5_found(spark, sf_dir):
    """(uid, line_no): lines of page furniture in source texts that are prose."""
    t, texts = _records(spark, sf_dir, (corpus.SOURCE, corpus.REWRITE))
    decoder = codepages.fit(texts)
    lines = pages.line_model(texts, decoder)
    other = _named_figures(texts, decoder, lines, False).where("kind <> 'prose'").select(*corpus.KEY)
    return pages.furniture(t, texts.where(F.col("kind") == corpus.SOURCE).join(other, corpus.KEY, "left_anti"), lines)


def p5_main_text(spark, sf_dir):
    """(uid, main_text, dropped_lines) of every source text."""
    return pages.main_text(_table(spark, sf_dir, "sample_5"), p5_found(spark, sf_dir))


def p6_found(spark, sf_dir):
    """(uid, kind): records whose content is or holds template residue, filler, an error page or a script notice."""
    t, texts = _records(spark, sf_dir)
    return residue.residues(spread(t.select("uid", "content")), residue.residue_model(texts), codepages.fit(texts))


def p7_found(spark, sf_dir):
    """(uid, pair_no, defect): defective question-answer pairs; records with residue in place of their text have none."""
    t, texts = _records(spark, sf_dir)
    ident = langid.identifier(t, texts)
    found = cut(pairs.defective_pairs(t, texts, pairs.pair_model(texts, ident)))
    left = residue.residues(t.where("style = 'qa'").join(found.select("uid").distinct(), "uid", "left_semi"), residue.residue_model(texts), ident.decoder)
    return found.join(left.where("kind <> 'placeholder'"), "uid", "left_anti")


def p8_ids(spark, sf_dir):
    """(doc_id, ids) of every document; [] for null and empty texts."""
    return bpe.token_ids(_table(spark, sf_dir, "documents"), ["doc_id"])


def p9_draws(spark, sf_dir):
    """(doc_id, source, tokens, repeats) of the documents drawn to the target weights."""
    docs = cut(mixing.sized(_table(spark, sf_dir, "documents")))
    return mixing.draws(docs, _table(spark, sf_dir, "mix_targets"))


def p9_shares(spark, sf_dir):
    """Wanted and actual share of the tokens, per source of mix_targets."""
    docs = cut(mixing.sized(_table(spark, sf_dir, "documents")))
    targets = _table(spark, sf_dir, "mix_targets")
    return mixing.shares(cut(mixing.draws(docs, targets)), docs, targets)


def p10_found(spark, sf_dir):
    """(doc_id_a, doc_id_b): documents that look the same and differ in code points."""
    return lookalikes.equal_looking_pairs(_table(spark, sf_dir, "documents"))


def p10_one_form(spark, sf_dir):
    """(doc_id, one_form): every text in its one form."""
    return lookalikes.with_one_form(_table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "one_form").select("doc_id", "one_form")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1:2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {}
