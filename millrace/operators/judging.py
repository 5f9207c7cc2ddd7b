"""Validation of judge objects (JSON text), by columns over VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fields of the two judges.
PAIRWISE = {
    "scores": ["faithfulness_score", "answerability_score", "hallucination_risk_score", "self_containment_score", "coverage_score",
               "official_closeness_score", "pair_count_similarity", "question_style_similarity", "answer_style_similarity", "focus_similarity"],
    "flags": ["local_too_verbose", "local_too_textbook_like", "local_over_explains", "local_noise_question", "local_omits_official_focus"],
    "texts": ["main_gap", "unlike_official_questions", "question_style_issue", "answer_style_issue", "coverage_issue", "actionable_prompt_fix"],
}
REWRITE = {
    "scores": ["faithfulness_score", "information_retention_score", "refinement_value_score", "official_style_closeness_score", "natural_prose_score",
               "low_template_score", "appropriate_length_score", "noise_handling_score", "hallucination_risk_score", "overall_score"],
    "flags": ["too_markdown_or_template", "too_textbook_like", "too_conversational", "too_abstract_short", "adds_unseen_facts", "drops_key_information",
              "keeps_web_noise_unnecessarily", "keeps_brand_ad_noise", "unsupported_numeric_correction", "drops_key_technical_parameter"],
    "texts": ["main_gap", "prompt_fix"],
}
WEAK_ORDER = ["official_style_closeness_score", "overall_score", "noise_handling_score", "low_template_score"]
NO_FIX = ["无需修改", "当前 prompt 已", "当前prompt已"]

def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _get(obj: Column, field: str, kind: str) -> Column:
    return F.try_variant_get(obj, f"$.{field}", kind)


def whole_score(obj: Column, field: str, bool_is_int: bool = True) -> Column:
    """Whether the field is a whole number from 1 to 5; with bool_is_int, true counts as 1."""
    k = _kind(_get(obj, field, "variant"))
    ok = (k == "BIGINT") & _get(obj, field, "long").between(1, 5)
    return F.coalesce(ok | ((k == "BOOLEAN") & _get(obj, field, "boolean")) if bool_is_int else ok, F.lit(False))


def score(obj: Column, field: str) -> Column:
    """A score from 1 to 5, whole or rounded half up; null for anything else, truth values too."""
    k = _kind(_get(obj, field, "variant"))
    x = _get(obj, field, "double")
    numeric = (k == "BIGINT") | (k == "DOUBLE") | (k == "FLOAT") | k.startswith("DECIMAL")
    return F.when(F.coalesce(numeric & x.between(1, 5), F.lit(False)), F.least(F.floor(x + 0.5), F.lit(5)).cast("int"))


def _checks(obj: Column, fields: dict, good_score) -> Column:
    tests = [F.when(obj.isNull(), F.lit("judge_output_not_object"))]
    tests += [F.when(~good_score(f), F.lit(f"invalid_score:{f}")) for f in fields["scores"]]
    tests += [F.when(F.coalesce(_kind(_get(obj, f, "variant")) != "BOOLEAN", F.lit(True)), F.lit(f"invalid_bool:{f}")) for f in fields["flags"]]
    text_ok = lambda f: F.coalesce((_kind(_get(obj, f, "variant")) == "STRING") & (F.length(F.trim(_get(obj, f, "string"))) > 0), F.lit(False))
    tests += [F.when(~text_ok(f), F.lit(f"invalid_text:{f}")) for f in fields["texts"]]
    return F.coalesce(*tests)


def validate_pairwise(df: DataFrame, json: str = "json", bool_is_int: bool = True, fields: dict | None = None) -> DataFrame:
    """failure_reason: the first invalid field, scores then flags then texts; null if the object is valid."""
    fields = fields or PAIRWISE
    d = df.withColumn("_o", F.try_parse_json(json))
    return d.withColumn("failure_reason", _checks(F.col("_o"), fields, lambda f: whole_score(F.col("_o"), f, bool_is_int))).drop("_o")


def normalize_rewrite(df: DataFrame, json: str = "json", fields: dict | None = None) -> DataFrame:
    """failure_reason, scores (map of repaired whole scores) and notes ('field:old->new' where a score changed)."""
    fields = fields or REWRITE
    d = df.withColumn("_o", F.try_parse_json(json))
    o = F.col("_o")
    old = lambda f: _get(o, f, "double")
    notes = F.array_compact(F.array(*[F.when(score(o, f).isNotNull() & (score(o, f) != old(f)), F.concat(F.lit(f + ":"), _get(o, f, "string"), F.lit("->"), score(o, f).cast("string"))) for f in fields["scores"]]))
    scores = F.create_map(*[x for f in fields["scores"] for x in (F.lit(f), score(o, f))])
    return d.withColumns({"failure_reason": _checks(o, fields, lambda f: score(o, f).isNotNull()), "scores": scores, "notes": notes}).drop("_o")


def actionable(fix: Column) -> Column:
    """A fix that is there and doesn't say that none is needed."""
    t = F.trim(F.coalesce(fix, F.lit("")))
    none = t == ""
    for w in NO_FIX:
        none = none | F.contains(t, F.lit(w))
    return ~none
