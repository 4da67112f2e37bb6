"""Pair rules and their null semantics."""
from pyspark.sql import functions as F

from sameitem.functions import rules as R
from sameitem.functions.titles import ATTRIBUTES

FIELDS = [*ATTRIBUTES, "category", "normalized_title"]


def pair(spark, a, b):
    row = {f"{k}_1": a.get(k) for k in FIELDS} | {f"{k}_2": b.get(k) for k in FIELDS}
    schema = ", ".join(f"{k} string" for k in row)
    return spark.createDataFrame([tuple(row.values())], schema)


def first(df, col):
    return df.select(col.alias("x")).collect()[0]["x"]


def test_conflict_order_and_nulls(spark):
    a = dict(brand="apple", model_family="iphone", model_number="15", storage="128gb", tier_variant="pro")
    assert first(pair(spark, a, dict(a, storage="256gb", tier_variant="ultra")), R.conflict_reason()) == "storage_mismatch"
    assert first(pair(spark, a, dict(a, tier_variant=None)), R.conflict_reason()) is None
    assert first(pair(spark, dict(a, condition="refurbished"), a), R.conflict_reason()) == "condition_mismatch"
    assert first(pair(spark, dict(a, condition="new"), a), R.conflict_reason()) is None


def test_strong_identity_null_equals_null(spark):
    a = dict(normalized_title="x y", brand=None)
    b = dict(normalized_title="x z", brand=None)
    assert first(pair(spark, a, b), R.strong_reason()) == "strong_model_identity_match"
    p = dict(brand="apple", model_family="iphone", model_number="15", category="phone", normalized_title="a", ram="8gb")
    assert first(pair(spark, p, dict(p, normalized_title="b", ram=None)), R.strong_reason()) == "strong_phone_identity_match"


def test_risk_flags_and_ladder(spark):
    a = dict(brand="samsung", model_family="galaxy", model_number="s23", tier_variant="ultra", color="black")
    df = pair(spark, a, dict(a, tier_variant=None, color=None))
    assert first(df, R.risk_flags(F.lit(0.95))) == "base_vs_special_variant_missing_side|color_missing_side"
    d = first(df, R.decide(F.lit(0.99), F.lit(None).cast("string"), F.lit(None).cast("string"), R.risk_flags(F.lit(0.99))))
    assert d["decision"] == "llm_verify"
    d = first(df, R.decide(F.lit(0.80), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("")))
    assert (d["decision"], d["reason"]) == ("llm_review", "borderline_score_review")
    d = first(df, R.decide(F.lit(0.985), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("")))
    assert d["decision"] == "merge"


def test_dangerous_variant(spark):
    assert first(pair(spark, dict(tier_variant="pro"), dict(tier_variant=None)), R.dangerous_variant_mismatch())
    assert not first(pair(spark, dict(tier_variant=None), dict(tier_variant=None)), R.dangerous_variant_mismatch())
    assert first(pair(spark, dict(tier_variant=" Pro "), dict(tier_variant="ultra")), R.dangerous_variant_mismatch())
