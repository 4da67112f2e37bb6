"""Pair predicates and scores as column expressions.

All functions read two sides of a pair from columns suffixed ``_1`` and
``_2`` (``brand_1``, ``brand_2`` ...).  Null semantics follow the
reference exactly: "both present and different" for conflicts, null-safe
equality (None == None) for identity tests.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sameitem.functions.titles import SCORED_FIELDS, SPECIAL_TIERS

# The fields of each test, in test order.
CONFLICT_FIELDS = ["brand", "model_family", "model_number", "storage", "tier_variant",
                   "display_variant", "connectivity", "ram", "condition"]
PHONE_IDENTITY = ["brand", "model_family", "model_number", "storage", "tier_variant",
                  "condition", "color"]
MODEL_IDENTITY = ["brand", "model_family", "model_number", "tier_variant", "display_variant",
                  "connectivity", "ram", "storage", "screen_size", "condition", "color"]
STRICT_CONDITIONS = ["refurbished", "used"]

# Thresholds, weights and labels of the decision ladder.
W_FUZZY, W_ATTRIBUTE, W_EMBEDDING = 0.50, 0.35, 0.15
AUTO_MERGE = 0.985
REVIEW_LOW = 0.78
FLAG_HIGH = 0.90
FLAG_COLOR = 0.80
DISAGREEMENT = 0.9
VERDICT_MIN_CONFIDENCE = 0.5
PIPELINE_VERSION = "v2_routed_llm_verifier_guarded_yes_merge"
SCORE_VERSION = "fuzzy50_attr35_embed15"
PROMPT_VERSION = "v4_evidence_routed"


def a(f: str) -> Column:
    return F.col(f + "_1")


def b(f: str) -> Column:
    return F.col(f + "_2")


def eq(f: str) -> Column:
    return a(f).eqNullSafe(b(f))


def both_differ(f: str) -> Column:
    return a(f).isNotNull() & b(f).isNotNull() & (a(f) != b(f))


def _all(cols) -> Column:
    return reduce(lambda x, y: x & y, cols)


def same_core() -> Column:
    """C1"""
    return _all([eq("brand"), eq("model_family"), eq("model_number")])


def conflict_reason() -> Column:
    """First conflicting field as ``<field>_mismatch``, null when none."""
    out = None
    for f in CONFLICT_FIELDS:
        cond = both_differ(f)
        val = F.lit(f + "_mismatch")
        out = F.when(cond, val) if out is None else out.when(cond, val)
    strict = F.array(*[F.lit(x) for x in STRICT_CONDITIONS])
    special = ((F.coalesce(F.array_contains(strict, a("condition")), F.lit(False)) & ~eq("condition"))
               | (F.coalesce(F.array_contains(strict, b("condition")), F.lit(False)) & ~eq("condition")))
    return out.when(special, F.lit("condition_mismatch"))


def strong_reason(conflict: Column | None = None, min_non_null_fields: int = 0) -> Column:
    """Strong identity reason, null when not strong.

    ``min_non_null_fields``: present fields that the all-fields test needs.  0 is the
    reference's rule, under which null equals null and titles without any
    attribute that share a fallback key are the same.
    """
    conflict = conflict_reason() if conflict is None else conflict
    exact = (a("normalized_title") == b("normalized_title")) & conflict.isNull()
    phone = ((a("category") == "phone") & (b("category") == "phone")
             & _all([eq(f) for f in PHONE_IDENTITY]))
    model = _all([eq(f) for f in MODEL_IDENTITY])
    if min_non_null_fields:
        model = model & (sum(a(f).isNotNull().cast("int") for f in MODEL_IDENTITY) >= min_non_null_fields)
    return (F.when(exact, F.lit("exact_normalized_match"))
            .when(phone, F.lit("strong_phone_identity_match"))
            .when(model, F.lit("strong_model_identity_match")))


def attribute_agreement(fields=SCORED_FIELDS) -> Column:
    """M2: equal / comparable over fields present on both sides; 0.0 when none."""
    comparable = sum((a(f).isNotNull() & b(f).isNotNull()).cast("int") for f in fields)
    matches = sum((a(f).isNotNull() & b(f).isNotNull() & (a(f) == b(f))).cast("int") for f in fields)
    return F.when(comparable > 0, matches / comparable).otherwise(F.lit(0.0))


def cosine(v1: Column, v2: Column) -> Column:
    """M3: cosine of two vectors; 0.0 when either is missing or zero."""
    d1 = v1.cast("array<double>")
    d2 = v2.cast("array<double>")
    dot = F.aggregate(F.zip_with(d1, d2, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    n1 = F.sqrt(F.aggregate(F.transform(d1, lambda x: x * x), F.lit(0.0), lambda s, x: s + x))
    n2 = F.sqrt(F.aggregate(F.transform(d2, lambda x: x * x), F.lit(0.0), lambda s, x: s + x))
    ok = v1.isNotNull() & v2.isNotNull() & (n1 > 0) & (n2 > 0) & (F.size(v1) == F.size(v2))
    return F.when(ok, dot / (n1 * n2)).otherwise(F.lit(0.0))


def match_score(fuzzy: Column, attribute: Column, embedding: Column) -> Column:
    """M4"""
    return W_FUZZY * fuzzy + W_ATTRIBUTE * attribute + W_EMBEDDING * embedding


def risk_flags(score: Column) -> Column:
    """C4: pipe-joined risk flags in reference order ('' when none)."""
    core = same_core()
    special = F.array(*[F.lit(x) for x in SPECIAL_TIERS])

    def is_special(c: Column) -> Column:
        return F.coalesce(F.array_contains(special, c), F.lit(False))

    base_vs_special = core & ((is_special(a("tier_variant")) & b("tier_variant").isNull())
                              | (is_special(b("tier_variant")) & a("tier_variant").isNull()))

    def partial(f: str) -> Column:
        return core & ~eq(f) & (a(f).isNull() | b(f).isNull())

    return F.concat_ws(
        "|",
        F.when(base_vs_special, F.lit("base_vs_special_variant_missing_side")),
        F.when((score >= FLAG_HIGH) & partial("display_variant"), F.lit("display_variant_partial_disagreement")),
        F.when((score >= FLAG_HIGH) & partial("connectivity"), F.lit("connectivity_partial_disagreement")),
        F.when((score >= FLAG_COLOR) & partial("color"), F.lit("color_missing_side")),
    )


def decide(score: Column, conflict: Column, strong: Column, flags: Column) -> Column:
    """``struct(decision, reason)`` from the unrounded score."""
    def st(d: str, r: Column) -> Column:
        return F.struct(F.lit(d).alias("decision"), r.alias("reason"))

    return (F.when(conflict.isNotNull(), st("reject", conflict))
            .when(strong.isNotNull(), st("merge", strong))
            .when((score >= AUTO_MERGE) & (flags == ""), st("merge", F.lit("very_high_score_no_conflict")))
            .when(flags != "", st("llm_verify", flags))
            .when((score >= REVIEW_LOW) & (score < AUTO_MERGE), st("llm_review", F.lit("borderline_score_review")))
            .otherwise(st("reject", F.lit("low_or_insufficient_confidence"))))


def normalize_variant(c: Column) -> Column:
    """Trim + lower, blank -> null."""
    return F.nullif(F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")), F.lit(""))


def dangerous_variant_mismatch() -> Column:
    """Explicit different tiers, or base vs special (no same-core needed)."""
    va, vb = normalize_variant(a("tier_variant")), normalize_variant(b("tier_variant"))
    special = F.array(*[F.lit(x) for x in SPECIAL_TIERS])
    sp_a = F.coalesce(F.array_contains(special, va), F.lit(False))
    sp_b = F.coalesce(F.array_contains(special, vb), F.lit(False))
    return F.coalesce(va.isNotNull() & vb.isNotNull() & (va != vb), F.lit(False)) \
        | (va.isNull() & sp_b) | (vb.isNull() & sp_a)
