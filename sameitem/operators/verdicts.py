"""External verdicts for routed pairs (K6, S5, J-b..J-g, J5, C6-C11).

The reference calls a chat service once per routed pair.  Here the request
side is an *outbox table* (one JSON request per routed title pair) and the
answer side is a *verdict table* ``(listing_id_1, listing_id_2,
raw_response, error)`` that is left-joined back.  Parsing the raw text and
applying the decision rules are column expressions over that table.  The table
may hold several replies of a pair, either order of its ids, and any listing of
its titles (:func:`resolve_verdicts`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sameitem.functions import rules as R

# Fixed values of the request payload and response normalisation.
INSTRUCTION = ("Decide whether these two listings refer to the exact same sellable product. "
               "False merges are much worse than missed matches. "
               "Be conservative.")
RULES = [
    "Brand must match if present on both",
    "Model family must match if present on both",
    "Model number must match if present on both",
    "Storage must match if present on both",
    "Tier variant must match if present on both",
    "Display variant must match if present on both",
    "Connectivity must match if present on both",
    "Condition must match if present on both",
    "RAM must match if present on both",
    "Do not merge base/pro/ultra/fe variants",
    "Do not merge refurbished with new",
    "Do not merge GPS with GPS+Cellular",
    "Do not merge gen1 with gen2",
    "Do not merge only from semantic similarity",
    "If uncertain, return no",
    "Return only JSON",
]
OUTPUT_FORMAT = {"match": "yes_or_no", "confidence": "high_medium_low",
                 "reason": "short explanation mentioning key matching or conflicting attributes"}
CONFIDENCE_SCORES = {"high": 0.9, "medium": 0.6, "low": 0.3}
DEFAULT_CONFIDENCE = 0.3
PAYLOAD_FIELDS = ["title", "normalized_title", "brand", "model_family", "model_number", "tier_variant",
                  "display_variant", "connectivity", "condition", "storage", "ram", "screen_size",
                  "color", "category"]
ROUTES = ["llm_review", "llm_verify"]

VERDICT_SCHEMA = "listing_id_1 long, listing_id_2 long, raw_response string, error string"


def product_payload(suffix: str) -> Column:
    """J-b: the 14-field product object of one side."""
    return F.struct(*[F.col(f + suffix).alias(f) for f in PAYLOAD_FIELDS])


def request_json() -> Column:
    """J-c: the request document, nulls written out like the reference."""
    evidence = F.struct(
        F.col("decision").alias("route"),
        F.col("fuzzy_score"), F.col("embedding_score"), F.col("attribute_score"), F.col("final_score"),
        F.col("reason").alias("rule_reason_before_llm"))
    payload = F.struct(
        F.lit("product_match_decision").alias("task"),
        F.lit(R.PROMPT_VERSION).alias("prompt_version"),
        F.lit(INSTRUCTION).alias("instruction"),
        F.array(*[F.lit(r) for r in RULES]).alias("rules"),
        product_payload("_1").alias("product_a"),
        product_payload("_2").alias("product_b"),
        evidence.alias("evidence"),
        F.struct(*[F.lit(v).alias(k) for k, v in OUTPUT_FORMAT.items()]).alias("output_format"))
    text = F.to_json(payload, {"ignoreNullFields": "false"})
    # Scores have four digits; Spark writes those below 0.001 as d.0E-4, JSON writers elsewhere as 0.000d.
    return F.regexp_replace(text, r'(?<=[a-z]":)(-?)(\d)\.0E-4(?=[,}])', r"$10\.000$2")


def verdict_requests(pairs_with_nodes: DataFrame) -> DataFrame:
    """One request per routed title pair, bucketed by route."""
    routed = pairs_with_nodes.where(F.col("decision").isin(*ROUTES))
    return routed.select(
        "listing_id_1", "listing_id_2",
        F.when(F.col("decision") == "llm_verify", "verify").otherwise("review").alias("review_bucket"),
        request_json().alias("request_json"))


def _ustrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def response_text(api_response: Column) -> Column:
    """J-g: ``output_text`` of an API response, else the first choice's content, else ''."""
    return _ustrip(F.coalesce(F.get_json_object(api_response, "$.output_text"),
                              F.get_json_object(api_response, "$.choices[0].message.content"),
                              F.lit("")))


_SCALAR_TRUE = r"^(true|-?(0*[1-9]\d*(\.\d*)?|0*\.\d*[1-9]\d*|0+\.0*[1-9]\d*)([eE][+-]?\d+)?|\"(.|\n)+\")$"
_SCALAR_FALSE = r"^(false|null|-?0+(\.0*)?([eE][+-]?\d+)?|\"\")$"


def api_verdicts(responses: DataFrame) -> DataFrame:
    """S5 / J-g: verdict table from stored API envelopes ``(listing_id_1, listing_id_2, api_response, error)``."""
    return responses.select("listing_id_1", "listing_id_2",
                            F.when(F.col("error").isNull(), response_text(F.col("api_response"))).alias("raw_response"), "error")


def parse_verdicts(verdicts: DataFrame) -> DataFrame:
    """J-d, J-e, J-f: raw response text -> ``llm_match, llm_confidence, llm_reason``.

    Order of the reference: empty -> invalid; strip code fences when the text
    starts with them; parse the text; if it is not JSON, parse the span from
    the first ``{`` to the last ``}``.  A parsed empty value is invalid, a
    non-object value fails like an attribute lookup.
    """
    c = F.col
    # Staged projections: every intermediate is computed once and read by name.
    v = verdicts.select("listing_id_1", "listing_id_2", "error",
                        _ustrip(F.coalesce(c("raw_response"), F.lit(""))).alias("_raw"))
    v = v.withColumn("_t", F.when(c("_raw").startswith("```"),
                                  _ustrip(F.regexp_replace(F.regexp_replace(c("_raw"), "```json", ""), "```", "")))
                     .otherwise(c("_raw")))
    v = v.withColumns({"_first": F.instr(c("_t"), "{"),
                       "_last": F.length(c("_t")) - F.instr(F.reverse(c("_t")), "}") + 1,
                       "_close": F.instr(c("_t"), "}")})
    v = v.withColumn("_inner", F.when((c("_first") > 0) & (c("_close") > 0) & (c("_last") > c("_first")),
                                      F.substring(c("_t"), c("_first"), c("_last") - c("_first") + 1)))
    v = v.withColumns({"_keys1": F.json_object_keys(c("_t")), "_arr1": F.json_array_length(c("_t")),
                       "_strue": c("_t").rlike(_SCALAR_TRUE), "_sfalse": c("_t").rlike(_SCALAR_FALSE),
                       "_keys2": F.json_object_keys(c("_inner"))})
    outcome = (F.when(c("error").isNotNull(), F.concat(F.lit("provider_error_"), c("error")))
               .when(c("_raw") == "", F.lit("invalid_json_response"))
               .when(c("_keys1").isNotNull() & (F.size(c("_keys1")) == 0), F.lit("invalid_json_response"))
               .when(c("_keys1").isNotNull(), F.lit(None))
               .when(c("_arr1") > 0, F.lit("provider_error_AttributeError"))
               .when(c("_arr1") == 0, F.lit("invalid_json_response"))
               .when(c("_strue"), F.lit("provider_error_AttributeError"))
               .when(c("_sfalse"), F.lit("invalid_json_response"))
               .when(c("_keys2").isNotNull() & (F.size(c("_keys2")) > 0), F.lit(None))
               .otherwise(F.lit("invalid_json_response")))
    obj = (F.when(c("_keys1").isNotNull(), c("_t"))
           .when(c("_arr1").isNull() & ~c("_strue") & ~c("_sfalse") & c("_keys2").isNotNull(), c("_inner")))
    v = v.select("listing_id_1", "listing_id_2", outcome.alias("_outcome"),
                 F.when(c("_keys1").isNotNull(), c("_keys1")).otherwise(c("_keys2")).alias("_keys"),
                 F.from_json(obj, "match string, confidence string, reason string").alias("_p"))

    def field(name: str, default: str) -> Column:
        present = F.coalesce(F.array_contains(c("_keys"), name), F.lit(False))
        return _ustrip(F.when(present, F.coalesce(c("_p")[name], F.lit("None"))).otherwise(F.lit(default)))

    v = v.select("listing_id_1", "listing_id_2", "_outcome",
                 F.lower(field("match", "no")).alias("_m"), F.lower(field("confidence", "low")).alias("_c"),
                 field("reason", "missing_reason").alias("_r"))
    conf_map = F.create_map(*[F.lit(x) for kv in CONFIDENCE_SCORES.items() for x in kv])
    ok = c("_outcome").isNull()
    return v.select(
        "listing_id_1", "listing_id_2",
        F.when(ok & c("_m").isin("yes", "no"), c("_m")).otherwise(F.lit("no")).alias("llm_match"),
        F.when(ok, F.coalesce(F.try_element_at(conf_map, c("_c")), F.lit(DEFAULT_CONFIDENCE)))
        .otherwise(F.lit(DEFAULT_CONFIDENCE)).alias("llm_confidence"),
        F.when(ok, F.when(c("_r") == "", F.lit("missing_reason")).otherwise(c("_r")))
        .otherwise(c("_outcome")).alias("llm_reason"),
    )


def resolve_verdicts(verdicts: DataFrame, node_of: DataFrame | None = None) -> DataFrame:
    """One parsed reply per title pair, whatever the verdict table repeats.

    ``node_of`` (``listing_id, node_id``) maps each id to its title's node; without it
    ids are nodes already.  Rows with an id that no listing has, or with both ids in
    one title, name no pair and are left out.  The pair is put in order and its
    replies are combined before the shuffle by a rule that no row order changes: a
    reply that was understood goes before a failed one, ``no`` before ``yes`` (a false
    merge is worse than a missed one), the higher confidence before the lower, then
    the least reason.  Adds ``n_replies``.
    """
    v = parse_verdicts(verdicts)
    if node_of is not None:
        for s in "12":
            of = node_of.select(F.col("listing_id").alias(f"listing_id_{s}"), F.col("node_id").alias(f"_n{s}"))
            v = v.join(of, f"listing_id_{s}")
    else:
        v = v.withColumns({f"_n{s}": F.col(f"listing_id_{s}") for s in "12"})
    failed = (F.col("llm_reason") == "invalid_json_response") | F.col("llm_reason").startswith("provider_error_")
    rank = F.struct(failed, F.col("llm_match") == "yes", -F.col("llm_confidence"), F.col("llm_reason"))
    return (v.where(F.col("_n1") != F.col("_n2"))
            .groupBy(F.least("_n1", "_n2").alias("listing_id_1"), F.greatest("_n1", "_n2").alias("listing_id_2"))
            .agg(F.min_by(F.struct("llm_match", "llm_confidence", "llm_reason"), rank).alias("_v"), F.count(F.lit(1)).alias("n_replies"))
            .select("listing_id_1", "listing_id_2", "_v.*", "n_replies"))


def finalize(pairs: DataFrame, verdicts: DataFrame | None, node_of: DataFrame | None = None) -> DataFrame:
    """Apply verdicts to routed pairs; other pairs pass through.

    ``verdicts=None`` means no verdict service (C10): routed pairs become
    ``llm_unavailable_conservative_reject`` and keep a null ``llm_route``.
    A routed pair without a row in the verdict table is treated the same way.
    ``node_of``: see :func:`resolve_verdicts`.
    """
    routed = F.col("decision").isin(*ROUTES)
    if verdicts is None:
        v = pairs.withColumns({"llm_match": F.lit(None).cast("string"),
                               "llm_confidence": F.lit(None).cast("double"),
                               "llm_reason": F.lit(None).cast("string")})
    else:
        v = pairs.join(resolve_verdicts(verdicts, node_of).drop("n_replies"), ["listing_id_1", "listing_id_2"], "left")
    answered = routed & F.col("llm_match").isNotNull()
    yes_ok = (F.col("llm_match") == "yes") & (F.col("llm_confidence") >= R.VERDICT_MIN_CONFIDENCE)
    guard = R.dangerous_variant_mismatch()
    decision = (F.when(~routed, F.col("decision"))
                .when(~answered, F.lit("reject"))
                .when(yes_ok & guard, F.lit("reject"))
                .when(yes_ok, F.lit("merge"))
                .otherwise(F.lit("reject")))
    reason = (F.when(~routed, F.col("reason"))
              .when(~answered, F.lit("llm_unavailable_conservative_reject"))
              .when(yes_ok & guard, F.lit("guardrail_variant_after_llm_yes"))
              .when(yes_ok, F.concat(F.lit("llm_merge: "), F.col("llm_reason")))
              .otherwise(F.concat(F.lit("llm_reject: "), F.col("llm_reason"))))
    reason = F.when(answered & (F.col("llm_match") == "no") & (F.col("final_score") > R.DISAGREEMENT),
                    F.concat(reason, F.lit(" | llm_rule_disagreement"))).otherwise(reason)
    return v.withColumns({
        "llm_confidence": F.when(answered, F.col("llm_confidence")),
        "llm_raw_decision": F.when(answered, F.col("llm_match")),
        "llm_prompt_version": F.when(answered, F.lit(R.PROMPT_VERSION)),
        "llm_route": F.when(answered, F.col("decision")),
        "pipeline_version": F.when(answered, F.lit(R.PIPELINE_VERSION)),
        "score_version": F.when(answered, F.lit(R.SCORE_VERSION)),
        "review_bucket": F.when(answered, F.when(F.col("decision") == "llm_verify", "verify").otherwise("review")),
    }).withColumns({"decision": decision, "reason": reason}).drop("llm_match", "llm_reason")
