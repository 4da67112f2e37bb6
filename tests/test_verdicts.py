"""J-d..J-f and C8: raw verdict text -> normalised verdict -> decision."""
from sameitem.operators.verdicts import VERDICT_SCHEMA, finalize, parse_verdicts, resolve_verdicts

CASES = [
    ('{"match": "yes", "confidence": "high", "reason": "same"}', None, ("yes", 0.9, "same")),
    ('```json\n{"match": "No", "confidence": "medium", "reason": "tier"}\n```', None, ("no", 0.6, "tier")),
    ('Sure: {"match": "YES", "confidence": "High", "reason": " ok "} thanks', None, ("yes", 0.9, "ok")),
    ('{"match": "maybe", "confidence": "unknown"}', None, ("no", 0.3, "missing_reason")),
    ('{"match": "yes", "confidence": 0.9, "reason": null}', None, ("yes", 0.3, "None")),
    ('{"match": "yes", "reason": ""}', None, ("yes", 0.3, "missing_reason")),
    ('{}', None, ("no", 0.3, "invalid_json_response")),
    ('', None, ("no", 0.3, "invalid_json_response")),
    ('not json', None, ("no", 0.3, "invalid_json_response")),
    ('[{"match": "yes"}]', None, ("no", 0.3, "provider_error_AttributeError")),
    ('[]', None, ("no", 0.3, "invalid_json_response")),
    ('"text"', None, ("no", 0.3, "provider_error_AttributeError")),
    ('0', None, ("no", 0.3, "invalid_json_response")),
    (None, "Timeout", ("no", 0.3, "provider_error_Timeout")),
]


def test_parse_cases(spark):
    rows = [(i, i + 1, raw, err) for i, (raw, err, _) in enumerate(CASES)]
    out = {r["listing_id_1"]: r for r in parse_verdicts(spark.createDataFrame(rows, VERDICT_SCHEMA)).collect()}
    for i, (_, _, want) in enumerate(CASES):
        got = (out[i]["llm_match"], out[i]["llm_confidence"], out[i]["llm_reason"])
        assert got == want, (CASES[i], got)


def say(match, confidence="high", reason="why"):
    return '{"match": "%s", "confidence": "%s", "reason": "%s"}' % (match, confidence, reason)


def test_one_reply_a_pair(spark):
    """Doubled, swapped, contradictory, failed and differently keyed replies."""
    nodes = spark.createDataFrame([(1, 1), (11, 1), (2, 2), (12, 2), (3, 3), (4, 4)], "listing_id long, node_id long")
    rows = [(1, 2, say("yes"), None), (1, 2, say("yes"), None), (2, 1, say("yes"), None), (12, 11, say("yes", "low", "unsure"), None),
            (1, 3, say("yes"), None), (3, 1, say("no", "low", "b"), None), (11, 3, say("no", "low", "a"), None), (1, 3, say("no", "medium", "z"), None),
            (1, 4, None, "Timeout"), (4, 1, "not json", None), (4, 11, say("yes", "low"), None),
            (2, 3, None, "Timeout"), (3, 2, "not json", None),
            (1, 11, say("yes"), None), (1, 99, say("yes"), None), (None, 2, say("yes"), None)]
    want = {(1, 2): ("yes", 0.9, "why", 4), (1, 3): ("no", 0.6, "z", 4), (1, 4): ("yes", 0.3, "why", 3),
            (2, 3): ("no", 0.3, "invalid_json_response", 2)}
    for order in (rows, rows[::-1]):
        out = resolve_verdicts(spark.createDataFrame(order, VERDICT_SCHEMA).repartition(3), nodes).collect()
        assert {(r.listing_id_1, r.listing_id_2): (r.llm_match, r.llm_confidence, r.llm_reason, r.n_replies) for r in out} == want


def test_repeated_verdicts_multiply_no_pair(spark):
    pairs = spark.createDataFrame([(1, 2, "llm_review", 0.8, "rule", None, None), (1, 3, "merge", 1.0, "rule", None, None)],
                                  "listing_id_1 long, listing_id_2 long, decision string, final_score double, reason string, "
                                  "tier_variant_1 string, tier_variant_2 string")
    v = spark.createDataFrame([(1, 2, say("yes"), None), (2, 1, say("yes"), None), (1, 2, say("yes"), None)], VERDICT_SCHEMA)
    out = finalize(pairs, v).collect()
    assert sorted((r.listing_id_2, r.decision) for r in out) == [(2, "merge"), (3, "merge")]
