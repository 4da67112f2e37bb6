"""Pipeline invariants on the sf0.001 fixture, and its odd corners on small tables."""
import duckdb
import pytest
from pyspark.sql import functions as F

from sameitem.functions import rules as R
from sameitem.functions.titles import normalize_title, times_1024
from sameitem.operators import analysis, evaluation, groups, verdicts
from sameitem.operators.blocking import block_keys, pair_product, pairs_within
from sameitem.operators.quality import latest_listings
from sameitem.plans.oracle_queries import build
from sameitem.plans.pipeline import Run
from sameitem.plans.queries import QUERIES

from conftest import SF001


@pytest.mark.parametrize("listing", ["all", "classes"])
def test_counts_match_brute_force(spark, listing):
    r = Run.from_fixture(spark, SF001, listing=listing)
    L = r.listings
    ex = block_keys(L).select("listing_id", F.explode("block_keys").alias("k"))
    pairs = (ex.alias("a").join(ex.alias("b"), (F.col("a.k") == F.col("b.k")) & (F.col("a.listing_id") < F.col("b.listing_id")))
             .select(F.col("a.listing_id").alias("i"), F.col("b.listing_id").alias("j")).distinct())
    cols = ["listing_id", "normalized_title", "category", *[c for c in R.MODEL_IDENTITY]]
    A = L.select(*[F.col(c).alias(c + "_1") for c in cols])
    B = L.select(*[F.col(c).alias(c + "_2") for c in cols])
    bp = pairs.join(A, F.col("i") == F.col("listing_id_1")).join(B, F.col("j") == F.col("listing_id_2"))
    brute = {r_["reason"]: r_["count"] for r_ in bp.groupBy(R.conflict_reason().alias("reason")).count().collect()}
    total = sum(brute.values())
    assert r.candidate_count.collect()[0][0] == total
    agg = {x["reason"]: x["pairs"] for x in r.conflicts.collect()}
    assert agg == {k: v for k, v in brute.items() if k is not None}
    scored = r.scored.agg(F.sum("n_pairs")).collect()[0][0]
    same = r.same_title.agg(F.sum("n_pairs")).collect()[0][0] or 0
    linked = r.links.agg(F.sum("n_pairs")).collect()[0][0] if listing == "classes" else 0
    assert scored + linked + same == brute[None]
    dc = {x["decision"]: x["pairs"] for x in r.decision_counts().collect()}
    assert dc["total"] == total
    # The variant report's details add up to its summary.
    rows = analysis.error_analysis_table(r.final_pairs, r.weighted, r.variant_conflicts).collect()
    assert sum(int(x["n_pairs"]) for x in rows if x["listing_id_1"] != "SUMMARY") == \
        next(int(x["n_pairs"]) for x in rows if x["listing_id_1"] == "SUMMARY")


def test_groups_and_metrics(spark):
    r = Run.from_fixture(spark, SF001)
    g = r.groups.collect()
    ids = sorted(x["group_id"] for x in g)
    assert ids == list(range(1, len(ids) + 1))
    assert sum(x["n_listings"] for x in g) == r.listings.count()
    m = r.metrics.collect()[0]
    assert m["tp"] + m["fp"] + m["tn"] + m["fn"] == m["evaluated_pairs"]
    assert m["false_merge_rate"] == 0.0


@pytest.mark.parametrize("name", ["fuzzy_scores", "match_decisions", "verdict_requests", "product_groups", "error_analysis"])
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("part", "embeddings", "documents"):
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    df, res = QUERIES[name](spark, SF001), con.execute(build()[name])
    names = [d[0] for d in res.description]
    tidy = lambda x: round(x, 9) if isinstance(x, float) else x
    got = sorted(tuple(str(tidy(r[c])) for c in sorted(names)) for r in df.collect())
    want = sorted(tuple(str(tidy(v)) for _, v in sorted(zip(names, r))) for r in res.fetchall())
    assert sorted(df.columns) == sorted(names) and got == want


def test_numbers_of_any_length(spark):
    n = ["1", "007", "0", "9" * 14, "1" + "0" * 14, "9" * 38, "12345678901234567890123456789012345678901", "٣"]
    out = spark.createDataFrame([(x,) for x in n], "n string").select(times_1024(F.col("n")).alias("v")).collect()
    assert [r.v for r in out] == [str(int(x) * 1024) for x in n]
    t = "disk " + "7" * 41 + " tb and 2tb"
    got = spark.createDataFrame([(t,)], "t string").select(normalize_title(F.col("t")).alias("v")).first().v
    assert got == f"disk {int('7' * 41) * 1024}gb and 2048gb"


def test_counts_beyond_a_long(spark):
    df = spark.createDataFrame([(60_000_000_000, 200_000_003)], "a long, b long")
    r = df.select(pairs_within(F.col("a")).alias("x"), pairs_within(F.col("b")).alias("y"),
                  pair_product(F.col("a"), F.col("a")).alias("z")).first()
    assert int(r.x) == 60_000_000_000 * 59_999_999_999 // 2 and int(r.y) == 200_000_003 * 200_000_002 // 2
    assert int(r.z) == 60_000_000_000 ** 2


def listings(spark, rows):
    return spark.createDataFrame(rows, "listing_id long, title string, price string, source string, currency string")


def test_last_of_repeated_listing_ids_stays(spark):
    df = listings(spark, [(1, "old", "1", "a", "x"), (1, "new", "2", "a", "x"), (2, "b", "3", "a", "x"), (None, "c", "1", "a", "x")])
    df = df.withColumn("row_seq", F.when(F.col("title") == "new", 9).otherwise(1).cast("long"))
    got = sorted((str(r.listing_id), r.title) for r in latest_listings(df).collect())
    assert got == [("1", "new"), ("2", "b"), ("None", "c")]
    run = Run(spark, df)
    assert run.candidate_count.first()[0] == 0 and run.listings.count() == 3


def test_flag_mode_keeps_invalid_rows(spark):
    rows = [(1, None, "5", "a", "x"), (2, "nan", "5", "a", "x"), (3, "ok title", "n/a", "a", "x"), (4, "ok title", "-1", None, "x")]
    df = listings(spark, rows)
    assert Run(spark, df).attributed.count() == 0
    flags = {r.listing_id: r for r in Run(spark, df, mode="flag").attributed.collect()}
    assert len(flags) == 4 and flags[1].dq_missing_title and flags[3].dq_missing_price and flags[4].dq_nonpositive_price
    assert flags[4].source == "nan"


def test_a_hot_block_and_component(spark):
    """A third of all rows share one product: one component, one block."""
    rows = [(i, f"apple iphone 15 128gb black {'deal' if i % 2 else ''}", str(1000 + i % 7 if i else 10), f"s{i % 3}", "x") for i in range(400)]
    rows += [(1000 + i, f"gadget{i} thing{i}", "50", "s", "x") for i in range(800)]
    r = Run(spark, listings(spark, rows))
    g = {x["n_listings"]: x for x in r.groups.collect()}
    assert g[400]["min_price"] == 1000.0 and g[400]["canonical_title"].startswith("apple iphone 15")
    flagged = [x.listing_id for x in r.group_members.where("suspicious_price").collect()]
    assert flagged == [0]
    assert r.candidate_count.first()[0] == 400 * 399 // 2


def test_median_of_even_and_odd_counts(spark):
    rows = [("a", p) for p in (1.0, 2.0, 3.0, 100.0)] + [("b", p) for p in (10.0, 4.0, 30.0)] + [("c", 1.0), ("d", None)]
    low = groups.low_prices(spark.createDataFrame(rows, "component string, price double")).collect()
    assert {(r.component, r.price) for r in low} == {("a", 1.0), ("b", 4.0)}


def test_consecutive_ids_over_partitions(spark):
    df = spark.range(0, 5000, 7).withColumn("first_seq", F.col("id") * 3).repartition(6)
    out = groups.number_groups(df).orderBy("first_seq").collect()
    assert [r.group_id for r in out] == list(range(1, len(out) + 1))


def pairs_for_verdicts(spark):
    rows = [(1, 2, "llm_review", 0.8, "pro", "pro"), (1, 3, "llm_review", 0.95, "pro", "pro"), (1, 4, "llm_verify", 0.8, "pro", None),
            (1, 5, "llm_review", 0.8, None, None), (1, 6, "merge", 0.99, None, None), (1, 7, "llm_verify", 0.8, "pro", "ultra")]
    return spark.createDataFrame(rows, "listing_id_1 long, listing_id_2 long, decision string, final_score double, "
                                       "tier_variant_1 string, tier_variant_2 string").withColumn("reason", F.lit("rule"))


def test_finalize_branches(spark):
    say = lambda m, c="high": '{"match": "%s", "confidence": "%s", "reason": "why"}' % (m, c)
    v = spark.createDataFrame([(1, 2, say("yes"), None), (1, 3, say("no"), None), (1, 4, say("yes"), None), (1, 5, say("yes", "low"), None),
                               (1, 7, say("yes"), None)], verdicts.VERDICT_SCHEMA)
    got = {r.listing_id_2: (r.decision, r.reason, r.llm_route, r.review_bucket) for r in verdicts.finalize(pairs_for_verdicts(spark), v).collect()}
    assert got[2] == ("merge", "llm_merge: why", "llm_review", "review")
    assert got[3] == ("reject", "llm_reject: why | llm_rule_disagreement", "llm_review", "review")
    assert got[4] == ("reject", "guardrail_variant_after_llm_yes", "llm_verify", "verify")
    assert got[5] == ("reject", "llm_reject: why", "llm_review", "review")  # yes with low confidence
    assert got[6] == ("merge", "rule", None, None)
    assert got[7][1] == "guardrail_variant_after_llm_yes"
    none = {r.listing_id_2: (r.decision, r.reason, r.llm_route) for r in verdicts.finalize(pairs_for_verdicts(spark), None).collect()}
    assert none[2] == ("reject", "llm_unavailable_conservative_reject", None) and none[6] == ("merge", "rule", None)


def test_base_against_special_never_merges(spark):
    v = spark.createDataFrame([(1, i, '{"match": "yes", "confidence": "high"}', None) for i in (2, 3, 4, 5, 7)], verdicts.VERDICT_SCHEMA)
    out = verdicts.finalize(pairs_for_verdicts(spark), v).where(R.dangerous_variant_mismatch())
    assert {r.decision for r in out.collect()} == {"reject"}


def test_api_envelopes(spark):
    body = '{\\"match\\": \\"yes\\"}'
    rows = [(1, 2, '{"output_text": " %s "}' % body, None), (1, 3, '{"choices": [{"message": {"content": "%s"}}]}' % body, None),
            (1, 4, "{}", None), (1, 5, None, "Timeout")]
    env = spark.createDataFrame(rows, "listing_id_1 long, listing_id_2 long, api_response string, error string")
    got = {r.listing_id_2: (r.llm_match, r.llm_reason) for r in verdicts.parse_verdicts(verdicts.api_verdicts(env)).collect()}
    assert got == {2: ("yes", "missing_reason"), 3: ("yes", "missing_reason"), 4: ("no", "invalid_json_response"),
                   5: ("no", "provider_error_Timeout")}


def test_false_rows_carry_their_score(spark):
    r = Run.from_fixture(spark, SF001)
    rows = evaluation.misclassified(r.predictions).collect()
    assert all(x.final_score is not None for x in rows if x.decision in ("merge", "reject") and "mismatch" not in (x.reason or "")
               and x.reason != "exact_normalized_match")


def test_oracle_tables_equal_the_engine_s():
    from sameitem.plans import oracle as O
    assert (O.CONFLICT, O.PHONE, O.MODEL, O.GROUP_CONFLICT) == (R.CONFLICT_FIELDS, R.PHONE_IDENTITY, R.MODEL_IDENTITY,
                                                               groups.GROUP_CONFLICT_FIELDS)
