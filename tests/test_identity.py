"""Identity classes give what the full listing of title pairs gives."""
import pytest
from pyspark.sql import functions as F

from sameitem.operators import blocking as B
from sameitem.operators.components import connected_components
from sameitem.operators.matching import rule_pairs, strong_edges
from sameitem.plans.pipeline import Run
from sameitem.sources import fixture

from conftest import SF001

LISTING = "listing_id long, title string, price string, source string, currency string"


def rows(df, *cols):
    return sorted((tuple(str(r[c]) for c in cols) for r in df.collect()))


def titles():
    """Titles whose attributes are equal, partly missing, in conflict, or absent."""
    out, i = [], 0
    for base in ("apple iphone 15 128gb black", "apple iphone 15 128gb black 8gb ram", "apple iphone 15 128gb", "samsung galaxy s23 ultra 256gb",
                 "samsung galaxy s23 256gb", "apple watch series 9 45mm gps", "apple watch series 9 gps cellular", "plain thing one",
                 "plain thing two", "apple iphone 15 128gb black refurbished"):
        for extra in ("", " deal", " shop price", " deal"):
            out.append((i, base + extra, str(900 + i % 5), f"s{i % 3}", "x"))
            i += 1
    return out


@pytest.mark.parametrize("least", [0, 4])
def test_classes_equal_the_full_listing(spark, least):
    listings = spark.createDataFrame(titles(), LISTING)
    labels = spark.createDataFrame([(a, b, int(a % 4 == b % 4)) for a in range(0, 40, 3) for b in range(a + 1, 40, 5)],
                                   "listing_id_1 int, listing_id_2 int, label int")
    both = [Run(spark, listings, labels=labels, verdict_source="replay", listing=x, min_non_null_fields=least) for x in ("all", "classes")]
    all_, classes = both
    assert rows(all_.weighted, "decision", "reason", "pairs") == rows(classes.weighted, "decision", "reason", "pairs")
    assert rows(all_.members, "listing_id", "component") == rows(classes.members, "listing_id", "component")
    cols = ["group_id", "canonical_title", "n_listings", "min_price", "match_source", "group_conflict_reason"]
    assert rows(all_.groups, *cols) == rows(classes.groups, *cols)
    kept = {r.group_id: r.confidence for r in all_.groups.collect()}
    assert all(r.confidence >= kept[r.group_id] for r in classes.groups.collect())
    assert rows(all_.predictions, *all_.predictions.columns) == rows(classes.predictions, *classes.predictions.columns)
    # Listed or counted, no pair is lost.
    assert all_.pairs.count() == classes.pairs.count() + (classes.links.agg(F.sum("n_links")).first()[0] or 0)


def test_links_against_the_listed_strong_pairs(spark):
    r = Run.from_fixture(spark, SF001, listing="all")
    se = strong_edges(r.title_nodes_only, r.pairs)
    want = {x["reason"]: (x["n"], x["p"]) for x in se.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("n_pairs").alias("p")).collect()}
    got = {x["reason"]: (x["n"], x["p"]) for x in r.links.groupBy("reason").agg(F.sum("n_links").alias("n"), F.sum("n_pairs").alias("p")).collect()}
    assert got == want
    of = lambda e: rows(connected_components(e), "node", "component")
    assert of(se.select(F.col("listing_id_1").alias("src"), F.col("listing_id_2").alias("dst"))) == of(r.identity_edges.toDF("src", "dst"))


def test_open_pairs_are_the_listed_ones_without_the_strong(spark):
    r = Run.from_fixture(spark, SF001, listing="all")
    want = rule_pairs(r.title_nodes_only, r.pairs).where("_strong is null")
    got = B.open_title_pairs(r.class_pairs, r.members_of_classes)
    assert rows(got, "node_id_1", "node_id_2") == rows(want, "node_id_1", "node_id_2")
    assert got.distinct().count() == got.count()


def test_a_hot_block_of_one_tuple_is_linear(spark):
    """Twenty thousand titles without attributes share a block: no pair of them is listed."""
    n = 20_000
    listings = spark.range(n).select(F.col("id").alias("listing_id"), F.concat(F.lit("plain thing number "), F.col("id")).alias("title"),
                                     F.lit("50").alias("price"), F.lit("s").alias("source"), F.lit("x").alias("currency"))
    r = Run(spark, listings)
    assert r.classes.count() == 1 and r.pairs.count() == 0 and r.identity_edges.count() == n - 1
    link = r.links.first()
    assert (int(link.n_links), int(link.n_pairs), link.reason) == (n * (n - 1) // 2, n * (n - 1) // 2, "strong_model_identity_match")
    assert r.candidate_count.first()[0] == n * (n - 1) // 2
    assert r.members.select("component").distinct().count() == 1


def test_listing_is_checked(spark):
    with pytest.raises(ValueError):
        Run(spark, fixture.fixture_listings(spark, SF001), listing="some")
