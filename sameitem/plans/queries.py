"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver tables (``part``, ``embeddings``, ``documents``)
or data Spark derives from them, over whole tables and whole texts, and has a
DuckDB oracle (:mod:`sameitem.plans.oracle_queries`).  The operators count pairs
as decimal(38,0); the queries show them as longs, which the oracle has too.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sameitem.functions.titles import ATTRIBUTES, with_attributes
from sameitem.operators import analysis, evaluation, groups
from sameitem.operators.components import connected_components
from sameitem.operators.matching import rule_pairs
from sameitem.operators.verdicts import finalize, parse_verdicts, resolve_verdicts
from sameitem.plans.pipeline import Run
from sameitem.session import checkpoint_dir, configure, spread
from sameitem.sources import fixture
from sameitem.sources.files import read_listing_feeds, read_table_csv, write_table

LISTING_COLS = ["listing_id", "title", "price", "source", "currency"]
DQ = ["dq_missing_title", "dq_missing_price", "dq_nonpositive_price", "dq_suspicious_low_price"]
CONF = [f"{a}_confidence" for a in ATTRIBUTES]


def _long(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in cols})


def _run(spark: SparkSession, sf_dir: str, **kw) -> Run:
    return Run.from_fixture(configure(spark), sf_dir, **kw)


def q_listings(spark, sf_dir):
    return fixture.fixture_listings(configure(spark), sf_dir).select(*LISTING_COLS)


def q_feed_listings(spark, sf_dir):
    """Listings written as feeds of six charsets, with line breaks in quotes, and read back."""
    folder = fixture.write_feeds(configure(spark), fixture.fixture_listings(spark, sf_dir))
    return read_listing_feeds(spark, folder, with_charset=True)


def q_output_tables(spark, sf_dir):
    """The sorted CSV result tables, read back in file order."""
    r = _run(spark, sf_dir, listing="all")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/outputs/{uuid.uuid4().hex}"
    usage = _long(r.usage(), "total_pairs", "llm_used")
    tables = {
        "decisions": (_long(r.final_pairs.select("listing_id_1", "listing_id_2", "n_pairs", "decision", "reason"), "n_pairs"),
                      ["listing_id_1", "listing_id_2"]),
        "groups": (r.groups.select("group_id", "canonical_title", "n_listings", "sources", "min_price"), ["group_id"]),
        "attributes": (r.extracted.select("listing_id", "row_seq", "normalized_title", "brand", "model_family", "storage"), ["row_seq"]),
        "usage": (usage, None),
    }
    out = None
    for name, (df, order) in tables.items():
        write_table(df, f"{folder}/{name}", "csv", order, bom=name == "groups")
        back = read_table_csv(spark, f"{folder}/{name}")
        rows = back.select(F.lit(name).alias("table_name"), F.col("row_no"), F.concat_ws(
            "|", *[F.coalesce(F.col(c), F.lit("")) for c in df.columns]).alias("row_text"))
        out = rows if out is None else out.unionByName(rows)
    write_table(r.requests, f"{folder}/outbox", partition_by="review_bucket")
    box = spark.read.parquet(f"{folder}/outbox").groupBy("review_bucket").count()
    return out.unionByName(box.select(F.lit("outbox").alias("table_name"), F.lit(None).cast("long").alias("row_no"),
                                      F.concat_ws("|", "review_bucket", F.col("count").cast("string")).alias("row_text")))


def q_clean_listings(spark, sf_dir):
    return _run(spark, sf_dir).attributed.select(*LISTING_COLS, *DQ)


def q_dq_flags(spark, sf_dir):
    """README mode: invalid rows kept and flagged."""
    return _run(spark, sf_dir, mode="flag").attributed.select(*LISTING_COLS, *DQ)


def q_title_normalize(spark, sf_dir):
    return _run(spark, sf_dir).attributed.select("listing_id", "normalized_title")


def q_attributes(spark, sf_dir):
    return _run(spark, sf_dir).attributed.select("listing_id", *ATTRIBUTES, "category", *CONF)


def q_block_keys(spark, sf_dir):
    return _run(spark, sf_dir).keyed.select(
        "listing_id", F.array_join(F.array_sort("block_keys"), ";").alias("block_keys"))


def q_candidate_pair_count(spark, sf_dir):
    return _long(_run(spark, sf_dir).candidate_count, "candidate_pairs")


def q_conflict_counts(spark, sf_dir):
    return _long(_run(spark, sf_dir).conflicts, "pairs")


def q_identity_classes(spark, sf_dir):
    """Strong matches per pair of identity classes, counted and not listed."""
    return _long(_run(spark, sf_dir).links, "n_links", "n_pairs")


def q_compatible_pairs(spark, sf_dir):
    r = _run(spark, sf_dir, listing="all")
    return rule_pairs(r.nodes, r.pairs).select(
        F.col("node_id_1").alias("listing_id_1"), F.col("node_id_2").alias("listing_id_2"),
        (F.col("n_listings_1") * F.col("n_listings_2")).alias("n_pairs"),
        F.round("attribute", 4).alias("attribute_score"),
        F.round("emb", 4).alias("embedding_score"),
        F.col("_strong").alias("strong_reason"))


def _strong_run(spark, sf_dir):
    r = _run(spark, sf_dir)
    comps = connected_components(r.identity_edges.toDF("src", "dst"))
    members = groups.listing_components(r.listings, r.title_nodes, comps)
    return r, members


def q_strong_components(spark, sf_dir):
    _, members = _strong_run(spark, sf_dir)
    return members.select("listing_id", "component")


def q_strong_groups(spark, sf_dir):
    _, members = _strong_run(spark, sf_dir)
    g = groups.number_groups(groups.product_groups(members))
    return g.select("group_id", "first_seq", "n_listings", "canonical_title", "min_price",
                    F.array_join("sources", "|").alias("sources"), "currency",
                    "group_conflict_reason", "n_suspicious_low_price")


def q_gold_pairs(spark, sf_dir):
    return fixture.gold_pairs(configure(spark), sf_dir)


def q_strong_evaluation(spark, sf_dir):
    r = _run(spark, sf_dir)
    # Strong identity is read off the labelled pair, so no pair is listed.
    none = spark.createDataFrame([], "listing_id_1 long, listing_id_2 long, decision string, reason string, final_score double")
    pred = evaluation.labelled_predictions(r.labels, r.listings, none)
    return evaluation.confusion_metrics(pred)


def q_document_attributes(spark, sf_dir):
    """N*/A* over whole document texts (long multilingual prose)."""
    docs = spread(fixture.read_table(configure(spark), sf_dir, "documents").select("doc_id", "text"))
    a = with_attributes(docs, title_col="text")
    return a.select("doc_id", F.length("normalized_title").alias("normalized_length"), *ATTRIBUTES, "category")


# -- full pipeline
def q_fuzzy_scores(spark, sf_dir):
    return _run(spark, sf_dir, listing="all").scored.select("listing_id_1", "listing_id_2", "fuzzy_score", "final_score")


def q_match_decisions(spark, sf_dir):
    cols = ["listing_id_1", "listing_id_2", "title_1", "title_2", "normalized_title_1", "normalized_title_2",
            "n_pairs", "fuzzy_score", "embedding_score", "attribute_score", "final_score", "decision", "reason",
            "llm_confidence", "llm_raw_decision", "llm_prompt_version", "llm_route", "pipeline_version",
            "score_version", "review_bucket"]
    return _long(_run(spark, sf_dir, listing="all").final_pairs.select(*cols), "n_pairs")


def q_decision_counts(spark, sf_dir):
    return _long(_run(spark, sf_dir).decision_counts(), "pairs")


def q_reason_counts(spark, sf_dir):
    return _long(_run(spark, sf_dir).weighted, "pairs")


def q_verdict_requests(spark, sf_dir):
    return _run(spark, sf_dir).requests


def q_verdict_parse(spark, sf_dir):
    return parse_verdicts(_run(spark, sf_dir).verdict_table)


def _messy(r: Run) -> DataFrame:
    last_of = r.node_of.groupBy("node_id").agg(F.max("listing_id").alias("last_id"))
    return fixture.messy_verdicts(r.verdict_table, last_of)


def q_verdict_resolution(spark, sf_dir):
    """One reply per title pair from a table of repeated, swapped, contradictory and differently keyed rows."""
    r = _run(spark, sf_dir)
    return resolve_verdicts(_messy(r), r.node_of)


def q_resolved_decisions(spark, sf_dir):
    """Decisions of the routed pairs under that table."""
    r = _run(spark, sf_dir)
    return _long(finalize(r.scored, _messy(r), r.node_of).where(F.col("llm_route").isNotNull())
                 .select("listing_id_1", "listing_id_2", "n_pairs", "llm_raw_decision", "llm_confidence", "decision", "reason"), "n_pairs")


def q_unanswered_decisions(spark, sf_dir):
    """Decision counts of a run without a verdict service."""
    return _long(_run(spark, sf_dir, verdict_source=None).weighted, "pairs")


def q_components(spark, sf_dir):
    return _run(spark, sf_dir).members.select("listing_id", "component")


def q_product_groups(spark, sf_dir):
    # The confidence is the least score of all merges, so all of them are scored.
    g = _run(spark, sf_dir, listing="all").groups
    return g.select("group_id", "canonical_title", "n_listings", F.array_join("sources", "|").alias("sources"),
                    "min_price", "currency", "match_source", "confidence", "group_conflict",
                    "group_conflict_reason", "n_suspicious_low_price")


def q_group_members(spark, sf_dir):
    return _run(spark, sf_dir).group_members


def q_evaluation_metrics(spark, sf_dir):
    return _run(spark, sf_dir).metrics


def q_evaluation_summary(spark, sf_dir):
    r = _run(spark, sf_dir)
    return evaluation.evaluation_summary(r.predictions, r.groups)


def q_misclassified_pairs(spark, sf_dir):
    return evaluation.misclassified(_run(spark, sf_dir).predictions)


def q_verdict_usage(spark, sf_dir):
    return _long(_run(spark, sf_dir).usage(), "total_pairs", "llm_used")


def q_route_breakdown(spark, sf_dir):
    return _long(analysis.route_breakdown(_run(spark, sf_dir).final_pairs), "count")


def q_verdict_summary(spark, sf_dir):
    return _long(analysis.verdict_summary(_run(spark, sf_dir).final_pairs), "pairs", "disagreements", "llm_used")


def q_variant_confusion(spark, sf_dir):
    r = _run(spark, sf_dir)
    return _long(analysis.variant_confusion(r.final_pairs, r.variant_conflicts), "n_pairs")


def q_error_analysis(spark, sf_dir):
    r = _run(spark, sf_dir)
    return analysis.error_analysis_table(r.final_pairs, r.weighted, r.variant_conflicts)


def q_top_reject_reasons(spark, sf_dir):
    return _long(analysis.top_reject_reasons(_run(spark, sf_dir).weighted), "pairs")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "listings": q_listings,
    "feed_listings": q_feed_listings,
    "output_tables": q_output_tables,
    "clean_listings": q_clean_listings,
    "dq_flags": q_dq_flags,
    "title_normalize": q_title_normalize,
    "attributes": q_attributes,
    "block_keys": q_block_keys,
    "candidate_pair_count": q_candidate_pair_count,
    "conflict_counts": q_conflict_counts,
    "identity_classes": q_identity_classes,
    "compatible_pairs": q_compatible_pairs,
    "strong_components": q_strong_components,
    "strong_groups": q_strong_groups,
    "gold_pairs": q_gold_pairs,
    "strong_evaluation": q_strong_evaluation,
    "document_attributes": q_document_attributes,
    "fuzzy_scores": q_fuzzy_scores,
    "match_decisions": q_match_decisions,
    "decision_counts": q_decision_counts,
    "reason_counts": q_reason_counts,
    "verdict_requests": q_verdict_requests,
    "verdict_parse": q_verdict_parse,
    "verdict_resolution": q_verdict_resolution,
    "resolved_decisions": q_resolved_decisions,
    "unanswered_decisions": q_unanswered_decisions,
    "components": q_components,
    "product_groups": q_product_groups,
    "group_members": q_group_members,
    "evaluation_metrics": q_evaluation_metrics,
    "evaluation_summary": q_evaluation_summary,
    "misclassified_pairs": q_misclassified_pairs,
    "verdict_usage": q_verdict_usage,
    "route_breakdown": q_route_breakdown,
    "verdict_summary": q_verdict_summary,
    "variant_confusion": q_variant_confusion,
    "error_analysis": q_error_analysis,
    "top_reject_reasons": q_top_reject_reasons,
}
