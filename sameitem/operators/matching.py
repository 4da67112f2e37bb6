"""Pair scoring and decisions over title pairs.

The output is one row per compatible pair of distinct title nodes with
``n_pairs`` = number of listing pairs it stands for (product of the two
titles' listing counts).  Conflict pairs are counted separately
(:func:`sameitem.operators.blocking.conflict_counts`), and pairs of listings
sharing a normalised title are implicit exact-title merges
(:func:`same_title_edges`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sameitem.functions import rules as R
from sameitem.functions.fuzzy import with_fuzzy
from sameitem.functions.titles import ATTRIBUTES
from sameitem.operators.blocking import compatible_title_pairs, pair_product, pairs_within

#: Title pairs that one task of the ratios takes.
PAIRS_PER_TASK = 50_000
NODE_COLUMNS = ["node_id", "normalized_title", "rep_title", "n_listings", "category", *ATTRIBUTES]


def nodes_with_vectors(nodes: DataFrame, vectors: DataFrame | None = None) -> DataFrame:
    """Title nodes plus the vector of each title.

    A title's vector is the vector of its lowest listing id: the reference
    embeds the normalised title, so one vector per title is its model.
    Only one lookup per title node reaches the vector table.
    """
    if vectors is None:
        return nodes.withColumn("embedding", F.lit(None).cast("array<float>"))
    # One vector a listing, whatever the source holds: the least of them.
    vec = (vectors.withColumnRenamed("listing_id", "node_id").join(nodes.select("node_id"), "node_id", "left_semi")
           .groupBy("node_id").agg(F.min("embedding").alias("embedding")))
    return nodes.join(vec, "node_id", "left")


def _side(nodes: DataFrame, suffix: str) -> DataFrame:
    cols = NODE_COLUMNS + ["embedding"]
    return nodes.select(*[F.col(c).alias(c + suffix) for c in cols])


def rule_pairs(nodes: DataFrame, pairs: DataFrame | None = None, min_non_null_fields: int = 0) -> DataFrame:
    """Compatible title pairs with both sides' attributes and the score-free rules.

    Adds ``attribute`` (M2), ``emb`` (M3), ``_conflict`` (C2, always null
    here) and ``_strong`` (C3).  No Python: the strong-identity slice of the
    pipeline runs on this alone.  ``min_non_null_fields``: see :func:`R.strong_reason`.
    """
    pairs = compatible_title_pairs(nodes) if pairs is None else pairs
    p = (pairs.join(_side(nodes, "_1"), "node_id_1").join(_side(nodes, "_2"), "node_id_2"))
    p = p.withColumns({
        "attribute": R.attribute_agreement(),
        "emb": R.cosine(F.col("embedding_1"), F.col("embedding_2")),
        "_conflict": R.conflict_reason(),
    })
    return p.withColumn("_strong", R.strong_reason(F.col("_conflict"), min_non_null_fields))


def strong_edges(nodes: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Title pairs merged by strong identity (C3) alone, with ``n_pairs``."""
    p = rule_pairs(nodes, pairs).where(F.col("_strong").isNotNull())
    return p.select(F.col("node_id_1").alias("listing_id_1"), F.col("node_id_2").alias("listing_id_2"),
                    pair_product(F.col("n_listings_1"), F.col("n_listings_2")).alias("n_pairs"),
                    F.lit("merge").alias("decision"), F.col("_strong").alias("reason"))


def score_pairs(nodes: DataFrame, pairs: DataFrame | None = None, min_non_null_fields: int = 0) -> DataFrame:
    """R2 for compatible title pairs: scores, decision, reason.

    The Python UDF sees each distinct title pair once; everything else is
    JVM expressions.  Scores are rounded to 4 digits on output (M5), the
    decision uses the unrounded score.
    """
    spark = nodes.sparkSession
    pairs = compatible_title_pairs(nodes) if pairs is None else pairs
    p = rule_pairs(nodes, pairs, min_non_null_fields)
    # The ratios are CPU-bound: AQE would coalesce the byte-small pair table into
    # few partitions.  A numbered repartition is never coalesced; it grows with the pairs.
    n = max(spark.sparkContext.defaultParallelism, -(-pairs.count() // PAIRS_PER_TASK))
    p = p.repartition(n, "node_id_1", "node_id_2")
    p = with_fuzzy(p, "normalized_title_1", "normalized_title_2")
    p = p.withColumn("score", R.match_score(F.col("fuzzy"), F.col("attribute"), F.col("emb")))
    # One column per rule so no rule's expression is inlined twice.
    p = p.withColumn("_flags", R.risk_flags(F.col("score")))
    p = p.withColumn("d", R.decide(F.col("score"), F.col("_conflict"), F.col("_strong"), F.col("_flags")))
    return p.select(
        F.col("node_id_1").alias("listing_id_1"),
        F.col("node_id_2").alias("listing_id_2"),
        F.col("rep_title_1").alias("title_1"),
        F.col("rep_title_2").alias("title_2"),
        "normalized_title_1", "normalized_title_2",
        pair_product(F.col("n_listings_1"), F.col("n_listings_2")).alias("n_pairs"),
        F.round("fuzzy", 4).alias("fuzzy_score"),
        F.round("emb", 4).alias("embedding_score"),
        F.round("attribute", 4).alias("attribute_score"),
        F.round("score", 4).alias("final_score"),
        F.col("d.decision").alias("decision"),
        F.col("d.reason").alias("reason"),
        *[F.col(f"{c}{s}") for c in [*ATTRIBUTES, "category"] for s in ("_1", "_2")],
    )


def same_title_edges(nodes: DataFrame) -> DataFrame:
    """Listing pairs that share a normalised title: exact-title merges.

    Their scores are those of a string with itself: fuzzy 1, attribute 1
    when any attribute is present, embedding 1 when the title has a
    non-zero vector.  One row per title with ``n_pairs = C(n, 2)``.
    """
    any_attr = F.greatest(*[F.col(c).isNotNull() for c in ATTRIBUTES])
    vec = F.col("embedding").cast("array<double>")
    has_vec = F.col("embedding").isNotNull() & (
        F.aggregate(F.transform(vec, lambda x: x * x), F.lit(0.0), lambda s, x: s + x) > 0)
    score = (R.W_FUZZY * 1.0 + R.W_ATTRIBUTE * any_attr.cast("double")
             + R.W_EMBEDDING * has_vec.cast("double"))
    return (nodes.where(F.col("n_listings") >= 2)
            .select(F.col("node_id").alias("listing_id_1"), F.col("node_id").alias("listing_id_2"),
                    pairs_within(F.col("n_listings")).alias("n_pairs"),
                    F.round(score, 4).alias("final_score"),
                    F.lit("merge").alias("decision"),
                    F.lit("exact_normalized_match").alias("reason")))
