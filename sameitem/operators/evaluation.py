"""Labelled evaluation and decision summaries (R3, R4, J6, J-h, G8-G11, P16).

Predictions for a labelled listing pair are computed directly for that pair:
not a candidate -> no prediction (0); hard conflict -> reject; same
normalised title -> merge; otherwise the final decision of its title pair.
No candidate pair is enumerated for this.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sameitem.functions import rules as R
from sameitem.functions.titles import ATTRIBUTES
from sameitem.operators.blocking import big, block_id, core_storage_key

LABEL_SCHEMA = "listing_id_1 int, listing_id_2 int, label int"


def read_labels_csv(spark, path: str) -> DataFrame:
    """Labelled-pair CSV with header."""
    return spark.read.schema(LABEL_SCHEMA).option("header", True).csv(path)


def _labelled(labels: DataFrame, listings: DataFrame) -> DataFrame:
    """Labelled pairs (``k1 <= k2``) with both listings' columns and their title nodes ``n1, n2``."""
    keyed = listings.select("listing_id", "title", "normalized_title", "category", *ATTRIBUTES,
                            block_id().alias("block"), core_storage_key().alias("cs"))
    g = labels.select(F.least("listing_id_1", "listing_id_2").cast("long").alias("k1"),
                      F.greatest("listing_id_1", "listing_id_2").cast("long").alias("k2"), "label")
    s1 = keyed.select(*[F.col(c).alias(c + "_1") for c in keyed.columns])
    s2 = keyed.select(*[F.col(c).alias(c + "_2") for c in keyed.columns])
    j = (g.join(s1, F.col("k1") == F.col("listing_id_1"), "left")
         .join(s2, F.col("k2") == F.col("listing_id_2"), "left"))
    node_of = listings.groupBy("normalized_title").agg(F.min("listing_id").alias("node"))
    return (j.join(node_of.select(F.col("normalized_title").alias("normalized_title_1"), F.col("node").alias("n1")),
                   "normalized_title_1", "left")
            .join(node_of.select(F.col("normalized_title").alias("normalized_title_2"), F.col("node").alias("n2")),
                  "normalized_title_2", "left"))


def labelled_strong_pairs(labels: DataFrame, listings: DataFrame, min_non_null_fields: int = 0) -> DataFrame:
    """Distinct title pairs ``node_id_1 < node_id_2`` of labelled pairs that strong identity decides."""
    strong = R.strong_reason(R.conflict_reason(), min_non_null_fields)
    j = _labelled(labels, listings).where((F.col("n1") != F.col("n2")) & (F.col("block_1") == F.col("block_2"))
                                          & R.conflict_reason().isNull() & strong.isNotNull())
    return j.select(F.least("n1", "n2").alias("node_id_1"), F.greatest("n1", "n2").alias("node_id_2")).distinct()


def labelled_predictions(labels: DataFrame, listings: DataFrame, final_pairs: DataFrame,
                         min_non_null_fields: int = 0) -> DataFrame:
    """J6 + J-h: gold pairs with ``pred_label`` and the pair's decision/reason.

    Strong identity is decided on the labelled pair itself, so ``final_pairs``
    need not list such pairs; where it does, it gives their score.
    """
    j = _labelled(labels, listings)
    candidate = (F.col("listing_id_1").isNotNull() & F.col("listing_id_2").isNotNull() & (F.col("k1") != F.col("k2"))
                 & ((F.col("block_1") == F.col("block_2")) | (F.col("cs_1") == F.col("cs_2"))))
    conflict = R.conflict_reason()
    strong = R.strong_reason(conflict, min_non_null_fields)
    fp = final_pairs.select(F.col("listing_id_1").alias("p1"), F.col("listing_id_2").alias("p2"),
                            F.col("decision").alias("pair_decision"), F.col("reason").alias("pair_reason"),
                            F.col("final_score").alias("pair_score"))
    j = j.join(fp, (F.least("n1", "n2") == F.col("p1")) & (F.greatest("n1", "n2") == F.col("p2")), "left")
    decision = (F.when(~F.coalesce(candidate, F.lit(False)), F.lit(None))
                .when(conflict.isNotNull(), F.lit("reject"))
                .when(strong.isNotNull(), F.lit("merge"))
                .otherwise(F.col("pair_decision")))
    reason = (F.when(~F.coalesce(candidate, F.lit(False)), F.lit(None))
              .when(conflict.isNotNull(), conflict)
              .when(strong.isNotNull(), strong)
              .otherwise(F.col("pair_reason")))
    return j.select(F.col("k1").alias("listing_id_1"), F.col("k2").alias("listing_id_2"), "label",
                    decision.alias("decision"), reason.alias("reason"),
                    F.coalesce((decision == "merge").cast("int"), F.lit(0)).alias("pred_label"),
                    F.col("title_1"), F.col("title_2"),
                    F.when(F.col("normalized_title_1") != F.col("normalized_title_2"), F.col("pair_score")).alias("final_score"))


def confusion_metrics(pred: DataFrame) -> DataFrame:
    """G8 + G9: one row of tp/fp/tn/fn and zero-guarded ratios."""
    def cnt(c):
        return F.count_if(c).cast("long")

    m = pred.agg(
        F.count(F.lit(1)).cast("long").alias("evaluated_pairs"),
        cnt((F.col("label") == 1) & (F.col("pred_label") == 1)).alias("tp"),
        cnt((F.col("label") == 0) & (F.col("pred_label") == 1)).alias("fp"),
        cnt((F.col("label") == 0) & (F.col("pred_label") == 0)).alias("tn"),
        cnt((F.col("label") == 1) & (F.col("pred_label") == 0)).alias("fn"))

    def ratio(n, d):
        return F.coalesce(F.round(n / F.nullif(d, F.lit(0)), 6), F.lit(0.0))

    return m.select("*",
                    ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                    ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
                    ratio(F.col("tp") + F.col("tn"), F.col("evaluated_pairs")).alias("accuracy"),
                    ratio(F.col("fp"), F.col("tp") + F.col("fp")).alias("false_merge_rate"))


def misclassified(pred: DataFrame) -> DataFrame:
    """False positives (bad merges) and false negatives (missed matches)."""
    kind = (F.when((F.col("label") == 0) & (F.col("pred_label") == 1), F.lit("false_positive"))
            .when((F.col("label") == 1) & (F.col("pred_label") == 0), F.lit("false_negative")))
    return pred.withColumn("error_kind", kind).where(F.col("error_kind").isNotNull())


def weighted_decisions(final_pairs: DataFrame, same_title: DataFrame, conflicts: DataFrame,
                       links: DataFrame | None = None) -> DataFrame:
    """All candidate listing pairs as ``decision, reason, pairs`` (G10 source).

    ``links``: counted strong matches (:func:`sameitem.operators.blocking.identity_links`)
    that ``final_pairs`` doesn't list.
    """
    scored = final_pairs.groupBy("decision", "reason").agg(big(F.sum("n_pairs")).alias("pairs"))
    same = same_title.groupBy("decision", "reason").agg(big(F.sum("n_pairs")).alias("pairs"))
    conf = conflicts.select(F.lit("reject").alias("decision"), "reason", "pairs")
    parts = scored.unionByName(same).unionByName(conf)
    if links is not None:
        parts = parts.unionByName(links.groupBy("reason").agg(big(F.sum("n_pairs")).alias("pairs"))
                                  .select(F.lit("merge").alias("decision"), "reason", "pairs"))
    return (parts
            .groupBy("decision", "reason").agg(big(F.sum("pairs")).alias("pairs")))


def decision_counts(weighted: DataFrame) -> DataFrame:
    """Listing pairs per decision, plus the total as ``decision = 'total'``."""
    per = weighted.groupBy("decision").agg(big(F.sum("pairs")).alias("pairs"))
    total = weighted.agg(big(F.sum("pairs")).alias("pairs")).select(F.lit("total").alias("decision"), "pairs")
    return per.unionByName(total)


def evaluation_summary(pred: DataFrame, groups: DataFrame) -> DataFrame:
    """G8-G11 in one row: the confusion metrics and the number of product groups."""
    total = groups.agg(F.count(F.lit(1)).alias("total_groups"))
    return confusion_metrics(pred).withColumn("_k", F.lit(1)).join(total.withColumn("_k", F.lit(1)), "_k").drop("_k")
