"""Verdict usage and error analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sameitem.operators.blocking import big

# Fixed value: the summary row's sentence.
SUMMARY_REASON = "variant_confusion cases — LLM correctly rejected base vs special variant pairs"


def verdict_usage(final_pairs: DataFrame, weighted: DataFrame) -> DataFrame:
    """Total listing pairs, pairs that used a verdict, percentage (2 digits)."""
    none = big(F.lit(0))
    parts = (weighted.select(F.col("pairs").alias("t"), none.alias("u"))
             .unionByName(final_pairs.where(F.col("llm_route").isNotNull()).select(none.alias("t"), F.col("n_pairs").alias("u"))))
    both = parts.agg(F.coalesce(big(F.sum("t")), none).alias("total_pairs"),
                     F.coalesce(big(F.sum("u")), none).alias("llm_used"))
    share = 100.0 * F.col("llm_used").cast("double") / F.nullif(F.col("total_pairs").cast("double"), F.lit(0.0))
    return both.select("total_pairs", "llm_used", F.coalesce(F.round(share, 2), F.lit(0.0)).alias("llm_used_pct"))


def route_breakdown(final_pairs: DataFrame) -> DataFrame:
    """Pairs per verdict route."""
    return (final_pairs.where(F.col("llm_route").isNotNull())
            .groupBy("llm_route").agg(big(F.sum("n_pairs")).alias("count")))


def verdict_summary(final_pairs: DataFrame) -> DataFrame:
    """Finalised verdict rows per decision, mean confidence, disagreements."""
    fin = final_pairs.where(F.col("reason").startswith("llm_"))
    per = fin.groupBy("decision").agg(big(F.sum("n_pairs")).alias("pairs"))
    n, none = F.col("n_pairs").cast("double"), big(F.lit(0))
    stats = final_pairs.agg(
        F.round(F.sum(F.col("llm_confidence") * n) / F.sum(F.when(F.col("llm_confidence").isNotNull(), n)), 3).alias("mean_llm_confidence"),
        F.coalesce(big(F.sum(F.when(F.col("reason").contains("llm_rule_disagreement"), F.col("n_pairs")))), none).alias("disagreements"),
        F.coalesce(big(F.sum(F.when(F.col("llm_route").isNotNull(), F.col("n_pairs")))), none).alias("llm_used"))
    # One row of totals, joined to at most three decisions; without decisions the totals stand alone.
    return (stats.withColumn("_k", F.lit(1)).join(per.withColumn("_k", F.lit(1)), "_k", "left")
            .select("decision", F.coalesce("pairs", none).alias("pairs"), "mean_llm_confidence", "disagreements", "llm_used"))


def variant_confusion(final_pairs: DataFrame, conflicts: DataFrame) -> DataFrame:
    """Rejects whose reason mentions a variant (8 columns, ``n_pairs`` and ``error_type``).

    Scored title pairs, and the hard conflicts of
    :func:`sameitem.operators.blocking.variant_conflicts`, which are not scored.
    """
    cols = ["listing_id_1", "listing_id_2", "title_1", "title_2", "final_score", "llm_raw_decision", "llm_confidence",
            "reason", "n_pairs"]
    scored = final_pairs.where(F.lower("reason").contains("variant") & (F.col("decision") == "reject")).select(*cols)
    hard = conflicts.withColumns({"final_score": F.lit(None).cast("double"), "llm_raw_decision": F.lit(None).cast("string"),
                                  "llm_confidence": F.lit(None).cast("double")}).select(*cols)
    return scored.unionByName(hard).withColumn("error_type", F.lit("variant_confusion"))


def variant_confusion_counts(weighted: DataFrame) -> DataFrame:
    """Variant rejections per reason over all candidate pairs, conflict rejects included."""
    return (weighted.where(F.lower("reason").contains("variant") & (F.col("decision") == "reject"))
            .select(F.lit("variant_confusion").alias("error_type"), "reason", "pairs"))


def error_analysis_table(final_pairs: DataFrame, weighted: DataFrame, conflicts: DataFrame) -> DataFrame:
    """Summary row + detail rows, all as text (the reference's CSV layout plus ``n_pairs``).

    The summary's total is the sum of the details' ``n_pairs``.
    """
    details = variant_confusion(final_pairs, conflicts)
    total = variant_confusion_counts(weighted).agg(F.coalesce(F.sum("pairs"), big(F.lit(0))).alias("n"))
    summary = total.select(
        F.lit("SUMMARY").alias("listing_id_1"),
        F.concat(F.lit("total: "), F.col("n").cast("string")).alias("listing_id_2"),
        F.lit("").alias("title_1"), F.lit("").alias("title_2"), F.lit("").alias("final_score"),
        F.lit("").alias("llm_raw_decision"), F.lit("").alias("llm_confidence"),
        F.lit(SUMMARY_REASON).alias("reason"), F.col("n").cast("string").alias("n_pairs"),
        F.lit("variant_confusion").alias("error_type"))
    rows = details.select(*[F.col(c).cast("string").alias(c) for c in summary.columns])
    return summary.unionByName(rows)


def top_reject_reasons(weighted: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent (error_type, reason) among variant rejections."""
    return (variant_confusion_counts(weighted).orderBy(F.desc("pairs"), F.asc("reason")).limit(k))
