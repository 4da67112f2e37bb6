"""Product groups: component membership, canonical row, prices, metadata.

Everything is a ``groupBy(component)`` with partial aggregation or a join on
the component key; no per-group Python and no list of all members in one
row.  Member lists of the reference (ids, titles, flagged ids) come as a
long table (:func:`group_members`), which stays correct for a group that
holds a third of all listings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sameitem.functions.titles import completeness, promo_penalty
from sameitem.session import stage

# Group conflict test order (C12), no colour.
GROUP_CONFLICT_FIELDS = ["brand", "model_family", "model_number", "tier_variant", "display_variant",
                         "connectivity", "storage", "ram", "screen_size", "condition"]
SUSPICIOUS_RATIO = 0.5
#: Accuracy of the quantile sketch that encloses a median: its error is one rank in this many.
SKETCH = 10_000


def consecutive_ids(df: DataFrame, order_col: str, name: str) -> DataFrame:
    """1..n in ``order_col`` order without a single-partition window.

    Range-partition, count rows per partition (one small row each), turn the
    counts into offsets, and add a row number inside each partition.  Only
    the per-partition counts (bounded by the partition count) are broadcast.
    """
    # Written once: this fixes the range bounds and partition ids for both uses.
    parts = stage(df.repartitionByRange(order_col).withColumn("_pid", F.spark_partition_id()), "numbered")
    counts = parts.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    w = Window.partitionBy("_pid").orderBy(order_col)
    return (parts.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + F.row_number().over(w)).cast("long"))
            .drop("_pid", "_off"))


def listing_components(listings: DataFrame, nodes: DataFrame, components: DataFrame) -> DataFrame:
    """Component of every matchable listing (its own id when unmatched)."""
    node_of = nodes.select("normalized_title", "node_id", "block")
    comp = components.select(F.col("node").alias("node_id"), "component")
    return (listings.join(node_of, "normalized_title", "left")
            .join(comp, "node_id", "left")
            .withColumn("component", F.coalesce("component", "node_id", "listing_id")))


def median_ranks(total: Column) -> tuple[Column, Column]:
    """The two middle ranks of ``total`` values, from 1; they are one for an odd number."""
    return F.floor((total + 1) / 2), F.floor(total / 2) + 1


def around_median(members: DataFrame, prices: DataFrame, accuracy: int = SKETCH) -> DataFrame:
    """The prices that can be a component's median: ``component, price, n, total, below``.

    A quantile sketch of each component, merged map-side, gives a price on either
    side of the median.  Exact counts then say whether they enclose it; an end that
    does not is dropped, so a sketch's error costs rows but never the result.
    ``below`` is the number of listings under the range.
    """
    off = 2.0 / accuracy
    ends = (members.where(F.col("price").isNotNull()).groupBy("component")
            .agg(F.percentile_approx("price", [max(0.0, 0.5 - off), min(1.0, 0.5 + off)], accuracy).alias("ends"),
                 F.count(F.lit(1)).alias("total"))
            .where(F.col("total") >= 2)
            .select("component", "total", F.col("ends")[0].alias("low"), F.col("ends")[1].alias("high")))
    counted = prices.join(ends, "component").groupBy("component", "total", "low", "high").agg(
        F.sum(F.when(F.col("price") < F.col("low"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("price") <= F.col("high"), F.col("n")).otherwise(0)).alias("upto"))
    first, second = median_ranks(F.col("total"))
    under, over = F.col("below") < first, F.col("upto") >= second
    ranges = counted.select("component", "total", F.when(under, F.col("low")).alias("low"), F.when(over, F.col("high")).alias("high"),
                            F.when(under, F.col("below")).otherwise(0).alias("below"))
    return (prices.join(ranges, "component")
            .where((F.col("low").isNull() | (F.col("price") >= F.col("low")))
                   & (F.col("high").isNull() | (F.col("price") <= F.col("high"))))
            .select("component", "price", "n", "total", "below"))


def median_prices(near: DataFrame) -> DataFrame:
    """``component, median``: the middle ranks read off running counts of :func:`around_median`'s rows."""
    upto = Window.partitionBy("component").orderBy("price").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first, second = median_ranks(F.col("total"))
    end = near.withColumn("end", F.col("below") + F.sum("n").over(upto))
    return (end.groupBy("component").agg(F.min(F.when(F.col("end") >= first, F.col("price"))).alias("lower"),
                                         F.min(F.when(F.col("end") >= second, F.col("price"))).alias("upper"))
            .select("component", ((F.col("lower") + F.col("upper")) / 2).alias("median")))


def low_prices(members: DataFrame, accuracy: int = SKETCH) -> DataFrame:
    """Distinct prices per component that lie below half the component's median.

    Prices are counted per (component, price) before the shuffle and staged.  Only the
    few prices around the median go through a window, so a component with millions of
    prices is counted, bracketed and filtered in many tasks; components with fewer
    than two prices have no median.
    """
    prices = stage(members.where(F.col("price").isNotNull()).groupBy("component", "price").agg(F.count(F.lit(1)).alias("n")), "prices")
    medians = median_prices(around_median(members, prices, accuracy))
    return (prices.join(medians, "component").where(F.col("price") < SUSPICIOUS_RATIO * F.col("median"))
            .select("component", "price"))


def flag_suspicious(members: DataFrame) -> DataFrame:
    """``suspicious_price`` = price below half the group median.

    Joined on (component, price), so a component with a third of all listings
    is spread over its prices.
    """
    low = low_prices(members).withColumn("_low", F.lit(True))
    return (members.join(low, ["component", "price"], "left")
            .withColumn("suspicious_price", F.coalesce("_low", F.lit(False))).drop("_low"))


def match_metadata(edges: DataFrame, comp_of_node: DataFrame) -> DataFrame:
    """Weakest accepted edge per component -> ``match_source, confidence``.

    Ties on the score are broken by the smaller representative ids.
    """
    e = edges.where(F.col("decision") == "merge").join(
        comp_of_node.select(F.col("node").alias("listing_id_1"), "component"), "listing_id_1", "left")
    e = e.withColumn("component", F.coalesce("component", "listing_id_1"))
    key = F.struct(F.col("final_score"), F.col("listing_id_1"), F.col("listing_id_2"))
    return e.groupBy("component").agg(
        F.min_by(F.struct("final_score", "reason"), key).alias("_w")
    ).select("component",
             F.when(F.col("_w.reason").contains("llm"), F.lit("llm")).otherwise(F.lit("rules_scoring")).alias("match_source"),
             F.round(F.col("_w.final_score"), 4).alias("confidence"))


def product_groups(members: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """One row per product group.

    ``members``: listings with ``component`` (from :func:`listing_components`).
    Columns: group_id, canonical_title, n_listings, sources, min_price,
    currency, match_source, confidence, group_conflict, group_conflict_reason,
    n_suspicious_low_price, first_seq.
    """
    m = flag_suspicious(members).withColumns({
        "_complete": completeness(),
        "_promo": promo_penalty(F.col("title")),
        "_len": F.length("title"),
    })
    # Completeness desc, promo asc, length desc, price asc, then input order.
    rank = F.struct(F.col("_complete"), -F.col("_promo"), F.col("_len"), -F.col("price"), -F.col("row_seq"))
    keep = ~F.col("suspicious_price")
    conflict = None
    for f in GROUP_CONFLICT_FIELDS:
        cond = F.min(f) != F.max(f)
        v = F.lit(f"group_{f}_conflict")
        conflict = F.when(cond, v) if conflict is None else conflict.when(cond, v)
    agg = m.groupBy("component").agg(
        F.min("row_seq").alias("first_seq"),
        F.count(F.lit(1)).alias("n_listings"),
        F.coalesce(F.max_by(F.when(keep, F.col("title")), F.when(keep, rank)),
                   F.max_by("title", rank)).alias("canonical_title"),
        F.coalesce(F.min(F.when(keep, F.col("price"))), F.min("price")).alias("min_price"),
        F.sort_array(F.collect_set("source")).alias("sources"),
        F.min_by("currency", "row_seq").alias("currency"),
        conflict.alias("group_conflict_reason"),
        F.sum(F.col("dq_suspicious_low_price").cast("int")).alias("n_suspicious_low_price"),
    )
    if metadata is not None:
        agg = agg.join(metadata, "component", "left")
    else:
        agg = agg.withColumns({"match_source": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")})
    agg = agg.withColumns({
        "match_source": F.coalesce("match_source", F.lit("singleton")),
        "confidence": F.coalesce("confidence", F.lit(1.0)),
        "group_conflict": F.col("group_conflict_reason").isNotNull(),
        "group_conflict_reason": F.coalesce("group_conflict_reason", F.lit("no_conflict")),
    })
    return agg


def number_groups(groups: DataFrame) -> DataFrame:
    """Group ids 1..n by first appearance in input order."""
    return consecutive_ids(groups, "first_seq", "group_id")


def group_members(members: DataFrame, numbered: DataFrame) -> DataFrame:
    """Long form of the reference's list columns (listing_ids, titles, flagged ids)."""
    gid = numbered.select("component", "group_id")
    return (flag_suspicious(members).join(gid, "component")
            .select("group_id", "listing_id", "row_seq", "title", "price", "source",
                    "suspicious_price", F.col("dq_suspicious_low_price").alias("suspicious_low_price")))
