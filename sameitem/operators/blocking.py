"""Block keys, title nodes, candidate pairs and hard-conflict counts (J-a, J1, C2, O1-O4).

Scale design
------------
* Every pair decision of the reference is a function of the two normalised
  titles (attributes are extracted from the normalised title and the
  vector is a vector of that title).  So listings are first collapsed to
  one *title node* per distinct normalised title; a title held by a third of
  all rows is one node with a multiplicity, not a quadratic clique.
* Candidate pairs of the reference are the pairs sharing a block key.  All
  keys but one contain brand and family, so (O1) candidates are exactly:
  same ``family|brand|family`` block, plus same ``core_storage`` key across
  families (always a ``model_family_mismatch`` reject), plus same
  ``fallback`` key (rows without brand+family).
* Pairs that are hard conflicts (C2) are rejects whatever their scores, so
  they are never enumerated: their number per reason is computed exactly by
  aggregation (:func:`conflict_counts`).  Only *compatible* title pairs
  (no C2 conflict) are enumerated, by an equi-join on the null pattern of
  the conflict fields (:func:`compatible_title_pairs`): a pair is compatible
  iff both agree on the fields that are non-null on both sides, so joining
  rows of pattern P with rows of pattern Q on the projection to P∩Q gives
  each compatible pair exactly once per orientation.
* Titles of one block with the same eleven attributes are one *identity class*
  (:func:`title_classes`).  Any two of them are a strong match (C3) whatever their
  scores, and so are classes of one phone identity, so such pairs are counted
  (:func:`identity_links`) and represented by one star edge per title
  (:func:`identity_edges`); only pairs of titles in compatible classes without a
  strong match are enumerated (:func:`open_title_pairs`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sameitem.functions.rules import CONFLICT_FIELDS, STRICT_CONDITIONS, strong_reason
from sameitem.functions.titles import ATTRIBUTES

SEP = "\u0001"
ABSENT = "\u0002"


def block_keys(df: DataFrame) -> DataFrame:
    """J-a: the reference's key set per listing as ``block_keys array<string>``."""
    b, fam, num = F.col("brand"), F.col("model_family"), F.col("model_number")

    def key(name: str, *cols: str) -> Column:
        cs = [F.col(c) for c in cols]
        ok = reduce(lambda x, y: x & y, [c.isNotNull() for c in cs])
        return F.when(ok, F.concat_ws("|", F.lit(name), *cs))

    bf = b.isNotNull() & fam.isNotNull()
    keys = F.array_compact(F.array(
        key("core", "brand", "model_family", "model_number"),
        key("core_storage", "brand", "model_number", "storage"),
        key("family_storage", "brand", "model_family", "storage"),
        key("family_variant", "brand", "model_family", "tier_variant"),
        key("family_display", "brand", "model_family", "display_variant"),
        key("family_conn", "brand", "model_family", "connectivity"),
        key("family_ram", "brand", "model_family", "ram"),
        key("family_size", "brand", "model_family", "screen_size"),
        key("family_condition", "brand", "model_family", "condition"),
        key("family", "brand", "model_family"),
        F.when(bf & num.isNotNull(), F.concat_ws("|", F.lit("loose"), b, fam, num))
        .when(bf, F.concat_ws("|", F.lit("loose"), b, fam)),
    ))
    toks = F.split(F.col("normalized_title"), " ")
    fallback = F.when((F.size(toks) >= 2) & (F.col("normalized_title") != ""),
                      F.array(F.concat_ws("|", F.lit("fallback"), toks[0], toks[1])))
    keys = F.when(F.size(keys) > 0, keys).otherwise(F.coalesce(fallback, F.array().cast("array<string>")))
    return df.withColumn("block_keys", F.array_distinct(keys))


def block_id(prefix: str = "") -> Column:
    """The block a row belongs to (O1): its family key, else its fallback key."""
    p = (lambda c: F.col(prefix + c))
    toks = F.split(p("normalized_title"), " ")
    return (F.when(p("brand").isNotNull() & p("model_family").isNotNull(),
                   F.concat_ws("|", F.lit("family"), p("brand"), p("model_family")))
            .when((F.size(toks) >= 2) & (p("normalized_title") != ""),
                  F.concat_ws("|", F.lit("fallback"), toks[0], toks[1])))


def core_storage_key() -> Column:
    c = F.col
    return F.when(c("brand").isNotNull() & c("model_number").isNotNull() & c("storage").isNotNull(),
                  F.concat_ws("|", F.lit("core_storage"), c("brand"), c("model_number"), c("storage")))


def null_pattern(fields=CONFLICT_FIELDS) -> Column:
    """Bit i set when conflict field i is non-null."""
    return reduce(lambda a, b: a + b,
                  [F.when(F.col(f).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0))
                   for i, f in enumerate(fields)])


def strict_condition() -> Column:
    """Refurbished/used demand an equal condition on the other side (C2 tail rule)."""
    return F.coalesce(F.col("condition").isin(*STRICT_CONDITIONS), F.lit(False))


def projection(mine: Column, other: Column, fields=CONFLICT_FIELDS, upto: int | None = None) -> Column:
    """Values on the fields non-null on both sides (bits of ``mine & other``)."""
    upto = len(fields) if upto is None else upto
    both = mine.bitwiseAND(other)
    parts = [F.when(both.bitwiseAND(F.lit(1 << i)) != 0, F.col(f)) for i, f in enumerate(fields[:upto])]
    return F.concat_ws(SEP, *parts) if parts else F.lit("")


def title_nodes(listings: DataFrame) -> DataFrame:
    """Collapse blocked matchable listings to one node per normalised title.

    Output: ``node_id`` (lowest listing id with that title), ``n_listings``,
    ``first_seq``, the block, the null pattern and the attributes.  Listings
    without a block can pair with nothing and are left out.
    """
    keyed = listings.withColumn("block", block_id()).where(F.col("block").isNotNull())
    return (keyed.groupBy("normalized_title")
            .agg(F.min("listing_id").alias("node_id"),
                 F.count(F.lit(1)).alias("n_listings"),
                 F.min("row_seq").alias("first_seq"),
                 F.min_by("title", "listing_id").alias("rep_title"),
                 F.any_value("block").alias("block"),
                 F.any_value("category").alias("category"),
                 *[F.any_value(a).alias(a) for a in ATTRIBUTES])
            .withColumn("pattern", null_pattern())
            .withColumn("strict_cond", strict_condition()))


def compatible_title_pairs(nodes: DataFrame) -> DataFrame:
    """All pairs of distinct title nodes in one block with no hard conflict.

    Each node is expanded once per null pattern of any node (at most 2^9, in
    practice a handful, read to the driver) and joined on
    ``(block, my pattern, other pattern, strict condition, shared values)``.
    Nothing is joined on the block alone, and both sides are plain exchanges,
    so adaptive execution can split a heavy key.  Output: ``node_id_1 < node_id_2``.
    """
    expanded = (nodes.select("block", "node_id", "pattern", "strict_cond", *CONFLICT_FIELDS)
                .withColumn("other", F.explode(_patterns(nodes)))
                .select("block", "node_id", "pattern", "other", "strict_cond",
                        projection(F.col("pattern"), F.col("other")).alias("proj")))
    left = expanded.alias("l")
    right = expanded.alias("r")
    cond = ((F.col("l.block") == F.col("r.block"))
            & (F.col("l.pattern") == F.col("r.other"))
            & (F.col("l.other") == F.col("r.pattern"))
            & (F.col("l.strict_cond") == F.col("r.strict_cond"))
            & (F.col("l.proj") == F.col("r.proj"))
            & (F.col("l.node_id") < F.col("r.node_id")))
    return left.join(right, cond).select(F.col("l.node_id").alias("node_id_1"),
                                         F.col("r.node_id").alias("node_id_2"))


def _patterns(df: DataFrame) -> Column:
    """The null patterns that occur, as an array literal (at most 2^9 small numbers)."""
    found = sorted(r["pattern"] for r in df.select("pattern").distinct().collect())
    return F.array(*[F.lit(p) for p in found]) if found else F.array().cast("array<int>")


def class_key() -> Column:
    """The identity class of a title node as text: its block and its eleven attributes."""
    return F.concat_ws(SEP, F.col("block"), *[F.coalesce(F.col(a), F.lit(ABSENT)) for a in ATTRIBUTES])


def title_classes(nodes: DataFrame) -> DataFrame:
    """Identity classes of title nodes: one row per block and attribute tuple.

    ``class_id`` is the least node id; ``n_titles``, ``n_listings`` and ``squares`` (sum of the
    titles' squared listing counts) are what :func:`identity_links` counts from.
    """
    return (nodes.groupBy(class_key().alias("class_key"))
            .agg(F.min("node_id").alias("class_id"), F.any_value("block").alias("block"),
                 F.any_value("category").alias("category"), F.any_value("pattern").alias("pattern"),
                 F.any_value("strict_cond").alias("strict_cond"),
                 F.count(F.lit(1)).alias("n_titles"), F.sum("n_listings").alias("n_listings"),
                 F.sum(pair_product(F.col("n_listings"), F.col("n_listings"))).alias("squares"),
                 *[F.any_value(a).alias(a) for a in ATTRIBUTES]))


def class_members(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """``node_id, class_id`` of every title node (``classes`` staged, so that a heavy class can be split)."""
    return (nodes.select("node_id", class_key().alias("class_key"))
            .join(classes.select("class_key", "class_id"), "class_key").select("node_id", "class_id"))


def class_pairs(classes: DataFrame, min_non_null_fields: int = 0) -> DataFrame:
    """Compatible pairs of classes, each with itself included: ``class_id_1 <= class_id_2, strong``.

    ``strong`` is the reason (C3) that merges every pair of titles between the two
    classes, null where scores decide.  Joined like :func:`compatible_title_pairs`.
    """
    pairs = compatible_title_pairs(classes.withColumnRenamed("class_id", "node_id")).select(
        F.col("node_id_1").alias("class_id_1"), F.col("node_id_2").alias("class_id_2"))
    own = classes.where(F.col("n_titles") > 1).select(F.col("class_id").alias("class_id_1"), F.col("class_id").alias("class_id_2"))
    cols = ["class_id", "category", *ATTRIBUTES]
    sides = [classes.select(*[F.col(c).alias(c + s) for c in cols]) for s in ("_1", "_2")]
    # Distinct titles never match exactly; conflicts are out already.
    p = (pairs.unionByName(own).join(sides[0], "class_id_1").join(sides[1], "class_id_2")
         .withColumns({"normalized_title_1": F.lit("1"), "normalized_title_2": F.lit("2")}))
    return p.select("class_id_1", "class_id_2",
                    strong_reason(F.lit(None).cast("string"), min_non_null_fields).alias("strong"))


def identity_links(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Exact numbers of strong matches per pair of classes, without a row per pair of titles.

    ``class_id_1, class_id_2, reason, n_links`` (pairs of titles), ``n_pairs`` (pairs of
    listings with different titles).
    """
    cols = ["class_id", "n_titles", "n_listings", "squares"]
    sides = [classes.select(*[F.col(c).alias(c + s) for c in cols]) for s in ("_1", "_2")]
    p = pairs.where(F.col("strong").isNotNull()).join(sides[0], "class_id_1").join(sides[1], "class_id_2")
    same = F.col("class_id_1") == F.col("class_id_2")
    # Of N listings, those of different titles make (N * N - sum of n * n) / 2 pairs; the difference is even.
    within = big((pair_product(F.col("n_listings_1"), F.col("n_listings_1")) - F.col("squares_1")) / 2)
    return p.select("class_id_1", "class_id_2", F.col("strong").alias("reason"),
                    F.when(same, pairs_within(F.col("n_titles_1"))).otherwise(pair_product(F.col("n_titles_1"), F.col("n_titles_2"))).alias("n_links"),
                    F.when(same, within).otherwise(pair_product(F.col("n_listings_1"), F.col("n_listings_2"))).alias("n_pairs"))


def identity_edges(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Title pairs that stand for all strong matches: a star per class and an edge per pair of classes.

    They connect what all strong matches connect; ``node_id_1 < node_id_2``.
    """
    strong = pairs.where(F.col("strong").isNotNull())
    centre = strong.where(F.col("class_id_1") == F.col("class_id_2")).select(F.col("class_id_1").alias("class_id"))
    star = (members.where(F.col("node_id") != F.col("class_id")).join(centre, "class_id")
            .select(F.col("class_id").alias("node_id_1"), F.col("node_id").alias("node_id_2")))
    between = strong.where(F.col("class_id_1") < F.col("class_id_2")).select(
        F.col("class_id_1").alias("node_id_1"), F.col("class_id_2").alias("node_id_2"))
    return star.unionByName(between)


def open_title_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Title pairs of compatible classes that no strong match decides: ``node_id_1 < node_id_2``."""
    open_ = pairs.where(F.col("strong").isNull()).select("class_id_1", "class_id_2")
    one, two = (members.select(F.col("class_id").alias(f"class_id_{s}"), F.col("node_id").alias(f"n{s}")) for s in "12")
    met = open_.join(one, "class_id_1").join(two, "class_id_2")
    return met.where((F.col("class_id_1") != F.col("class_id_2")) | (F.col("n1") < F.col("n2"))).select(
        F.least("n1", "n2").alias("node_id_1"), F.greatest("n1", "n2").alias("node_id_2"))


def big(n: Column) -> Column:
    """Counts of pairs are decimal(38,0) throughout: they outgrow a long."""
    return n.cast("decimal(38,0)")


def pairs_within(n: Column) -> Column:
    """C(n, 2), exact: one of n and n - 1 is even and is halved before the product."""
    n = n.cast("long")
    even = n % 2 == 0
    return pair_product(F.shiftright(F.when(even, n).otherwise(n - 1), 1), F.when(even, n - 1).otherwise(n))


def pair_product(a: Column, b: Column) -> Column:
    """Product of two counts, exact."""
    return big(a.cast("decimal(19,0)") * b.cast("decimal(19,0)"))


def candidate_pair_count(listings: DataFrame) -> DataFrame:
    """Number of distinct candidate listing pairs (J1 + G18), without enumerating them.

    family blocks + fallback blocks + same core_storage key across families.
    """
    keyed = listings.select(block_id().alias("block"), core_storage_key().alias("cs"),
                            F.col("model_family"))
    blocks = (keyed.where(F.col("block").isNotNull()).groupBy("block").count()
              .agg(F.sum(pairs_within(F.col("count"))).alias("n")))
    cs_all = (keyed.where(F.col("cs").isNotNull()).groupBy("cs").count()
              .agg(F.sum(pairs_within(F.col("count"))).alias("n")))
    cs_same = (keyed.where(F.col("cs").isNotNull()).groupBy("cs", "model_family").count()
               .agg(F.sum(pairs_within(F.col("count"))).alias("n")))
    none = big(F.lit(0))
    parts = (blocks.select(F.coalesce(F.col("n"), none).alias("n"))
             .unionByName(cs_all.select(F.coalesce(F.col("n"), none).alias("n")))
             .unionByName(cs_same.select((-F.coalesce(F.col("n"), none)).alias("n"))))
    return parts.agg(big(F.sum("n")).alias("candidate_pairs"))


def compatible_pair_count_by_level(listings: DataFrame) -> DataFrame:
    """Listing pairs per block compatible on the first k conflict fields, k = 0..10.

    Level 10 adds the strict-condition rule.  Computed by aggregation over
    ``(block, pattern)`` groups: for patterns P and Q, pairs compatible on
    fields F are pairs equal on the projection to F∩P∩Q, counted as
    products of group sizes (never enumerated).
    """
    nf = len(CONFLICT_FIELDS)
    keyed = (listings.withColumn("block", block_id()).where(F.col("block").isNotNull())
             .withColumn("pattern", null_pattern())
             .withColumn("strict_cond", strict_condition()))
    # Distinct conflict tuples with their listing counts (partial aggregation).
    tuples = keyed.groupBy("block", "pattern", "strict_cond", *CONFLICT_FIELDS).agg(
        F.count(F.lit(1)).alias("n"))
    levels = F.explode(F.sequence(F.lit(0), F.lit(nf + 1))).alias("level")
    exp = tuples.withColumn("other", F.explode(_patterns(tuples))).select("*", levels)
    proj = F.concat_ws(
        SEP,
        *[F.when((F.col("level") > i) & (F.col("pattern").bitwiseAND(F.col("other")).bitwiseAND(F.lit(1 << i)) != 0),
                 F.col(f)) for i, f in enumerate(CONFLICT_FIELDS)],
        F.when(F.col("level") > nf, F.col("strict_cond").cast("string")))
    grouped = (exp.withColumn("proj", proj)
               .groupBy("block", "level", "pattern", "other", "proj")
               .agg(F.sum("n").alias("s")))
    l, r = grouped.alias("l"), grouped.alias("r")
    joined = l.join(r, (F.col("l.block") == F.col("r.block")) & (F.col("l.level") == F.col("r.level"))
                    & (F.col("l.pattern") == F.col("r.other")) & (F.col("l.other") == F.col("r.pattern"))
                    & (F.col("l.proj") == F.col("r.proj")) & (F.col("l.pattern") <= F.col("r.pattern")))
    pairs = F.when(F.col("l.pattern") == F.col("r.pattern"), pairs_within(F.col("l.s"))) \
        .otherwise(pair_product(F.col("l.s"), F.col("r.s")))
    return (joined.groupBy(F.col("l.block").alias("block"), F.col("l.level").alias("level"))
            .agg(big(F.sum(pairs)).alias("compatible_pairs")))


def conflict_counts(listings: DataFrame) -> DataFrame:
    """Hard-conflict rejects per reason (C2 over all candidate pairs), exact, by aggregation.

    Output ``reason, pairs``; reasons with zero pairs are omitted.
    """
    nf = len(CONFLICT_FIELDS)
    lv = compatible_pair_count_by_level(listings)
    per_level = lv.groupBy("level").agg(F.sum("compatible_pairs").alias("c"))
    a, b = per_level.alias("a"), per_level.alias("b")
    reasons = F.create_map(*[x for i, f in enumerate(CONFLICT_FIELDS)
                             for x in (F.lit(i + 1), F.lit(f + "_mismatch"))],
                           F.lit(nf + 1), F.lit("condition_mismatch"))
    within = (a.join(b, F.col("b.level") == F.col("a.level") + 1)
              .select(F.element_at(reasons, F.col("b.level")).alias("reason"),
                      (F.col("a.c") - F.col("b.c")).alias("pairs")))
    keyed = listings.select(core_storage_key().alias("cs"), F.col("model_family"))
    cs_all = keyed.where(F.col("cs").isNotNull()).groupBy("cs").count() \
        .select(pairs_within(F.col("count")).alias("p"))
    cs_same = keyed.where(F.col("cs").isNotNull()).groupBy("cs", "model_family").count() \
        .select((-pairs_within(F.col("count"))).alias("p"))
    cross = cs_all.unionByName(cs_same).agg(F.sum("p").alias("pairs")) \
        .select(F.lit("model_family_mismatch").alias("reason"), F.coalesce(F.col("pairs"), big(F.lit(0))).alias("pairs"))
    return (within.unionByName(cross).groupBy("reason").agg(big(F.sum("pairs")).alias("pairs"))
            .where(F.col("pairs") > 0))


def variant_conflicts(listings: DataFrame) -> DataFrame:
    """Hard-conflict rejects whose reason names a variant, one row per pair of attribute tuples.

    Listings of one block with equal conflict fields are one tuple, named by its
    lowest listing.  Two tuples meet by an equi-join on the fields before the
    variant, as in :func:`compatible_title_pairs`, so no listing pair is emitted;
    ``n_pairs`` is the number of listing pairs that a row stands for.
    """
    keyed = (listings.withColumn("block", block_id()).where(F.col("block").isNotNull())
             .withColumn("pattern", null_pattern()))
    tuples = keyed.groupBy("block", "pattern", *CONFLICT_FIELDS).agg(
        F.min("listing_id").alias("id"), F.min_by("title", "listing_id").alias("title"), F.count(F.lit(1)).alias("n"))
    out = None
    for at, field in enumerate(CONFLICT_FIELDS):
        if "variant" not in field:
            continue
        here = (tuples.where(F.col(field).isNotNull()).withColumn("other", F.explode(_patterns(tuples)))
                .select("block", "pattern", "other", projection(F.col("pattern"), F.col("other"), upto=at).alias("proj"),
                        F.col(field).alias("value"), "id", "title", "n"))
        l, r = here.alias("l"), here.alias("r")
        met = l.join(r, (F.col("l.block") == F.col("r.block")) & (F.col("l.pattern") == F.col("r.other"))
                     & (F.col("l.other") == F.col("r.pattern")) & (F.col("l.proj") == F.col("r.proj"))
                     & (F.col("l.value") != F.col("r.value")) & (F.col("l.id") < F.col("r.id")))
        rows = met.select(F.col("l.id").alias("listing_id_1"), F.col("r.id").alias("listing_id_2"),
                          F.col("l.title").alias("title_1"), F.col("r.title").alias("title_2"),
                          F.lit(field + "_mismatch").alias("reason"), pair_product(F.col("l.n"), F.col("r.n")).alias("n_pairs"))
        out = rows if out is None else out.unionByName(rows)
    return out
