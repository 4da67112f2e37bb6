"""The full dedup run (R6) as composed, lazy DataFrames.

``Run`` holds every intermediate as an attribute built on first use, so a
query that needs only the attributed listings never plans the pair join,
and a query that needs groups reuses the staged pair table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sameitem.functions.titles import ATTRIBUTES, with_attributes
from sameitem.operators import analysis, evaluation, groups, verdicts
from sameitem.operators.blocking import (block_keys, candidate_pair_count, class_members, class_pairs, compatible_title_pairs,
                                         conflict_counts, identity_edges, identity_links, open_title_pairs, title_classes,
                                         title_nodes, variant_conflicts)
from sameitem.operators.components import connected_components
from sameitem.operators.matching import nodes_with_vectors, same_title_edges, score_pairs
from sameitem.operators.quality import matchable, prepare_listings
from sameitem.session import configure, ship_package, stage
from sameitem.sources import fixture


class Run:
    """One dedup run over a listing DataFrame.

    ``verdict_source``: ``None`` (no verdict service: routed pairs are
    conservative rejects), ``"replay"`` (replies derived from the outbox,
    for tests) or a DataFrame with :data:`verdicts.VERDICT_SCHEMA`.

    ``listing``: ``"classes"`` scores only the title pairs that strong identity doesn't
    decide; the others are counted, and merged by one edge per title, so a block of
    equal attributes costs rows in proportion to its titles.  Decisions, counts,
    groups and evaluation are the same as with ``"all"``, which lists and scores
    every compatible title pair; only a group's ``confidence``, the least score of its
    merges, is then taken over the scored edges alone.

    ``min_non_null_fields``: present attributes that an all-attributes match needs
    (0, the reference's rule: null equals null).
    """

    def __init__(self, spark: SparkSession, raw: DataFrame, vectors: DataFrame | None = None,
                 labels: DataFrame | None = None, verdict_source=None, mode: str = "drop",
                 listing: str = "classes", min_non_null_fields: int = 0):
        if listing not in ("classes", "all"):
            raise ValueError(f"listing is 'classes' or 'all', not {listing!r}")
        self.spark = configure(spark)
        ship_package(spark)
        self.raw = raw
        self.vectors = vectors
        self.labels = labels
        self.verdict_source = verdict_source
        self.mode = mode
        self.listing = listing
        self.min_non_null_fields = min_non_null_fields

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str, verdict_source="replay", **kw) -> "Run":
        raw = fixture.fixture_listings(spark, sf_dir)
        return cls(spark, raw, vectors=fixture.listing_vectors(spark, sf_dir, raw),
                   labels=fixture.gold_pairs(spark, sf_dir), verdict_source=verdict_source, **kw)

    # -- listings -------------------------------------------------------
    @cached_property
    def prepared(self) -> DataFrame:
        return prepare_listings(self.raw, mode=self.mode)

    @cached_property
    def attributed(self) -> DataFrame:
        return with_attributes(self.prepared)

    @cached_property
    def extracted(self) -> DataFrame:
        # Materialised once: the regex extraction is the heaviest per-row step
        # and nodes, conflict counts, members, evaluation and the attribute table all read it.
        # Only the columns that they use are written, and each of them reads only its own.
        keep = ["listing_id", "row_seq", "title", "price", "source", "currency", "dq_missing_title", "dq_missing_price",
                "dq_nonpositive_price", "dq_suspicious_low_price", "normalized_title", "category", *ATTRIBUTES]
        return stage(self.attributed.select(*keep), "listings")

    @cached_property
    def listings(self) -> DataFrame:
        """The extracted listings that are matched."""
        return matchable(self.extracted).drop("dq_missing_title", "dq_missing_price", "dq_nonpositive_price")

    @cached_property
    def keyed(self) -> DataFrame:
        return block_keys(self.listings)

    # -- pairs ------------------------------------------------------------
    @cached_property
    def title_nodes(self) -> DataFrame:
        return stage(title_nodes(self.listings), "title-nodes")

    @cached_property
    def node_of(self) -> DataFrame:
        """``listing_id, node_id`` of every listing in a block."""
        return (self.listings.select("listing_id", "normalized_title")
                .join(self.title_nodes.select("normalized_title", "node_id"), "normalized_title")
                .select("listing_id", "node_id"))

    @cached_property
    def title_nodes_only(self) -> DataFrame:
        """Title nodes without vectors, for rules that don't use them."""
        return nodes_with_vectors(self.title_nodes)

    @cached_property
    def nodes(self) -> DataFrame:
        return nodes_with_vectors(self.title_nodes, self.vectors)

    @cached_property
    def classes(self) -> DataFrame:
        return stage(title_classes(self.title_nodes), "title-classes")

    @cached_property
    def members_of_classes(self) -> DataFrame:
        return stage(class_members(self.title_nodes, self.classes), "class-members")

    @cached_property
    def class_pairs(self) -> DataFrame:
        return stage(class_pairs(self.classes, self.min_non_null_fields), "class-pairs")

    @cached_property
    def links(self) -> DataFrame:
        """Strong matches, counted per pair of classes."""
        return identity_links(self.class_pairs, self.classes)

    @cached_property
    def identity_edges(self) -> DataFrame:
        return stage(identity_edges(self.class_pairs, self.members_of_classes), "identity-edges")

    @cached_property
    def pairs(self) -> DataFrame:
        """The title pairs that are scored."""
        found = (compatible_title_pairs(self.title_nodes) if self.listing == "all"
                 else open_title_pairs(self.class_pairs, self.members_of_classes))
        return stage(found, "title-pairs")

    @cached_property
    def scored(self) -> DataFrame:
        return stage(score_pairs(self.nodes, self.pairs, self.min_non_null_fields), "scored-pairs")

    @cached_property
    def scored_edges(self) -> DataFrame:
        """The edges that stand for the strong matches, scored: one per title and pair of classes."""
        return stage(score_pairs(self.nodes, self.identity_edges, self.min_non_null_fields), "scored-edges")

    @cached_property
    def requests(self) -> DataFrame:
        return verdicts.verdict_requests(self.scored)

    @cached_property
    def verdict_table(self) -> DataFrame | None:
        if self.verdict_source is None:
            return None
        if isinstance(self.verdict_source, str) and self.verdict_source == "replay":
            return fixture.replay_verdicts(self.requests)
        return self.verdict_source

    @cached_property
    def final_pairs(self) -> DataFrame:
        # The replay is keyed by nodes and has one reply a pair; a given table may name any listing.
        node_of = self.node_of if isinstance(self.verdict_source, DataFrame) else None
        return verdicts.finalize(self.scored, self.verdict_table, node_of)

    @cached_property
    def same_title(self) -> DataFrame:
        return same_title_edges(self.nodes)

    @cached_property
    def conflicts(self) -> DataFrame:
        return conflict_counts(self.listings)

    @cached_property
    def candidate_count(self) -> DataFrame:
        return candidate_pair_count(self.listings)

    @cached_property
    def weighted(self) -> DataFrame:
        return evaluation.weighted_decisions(self.final_pairs, self.same_title, self.conflicts,
                                             self.links if self.listing == "classes" else None)

    # -- groups -------------------------------------------------------------
    @cached_property
    def merge_edges(self) -> DataFrame:
        cols = ["listing_id_1", "listing_id_2", "final_score", "decision", "reason"]
        edges = (self.final_pairs.where(F.col("decision") == "merge").select(*cols)
                 .unionByName(self.same_title.select(*cols)))
        return edges if self.listing == "all" else edges.unionByName(self.scored_edges.select(*cols))

    @cached_property
    def components(self) -> DataFrame:
        ends = [F.col("listing_id_1").alias("src"), F.col("listing_id_2").alias("dst")]
        e = self.final_pairs.where(F.col("decision") == "merge").select(*ends)
        if self.listing == "classes":
            e = e.unionByName(self.identity_edges.toDF("src", "dst"))
        return stage(connected_components(e), "components")

    @cached_property
    def members(self) -> DataFrame:
        return stage(groups.listing_components(self.listings, self.title_nodes, self.components), "members")

    @cached_property
    def groups(self) -> DataFrame:
        meta = groups.match_metadata(self.merge_edges, self.components)
        return groups.number_groups(groups.product_groups(self.members, meta))

    @cached_property
    def group_members(self) -> DataFrame:
        return groups.group_members(self.members, self.groups)

    @cached_property
    def variant_conflicts(self) -> DataFrame:
        return variant_conflicts(self.listings)

    # -- evaluation / analysis ---------------------------------------------
    @cached_property
    def predictions(self) -> DataFrame:
        if self.labels is None:
            raise ValueError("no labels")
        pairs = self.final_pairs.select("listing_id_1", "listing_id_2", "decision", "reason", "final_score")
        if self.listing == "classes":
            # Scores of the labelled pairs that strong identity decides: as many as labels, not as pairs.
            strong = evaluation.labelled_strong_pairs(self.labels, self.listings, self.min_non_null_fields)
            scored = score_pairs(self.nodes, stage(strong, "labelled-strong"), self.min_non_null_fields)
            pairs = pairs.unionByName(scored.select(*pairs.columns))
        return evaluation.labelled_predictions(self.labels, self.listings, pairs, self.min_non_null_fields)

    @cached_property
    def metrics(self) -> DataFrame:
        return evaluation.confusion_metrics(self.predictions)

    def decision_counts(self) -> DataFrame:
        return evaluation.decision_counts(self.weighted)

    def usage(self) -> DataFrame:
        return analysis.verdict_usage(self.final_pairs, self.weighted)
