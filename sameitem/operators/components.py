"""Connected components of merge edges.

Spark has no DataFrame connected-components primitive, so this is the
alternating large-star / small-star algorithm (Kiveris et al., "Connected
Components in MapReduce and Beyond", SoCC 2014): every round is one
``groupBy(min)`` + ``join`` per star step, rounds are O(log^2 n), and the
edge set shrinks to a star around each component's minimum id.  Whether a
round changed anything is read from a checksum, not from a set difference.

Each round's edge set is written with ``checkpoint()`` (reliable, into the
session's ``spark.checkpoint.dir``) so lineage stays short and a lost
executor recomputes one round, not the whole loop.  The only driver work is
a one-row change count per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sameitem.session import checkpoint_dir


def _canonical(edges: DataFrame) -> DataFrame:
    return (edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
            .where(F.col("src") != F.col("dst")).distinct())


def _least_smaller(e: DataFrame) -> DataFrame:
    """Least smaller neighbour of every node that has one.

    Checkpointed, so that the joins below have plain exchanges on both sides
    and adaptive execution can split a hub's rows.
    """
    return e.groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("least")).checkpoint()


def _large_star(e: DataFrame) -> DataFrame:
    """Connect every larger neighbour of u to the minimum of u's closed neighbourhood.

    u is the smaller end of the edge; only a u with a still smaller neighbour
    changes anything, so a hub that is its component's minimum joins no row.
    """
    m = _least_smaller(e)
    return _canonical(e.join(m, e["src"] == m["node"], "left")
                      .select(F.col("dst").alias("src"), F.coalesce("least", "src").alias("dst"))
                      .unionByName(m.select(F.col("node").alias("src"), F.col("least").alias("dst"))))


def _small_star(e: DataFrame) -> DataFrame:
    """Connect u and its smaller neighbours to the minimum of those neighbours."""
    m = _least_smaller(e)
    return _canonical(e.join(m, e["dst"] == m["node"]).select("src", F.col("least").alias("dst"))
                      .unionByName(m.select(F.col("node").alias("src"), F.col("least").alias("dst"))))


def _state(e: DataFrame) -> tuple:
    """Count and order-free checksum of an edge set."""
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Component label (minimum node id) per node that has an edge.

    ``edges``: ``src, dst`` (long).  Output ``node, component``; nodes
    without edges are their own component and are not listed.
    Raises after ``max_rounds`` without convergence (never silently stops).
    """
    spark = edges.sparkSession
    checkpoint_dir(spark)
    e = _canonical(edges.select(F.col("src").cast("long"), F.col("dst").cast("long"))).checkpoint()
    state = _state(e)
    for _ in range(max_rounds):
        e = _small_star(_large_star(e).checkpoint()).checkpoint()
        before, state = state, _state(e)
        if state == before:
            break
    else:
        raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")
    # Converged: a star per component, centre = minimum id.
    return (e.select(F.col("dst").alias("node"), F.col("src").alias("component"))
            .unionByName(e.select(F.col("src").alias("node"), F.col("src").alias("component")))
            .groupBy("node").agg(F.min("component").alias("component")))
