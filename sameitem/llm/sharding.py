"""Operator 5: sharding along a Hilbert curve over several metadata columns.

Each dimension is quantised to ``2**bits`` buckets by quantile cut points
(:func:`quantise`), the buckets are one point of a grid, and rows are sorted
by the point's index on the Hilbert curve.  Cutting that order into runs
gives shards whose rows lie close in *every* dimension, so a filter on any
of them prunes files (:func:`write_shards`, :func:`shard_bounds`).

Law ``rows``: shard ``s`` of ``k`` holds the ranks ``r`` with
``floor(r * k / n) = s``, so shard counts are at most one apart.

A text dimension is the rank of its whole value among the distinct ones, in UTF-8
order, so that values with a long common start stay apart.

Defined cases: a null dimension counts as the lowest value; equal curve
positions are ordered by ``doc_id`` (null first), then text checksum; repeated
rows keep a slot each; an empty table gives no rows; columns other than the
dimensions, ``doc_id`` and ``text`` are never read, so their names can't clash.

Scale: no window without partitions.  The order comes from a range partition
that includes ``doc_id``, so a source with a third of all rows is split; the
only driver-side data are the cut points (``2**bits - 1`` per dimension) and
one count per partition.  Ranks of distinct values are a table, broadcast by Spark if
its file is small and joined by a shuffle that adaptive execution can split if not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sameitem.llm.common import prepared, stage, table

BITS = 5
LAW = "rows"
#: Rows of one range partition.
PARTITION_ROWS = 1_000_000


def quantise(df: DataFrame, dims: list[str], bits: int = BITS) -> list[list[float]]:
    """Cut points of each numeric column: the distinct quantiles, at most ``2**bits - 1``."""
    cells = 1 << bits
    at = [i / cells for i in range(1, cells)]
    row = df.agg(*[F.percentile_approx(d, at, 10_000).alias(f"c{i}") for i, d in enumerate(dims)]).first()
    return [sorted(set(row[i] or [])) for i in range(len(dims))]


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of ``points`` (n x dimensions, below ``2**bits``).

    Skilling's transform (AIP Conf. Proc. 707, 2004), all rows at a time.
    """
    x = [points[:, i].astype(np.uint64) for i in range(points.shape[1])]
    n, one = len(x), np.uint64(1)
    bit = np.uint64(1 << (bits - 1))
    while bit > one:
        low = bit - one
        for i in range(n):
            on = (x[i] & bit) != 0
            swap = (x[0] ^ x[i]) & low
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = np.where(on, x[i], x[i] ^ swap)
        bit >>= one
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    fold = np.zeros_like(x[0])
    bit = np.uint64(1 << (bits - 1))
    while bit > one:
        fold = np.where((x[n - 1] & bit) != 0, fold ^ (bit - one), fold)
        bit >>= one
    x = [v ^ fold for v in x]
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = (out << one) | ((v >> np.uint64(b)) & one)
    return out.astype(np.int64)


def with_curve(df: DataFrame, dims: list[str], cuts: list[list[float]], bits: int = BITS) -> DataFrame:
    """Add ``curve``: the Hilbert index of the dimensions' buckets."""
    steps = [np.asarray(c, dtype=np.float64) for c in cuts]
    types = T.StructType([*df.schema.fields, T.StructField("curve", T.LongType())])

    def index(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in records:
            points = np.empty((batch.num_rows, len(dims)), dtype=np.uint64)
            for i, d in enumerate(dims):
                value = batch.column(batch.schema.get_field_index(d)).to_numpy(zero_copy_only=False).astype(np.float64)
                points[:, i] = np.searchsorted(steps[i], value, side="left")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(hilbert_index(points, bits))], [*batch.schema.names, "curve"])

    return df.mapInArrow(index, types)


def ranked(spark: SparkSession, df: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """Add ``rank`` 0..n-1 in ``order`` (null first), and return n.  No step needs all rows in one task."""
    rows = df.count()
    parts = max(1, -(-rows // PARTITION_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")) if rows > 10_000 else 1)
    placed = stage(spark, (df.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in order])
                           .withColumn("_part", F.spark_partition_id())), name)
    counts = sorted((r["_part"], r["count"]) for r in placed.groupBy("_part").count().collect())  # one row a partition
    base, total = [], 0
    for part, count in counts:
        base.append((part, total))
        total += count
    offsets = spark.createDataFrame(base, "_part int, _base long")
    within = Window.partitionBy("_part").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    out = (placed.withColumn("_in", F.row_number().over(within))
           .join(F.broadcast(offsets), "_part")
           .withColumn("rank", F.col("_base") + F.col("_in") - 1)
           .drop("_part", "_in", "_base"))
    return out, total


def with_text_rank(spark: SparkSession, df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with ``column`` replaced by its value's rank among the distinct ones (null: -1)."""
    values, _ = ranked(spark, df.where(F.col(column).isNotNull()).select(column).distinct(), [column], f"{name}-values")
    values = stage(spark, values.withColumnRenamed("rank", "_rank"), f"{name}-ranks")
    return (df.join(values, column, "left")
            .withColumn(column, F.coalesce("_rank", F.lit(-1)).cast("long")).drop("_rank"))


def hilbert_shards(spark: SparkSession, docs: DataFrame, shards: int = 8, bits: int = BITS) -> DataFrame:
    """Put documents into ``shards`` runs of the Hilbert order of (source, lang, size).

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard, curve``.
    """
    prepared(spark)
    facts = stage(spark, docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")).alias("text_crc32"),
        F.col("source").cast("string").alias("d_source"),
        F.col("lang").cast("string").alias("d_lang"),
    ), "shard-facts")
    for column in ("d_source", "d_lang"):
        facts = with_text_rank(spark, facts, column, f"shard-{column[2:]}")
    facts = facts.select("doc_id", "size", "text_crc32", "d_source", "d_lang")
    dims = ["d_source", "d_lang", "size"]
    curve = with_curve(facts, dims, quantise(facts, dims, bits), bits)
    placed, total = ranked(spark, curve.select("curve", "doc_id", "text_crc32", "size"),
                           ["curve", "doc_id", "text_crc32", "size"], "shard-order")
    total = max(total, 1)
    shard = F.expr(f"cast((rank * {shards}L) div {total}L as int)")
    return placed.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("rank") - F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "curve")


def write_shards(placed: DataFrame, path: str) -> None:
    """Write one folder per shard, each sorted along the curve."""
    (placed.repartition("shard").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def shard_bounds(placed: DataFrame, dims: list[str]) -> DataFrame:
    """Least and greatest value of each dimension per shard: what a reader prunes files by."""
    return placed.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[f(d).alias(f"{n}_{d}") for d in dims for n, f in (("min", F.min), ("max", F.max))])


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(spark, table(spark, sf_dir, "documents"))
