"""Operator 13: resampling documents towards a target distribution (DSIR, Xie et al., 2023).

Features are all runs of one to three consecutive words, counted by a hash bucket
over the corpus and over the target texts; a bucket's gain is the scaled log ratio
of its two shares, a document's weight the sum of its features' gains, its score
the weight plus Gumbel noise from its id.  The highest scores are drawn.

Weights are scored over arrays: words become CRC-32 values and lengths, and the
CRC of a run of words follows from theirs, so a batch needs no string per feature.
The draw finds its cutoff by bisection (:func:`cutoff`): each job counts the
persisted scores at or above a few thresholds exactly, until one score remains;
then the same over the ``doc_id`` of the rows tied at it, and over the row number of
rows tied in both.  Only the drawn rows are range-partitioned for their ranks.

Defined cases: a null or empty text has no features and a weight of 0; a null
``doc_id`` has the noise of ``42:`` alone and, in ties, comes after all others; rows
are documents, so repeated rows count and are drawn each; fewer than 20 eligible
documents draw none; an empty table gives no rows; other columns aren't read.

Scale: two passes over the documents.  Of the corpus the driver sees 10,000 counts
and a few counts a bisection step (at most :data:`WAYS` of them, some 40 steps for
all of a long's range three times); tasks get an array of 10,000 gains.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sameitem.llm.common import Words, batch_words, batches, prepared, stage, table
from sameitem.llm.sharding import ranked

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Parts that one counting job cuts the open interval into.
WAYS = 16
#: Words up to this many bytes are hashed column by column.
COLUMN_BYTES = 48

# -- CRC-32 over arrays ----------------------------------------------------------------

_BYTE = np.array([zlib.crc32(bytes([i])) for i in range(256)], dtype=np.uint32)
# The state after one more byte b is _STEP[(state ^ b) & 255] ^ (state >> 8).
_STEP = np.empty(256, dtype=np.uint32)
for _i in range(256):
    _c = _i
    for _ in range(8):
        _c = (_c >> 1) ^ (0xEDB88320 if _c & 1 else 0)
    _STEP[_i] = _c


def _zeros(tables: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Apply a linear map of 32 bits, given for each byte of its argument."""
    return tables[0][state & 255] ^ tables[1][(state >> 8) & 255] ^ tables[2][(state >> 16) & 255] ^ tables[3][state >> 24]


def _shift_tables() -> list[np.ndarray]:
    """Maps that pass ``2**k`` zero bytes, for every k below 32."""
    arg = [np.arange(256, dtype=np.uint32) << np.uint32(8 * i) for i in range(4)]
    one = np.stack([_STEP[a & 255] ^ (a >> 8) for a in arg])
    out = [one]
    for _ in range(31):
        out.append(np.stack([_zeros(out[-1], row) for row in out[-1]]))
    return out


_SHIFT = _shift_tables()


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What ``crc`` of a text contributes to the CRC of that text with ``length`` more bytes."""
    out = crc.copy()
    top = int(length.max()) if len(length) else 0
    for k in range(top.bit_length()):
        on = np.flatnonzero((length >> k) & 1)
        out[on] = _zeros(_SHIFT[k], out[on])
    return out


def word_crcs(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 and byte length of every word, ``A``-``Z`` as lower case."""
    data = words.data.copy()
    data[(data >= 0x41) & (data <= 0x5A)] += 32
    length = words.end - words.start
    crc = np.zeros(len(length), dtype=np.uint32)
    long_ = np.flatnonzero(length > COLUMN_BYTES)
    for i in long_:
        crc[i] = zlib.crc32(data[words.start[i]:words.end[i]])
    order = np.argsort(np.where(length > COLUMN_BYTES, 0, -length), kind="stable")
    order = order[:len(length) - len(long_)]
    state = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    start, size = words.start[order], length[order]
    live = len(order)
    for at in range(int(size[0]) if len(size) else 0):
        while live and size[live - 1] <= at:
            live = int(np.searchsorted(-size, -at, side="left"))
        state[:live] = _STEP[(state[:live] ^ data[start[:live] + at]) & 255] ^ (state[:live] >> 8)
    crc[order] = state ^ np.uint32(0xFFFFFFFF)
    return crc, length


def feature_buckets(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, 3 words: index of the text and bucket of every run."""
    crc, length = word_crcs(words)
    text, run = words.text, crc
    for size in range(1, LONGEST + 1):
        if size > 1:
            # The run so far, a space, and the next word of the same text.
            space = _BYTE[0x20] ^ shifted(run[:-1], np.ones(max(len(run) - 1, 0), dtype=np.int64))
            run = shifted(space, length[size - 1:]) ^ crc[size - 1:]
        same = text[size - 1:] == text[:len(text) - size + 1]
        yield text[size - 1:][same], (run[same] % np.uint32(BUCKETS)).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text"))


def _counted(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches(records):
        for words in batch_words(batch.column(0), punctuation=True):
            for _, bucket in feature_buckets(words):
                total += np.bincount(bucket, minlength=BUCKETS)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])


def bucket_counts(spark: SparkSession, docs: DataFrame) -> np.ndarray:
    """Features of all texts by bucket: one array a task, summed by Spark; 10,000 numbers reach the driver."""
    prepared(spark)
    rows = _texts(docs).mapInArrow(_counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Scaled log ratio of the target's and the corpus's share of each bucket, floored."""
    s_all, t_all = float(corpus.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def noise(doc_id: int | None) -> int:
    h = int(hashlib.sha256(f"{SEED}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(spark: SparkSession, docs: DataFrame, target: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, row`` of every row, written once; ``row`` numbers the rows."""
    gain = gains(bucket_counts(spark, docs), bucket_counts(spark, target))
    sent = spark.sparkContext.broadcast(gain)

    def weigh(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch in batches(records):
            n = batch.num_rows
            n_words, n_features, weight = (np.zeros(n, dtype=np.int64) for _ in range(3))
            for words in batch_words(batch.column(1), punctuation=True):
                own = slice(words.first, words.last)
                size = words.last - words.first
                n_words[own] += np.bincount(words.text, minlength=size)
                for text, bucket in feature_buckets(words):
                    n_features[own] += np.bincount(text, minlength=size)
                    ends = np.searchsorted(text, np.arange(size + 1))
                    total = np.concatenate([[0], np.cumsum(gain[bucket])])
                    weight[own] += total[ends[1:]] - total[ends[:-1]]
            drawn = np.array([noise(i) for i in batch.column(0).to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n_features), pa.array(weight), pa.array(weight + drawn)],
                ["doc_id", "n_words", "n_features", "weight", "score"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = own.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long, score long")
    out = stage(spark, rows.withColumn("row", F.monotonically_increasing_id()), "resampling-scores")
    sent.destroy()
    return out


# -- drawing -----------------------------------------------------------------------------

def cutoff(rows: DataFrame, value: Column, least: int) -> tuple[int, int] | None:
    """Greatest ``c`` that at least ``least`` rows reach (``value >= c``), and how many rows are above it.

    Numeric bisection: every job counts the rows at or above a few thresholds of the
    open interval, exactly.  None if the rows are too few.
    """
    low, high, n = rows.agg(F.min(value), F.max(value), F.count(value)).first()
    if least < 1 or n < least:
        return None
    above = 0  # rows of value > high
    while low < high:
        span = high - low
        cuts = sorted({low + 1 + (span - 1) * i // (WAYS - 1) for i in range(WAYS)})  # low + 1 to high
        counts = rows.agg(*[F.count_if(value >= F.lit(c)) for c in cuts]).first()
        reached = [c for c, k in zip(cuts, counts) if k >= least]
        missed = [(c, k) for c, k in zip(cuts, counts) if k < least]
        if reached:
            low = reached[-1]
        if missed:
            high, above = missed[0][0] - 1, missed[0][1]
    return low, above


def drawn(rows: DataFrame, share: int = PERCENT) -> tuple[Column | None, int]:
    """Condition that holds for the drawn rows of :func:`scored`, and their number."""
    eligible = F.col("n_words") >= LEAST_WORDS
    own = rows.where(eligible)
    wanted = share * own.count() // 100
    found = cutoff(own, F.col("score"), wanted)
    if found is None:
        return None, 0
    least, above = found
    drawn_ = F.col("score") > least
    tied, open_ = F.col("score") == least, wanted - above
    # Ties: the smaller doc_id first (null last), then the smaller row number.
    for value in (F.coalesce(F.bitwise_not("doc_id"), F.lit(-2 ** 63)), F.bitwise_not("row")):
        at, over = cutoff(own.where(tied), value, open_)
        drawn_ = drawn_ | (tied & (value > F.lit(at)))
        tied, open_ = tied & (value == F.lit(at)), open_ - over
    return eligible & (drawn_ | tied), wanted


def resampled(spark: SparkSession, docs: DataFrame, target: DataFrame, share: int = PERCENT) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row; rank 1, 2, ... for the drawn ones, else null."""
    rows = scored(spark, docs, target)
    chosen, _ = drawn(rows, share)
    shown = ["doc_id", "n_features", "weight", "score"]
    if chosen is None:
        return rows.select(*shown, F.lit(None).cast("long").alias("rank"))
    order = rows.where(chosen).withColumns({"_score": -F.col("score"), "_last": F.col("doc_id").isNull()})
    placed, _ = ranked(spark, order, ["_score", "_last", "doc_id", "row"], "resampling-order")
    return (placed.select(*shown, (F.col("rank") + 1).alias("rank"))
            .unionByName(rows.where(~chosen).select(*shown, F.lit(None).cast("long").alias("rank"))))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
