"""Helpers the training-data operators share: tables, staging, batched words.

Words follow one rule everywhere: lower-case ``A``-``Z``, then take runs of
bytes other than ``0x20`` and ``0x09``-``0x0D``.  :func:`batch_words` finds
them for a whole Arrow batch with numpy, as 64-bit hashes, so no Python
object is made per word.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from sameitem.session import checkpoint_dir, ship_package

#: Bytes of text that one numpy step holds; a longer text makes a step of its own.
STEP_BYTES = 1 << 20
#: The same where a step's borders change nothing: some 60 bytes of memory a byte of text are held meanwhile.
SMALL_STEP = 1 << 18
#: Bytes of rows that JVM and Python hand each other at a time while :func:`small_batches` holds.
BATCH_BYTES = "8m"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
# Everything but ASCII letters, digits and bytes above 0x7F parts words too.
_PUNCT = np.ones(256, dtype=bool)
_PUNCT[0x80:] = False
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    _PUNCT[_lo:_hi + 1] = False

_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[0x41:0x5B] = _VALUE[0x61:0x7B]
_R = 0x9E3779B97F4A7C15 | 1
_RINV = pow(_R, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepared(spark: SparkSession) -> SparkSession:
    """Ship the package to the executors (needed by every operator with Python tasks)."""
    ship_package(spark)
    return spark


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstage(spark: SparkSession, *tables: DataFrame | None) -> None:
    """Delete tables of :func:`stage` whose readers have all been written."""
    for df in tables:
        path = getattr(df, "_staged_path", None)
        if path:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside hand rows to Python by :data:`BATCH_BYTES`, however wide a row is; the session's own bound comes back after."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser (Steele, Lea and Flood, 2014) over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    key = str(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(n + n // 8, SMALL_STEP + 4096)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 8 * STEP_BYTES:
            _powers[key] = have
    return have


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return offsets.astype(np.int64) - int(offsets[0]), raw[int(offsets[0]):int(offsets[-1])]


@dataclass
class Words:
    """Words of the texts ``first`` to ``last`` (exclusive) of a batch."""

    first: int
    last: int
    text: np.ndarray    # index of the text, relative to first, of each word
    hash: np.ndarray    # uint64
    start: np.ndarray   # byte range in ``data``
    end: np.ndarray
    data: np.ndarray

    def bounds(self) -> np.ndarray:
        """Position of each text's first word, and the number of words at the end."""
        return np.searchsorted(self.text, np.arange(self.last - self.first + 1))


def batch_words(column: pa.Array, punctuation: bool = False, most: int = STEP_BYTES) -> Iterator[Words]:
    """Words of a batch of texts, in steps of about ``most`` bytes.

    ``punctuation=True`` parts words at everything but ASCII letters, digits
    and non-ASCII bytes.  Every text lies in one step, whatever its length.
    """
    offsets, data = utf8(column)
    n = len(offsets) - 1
    parts = _PUNCT if punctuation else _SPACE
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(n, max(first + 1, last))
        lo, hi = int(offsets[first]), int(offsets[last])
        yield _step(first, last, offsets[first:last + 1] - lo, data[lo:hi], parts)
        first = last


def _step(first: int, last: int, offsets: np.ndarray, data: np.ndarray, parts: np.ndarray) -> Words:
    size = len(data)
    none = np.zeros(0, dtype=np.int64)
    if not size:
        return Words(first, last, none, none.astype(np.uint64), none, none, data)
    word = ~parts[data]
    edge = np.zeros(size + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(size, dtype=bool)
    before[0] = True
    before[1:] = ~word[:-1]
    after = np.empty(size, dtype=bool)
    after[-1] = True
    after[:-1] = ~word[1:]
    start = np.flatnonzero(word & (before | edge[:-1]))
    end = np.flatnonzero(word & (after | edge[1:])) + 1
    total = np.empty(size + 1, dtype=np.uint64)
    total[0] = 0
    terms = _VALUE[data]
    terms *= _power(_R, size)[:size]
    np.cumsum(terms, out=total[1:])
    del terms
    value = mix64((total[end] - total[start]) * _power(_RINV, size)[start])
    text = np.searchsorted(offsets, start, side="right") - 1
    return Words(first, last, text, value, start, end, data)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; fewer words make one run of all of them."""
    n = len(words)
    if n == 0:
        return words
    k = min(n, size)
    out = np.zeros(n - k + 1, dtype=np.uint64)
    for i in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[i:n - k + 1 + i]
    return mix64(out + np.uint64(k if k < size else 0))


def batches(records: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of at most ``rows`` rows, to bound memory."""
    for batch in records:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch  # else it stays while the next one is read
    pa.default_memory_pool().release_unused()  # a worker outlives its task


def runs(records: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows with equal ``keys`` (integers, not null), also over batch borders."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in records:
        if not batch.num_rows:
            continue
        values = [batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys]
        differs = np.zeros(batch.num_rows - 1, dtype=bool)
        for v in values:
            differs |= v[1:] != v[:-1]
        edges = [0, *(np.flatnonzero(differs) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            key = tuple(int(v[lo]) for v in values)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)
