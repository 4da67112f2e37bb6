"""Operator 11: dropping repeated lines by probing a sharded minimal perfect hash.

A line's key is the line without white space at both ends, ``A``-``Z`` in lower
case.  Keys of at least :data:`LEAST_CHARS` code points are known by a 128-bit
hash.  :func:`line_index` turns all distinct hashes of a corpus into shards by the
hash's leading bits; a shard is one row: a minimal perfect hash (bit arrays by
level, after Limasset et al., SEA 2017) that gives each of its hashes a slot, and
by slot a 64-bit fingerprint, the number of documents and the largest ``doc_id``.
:func:`drop_lines` probes these arrays with the hashes of a chunk of documents and
drops the lines whose key is in at least ``least`` documents of the index, except
in the largest ``doc_id``.  The index is a table of its own, so later documents
can be probed against it too; a hash that it doesn't hold fails the fingerprint
and drops nothing.

Defined cases: a null or empty text is one empty line; rows are documents, so
repeated rows count each; a null ``doc_id`` is the smallest; all rows of the largest
``doc_id`` keep their lines; a text that loses all its lines becomes empty; an
empty table gives no rows and an empty index; other columns aren't read.

Scale: lines never leave their task, only 16-byte hashes do.  Documents are dealt
to chunks by a hash of id and text, hashes are made distinct by chunk before they
go to their shard, so a line that a third of all documents hold reaches its shard
once a chunk; within a shard, as within a chunk, rows stream behind the arrays
that they are held against.  No step holds more than one shard's arrays or one
chunk's repeated keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sameitem.llm.common import mix64, prepared, runs, stage, table

LEAST_CHARS = 20
LEAST_DOCS = 3
#: Mean number of hashes of a shard at most, and mean number of documents of a chunk.
SHARD_KEYS = 1024
CHUNK_DOCS = 512
#: Cells a hash of each level of the perfect hash; more cells mean fewer levels.
GAMMA = 2

SPACE = b" \t\n\x0b\x0c\r"
SEEN = "chunk long, h long, f long, docs long, last long"
INDEX = "shard long, sizes binary, bits binary, prints binary, counts binary, last binary, unnamed binary"
REPEATED = "chunk long, h long, f long, last long"
KEPT = "doc_id long, text string, n_lines long, n_dropped long"


def line_hash(line: bytes) -> bytes | None:
    """16-byte hash of a line's key, or None if the key is too short to count."""
    key = line.strip(SPACE).lower()
    if len(key) < LEAST_CHARS or (not key.isascii() and len(key.decode("utf-8", "replace")) < LEAST_CHARS):
        return None
    return xxhash.xxh3_128_digest(key)


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype=">i8").reshape(-1, 2).astype(np.int64)


def _digests(h: pa.Array, f: pa.Array) -> list[bytes]:
    raw = np.stack([h.to_numpy(), f.to_numpy()], axis=1).astype(">i8").tobytes()
    return [raw[i:i + 16] for i in range(0, len(raw), 16)]


def _bytes_of(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


# -- the perfect hash -----------------------------------------------------------

def _cell(h: np.ndarray, f: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = mix64(np.array([level + 1], dtype=np.uint64))[0]
    return (mix64(h ^ mix64(f + salt)) % np.uint64(size)).astype(np.int64)


def perfect_hash(h: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(level sizes, bits, slot of each key)`` of distinct keys ``(h, f)``, both uint64.

    Each level gives a bit to every key that has a cell for itself; the others go
    on to the next.  A key's slot is the number of bits before its own.
    """
    sizes, bits, placed = [], [], np.full(len(h), -1, dtype=np.int64)
    left, before = np.arange(len(h)), 0
    while len(left):
        size = max(8, GAMMA * len(left) + 7 & ~7)
        cell = _cell(h[left], f[left], len(sizes), size)
        alone = np.bincount(cell, minlength=size) == 1
        own = alone[cell]
        placed[left[own]] = before + cell[own]
        left, before = left[~own], before + size
        sizes.append(size)
        bits.append(alone)
        if len(sizes) > 200:
            raise ValueError("keys aren't distinct")
    bits = np.concatenate(bits) if bits else np.zeros(0, dtype=bool)
    return np.array(sizes, dtype=np.int32), bits, np.cumsum(bits)[placed] - 1 if len(h) else placed


def slots(sizes: np.ndarray, bits: np.ndarray, h: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Slot of each key, -1 for a key that fell through every level."""
    out, left, before = np.full(len(h), -1, dtype=np.int64), np.arange(len(h)), 0
    rank = np.cumsum(bits)
    for level, size in enumerate(sizes.tolist()):
        if not len(left):
            break
        cell = before + _cell(h[left], f[left], level, size)
        own = bits[cell]
        out[left[own]] = rank[cell[own]] - 1
        left, before = left[~own], before + size
    return out


# -- index -------------------------------------------------------------------------

def _chunked(docs: DataFrame) -> DataFrame:
    """``doc_id, text, chunk``; the chunk depends on id and text alone, so each reading deals alike."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = max(1, own.count() // CHUNK_DOCS)
    return own.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))


def _held(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in records:
        found: dict[tuple[int, bytes], list] = {}
        for doc_id, text, chunk in zip(batch.column(0).to_pylist(), _bytes_of(batch.column(1)), batch.column(2).to_pylist()):
            for digest in {line_hash(x) for x in (text or b"").split(b"\n")}:
                if digest is None:
                    continue
                have = found.get((chunk, digest))
                if have is None:
                    found[chunk, digest] = [1, doc_id]
                else:
                    have[0] += 1
                    if have[1] is None or (doc_id is not None and doc_id > have[1]):
                        have[1] = doc_id
        if found:
            halves = _halves([d for _, d in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in found], pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                 pa.array([n for n, _ in found.values()], pa.int64()), pa.array([x for _, x in found.values()], pa.int64())],
                ["chunk", "h", "f", "docs", "last"])


def held_keys(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Distinct line hashes by chunk, with the number of documents and the largest ``doc_id``."""
    prepared(spark)
    seen = _chunked(docs).mapInArrow(_held, SEEN)
    return stage(spark, seen.groupBy("chunk", "h", "f").agg(F.sum("docs").alias("docs"), F.max("last").alias("last")), "line-keys")


def _shard(bits: int) -> Column:
    return F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")


def _built(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for own in runs(records, ["shard"]):
        h, f = (own[c].to_numpy().view(np.uint64) for c in ("h", "f"))
        sizes, bits, at = perfect_hash(h, f)
        prints, counts, last = np.empty(len(h), np.uint64), np.empty(len(h), np.uint32), np.empty(len(h), np.int64)
        prints[at] = f
        counts[at] = np.minimum(own["docs"].to_numpy(), 2 ** 32 - 1)
        unnamed = np.zeros(len(h), dtype=bool)
        unnamed[at] = own["last"].combine_chunks().is_null().to_numpy(zero_copy_only=False)
        last[at] = own["last"].combine_chunks().fill_null(0).to_numpy()
        yield pa.RecordBatch.from_arrays(
            [own["shard"].combine_chunks()[:1], *[pa.array([x.tobytes()], pa.binary()) for x in
             (sizes, np.packbits(bits), prints, counts, last, np.packbits(unnamed))]],
            ["shard", "sizes", "bits", "prints", "counts", "last", "unnamed"])


class LineIndex:
    """Shard rows (:data:`INDEX`) and the number of leading hash bits that name a shard."""

    def __init__(self, rows: DataFrame, bits: int):
        self.rows, self.bits = rows, bits


def line_index(spark: SparkSession, seen: DataFrame) -> LineIndex:
    """The index of all distinct hashes of :func:`held_keys`."""
    bits = max(0, (seen.count() // SHARD_KEYS).bit_length())
    keys = (seen.select(_shard(bits).alias("shard"), "h", "f", "docs", "last").repartition("shard")
            .groupBy("shard", "h", "f").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))
            .sortWithinPartitions("shard"))
    return LineIndex(stage(spark, keys.mapInArrow(_built, INDEX), "line-index"), bits)


# -- probing -------------------------------------------------------------------------

def _probed(least: int):
    def probe(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in runs(records, ["shard"]):
            first = own["sizes"][0].as_py()
            if first is None or own.num_rows == 1:  # hashes without a shard, or a shard without hashes
                continue
            sizes, prints, counts, last = (np.frombuffer(own[c][0].as_py(), t) for c, t in
                                           (("sizes", np.int32), ("prints", np.uint64), ("counts", np.uint32), ("held", np.int64)))
            bits = np.unpackbits(np.frombuffer(own["bits"][0].as_py(), np.uint8)).astype(bool)
            unnamed = np.unpackbits(np.frombuffer(own["unnamed"][0].as_py(), np.uint8), count=len(prints)).astype(bool)
            asked = own.slice(1).select(["chunk", "h", "f"]).combine_chunks()
            h, f = (asked[c].to_numpy().view(np.uint64) for c in ("h", "f"))
            at = slots(sizes, bits, h, f)
            hit = np.flatnonzero(at >= 0)
            hit = hit[(prints[at[hit]] == f[hit]) & (counts[at[hit]] >= least)]
            if len(hit):
                out = asked.take(pa.array(hit)).append_column("last", pa.array(last[at[hit]], mask=unnamed[at[hit]]))
                yield from out.combine_chunks().to_batches()

    return probe


def repeated_keys(spark: SparkSession, seen: DataFrame, index: LineIndex, least: int = LEAST_DOCS) -> DataFrame:
    """Hashes by chunk that at least ``least`` documents of the index hold, with the largest ``doc_id``."""
    none = {c: F.lit(None).cast("binary") for c in ("sizes", "bits", "prints", "counts", "held", "unnamed")}
    arrays = index.rows.withColumnRenamed("last", "held").withColumns({c: F.lit(None).cast("long") for c in ("chunk", "h", "f")})
    asked = seen.select(_shard(index.bits).alias("shard"), "chunk", "h", "f").withColumns(none)
    both = arrays.withColumn("kind", F.lit(0)).unionByName(asked.withColumn("kind", F.lit(1)))
    # Each shard's arrays come before the hashes that probe them.
    both = both.repartition("shard").sortWithinPartitions("shard", "kind")
    return stage(spark, both.mapInArrow(_probed(least), REPEATED), "line-repeats")


def _dropped(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, repeated = None, {}
    for batch in records:
        column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
        chunks, kinds = column["chunk"].to_numpy(), column["kind"].to_numpy()
        ids, texts, lasts = column["doc_id"].to_pylist(), _bytes_of(column["text"]), column["last"].to_pylist()
        digests = _digests(column["h"].fill_null(0), column["f"].fill_null(0))
        out: list[tuple] = []
        for i in range(batch.num_rows):
            if chunks[i] != now:
                now, repeated = chunks[i], {}
            if kinds[i] == 0:
                repeated[digests[i]] = lasts[i]
                continue
            lines = (texts[i] or b"").split(b"\n")
            kept = lines
            if repeated:
                kept = []
                for line in lines:
                    digest = line_hash(line)
                    if digest is None or digest not in repeated or repeated[digest] == ids[i]:
                        kept.append(line)
            out.append((ids[i], b"\n".join(kept), len(lines), len(lines) - len(kept)))
        if out:
            ids_, texts_, lines_, dropped_ = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids_, pa.int64()), pa.array(texts_, pa.binary()).cast(pa.string()), pa.array(lines_, pa.int64()),
                 pa.array(dropped_, pa.int64())], ["doc_id", "text", "n_lines", "n_dropped"])


def drop_lines(spark: SparkSession, docs: DataFrame, index: LineIndex | None = None, least: int = LEAST_DOCS) -> DataFrame:
    """Documents without their repeated lines: ``doc_id, text, n_lines, n_dropped``.

    Without ``index``, the documents' own index is built.
    """
    seen = held_keys(spark, docs)
    index = line_index(spark, seen) if index is None else index
    repeats = repeated_keys(spark, seen, index, least)
    no = lambda c, t: F.lit(None).cast(t).alias(c)
    rows = _chunked(docs).select("chunk", F.lit(1).alias("kind"), "doc_id", "text", no("h", "long"), no("f", "long"), no("last", "long"))
    keys = repeats.select("chunk", F.lit(0).alias("kind"), no("doc_id", "long"), no("text", "string"), "h", "f", "last")
    # Each chunk's repeated keys come before its documents.
    return keys.unionByName(rows).repartition("chunk").sortWithinPartitions("chunk", "kind").mapInArrow(_dropped, KEPT)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_lines(spark, table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def oracle() -> str:
    """DuckDB SQL of :func:`op11_line_dedup`."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    space = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))
    return f"""
with d as (select row_number() over () as rid, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
l as (select rid, doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos from d),
k as (select *, translate(trim(line, {space}), '{upper}', '{lower}') as key from l),
c as (select key, count(distinct rid) as docs, max(doc_id) as last from k where length(key) >= {LEAST_CHARS} group by key),
m as (select k.*, coalesce(c.docs >= {LEAST_DOCS} and k.doc_id is distinct from c.last, false) as gone from k left join c using (key))
select doc_id, count(*)::BIGINT as n_lines, count(*) filter (where gone)::BIGINT as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from m group by rid, doc_id"""
