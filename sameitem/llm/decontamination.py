"""Operator 8: benchmark decontamination by greedy string tiling.

Tokens are runs of ASCII letters, digits and non-ASCII bytes, lower-cased
(A-Z), so punctuation and line breaks don't hide a passage.  A document and a
benchmark item are compared when they share a *seed*: ``min_match`` tokens in
a row (an item of fewer tokens is its own seed, so it must occur whole).
Running Karp-Rabin finds the seeds of all documents of a batch at once: a
hash of every window of ``min_match`` tokens, looked up among the item's.
Each seed grows along its diagonal to a maximal match; the longest match that
touches no marked token is marked as a tile, again and again (Wise, 1993), on
both sides.  A passage put together in another order gives several tiles, so
its coverage stays high.  ``coverage`` is the share of the item's tokens that
the tiles cover.

Defined cases: null and empty texts and items match nothing; items of equal
text are reported each; repeated documents are reported each; no ``min_match``
makes a one-token item match more than that token; empty tables give no rows;
only ``doc_id``/``item_id`` and ``text`` are read, so other columns can't clash.

Scale: documents are neither shuffled nor collected.  The items go to the
tasks in blocks of at most ``block_bytes``, one pass over the documents for
each block.  Of several blocks each one's result is written and its broadcast
destroyed before the next is read, so driver and tasks hold one block at a time.
A batch is a few hundred documents; one document and one item are the largest
unit of work, and a document's seeds are grouped by item, never paired with
other documents.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sameitem.llm.common import SMALL_STEP, batch_words, batches, mix64, prepared, stage, table

MIN_MATCH = 5
MIN_COVERAGE = 0.5
BLOCK_BYTES = 16 << 20
LEAKS = "doc_id long, item_id long, n_tiles long, tiled_tokens long, item_tokens long, coverage double"
HASH = "text_hash long"


def window_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Rolling (Karp-Rabin) hash of every ``size`` tokens in a row; none if there are fewer."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + tokens[i:n + i]
    return mix64(out)


def tiles(text: np.ndarray, item: np.ndarray, seeds: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(text start, item start, tokens)`` of the tiles.

    ``seeds`` are all ``(i, j)`` with ``text[i:i+least] == item[j:j+least]``.
    The longest match goes first; ties go to the least item, then text position.
    """
    heap, reached = [], {}
    for i, j in sorted(seeds):
        if reached.get(i - j, -1) >= i + least:
            continue
        n = least
        while i + n < len(text) and j + n < len(item) and text[i + n] == item[j + n]:
            n += 1
        reached[i - j] = i + n
        heap.append((-n, j, i))
    heapq.heapify(heap)
    in_text, in_item = set(), np.zeros(len(item), bool)
    out = []
    while heap:
        n, j, i = heapq.heappop(heap)
        n = -n
        free = [not in_item[j + k] and i + k not in in_text for k in range(n)]
        if all(free):
            out.append((i, j, n))
            in_item[j:j + n] = True
            in_text.update(range(i, i + n))
            continue
        k = 0
        while k < n:  # what is still free of it, if long enough
            if not free[k]:
                k += 1
                continue
            e = k
            while e < n and free[e]:
                e += 1
            if e - k >= least:
                heapq.heappush(heap, (k - e, j + k, i + k))
            k = e
    return sorted(out)


@dataclass
class Items:
    """A block of benchmark items as tokens and seeds."""

    ids: list[int]
    tokens: list[np.ndarray]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by length: sorted hash, item, position

    @classmethod
    def of(cls, ids: list[int], texts: pa.Array, least: int) -> Items:
        tokens: list[np.ndarray] = []
        for words in batch_words(texts, punctuation=True):
            at = words.bounds()
            tokens += [words.hash[at[i]:at[i + 1]] for i in range(words.last - words.first)]
        found: dict[int, list] = {}
        for k, t in enumerate(tokens):
            size = min(least, len(t))
            if size:
                h = window_hashes(t, size)
                found.setdefault(size, []).append((h, np.full(len(h), k), np.arange(len(h))))
        seeds = {}
        for size, parts in found.items():
            h, item, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((at, item, h))
            seeds[size] = (h[order], item[order], at[order])
        return cls(ids, tokens, seeds)

    def seeds_in(self, tokens: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each seed length: windows of ``tokens`` that are seeds, as (position, item, item position)."""
        for size, (h, item, at) in self.seeds.items():
            window = window_hashes(tokens, size)
            lo = np.searchsorted(h, window, side="left")
            hit = np.flatnonzero((lo < len(h)) & (h[np.minimum(lo, len(h) - 1)] == window)) if len(h) else lo[:0]
            if not len(hit):
                continue
            lo = lo[hit]
            many = np.searchsorted(h, window[hit], side="right") - lo
            pick = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            yield size, np.repeat(hit, many), item[pick], at[pick]


def _tiled(items: Items, doc_id: int | None, tokens: np.ndarray,
           hits: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], least: float) -> Iterator[tuple]:
    for size, at, item, start in hits:
        order = np.argsort(item, kind="stable")
        at, item, start = at[order], item[order], start[order]
        cut = np.flatnonzero(np.diff(item)) + 1
        for a, i, j in zip(np.split(item, cut), np.split(at, cut), np.split(start, cut), strict=True):
            target = items.tokens[int(a[0])]
            # No tile reaches beyond the item positions that windows cover.
            covered = np.zeros(len(target) + 1, np.int64)
            np.add.at(covered, j, 1)
            np.add.at(covered, j + size, -1)
            if np.count_nonzero(np.cumsum(covered)[:-1]) < least * len(target):
                continue
            found = tiles(tokens, target, list(zip(i.tolist(), j.tolist(), strict=True)), size)
            n = sum(t[2] for t in found)
            if n >= least * len(target):
                yield doc_id, items.ids[int(a[0])], len(found), n, len(target), n / len(target)


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
          min_coverage: float = MIN_COVERAGE, block_bytes: int = BLOCK_BYTES, text_hash: bool = False) -> DataFrame:
    """Pairs of document and benchmark item whose tiles cover at least ``min_coverage`` of the item.

    With ``text_hash`` also the text's ``xxhash64``, which tells rows of one ``doc_id`` apart.
    """
    prepared(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * size // block_bytes))
    if blocks > 1:
        items = stage(spark, items.withColumn(
            "block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))).repartition("block"), "benchmark-blocks")
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), F.xxhash64("text").alias("text_hash"))
    out = None
    for b in range(blocks):
        part = items.where(F.col("block") == b).drop("block") if blocks > 1 else items
        rows = part.orderBy("item_id", "text").toArrow()  # one block: about block_bytes / 2 of text
        shared = spark.sparkContext.broadcast(Items.of(
            rows.column("item_id").to_pylist(), rows.column("text").combine_chunks(), min_match))
        del rows

        def run(records: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block, schema = shared.value, pa.schema([
                ("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_tiles", pa.int64()), ("tiled_tokens", pa.int64()),
                ("item_tokens", pa.int64()), ("coverage", pa.float64()), ("text_hash", pa.int64())])
            for batch in batches(records):
                found: list[tuple] = []
                ids, marks = batch.column(0), batch.column(2)
                for words in batch_words(batch.column(1), punctuation=True, most=SMALL_STEP):
                    bounds, by_doc = words.bounds(), {}
                    for seed, at, item, start in block.seeds_in(words.hash):
                        doc = words.text[at]
                        whole = at + seed <= bounds[doc + 1]  # a window across two texts is none
                        at, item, start, doc = at[whole], item[whole], start[whole], doc[whole]
                        cut = np.flatnonzero(np.diff(doc)) + 1
                        for d, a, i, j in zip(*(np.split(x, cut) for x in (doc, at, item, start)), strict=True):
                            if len(d):
                                by_doc.setdefault(int(d[0]), []).append((seed, a - bounds[d[0]], i, j))
                    for d, hits in sorted(by_doc.items()):
                        tokens = words.hash[bounds[d]:bounds[d + 1]]
                        mark = marks[words.first + d].as_py()
                        found += [(*t, mark) for t in _tiled(block, ids[words.first + d].as_py(), tokens, hits, min_coverage)]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*found, strict=True), schema.types, strict=True)], schema=schema)

        here = picked.mapInArrow(run, f"{LEAKS}, {HASH}")
        if blocks > 1:  # one block at a time is held by driver and tasks
            here = stage(spark, here, "benchmark-leaks")
            shared.destroy()
        out = here if out is None else out.unionByName(here)
    return out if text_hash else out.drop("text_hash")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
