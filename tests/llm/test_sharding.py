import zlib

import numpy as np

from sameitem.llm.sharding import hilbert_index, hilbert_shards, quantise, shard_bounds, write_shards
from tests.llm.helpers import documents, frame


def test_curve_visits_every_cell_once_by_single_steps():
    for bits, dims in ((3, 2), (2, 3), (2, 4)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        at = hilbert_index(grid, bits)
        assert sorted(at.tolist()) == list(range(len(grid)))
        path = grid[np.argsort(at)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shards_are_gapless_and_at_most_one_apart(spark):
    rows = documents(61)
    out = hilbert_shards(spark, frame(spark, rows), 8).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == sorted((r[0] is None, r[0] or 0) for r in rows)
    counts = [sum(r.shard == s for r in out) for s in range(8)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    for s in range(8):
        own = sorted((r for r in out if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert [r.curve for r in own] == sorted(r.curve for r in own)
    ends = [(max(r.curve for r in out if r.shard == s), min(r.curve for r in out if r.shard == s + 1)) for s in range(7)]
    assert all(a <= b for a, b in ends)
    by_id = {r[0]: r for r in rows}
    for r in out:
        text = (by_id[r.doc_id][1] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text), "rows", None)


def test_empty_and_tiny_tables(spark):
    assert hilbert_shards(spark, frame(spark, [])).collect() == []
    assert [(r.shard, r.slot) for r in hilbert_shards(spark, frame(spark, documents(1, odd=False))).collect()] == [(0, 0)]


def test_written_shards_prune_by_every_dimension(spark, tmp_path):
    rows = [(i, "x" * (10 if i % 2 else 5000), "en" if i % 4 < 2 else "fr", "s0", 1) for i in range(64)]
    placed = hilbert_shards(spark, frame(spark, rows), 4)
    write_shards(placed, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 64
    bounds = shard_bounds(placed, ["size"]).collect()
    assert len(bounds) == 4 and sum(b.min_size == b.max_size for b in bounds) >= 3


def test_whole_result_against_a_plain_sort(spark):
    rows = [(i, t, lang, s and f"https://www.example.org/site/{s}", n) for i, t, lang, s, n in documents(90)]
    rank = [{v: k for k, v in enumerate(sorted({r[c] for r in rows} - {None}, key=lambda v: v.encode()))} for c in (3, 2)]
    facts = [(r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()), rank[0].get(r[3], -1), rank[1].get(r[2], -1))
             for r in rows]
    dims = ["d_source", "d_lang", "size"]
    df = spark.createDataFrame(facts, "doc_id long, size long, crc long, d_source long, d_lang long")
    cuts = quantise(df, dims)
    assert len(cuts[0]) > 2  # the sources stay apart
    points = np.stack([np.searchsorted(c, [f[i] for f in facts], side="left") for c, i in zip(cuts, (3, 4, 1))], -1)
    order = sorted(zip(hilbert_index(points, 5).tolist(), facts), key=lambda x: (x[0], x[1][0] is not None, x[1][0] or 0, x[1][2], x[1][1]))
    n, want, slots = len(order), [], {}
    for r, (curve, f) in enumerate(order):
        shard = r * 8 // n
        slots[shard] = slots.get(shard, -1) + 1
        want.append((f[0], f[1], f[2], shard, slots[shard], curve))
    got = [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot, r.curve) for r in hilbert_shards(spark, frame(spark, rows), 8).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
