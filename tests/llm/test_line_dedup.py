import random
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from sameitem.llm import line_dedup as L
from tests.llm.helpers import documents, frame, odd_rows, sentence, write

SPACE = " \t\n\x0b\x0c\r"
A_Z = {c: c + 32 for c in range(65, 91)}


def key(line):
    return line.strip(SPACE).translate(A_Z)


def brute(rows, least=3):
    held, last = Counter(), {}
    for i, t, *_ in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            held[k] += 1
            last[k] = max((last.get(k, (False, 0)), (i is not None, i or 0)))
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 20 and held[key(x)] >= least and last[key(x)] != (i is not None, i or 0))]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(5)
    common = [sentence(rng, 8) for _ in range(30)] + ["twenty code points!!", "nineteen characters", "ééééééééééééééééééé",
                                                      "éééééééééééééééééééé", "É" * 20, " " + "x" * 20, "x" * 20]
    rows = []
    for i in range(120):
        lines = [rng.choice(["", " ", "\t"]) + rng.choice([str.upper, str])(rng.choice(common)) + rng.choice(["", "\r", " \x0c"])
                 if rng.random() < 0.6 else sentence(rng, 6) for _ in range(rng.choice([1, 2, 5, 30]))]
        rows.append((i % 100, "\n".join(lines), "en", "s", 1))  # some ids repeat
    hot = "the very same line that a third of all documents hold"
    rows += [(1000 + i, f"{hot}\n{sentence(rng, 5)}\n{hot} ", "en", "s", 1) for i in range(60)]
    rows += [(None, f"{hot}\nno id of its own but a long line", "en", "s", 1)] * 4 + [(7, "\n\n", "en", "s", 1)]
    return rows + odd_rows()


def got(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=repr)


def test_against_brute_force(spark, monkeypatch):
    rows = corpus()
    assert got(L.drop_lines(spark, frame(spark, rows))) == brute(rows)
    monkeypatch.setattr(L, "CHUNK_DOCS", 16)
    monkeypatch.setattr(L, "SHARD_KEYS", 32)
    assert got(L.drop_lines(spark, frame(spark, rows).repartition(7), least=2)) == brute(rows, 2)


def test_query_equals_its_sql(spark, tmp_path):
    path = write(spark, tmp_path, corpus())
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{path}/documents.parquet/*.parquet')")
    want = sorted(con.execute(L.oracle()).fetchall(), key=repr)
    have = L.op11_line_dedup(spark, path)
    assert have.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert sorted((tuple(r) for r in have.collect()), key=repr) == want


def test_perfect_hash_is_minimal_and_strangers_fail():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 9, 1000, 5000):
        h, f = rng.integers(0, 1 << 63, n, dtype=np.uint64), rng.integers(0, 1 << 63, n, dtype=np.uint64)
        if n > 2:
            h[1] = h[0]  # equal in one half alone
        sizes, bits, at = L.perfect_hash(h, f)
        assert sorted(at.tolist()) == list(range(n))
        assert (L.slots(sizes, bits, h, f) == at).all()
        other = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
        strange = L.slots(sizes, bits, other, other)
        assert ((strange >= -1) & (strange < max(n, 1))).all()
        prints = np.zeros(max(n, 1), np.uint64)
        prints[at] = f
        assert not (prints[strange[strange >= 0]] == other[strange >= 0]).any()


def test_an_index_serves_later_documents(spark):
    old = [(i, "a line that three documents of the old corpus hold\nown line number %d of the old" % i, "en", "s", 1) for i in range(3)]
    index = L.line_index(spark, L.held_keys(spark, frame(spark, old)))
    new = [(9, "A line that three documents of the old corpus hold\nown line number 1 of the old\nnever seen before, anywhere", "en", "s", 1)]
    assert got(L.drop_lines(spark, frame(spark, new), index)) == [
        (9, "own line number 1 of the old\nnever seen before, anywhere", 3, 1)]
    shard = index.rows.first()
    assert len(shard.prints) // 8 == len(shard.counts) // 4 == 4


def test_empty_table_and_one_hot_line(spark):
    assert L.drop_lines(spark, frame(spark, [])).collect() == []
    rows = [(i, "one line that every single document holds", "en", "s", 1) for i in range(300)]
    out = L.drop_lines(spark, frame(spark, rows).repartition(6))
    assert out.agg(F.sum("n_dropped")).first()[0] == 299
    assert [r.doc_id for r in out.where("n_dropped = 0").collect()] == [299]


def test_a_chunk_sends_a_hot_line_once(spark, monkeypatch):
    rows = [(i, "one line that every single document holds", "en", "s", 1) for i in range(300)]
    monkeypatch.setattr(L, "CHUNK_DOCS", 100)
    seen = L.held_keys(spark, frame(spark, rows))
    assert seen.count() == 3 and seen.agg(F.sum("docs")).first()[0] == 300
    assert len(documents(3)) > 3
