import random
import re

import numpy as np
from pyspark.sql import functions as F

from sameitem.llm import jaccard_join as J
from tests.llm.helpers import documents, frame


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted((str(r[0]), len(sets[i]), least.get(find(i))) for i, r in enumerate(rows))


def near_copies(rng, base, n, first, edits):
    rows = []
    for k in range(n):
        w = base.split()
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"new{rng.randint(0, 9999)}"
        rows.append((first + k, " ".join(w), "en", "s0", 1))
    return rows


def corpus():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    rows = documents(20)
    passage = " ".join(rng.choice(words) for _ in range(60))
    for g in range(6):
        base = " ".join(rng.choice(words) for _ in range(rng.choice([30, 80, 150])))
        rows += near_copies(rng, base, rng.choice([2, 5, 30]), 1000 + 100 * g, 3)
    for k in range(40):  # unrelated documents that share a passage, in part most of their text
        rows.append((3000 + k, passage + " " + " ".join(rng.choice(words) for _ in range(rng.choice([3, 8, 14, 60]))), "en", "s0", 1))
    return rows


def test_components_against_all_pairs(spark):
    rows = corpus()
    want = components(rows)
    for settings in ({}, {"ROUNDS": 0, "CHUNK": 2, "COMMON": 1}):
        old = {k: getattr(J, k) for k in settings}
        try:
            for k, v in settings.items():
                setattr(J, k, v)
            out = J.jaccard_components(spark, frame(spark, rows).repartition(5)).collect()
        finally:
            for k, v in old.items():
                setattr(J, k, v)
        assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in out) == want
        if settings == {}:
            assert len({c for *_, c in want}) < len(want) - 30


def test_representatives_keep_one_row_of_each_component(spark):
    rows = corpus()
    want = components(rows)
    kept = J.representatives(spark, frame(spark, rows)).collect()
    wordless = sum(n == 0 for _, n, _ in want)
    groups = {c for _, n, c in want if n}
    assert len(kept) == wordless + len(groups)
    assert len([c for c in kept[0].asDict()]) == 15


def test_empty_table(spark):
    assert J.jaccard_components(spark, frame(spark, [])).collect() == []
    assert J.representatives(spark, frame(spark, [])).collect() == []


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n, m = rng.integers(1, 300, 2)
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate([rng.choice(a, min(len(a), int(n * rng.random()) + 1), replace=False),
                                      rng.integers(0, 1 << 62, int(m * rng.random() * 0.3)).astype(np.uint64)]))
        x, y = J._bits(J.set_bits(a)), J._bits(J.set_bits(b))
        assert J.missing(x, y) <= len(np.setdiff1d(a, b))
        assert J.may_link(x, len(a), y, len(b)) or not J.linked(a, b)
        both = np.union1d(a, b)
        assert J.missing(x, J._bits(J.set_bits(both))) == 0


def test_boundary_of_the_threshold():
    a = np.arange(100, dtype=np.uint64)
    assert J.linked(a[:80], a) and not J.linked(a[:79], a)
    assert J.prefix_size(100) == 21 and J.prefix_size(1) == 1 and J.prefix_size(0) == 0


def test_prefixes_of_linked_sets_share_as_many_tokens_as_said(spark):
    rng = np.random.default_rng(8)
    rows = []
    while len(rows) < 200:
        n = int(rng.integers(1, 300))
        both = np.arange(n, dtype=np.uint64) * np.uint64(7)
        a = np.unique(np.concatenate([both, rng.integers(0, 2100, int(n * rng.random() * 0.25)).astype(np.uint64)]))
        b = np.unique(np.concatenate([both, rng.integers(0, 2100, int(n * rng.random() * 0.25)).astype(np.uint64)]))
        if J.linked(a, b):
            common = len(np.intersect1d(a[:J.prefix_size(len(a))], b[:J.prefix_size(len(b))]))
            slack = int(rng.integers(0, 40))
            rows.append((len(a), len(b), max(1, len(b) - slack), len(b) + slack, common))
    n, m, low, high = (F.col(c) for c in ("n", "m", "low", "high"))
    df = spark.createDataFrame(rows, "n long, m long, low long, high long, common long")
    asked = df.select("common", J.least_shared(n, m, m).alias("pair"), J.least_shared(n, low, high).alias("group"), J.sizes_near(n, low, high).alias("near"))
    for r in asked.collect():
        assert r.near and r.group <= r.pair <= r.common
    assert spark.range(1).select(J.least_shared(F.lit(1000), F.lit(1000), F.lit(1000))).first()[0] > 80


def test_bitmaps_are_read_for_sets_that_share_enough_only(spark, monkeypatch):
    rng = random.Random(5)
    own = lambda n: " ".join(f"u{rng.randint(0, 10 ** 9)}" for _ in range(n))
    rows = [(i, "one run of five words " + own(30), "en", "s0", 1) for i in range(40)]
    copy = own(60)
    rows += [(100, copy, "en", "s0", 1), (101, copy + " end", "en", "s0", 1)]
    read = []

    def counted(spark, df, name, old=J.stage):
        out = old(spark, df, name)
        if "bits" in out.columns and name != "shingle-sets" or name.endswith("-chunks"):
            read.append(out.count())
        return out

    monkeypatch.setattr(J, "stage", counted)
    monkeypatch.setattr(J, "COMMON", 1)
    out = J.jaccard_components(spark, frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in out) == components(rows)
    assert sum(read) <= 10
