import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from sameitem.llm import importance_resampling as R
from sameitem.llm.common import batch_words
from tests.llm.helpers import documents, frame, sentence, write

A_Z = {c: c + 32 for c in range(65, 91)}


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_Z))
    return [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)], len(words)


def buckets(text):
    return [zlib.crc32(f.encode()) % 10000 for f in features(text)[0]]


def brute(docs, target):
    s, t = Counter(), Counter()
    for r in docs:
        s.update(buckets(r[1]))
    for x in target:
        t.update(buckets(x))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    rows = []
    for k, (i, text, *_) in enumerate(docs):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        own = buckets(text)
        weight = sum(gain[b] for b in own)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, features(text)[1]])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[:5 * len(able) // 100], 1):
        r[4] = rank
    return sorted([tuple(r[:5]) for r in rows], key=repr)


def corpus(n=160, seed=4):
    rng = random.Random(seed)
    rows = [(i, t, *rest) for i, t, *rest in documents(n, seed)]
    rows += [(2000 + i, "Same text, twenty-one words of it: " + " ".join(f"w{k}" for k in range(20)), "en", "s", 1) for i in range(40)]
    return rows + [(3000, "é" * 300 + " ÀÉ Ünï 日本 " + "x" * 100 + " " + sentence(rng, 30), "fr", "s", 1)]


def got(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=repr)


def test_against_brute_force(spark, tmp_path):
    rows = corpus()
    target = [sentence(random.Random(9), 50), None, "", rows[3][1]]
    path = write(spark, tmp_path, rows, benchmark=spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string"))
    out = R.op13_resampling(spark, path)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in out.dtypes} == {"bigint"}
    assert got(out) == brute(rows, target)


def test_crc_of_runs_of_words():
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choice("abzAZ09é日") for _ in range(rng.choice([1, 2, 7, 20, 47, 60, 300]))) for _ in range(n)) for n in (0, 1, 2, 3, 40)]
    texts += ["", "...", "one,two;THREE", "\x00a\x7fb"]
    have = [[] for _ in texts]
    for words in batch_words(pa.array(texts), punctuation=True):
        for text, bucket in R.feature_buckets(words):
            for t, b in zip(text.tolist(), bucket.tolist()):
                have[words.first + t].append(b)
    assert [sorted(h) for h in have] == [sorted(buckets(t)) for t in texts]


def test_cutoff_counts_exactly(spark):
    rng = random.Random(2)
    for values in ([5], [7] * 40, [rng.randrange(-50, 50) for _ in range(300)], [rng.randrange(-2 ** 62, 2 ** 62) for _ in range(100)],
                   [-2 ** 63, 2 ** 63 - 1, 0, 0]):
        df = spark.createDataFrame([(v,) for v in values], "v long").repartition(3)
        for least in {1, len(values) // 3 or 1, len(values)}:
            at, above = R.cutoff(df, F.col("v"), least)
            want = sorted(values, reverse=True)[least - 1]
            assert (at, above) == (want, sum(v > want for v in values))
        assert R.cutoff(df, F.col("v"), len(values) + 1) is None


def test_ties_go_to_the_smaller_id_then_to_any_copy(spark):
    rows = [(5, 1)] * 6 + [(3, 1), (None, 1), (None, 1), (9, 4)]
    df = spark.createDataFrame([(i, 30, 0, 0, s, k) for k, (i, s) in enumerate(rows)],
                               "doc_id long, n_words long, n_features long, weight long, score long, row long")
    for share, want in ((10, [9]), (20, [9, 3]), (40, [9, 3, 5, 5]), (90, [9, 3] + [5] * 6 + [None])):
        chosen, n = R.drawn(df, share)
        assert n == len(want) and sorted(map(str, (r.doc_id for r in df.where(chosen).collect()))) == sorted(map(str, want))


def test_small_and_empty_tables(spark):
    none = frame(spark, [])
    assert R.resampled(spark, none, none).collect() == []
    few = [(i, sentence(random.Random(i), 25), "en", "s", 1) for i in range(19)]
    assert got(R.resampled(spark, frame(spark, few), none)) == brute(few, [])
    hot = [(i % 3 or None, "all of these are one and the same text " * 4, "en", "s", 1) for i in range(60)]
    assert got(R.resampled(spark, frame(spark, hot), none)) == brute(hot, [])
