import hashlib
import random
import re

from pyspark.sql import functions as F

from sameitem.llm import spotsigs as S
from tests.llm.helpers import documents, frame, sentence


def chains(text):
    """Chains by their definition: (anchors, content words)."""
    words = [w for w in re.findall(r"[^\W_]+", (text or "").lower()) if w not in S.PASSED]
    out, anchors, content = [], [], []
    for w in words:
        if w in S.ANCHORS:
            anchors.append(w)
        else:
            content.append((tuple(anchors), w))
            anchors = []
    for i, (a, w) in enumerate(content):
        if a:
            out.append((a, w, *[c for _, c in content[i + 1:i + S.CHAIN]]))
    return set(out) or ({("whole", *re.findall(r"[^\W_]+", (text or "").lower()))} if re.search(r"[^\W_]", text or "") else set())


def likeness(a, b):
    a, b = chains(a), chains(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_against_brute_force(spark):
    rows = [r for r in documents(45) if r[0] is not None]
    rows = [r for r in rows if r[0] != 907][:] + [(907, "the same row twice", "en", "s", 1)] * 2
    rows.append((50, "A the IS of cat, sat the on the the Mat was", "en", "s", 1))
    order = sorted(rows, key=lambda r: -r[0])
    want = []
    for k, (i, t, *_) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(likeness(t, edited), 9), round(likeness(t, nxt), 9),
                     len(chains(t)), len(chains(edited))))
    for bucket_rows in (S.BUCKET_ROWS, 4):
        old, S.BUCKET_ROWS = S.BUCKET_ROWS, bucket_rows
        S.with_next.__defaults__ = (bucket_rows,)
        try:
            out = S.fingerprints(frame(spark, rows).repartition(4)).collect()
        finally:
            S.BUCKET_ROWS = old
            S.with_next.__defaults__ = (old,)
        got = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9),
                len(r.fingerprint.split()), len(r.edited_fingerprint.split())) for r in out]
        assert sorted(got) == sorted(want)
    by_text = {}
    for r in out:
        by_text.setdefault(dict((x[0], x[1] or "") for x in rows)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_empty_table_single_row_and_null_ids(spark):
    assert S.fingerprints(frame(spark, [])).collect() == []
    one = S.fingerprints(frame(spark, [(3, "the cat sat on the mat", "en", "s", 1)])).collect()[0]
    assert one.near_next == 1.0
    out = S.fingerprints(frame(spark, [(None, "the cat", "en", "s", 1), (1, "a dog", "en", "s", 1)])).collect()
    edited = {r.doc_id: r.edited_sha256 for r in out}
    assert edited[1] == hashlib.sha256(b"a dth").hexdigest() and edited[None] == hashlib.sha256(b"the a d").hexdigest()


def test_similar_texts_against_all_pairs(spark):
    rng = random.Random(8)
    rows = []
    for g in range(8):
        base = sentence(rng, 120).split()
        for k in range(5):
            w = list(base)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = f"edit{rng.randint(0, 99)}"
            rows.append((g * 10 + k, " ".join(w), "en", "s", 1))
    sets = {}
    for i, t, *_ in rows:
        sets.setdefault(frozenset(chains(t)), []).append(i)
    names = {s: min(v) for s, v in sets.items()}
    want = set()
    for a, x in names.items():
        for b, y in names.items():
            if x < y and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                want.add((x, y))
    got = {(r.a, r.b) for r in S.similar_texts(frame(spark, rows)).collect()}
    assert got == want and len(want) > 8


def test_bucket_is_a_binary_search(spark):
    cuts = [-5, 0, 3, 3000]
    out = spark.range(-10, 10).select("id", S._bucket(cuts, F.col("id")).alias("b")).collect()
    assert all(r.b == sum(c < r.id for c in cuts) for r in out)
    assert spark.range(1).select(S._bucket([], F.col("id")).alias("b")).first().b == 0


def test_one_id_with_a_third_of_all_rows_is_split_and_copied_once(spark):
    rows = [(None if i % 3 == 0 else i if i % 3 == 1 else 100_000 + i % 2, f"text {i // 2 % 500} of a row") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    placed, order = S.with_next(df, bucket_rows=50)
    got = placed.withColumn("next_text", F.lead("text").over(order)).where(~F.col("copy")).collect()
    sizes = {r.bucket: r["count"] for r in placed.where("not copy").groupBy("bucket").count().collect()}
    assert placed.count() == len(rows) + len(sizes) and max(sizes.values()) < 250 and len(sizes) > 30
    low = -(1 << 63)
    seq = sorted(got, key=lambda r: (-(low if r.doc_id is None else r.doc_id), r.tie))
    want = [(str(r.doc_id), r.text, n.text) for r, n in zip(seq, [*seq[1:], seq[0]])]
    assert sorted((str(r.doc_id), r.text, r.next_text) for r in seq) == sorted(want)
