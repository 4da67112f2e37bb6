"""Operators 1, 3 and 7: learnt models, held against held-out rows, gradients and plain recomputation."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sameitem.llm import gru, language_id, lm_scoring, toxicity
from sameitem.llm.common import utf8
from tests.llm.helpers import documents, frame, odd_rows, sentence

BAD = ["vileword", "uglyterm", "rudestem"]


def fold(i, m, r):
    return zlib.crc32(str(i).encode()) % m == r


def labelled(n=260, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = sentence(rng, rng.choice([6, 30, 90])).split()
        toxic = int(i % 4 == 0)
        for _ in range(3 * toxic):
            w[rng.randrange(len(w))] = rng.choice(BAD) + rng.choice(["", "s", "ish", ","])
        rows.append((i, " ".join(w), "en", "s0", 1))
        labels.append((i, 1, toxic))
    return rows, labels


# -- the recurrent layer ------------------------------------------------------
def test_step_and_its_gradient():
    rng = np.random.default_rng(1)
    gate, h, u = rng.normal(size=(3, 12)), rng.normal(size=(3, 4)), rng.normal(size=(4, 12))
    out, trace = gru.step_traced(gate, h, u)
    assert np.allclose(out, gru.step(gate.copy(), h.copy(), u), atol=1e-6)
    up = rng.normal(size=out.shape)
    grads = gru.step_back(up, trace, u)
    for x, g in zip((gate, h, u), grads):
        for at in list(np.ndindex(x.shape))[::5]:
            keep, e = x[at], 1e-5
            x[at] = keep + e
            a = (gru.step_traced(gate, h, u)[0] * up).sum()
            x[at] = keep - e
            b = (gru.step_traced(gate, h, u)[0] * up).sum()
            x[at] = keep
            assert abs((a - b) / (2 * e) - g[at]) < 1e-4


# -- toxicity ---------------------------------------------------------------
def test_toxicity_words_and_windows():
    texts = ["One two-THREE  éa", "", None, "12 34", "x"]
    x = toxicity.read_words(*utf8(pa.array(texts, pa.string())))
    assert np.bincount(x.text, minlength=5).tolist() == [4, 0, 0, 0, 1]
    assert x.texts == 5 and len(x.gram_start) == 5
    for n in (1, 15, 16, 17, 24, 25, 100):
        start, owner = toxicity.window_starts(np.array([0, n]))
        covered = {w for s in start for w in range(s, min(s + toxicity.WINDOW, n))}
        assert covered == set(range(n)) and (start >= 0).all() and set(owner) == {0}


def test_toxicity_gradient():
    rng = random.Random(4)
    x = toxicity.read_words(*utf8(pa.array([sentence(rng, 20), sentence(rng, 9)])))
    none = toxicity.LogOdds(np.zeros(0, np.uint64), np.zeros(0, np.float32))
    net = toxicity.Network(none, none)
    for name in ("word_table", "gram_table", "attention", "out", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.w, net.b, net.u = ([p.astype(np.float64) for p in g] for g in (net.w, net.b, net.u))
    start, size = np.array([0, 4, 20]), np.array([16, 16, 9])
    label, weight = np.array([1.0, 0.0, 1.0]), np.array([0.5, 1.0, 2.0])

    def loss():
        return net.gradients(x, net_vectors(), start, size, label, weight)[1]

    def net_vectors():
        grams = np.diff(np.append(x.gram_start, len(x.gram)))
        mean = np.add.reduceat(net.gram_table[x.gram % np.uint64(toxicity.BUCKETS)], x.gram_start, axis=0) / grams[:, None]
        zero = np.zeros((len(x.word), 1))
        return np.concatenate([net.word_table[x.word % np.uint64(toxicity.BUCKETS)], zero, mean, zero], axis=1)

    grads, _ = net.gradients(x, net_vectors(), start, size, label, weight)
    for p, g in zip(net.params(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep, e = p[at], 1e-3
        p[at] = keep + e
        a = loss()
        p[at] = keep - e
        b = loss()
        p[at] = keep
        assert abs((a - b) / (2 * e) - g[at]) < 2e-2 * max(1.0, abs(g[at]))


def test_toxicity_on_held_out_rows(spark):
    rows, labels = labelled()
    rows = rows + odd_rows() + [(5000, "word " * 3000 + "vileword " + "word " * 3000, "en", "s", 1)]
    tags = spark.createDataFrame(labels + [(907, 1, 0), (907, 1, None)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows).withColumn("score", F.lit("clash"))
    out = toxicity.toxicity(spark, docs.select("doc_id", "text", "k1"), tags, ~toxicity.held_out(), ["doc_id", "k1"]).collect()
    assert len(out) == len(rows)
    truth = {i: t for i, _, t in labels}
    held = [r for r in out if r.doc_id in truth and fold(r.doc_id, 5, 0)]
    assert len(held) > 30 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(r.score == 0 and r.predicted == 0 for r in out if r.doc_id in (901, 902, 903, 905))
    assert next(r for r in out if r.doc_id == 5000).predicted == 1  # one toxic word amid a long text
    assert len({r.score for r in out if r.doc_id == 907}) == 1
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)


def test_toxicity_without_labels_or_documents(spark):
    tags = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(spark, frame(spark, documents(4)).select("doc_id", "text"), tags, ~toxicity.held_out(), ["doc_id"])
    assert {r.score for r in out.collect()} == {0.0}
    assert toxicity.toxicity(spark, frame(spark, []).select("doc_id", "text"), tags, ~toxicity.held_out(), ["doc_id"]).collect() == []


# -- language identification ----------------------------------------------------
SOUNDS = {"en": ["the", "ing", "wh", "th", "ou"], "fr": ["eau", "éx", "que", "ç"], "de": ["sch", "ung", "ß", "ich"]}


def spoken(n=240):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(SOUNDS))
        words = ["".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.choice([5, 40, 200]))]
        rows.append((i, " ".join(words), lang if i % 9 else None, "s", 1))
        rows[-1] += (lang,)
    return rows


def test_language_windows_cover_every_byte():
    texts = ["", None, "ab", "x" * 96, "y" * 97, "Z" * 1000]
    x, owner = language_id.text_windows(*utf8(pa.array(texts, pa.string())))
    assert np.bincount(owner).tolist() == [1, 1, 1, 1, 2, 11]
    assert (x[owner == 5] == ord("z")).all() and (x[owner == 2] > 0).sum() == 2


def test_language_gradient():
    rng = np.random.default_rng(0)
    x = rng.integers(97, 110, (6, language_id.WINDOW)).astype(np.uint8)
    y = np.array([0, 1, 2, 0, 1, 2])
    net = language_id.ByteCNN.new(["a", "b", "c"])
    grads = net._gradients(x, y)
    params = [*net.tables, *net.bias, net.out, net.out_bias]

    def loss():
        return -float(net.log_probabilities(x)[np.arange(6), y].astype(np.float64).mean())

    for p, g in zip(params, grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep, e = p[at], 1e-2
        p[at] = keep + e
        a = loss()
        p[at] = keep - e
        b = loss()
        p[at] = keep
        assert abs((a - b) / (2 * e) - g[at]) < 0.05 * max(abs(g[at]), 0.02)


def test_language_on_held_out_rows(spark):
    rows = spoken()
    docs = frame(spark, [r[:5] for r in rows] + odd_rows())
    out = language_id.language_id(spark, docs.select("doc_id", "text", "lang", "rank"), ["doc_id", "rank"]).collect()
    assert len(out) == len(rows) + len(odd_rows())
    truth = {r[0]: r[5] for r in rows}
    held = [r for r in out if r.doc_id in truth and fold(r.doc_id, 4, 2)]
    assert len(held) > 30 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert {r.lang_pred for r in out if r.doc_id in (901, 902, 903, 905)} == {"und"}
    assert "und" not in {r.lang_pred for r in out if r.doc_id in (904, 906, 908)}
    assert all(0 <= r.score <= 1 for r in out)


def test_language_without_labels_or_documents(spark):
    docs = frame(spark, [(1, "some text", None, "s", 1)])
    assert [r.lang_pred for r in language_id.language_id(spark, docs, ["doc_id"]).collect()] == ["und"]
    assert language_id.language_id(spark, frame(spark, []), ["doc_id"]).collect() == []


# -- language model ---------------------------------------------------------------
def stream_of(text):
    return [w.decode() for w in re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())] + ["</s>"]


def base_scores(rows):
    counts = Counter(w for i, t, *_ in rows if not fold("" if i is None else i, 7, 2) for w in stream_of(t))
    n, v = sum(counts.values()), len(counts)
    return {(i, t): (len(stream_of(t)), sum(counts[w] > 0 for w in stream_of(t)), n,
                     sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in stream_of(t))) for i, t, *_ in rows}


def lm_rows():
    rng = random.Random(6)
    rows = []
    for i in range(150):  # two kinds of text, so that what came before tells what comes
        words = [f"{'ab'[i % 2]}{rng.randint(0, 12)}" for _ in range(rng.choice([1, 20, 60]))]
        words += [f"rare{rng.randint(0, 400)}" for _ in range(3)]
        rows.append((i, " ".join(words), "en", "s", 1))
    return rows + odd_rows()


def test_lm_against_plain_counts(spark):
    rows = lm_rows()
    want = base_scores(rows)
    for table_size in (500_000, 40):  # all counts held by tasks, and a long tail joined
        out = lm_scoring.lm_scores(spark, frame(spark, rows).repartition(3), ~lm_scoring.held_out(), table_size).collect()
        assert len(out) == len(rows)
        got = Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out)
        assert got == Counter((i, *want[i, t][:3], round(want[i, t][3], 6)) for i, t, *_ in rows)
        held = [r for r in out if r.doc_id is not None and r.doc_id < 150 and fold(r.doc_id, 7, 2)]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    model = lm_scoring.Model(40)  # a class and a part of one
    states = rng.normal(size=(3, lm_scoring.HIDDEN)).astype(np.float32)
    every = np.concatenate([np.arange(40), 64 + np.arange(lm_scoring.RARE_CLASSES)])
    total = sum(np.exp(model.log_likelihood(states, np.full(3, k)).astype(np.float64)) for k in every)
    assert np.allclose(total, 1, atol=1e-4)


def test_lm_score_carries_state_over_windows_and_batches():
    rng = np.random.default_rng(3)
    model = lm_scoring.Model(64)
    size = [1, 200, 33, 5]
    index = rng.integers(0, 64, sum(size))
    bounds = np.cumsum([0, *size])
    together = model.score(index, bounds, 0)
    for k in range(4):
        own = index[bounds[k]:bounds[k + 1]]
        h, before, total = np.zeros((1, lm_scoring.HIDDEN), np.float32), 0, 0.0
        for token in own:
            h = gru.step(model.gate[[before]], h, model.u)
            total += float(model.log_likelihood(h, np.array([token]))[0])
            before = token
        assert abs(total - together[k]) < 1e-2


def test_lm_training_lowers_the_loss_on_a_pattern():
    stream = np.tile(np.arange(8), 800)
    model = lm_scoring.Model(8).train(stream, 0, lanes=8, epochs=4)
    per_token = model.score(stream[:400], np.array([0, 400]), 7)[0] / 400
    assert per_token > -0.3  # uniform: -2.08


def test_lm_empty_tables(spark):
    assert lm_scoring.lm_scores(spark, frame(spark, []), ~lm_scoring.held_out()).collect() == []
    out = lm_scoring.lm_scores(spark, frame(spark, [(1, "a b", "en", "s", 1)]), F.lit(False)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in out] == [(3, 0, 0, 0.0, 0.0)]


def test_sample_read_in_blocks_equals_one_reading(monkeypatch):
    texts = ["", "One two, three", "x" * 50, "", "é à la carte 12 three", " ".join(f"w{i}x" for i in range(40)), "..."]
    whole = toxicity.read_words(*utf8(pa.array(texts, pa.string())))
    monkeypatch.setattr(toxicity, "STEP", 30)
    parts = toxicity.read_sample(texts)
    assert parts.texts == whole.texts
    for name in ("text", "word", "gram", "gram_start"):
        assert getattr(parts, name).tolist() == getattr(whole, name).tolist()
    assert toxicity.read_sample([]).texts == 0


def test_lm_round_is_the_mean_of_the_tasks_copies_by_tokens(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "TEAM", 2)  # three levels of sums
    rows = documents(60, odd=False)
    docs = frame(spark, rows).select("doc_id", "text").repartition(5, "doc_id").persist()
    counts = lm_scoring.gather_counts(lm_scoring.token_counts(docs))
    model, want = lm_scoring.Model(counts.size), []
    start = model.copy()
    for part in docs.rdd.glom().collect():
        own = start.copy()
        batch = pa.RecordBatch.from_arrays([pa.array([r.text for r in part], pa.string())], ["text"])
        streams = list(lm_scoring.stretches(iter([batch]), counts, own, 1 << 30))
        if streams:
            lanes = max(1, min(lm_scoring.ROUND_LANES, len(streams[0]) // 64))
            cut = streams[0][:len(streams[0]) // lanes * lanes].reshape(lanes, -1)
            own.learn(cut, 0, gru.Adam(own.params(), 0.01))
            want.append((cut.size, own))
    assert lm_scoring.averaged_round(spark, docs, counts, model, 0, 0.01) == sum(n for n, _ in want) and len(want) > 2
    for i, p in enumerate(model.params()):
        mean = sum(n * own.params()[i].astype(np.float64) for n, own in want) / sum(n for n, _ in want)
        np.testing.assert_allclose(p, mean, atol=1e-4)
    assert any((p != q).any() for p, q in zip(model.params(), start.params(), strict=True))
    docs.unpersist()


def test_lm_rounds_learn_from_a_share_that_grows_with_the_corpus(spark):
    seen = []
    for n in (200, 800):
        rows = [(None if i % 3 == 0 else i, f"w{i} " + "some words of a text here " * 20, "en", "s", 1) for i in range(n)]
        rows.append((n, "long text of words " * 30_000, "en", "s", 1))
        docs = frame(spark, rows).select("doc_id", "text").repartition(2, "doc_id")
        counts = lm_scoring.gather_counts(lm_scoring.token_counts(docs))
        seen.append(lm_scoring.corpus_rounds(spark, docs.where("length(text) < 20000"), counts, lm_scoring.Model(counts.size), 0))
        # A long text is learnt from whole, wherever its hash puts it.
        long_ = docs.where("length(text) >= 20000")
        assert lm_scoring.averaged_round(spark, long_, counts, lm_scoring.Model(counts.size), 0) > 119_000
    assert 2.5 < seen[1] / seen[0] < 6
    empty = frame(spark, []).select("doc_id", "text")
    assert lm_scoring.averaged_round(spark, empty, counts, lm_scoring.Model(counts.size), 0) == 0


def test_lm_rounds_learn_from_every_training_token(spark):
    rows = [(None if i % 5 == 0 else i, " ".join(f"w{(i * j) % 37}" for j in range(i % 23)), "en", "s", 1) for i in range(300)]
    docs = frame(spark, rows).select("doc_id", "text").repartition(3, "text")
    counts = lm_scoring.gather_counts(lm_scoring.token_counts(docs))
    seen = lm_scoring.corpus_rounds(spark, docs, counts, lm_scoring.Model(counts.size), 0)
    assert seen == counts.total == sum(len(t.split()) + 1 for _, t, *_ in rows)


def test_lm_stretches_side_by_side_hold_every_token():
    for n in (1, 5, 64, 100, 1027):
        for lanes in (1, 3, 8):
            rows = lm_scoring.side_by_side(np.arange(n), lanes, True)
            assert len(rows) <= lanes and set(rows.ravel().tolist()) == set(range(n))
            assert (np.diff(rows, axis=1) == 1).all()


def test_gru_window_gradients_equal_those_of_single_steps():
    rng = np.random.default_rng(4)
    gate, u = rng.normal(size=(7, 9)).astype(np.float32), rng.normal(size=(3, 9)).astype(np.float32)
    inputs, h, up = rng.integers(0, 7, (5, 4)), rng.normal(size=(4, 3)).astype(np.float32), rng.normal(size=(5, 4, 3)).astype(np.float32)
    states, last, trace = gru.run_traced(gate, inputs, h, u)
    plain, traces = h, []
    for t in range(5):
        plain, one = gru.step_traced(gate[inputs[t]], plain, u)
        traces.append(one)
        np.testing.assert_allclose(states[t], plain, atol=1e-5)
    np.testing.assert_allclose(gru.Cell(gate, u).run(inputs, h)[0], states, atol=1e-5)
    gates, g_u = gru.run_back(up, trace, u)
    carry, sum_u = np.zeros((4, 3), np.float32), 0
    for t in range(4, -1, -1):
        own, carry, part = gru.step_back(carry + up[t], traces[t], u)
        np.testing.assert_allclose(gates[t], own, atol=1e-4)
        sum_u = sum_u + part
    np.testing.assert_allclose(g_u, sum_u, atol=1e-4)
    assert (last == states[-1]).all()
