"""Operator 1: toxicity by a bidirectional gated recurrent network with attention pooling.

A text's words (runs of letters, lower-cased A-Z) are cut into overlapping
windows of ``WINDOW`` words, ``STRIDE`` apart, to the text's end.  Each word
enters as

* word inputs: a learnt vector of its hash bucket, and its log odds among the
  training texts;
* character inputs: the mean of learnt vectors of its 4-byte grams (a space
  on either side included), and the greatest log odds among those grams.

A GRU runs over the window in each direction; attention weighs the steps, and
a logistic unit scores the weighted sum.  A text's score is the greatest of all
its windows.  Training (numpy, driver) knows labels of whole texts only: each
round scores every window of the sample, takes each text's highest ones, and
trains on these by back-propagation through time.

The sample is bounded: ``SAMPLE_CLASS`` rows of either label, of at most
``SAMPLE_CHARS`` characters each.  Scoring covers all words of all texts.

Defined cases: null, empty and wordless texts score 0; texts shorter than a
window are one window; rows without a label, with a null text or with doc_ids
that occur in ``labels`` more than once count once per distinct label row;
without labels of both classes every text scores 0; repeated rows score alike;
an empty table gives no rows; columns other than ``doc_id`` and ``text`` are
not read, so extra names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sameitem.llm.common import _RINV, _R, _VALUE, _power, batches, mix64, prepared, table, utf8
from sameitem.llm.gru import F32, Adam, recurrent, sigmoid, step, step_back, step_traced

WINDOW = 16
STRIDE = 8
HIDDEN = 8
VECTOR = 4
BUCKETS = 1 << 14
GRAM = 4
#: Bound of the training sample: texts of label 0 and of label 1.
SAMPLE_CLASS = (1800, 900)
SAMPLE_CHARS = 12_000
ROUNDS = 6
#: Windows scored together; bytes of text read together.
BLOCK = 4096
#: Rows of a matrix product are a multiple of this, so that equal windows meet the same kernel and score alike.
ROWS = 64
STEP = 1 << 19

_LETTER = np.full(256, 0x20, dtype=np.uint8)  # all but letters parts words
_LETTER[0x80:] = np.arange(0x80, 256)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)


@dataclass
class Inputs:
    """Words and 4-byte grams of some texts, as hashes."""

    text: np.ndarray        # text of each word
    word: np.ndarray        # uint64
    gram: np.ndarray        # uint64, in order of the words
    gram_start: np.ndarray  # first gram of each word
    texts: int


def read_words(offsets: np.ndarray, data: np.ndarray) -> Inputs:
    n = len(offsets) - 1
    none = np.zeros(0, np.int64)
    if not len(data):
        return Inputs(none, none.astype(np.uint64), none.astype(np.uint64), none, n)
    # A space after every text, and one before the first, so that no gram crosses texts.
    text = np.repeat(np.arange(n), np.diff(offsets))
    at = np.arange(len(data)) + text + 1
    flat = np.full(len(data) + n + 1, 0x20, np.uint8)
    flat[at] = _LETTER[data]
    letter = flat != 0x20
    start = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    end = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
    if not len(start):
        return Inputs(none, none.astype(np.uint64), none.astype(np.uint64), none, n)
    power, inverse = _power(_R, len(flat)), _power(_RINV, len(flat))
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(_VALUE[flat] * power[:len(flat)], out=total[1:])
    word = mix64((total[end] - total[start]) * inverse[start])
    grams = np.maximum(end - start + 3 - GRAM, 1)
    first = np.cumsum(grams) - grams
    place = np.repeat(start - 1 - first, grams) + np.arange(int(grams.sum()))
    # A gram ends with the space after its word, so that a text's last word doesn't see the next text.
    stop = np.minimum(place + GRAM, np.repeat(end + 1, grams))
    gram = mix64((total[stop] - total[place]) * inverse[place])
    owner = np.searchsorted(offsets + np.arange(n + 1) + 1, start, side="right") - 1
    return Inputs(owner, word, gram, first, n)


def read_sample(texts: list[str]) -> Inputs:
    """:func:`read_words` of many texts, a block at a time: only the hashes of all of them are held at once."""
    blocks, words, grams, done = [], 0, 0, 0
    while done < len(texts):
        size, end = 0, done
        while end < len(texts) and (end == done or size < STEP):
            size += len(texts[end])
            end += 1
        x = read_words(*utf8(pa.array(texts[done:end], pa.string())))
        blocks.append((x.text + done, x.word, x.gram, x.gram_start + grams))
        words, grams, done = words + len(x.word), grams + len(x.gram), end
    if not blocks:
        return read_words(np.zeros(1, np.int64), np.zeros(0, np.uint8))
    return Inputs(*(np.concatenate(part) for part in zip(*blocks)), len(texts))


def window_starts(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and text of every window; ``bounds`` are the texts' first words and the end."""
    size = np.diff(bounds)
    count = np.where(size > 0, 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE)), 0)
    owner = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(nth * STRIDE, np.maximum(size[owner] - WINDOW, 0))
    return bounds[:-1][owner] + start, owner


@dataclass
class LogOdds:
    """Shrunken log odds of hashes seen in the sample (0 for others)."""

    hash: np.ndarray
    odds: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, bounds: np.ndarray, label: np.ndarray) -> LogOdds:
        """``hashes`` of all texts in a row, ``bounds`` of each text's, and its ``label``.  A text counts once a hash."""
        distinct = [np.unique(hashes[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
        size = [len(d) for d in distinct]
        key, at = np.unique(np.concatenate(distinct), return_inverse=True)
        bad = np.bincount(at, np.repeat(label, size), len(key))
        seen = np.bincount(at, minlength=len(key))
        n_bad, n = float(label.sum()), float(len(label))
        odds = np.log((bad + 0.5) / (n_bad + 1)) - np.log((seen - bad + 0.5) / (n - n_bad + 1))
        keep = seen >= 3
        return cls(key[keep], (odds * seen / (seen + 8.0))[keep].astype(F32))

    def look_up(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hash):
            return np.zeros(len(h), F32)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return np.where(self.hash[at] == h, self.odds[at], F32(0))


class Network:
    """Word and character inputs, a GRU each way, attention, a logistic unit."""

    def __init__(self, words: LogOdds, grams: LogOdds, seed: int = 5):
        rng = np.random.default_rng(seed)
        size = 2 * VECTOR + 2
        self.words, self.grams = words, grams
        self.word_table = rng.normal(0, 0.05, (BUCKETS, VECTOR)).astype(F32)
        self.gram_table = rng.normal(0, 0.05, (BUCKETS, VECTOR)).astype(F32)
        self.w = [rng.normal(0, size ** -0.5, (size, 3 * HIDDEN)).astype(F32) for _ in range(2)]
        self.b = [np.zeros(3 * HIDDEN, F32) for _ in range(2)]
        self.u = [recurrent(rng, HIDDEN) for _ in range(2)]
        self.attention = rng.normal(0, 0.3, 2 * HIDDEN).astype(F32)
        self.out = rng.normal(0, 0.5, 2 * HIDDEN).astype(F32)
        self.bias = np.zeros(1, F32)

    # -- inputs ---------------------------------------------------------
    def vectors(self, x: Inputs, block: int = 1 << 17) -> np.ndarray:
        """Input (words, 2 * VECTOR + 2) of every word, ``block`` words at a time."""
        out = np.empty((len(x.word), 2 * VECTOR + 2), F32)
        edge = np.append(x.gram_start, len(x.gram))
        for a in range(0, len(x.word), block):
            b = min(a + block, len(x.word))
            gram, first = x.gram[edge[a]:edge[b]], edge[a:b] - edge[a]
            total = np.add.reduceat(self.gram_table[gram % np.uint64(BUCKETS)], first, axis=0)
            out[a:b, :VECTOR] = self.word_table[x.word[a:b] % np.uint64(BUCKETS)]
            out[a:b, VECTOR] = self.words.look_up(x.word[a:b])
            out[a:b, VECTOR + 1:-1] = total / np.diff(edge[a:b + 1])[:, None]
            out[a:b, -1] = np.maximum.reduceat(self.grams.look_up(gram), first)
        return out

    # -- scoring --------------------------------------------------------
    def logits(self, vectors: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Logit of each window: its first word (ascending) and its number of words."""
        out = np.empty(len(start), F32)
        for at in range(0, len(start), 4 * BLOCK):
            some = slice(at, at + 4 * BLOCK)
            first = int(start[some][0])
            words = vectors[first:int((start[some] + size[some]).max())]
            words = np.concatenate([words, np.zeros((-len(words) % ROWS, words.shape[1]), F32)])
            gates = [np.concatenate([words @ w + b, np.zeros((1, 3 * HIDDEN), F32)]) for w, b in zip(self.w, self.b, strict=True)]
            full = size[some] == WINDOW
            for part in (np.flatnonzero(full), np.flatnonzero(~full)):
                for k in (part[i:i + BLOCK] for i in range(0, len(part), BLOCK)):
                    whole = bool(full[k[0]])
                    out[at + k] = self._score(gates, start[some][k] - first, None if whole else size[some][k])
        return out

    def _score(self, gates: list[np.ndarray], start: np.ndarray, size: np.ndarray | None) -> np.ndarray:
        many = len(start)
        n = many + -many % ROWS
        start = np.resize(start, n)
        size = None if size is None else np.resize(size, n)
        states = np.empty((2, WINDOW, n, HIDDEN), F32)
        for way, order in ((0, range(WINDOW)), (1, range(WINDOW - 1, -1, -1))):
            h = np.zeros((n, HIDDEN), F32)
            for t in order:
                if size is None:
                    h = step(gates[way].take(start + t, axis=0), h, self.u[way])
                else:
                    on = (t < size)[:, None]
                    h = np.where(on, step(gates[way].take(np.where(t < size, start + t, -1), axis=0), h, self.u[way]), h)
                states[way, t] = h
        weight = states[0] @ self.attention[:HIDDEN] + states[1] @ self.attention[HIDDEN:]
        value = states[0] @ self.out[:HIDDEN] + states[1] @ self.out[HIDDEN:]
        if size is not None:
            weight = np.where(np.arange(WINDOW)[:, None] < size, weight, F32(-1e9))
        weight = np.exp(weight - weight.max(axis=0))
        return ((weight * value).sum(axis=0) / weight.sum(axis=0) + self.bias[0])[:many]

    # -- training -------------------------------------------------------
    def params(self) -> list[np.ndarray]:
        return [self.word_table, self.gram_table, *self.w, *self.b, *self.u, self.attention, self.out, self.bias]

    def gradients(self, x: Inputs, vectors: np.ndarray, start: np.ndarray, size: np.ndarray,
                  label: np.ndarray, weight: np.ndarray) -> tuple[list[np.ndarray], float]:
        """Weighted cross-entropy over some windows, and its gradients."""
        n, time = len(start), np.arange(WINDOW)
        on = time[:, None] < size
        at = np.where(on, start + time[:, None], 0)
        v = vectors[at] * on[:, :, None]
        states, traces = np.zeros((2, WINDOW, n, HIDDEN), F32), [[None] * WINDOW, [None] * WINDOW]
        for way, order in ((0, range(WINDOW)), (1, range(WINDOW - 1, -1, -1))):
            h = np.zeros((n, HIDDEN), F32)
            for t in order:
                new, traces[way][t] = step_traced(v[t] @ self.w[way] + self.b[way], h, self.u[way])
                h = np.where(on[t][:, None], new, h)
                states[way, t] = h
        both = np.concatenate([states[0], states[1]], axis=2)
        e = np.where(on, both @ self.attention, F32(-1e9))
        alpha = np.exp(e - e.max(axis=0))
        alpha /= alpha.sum(axis=0)
        pooled = (alpha[:, :, None] * both).sum(axis=0)
        logit = pooled @ self.out + self.bias[0]
        p = sigmoid(logit)
        loss = -float((weight * np.log(np.maximum(np.where(label == 1, p, 1 - p), 1e-7))).sum())
        d = ((p - label) * weight).astype(F32)
        d_pooled = d[:, None] * self.out
        d_alpha = (both * d_pooled).sum(axis=2)
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(axis=0))
        d_both = alpha[:, :, None] * d_pooled + d_e[:, :, None] * self.attention
        d_w, d_b, d_u, d_v = [], [], [], np.zeros_like(v)
        for way, order in ((0, range(WINDOW - 1, -1, -1)), (1, range(WINDOW))):
            g_w, g_b, g_u = np.zeros_like(self.w[way]), np.zeros_like(self.b[way]), np.zeros_like(self.u[way])
            carry = np.zeros((n, HIDDEN), F32)
            for t in order:
                grad = carry + d_both[t][:, way * HIDDEN:(way + 1) * HIDDEN]
                live = on[t][:, None]
                gate, before, u = step_back(np.where(live, grad, 0), traces[way][t], self.u[way])
                carry = np.where(live, before, grad)
                g_w += v[t].T @ gate
                g_b += gate.sum(axis=0)
                g_u += u
                d_v[t] += gate @ self.w[way].T
            d_w.append(g_w)
            d_b.append(g_b)
            d_u.append(g_u)
        word_grad, gram_grad = np.zeros_like(self.word_table), np.zeros_like(self.gram_table)
        used, g = at[on], d_v[on]
        np.add.at(word_grad, x.word[used] % np.uint64(BUCKETS), g[:, :VECTOR])
        count = np.diff(np.append(x.gram_start, len(x.gram)))[used]
        rows = np.repeat(np.arange(len(used)), count)
        place = np.repeat(x.gram_start[used] - (np.cumsum(count) - count), count) + np.arange(len(rows))
        np.add.at(gram_grad, x.gram[place] % np.uint64(BUCKETS), (g[:, VECTOR + 1:2 * VECTOR + 1] / count[:, None])[rows])
        return [word_grad, gram_grad, *d_w, *d_b, *d_u,
                (d_e[:, :, None] * both).sum(axis=(0, 1)), d @ pooled, np.array([d.sum()], F32)], loss

    def train(self, x: Inputs, label: np.ndarray, rounds: int = ROUNDS, rate: float = 0.02, seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)
        bounds = np.searchsorted(x.text, np.arange(x.texts + 1))
        start, owner = window_starts(bounds)
        size = np.minimum(WINDOW, bounds[1:][owner] - start)
        adam = Adam(self.params(), rate)
        share = np.array([0.5 / max(1, (label == c).sum()) for c in (0, 1)])
        vectors = self.vectors(x)
        # The first round looks at the windows with the highest log odds.
        odds = np.append(np.maximum(vectors[:, VECTOR], vectors[:, -1]), F32(-99))
        at = np.where(np.arange(WINDOW) < size[:, None], start[:, None] + np.arange(WINDOW), len(odds) - 1)
        score = odds[at].max(axis=1)
        for turn in range(rounds):
            order = np.lexsort((-score, owner))
            nth = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
            # A toxic text needs one toxic window; none of a clean text's may be.
            most = np.where(label[owner[order]] == 1, 1, 4)
            pick = order[nth < most]
            weight = (share[label[owner[pick]]] * len(pick) / np.where(label[owner[pick]] == 1, 1, 4)).astype(F32)
            for _ in range(3):
                for k in np.array_split(rng.permutation(len(pick)), max(1, len(pick) // 256)):
                    q = pick[k]
                    grads, _ = self.gradients(x, vectors, start[q], size[q], label[owner[q]].astype(F32), weight[k] / len(k))
                    adam.update(grads)
                    vectors = self.vectors(x) if turn == 0 and len(x.word) < 20_000 else vectors
                vectors = self.vectors(x)
            score = self.logits(vectors, start, size)
        return self


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: tuple[int, int] = SAMPLE_CLASS) -> Network | None:
    """Train on at most ``sample[c]`` texts of each label ``c``, chosen by a hash of ``doc_id``."""
    known = labels.where(F.col("toxic").isin(0, 1)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    cell = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30))
    known = known.where(learn).withColumn("cell", cell)
    total = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(total) < 2:
        return None
    near = F.lit(False)
    for c, n in total.items():
        near = near | ((F.col("toxic") == c) & (F.col("cell") < min(1 << 30, int((1 << 30) * 1.3 * sample[c] / n) + 1)))
    picked = known.where(near)  # about 1.3 * sample rows of each class
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .where(F.length("text").between(1, SAMPLE_CHARS))
            .join(F.broadcast(picked), "doc_id")
            .orderBy("toxic", "cell", "doc_id", "text").toArrow())
    toxic, body = rows["toxic"].to_numpy(), rows["text"]
    texts, label = [], []
    for c in (0, 1):
        mine = body.take(pa.array(np.flatnonzero(toxic == c)[:sample[c]])).to_pylist()
        texts += mine
        label += [c] * len(mine)
    label = np.array(label, np.int64)
    if len(set(label.tolist())) < 2:
        return None
    del rows, body
    x = read_sample(texts)
    if not len(x.word):
        return None
    bounds = np.searchsorted(x.text, np.arange(x.texts + 1))
    return Network(LogOdds.of(x.word, bounds, label),
                   LogOdds.of(x.gram, np.append(x.gram_start, len(x.gram))[bounds], label)).train(x, label)


def score_texts(net: Network, column: pa.Array) -> np.ndarray:
    """Score of each text: the greatest of its windows' (0 without words)."""
    offsets, data = utf8(column)
    n = len(offsets) - 1
    out = np.zeros(n)
    a = 0
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(offsets, offsets[a] + STEP, side="right")) - 1))
        x = read_words(offsets[a:b + 1] - offsets[a], data[offsets[a]:offsets[b]])
        if len(x.word):
            bounds = np.searchsorted(x.text, np.arange(x.texts + 1))
            start, owner = window_starts(bounds)
            size = np.minimum(WINDOW, bounds[1:][owner] - start)
            best = np.full(x.texts, -np.inf, F32)
            np.maximum.at(best, owner, net.logits(net.vectors(x), start, size))
            out[a:b] = 1 / (1 + np.exp(-best.astype(np.float64)))
        a = b
    return out


def scored(spark: SparkSession, docs: DataFrame, labels: DataFrame, learn: Column, keep: list[str]) -> DataFrame:
    """``row`` (the ``keep`` columns), ``score`` and ``predicted`` for every whole text."""
    prepared(spark)
    shared = spark.sparkContext.broadcast(fit(docs, labels, learn))
    # A text goes to the tasks once, also where it is kept.
    picked = docs.select(F.struct(*keep).alias("row"), *[F.col("text")] * ("text" not in keep))
    schema = picked.drop("text").withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches(records):
            text = batch.column(0).field("text") if "text" in keep else batch.column(1)
            score = np.zeros(batch.num_rows) if net is None else score_texts(net, text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["row", "score", "predicted"])

    return picked.mapInArrow(run, schema)


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, learn: Column, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``score`` and ``predicted`` for every whole text (in place of columns of these names)."""
    rows = scored(spark, docs, labels, learn, keep)
    return rows.select(*[F.col("row")[k].alias(k) for k in keep if k not in ("score", "predicted")], "score", "predicted")


def held_out(modulus: int = 5, remainder: int = 0) -> Column:
    """``crc32(doc_id as text) mod modulus = remainder``."""
    return F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % modulus == remainder


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return toxicity(spark, docs, table(spark, sf_dir, "labels"), ~held_out(), ["doc_id", "held_out"])
