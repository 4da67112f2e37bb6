"""Operator 3: language identification by a byte convolutional network.

The UTF-8 bytes of a text are cut into windows of ``WINDOW`` bytes.  Filters of
2, 3 and 4 bytes slide over each window; each filter's greatest response
(max pooling, then ReLU) feeds a softmax over the languages.  The network is
trained in numpy with Adam on the driver, from a bounded sample of labelled
rows (``SAMPLE_DOCS`` documents, ``SAMPLE_WINDOWS`` windows of each).  A text's
prediction is the mean of the log-probabilities over *all* its windows.

A filter on one-hot bytes is a table of 256 weights for each of its positions,
so scoring is table look-ups and sums, in batches of windows.

Defined cases: a text that is null or has no letter gets ``und`` and score 1;
ties go to the first language in byte order; languages are learnt from rows
whose ``lang`` is not null; without any such row every text gets ``und``;
repeated rows are predicted alike; an empty table gives no rows; columns other
than ``doc_id``, ``text`` and (for learning) ``lang`` are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sameitem.llm.common import batches, prepared, table, utf8

WINDOW = 96
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Bound of the training sample: documents of each language, and windows of each document.
SAMPLE_DOCS = 400
SAMPLE_WINDOWS = 6
EPOCHS = 12
UNDETERMINED = "und"
#: Windows convolved together (kept small enough for the processor's cache).
CHUNK = 256


def held_out(modulus: int, remainder: int) -> Column:
    """``crc32(doc_id as text) mod modulus = remainder``."""
    return F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % modulus == remainder


def text_windows(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of every text (zero-padded; the last one overlaps if the text is longer), and their text.

    Letters of ASCII are lower-cased and digits made one, so casing costs no filters.
    """
    data = _FOLD[data]
    size = np.diff(offsets)
    count = np.maximum(1, -(-size // WINDOW))
    owner = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(nth * WINDOW, np.maximum(size[owner] - WINDOW, 0))
    at = (offsets[:-1][owner] + start)[:, None] + np.arange(WINDOW)
    inside = at < offsets[1:][owner][:, None]
    if not len(data):
        return np.zeros((len(owner), WINDOW), np.uint8), owner
    return np.where(inside, data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8), owner


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x30:0x3A] = 0x30


@dataclass
class ByteCNN:
    langs: list[str]
    tables: list[np.ndarray]  # per width: (width, 256, filters)
    bias: list[np.ndarray]
    out: np.ndarray           # (widths * filters, languages)
    out_bias: np.ndarray

    @classmethod
    def new(cls, langs: list[str], seed: int = 7) -> ByteCNN:
        rng = np.random.default_rng(seed)
        f = np.float32
        return cls(langs, [rng.normal(0, 0.5 / w ** 0.5, (w, 256, FILTERS)).astype(f) for w in WIDTHS],
                   [np.zeros(FILTERS, f) for _ in WIDTHS],
                   rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(langs))).astype(f), np.zeros(len(langs), f))

    def convolve(self, x: np.ndarray, w: int) -> np.ndarray:
        """Responses (windows, positions, filters) of the filters of the ``w``-th width."""
        width = WIDTHS[w]
        n = WINDOW - width + 1
        out = self.tables[w][0].take(x[:, :n], axis=0)
        for k in range(1, width):
            out += self.tables[w][k].take(x[:, k:k + n], axis=0)
        return out

    def pooled(self, x: np.ndarray) -> np.ndarray:
        parts = [self.convolve(x, w).max(axis=1) + self.bias[w] for w in range(len(WIDTHS))]
        return np.maximum(np.concatenate(parts, axis=1), 0)

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.langs)), np.float32)
        for at in range(0, len(x), CHUNK):
            z = self.pooled(x[at:at + CHUNK]) @ self.out + self.out_bias
            z -= z.max(axis=1, keepdims=True)
            out[at:at + CHUNK] = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
        return out

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 4e-3, seed: int = 11) -> ByteCNN:
        """Minimise cross-entropy with Adam, in batches of :data:`CHUNK` windows."""
        rng = np.random.default_rng(seed)
        params = [*self.tables, *self.bias, self.out, self.out_bias]
        first = [np.zeros_like(p) for p in params]
        second = [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(order), CHUNK):
                pick = order[at:at + CHUNK]
                for p, m, v, g in zip(params, first, second, self._gradients(x[pick], y[pick]), strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(v / (1 - 0.999 ** (step + 1))) + 1e-8)
                step += 1
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        n, rows = len(x), np.arange(len(x))[:, None]
        where, parts = [], []
        for w in range(len(WIDTHS)):
            r = self.convolve(x, w)
            where.append(r.argmax(axis=1))
            parts.append(r.max(axis=1) + self.bias[w])
        pre = np.concatenate(parts, axis=1)
        hidden = np.maximum(pre, 0)
        z = hidden @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        z /= z.sum(axis=1, keepdims=True)
        z[np.arange(n), y] -= 1
        z /= n
        back = (z @ self.out.T) * (pre > 0)
        tables, bias = [], []
        for w, width in enumerate(WIDTHS):
            g = back[:, w * FILTERS:(w + 1) * FILTERS]
            t = np.zeros_like(self.tables[w])
            for k in range(width):
                np.add.at(t[k], (x[rows, where[w] + k], np.arange(FILTERS)), g)
            tables.append(t)
            bias.append(g.sum(axis=0))
        return [*tables, *bias, hidden.T @ z, z.sum(axis=0)]


def fit(docs: DataFrame, learn: Column, sample_docs: int = SAMPLE_DOCS) -> ByteCNN | None:
    """Train on at most ``sample_docs`` documents of each language, chosen by a hash of ``doc_id``."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        F.col("lang").cast("string").alias("lang"), "doc_id",
        # Whole documents are not needed here: the sample takes windows spread over each.
        F.col("text"))
    total = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not total:
        return None
    langs = sorted(total, key=lambda s: s.encode())
    cell = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30))
    keep = F.lit(False)
    for lang in langs:  # a share of each language that gives about sample_docs rows
        share = min(1 << 30, int((1 << 30) * 1.2 * sample_docs / total[lang]) + 1)
        keep = keep | ((F.col("lang") == lang) & (cell < share))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(cell, "doc_id"))
    sample = (rows.where(keep).withColumn("nth", nth).where(F.col("nth") <= sample_docs)
              .select("lang", F.transform(
                  F.sequence(F.lit(0), F.lit(SAMPLE_WINDOWS - 1)),
                  lambda i: F.substring(F.col("text"), (i * F.greatest(F.length("text") - WINDOW, F.lit(0))
                                                        / (SAMPLE_WINDOWS - 1)).cast("int") + 1, F.lit(WINDOW))).alias("parts"))
              .orderBy("lang", "parts").collect())
    texts, labels = [], []
    for r in sample:
        for part in dict.fromkeys(r["parts"]):
            texts.append(part)
            labels.append(langs.index(r["lang"]))
    x, owner = text_windows(*utf8(pa.array(texts, pa.string())))
    y = np.array(labels)[owner]
    return ByteCNN.new(langs).train(x, y)


def predict(spark: SparkSession, docs: DataFrame, model: ByteCNN | None, keep: list[str]) -> DataFrame:
    """``row`` (the ``keep`` columns), ``lang_pred`` and ``score`` for every whole text."""
    shared = spark.sparkContext.broadcast(model)
    # A text goes to the tasks once, also where it is kept.
    picked = docs.select(F.struct(*keep).alias("row"), F.coalesce(
        F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"), *[F.col("text")] * ("text" not in keep))
    schema = picked.drop("text", "letters").withColumns(
        {"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0)}).schema

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cnn = shared.value
        for batch in batches(records, 512):
            letters = batch.column(1).to_numpy(zero_copy_only=False)
            n = batch.num_rows
            lang, score = np.full(n, UNDETERMINED, dtype=object), np.ones(n)
            if cnn is not None and n:
                offsets, data = utf8(batch.column(0).field("text") if "text" in keep else batch.column(2))
                total, count = np.zeros((n, len(cnn.langs))), np.zeros(n)
                for a, b in _spans(offsets):
                    x, owner = text_windows(offsets[a:b + 1] - offsets[a], data[offsets[a]:offsets[b]])
                    np.add.at(total, owner + a, cnn.log_probabilities(x))
                    np.add.at(count, owner + a, 1)
                mean = total / np.maximum(count, 1)[:, None]
                best = mean.argmax(axis=1)
                p = np.exp(mean - mean.max(axis=1, keepdims=True))
                p = 1 / p.sum(axis=1)
                for i in np.flatnonzero(letters):
                    lang[i], score[i] = cnn.langs[best[i]], float(p[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pc.cast(pa.array(score), pa.float64())],
                ["row", "lang_pred", "score"])

    return picked.mapInArrow(run, schema)


def _spans(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes together, one text at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        yield a, min(b, n)
        a = b


def predicted(spark: SparkSession, docs: DataFrame, keep: list[str]) -> DataFrame:
    """Learn from the documents outside the held-out fold, then predict all of them (``row, lang_pred, score``)."""
    prepared(spark)
    return predict(spark, docs, fit(docs, ~held_out(4, 2)), keep)


def language_id(spark: SparkSession, docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``lang_pred`` and ``score`` (in place of columns of these names)."""
    rows = predicted(spark, docs, keep)
    return rows.select(*[F.col("row")[k].alias(k) for k in keep if k not in ("lang_pred", "score")], "lang_pred", "score")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(4, 2).alias("held_out"), "text", "lang")
    return language_id(spark, docs, ["doc_id", "held_out"])
