"""Operator 7: language-model scoring with a gated recurrent network and a class-factored softmax.

Words come from the shared rule (:mod:`sameitem.llm.common`), then one end
token a text.  All counts (``c``, ``N``, ``V``) are over every training text:
tasks count words by hash, Spark adds them up.

The model: the ``VOCABULARY`` most frequent tokens form classes of
``CLASS_WORDS`` by rank; every other word falls into one of ``RARE_CLASSES``
classes by its last two bytes.  A GRU reads the tokens and gives

    P(token | before) = P(class | state) * P(token | class, state)

where within a rare class a word's share is ``(c + 1) / (S + 1)``, ``S`` being
the class's sum of ``c + 1`` and the 1 left for words never seen.  Weights
are trained in numpy by truncated back-propagation through time over every
training text, whole: a hash of id and text deals the texts to ``ROUNDS`` rounds,
in each of which every task trains its own copy on its texts and Spark averages
the copies by tokens.  A bounded sample (``SAMPLE_TOKENS``) only gives the copies
a common start.  Counts, class sums and vocabulary cover all training texts, too.
Scoring runs over whole texts in windows of
``WINDOW`` tokens that hand on their state, so the score is the
log-likelihood of the complete document.

The words with the highest counts, at most ``TABLE``, go to the tasks as a
sorted array.  All other words of a text leave the task as (hash, number) and
meet their counts in a shuffle join; they add the same term to both scores,
because within a rare class the model, too, uses the counts.

Defined cases: null and empty texts are one end token; with no training text
every count is 0 and the model gives the base score; repeated rows score
alike; an empty table gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import deepcopy
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sameitem.llm.common import Words, batch_words, batches, mix64, prepared, stage, table, unstage, utf8
from sameitem.llm.gru import F32, Adam, Cell, recurrent, run_back, run_traced

VOCABULARY = 2048
CLASS_WORDS = 32
RARE_CLASSES = 32
HIDDEN = 24
WINDOW = 32
LANES = 64
#: Tokens whose classes one product holds (so that it stays in a core's cache).
BLOCK = 2048
EPOCHS = 4
RATE = 0.01
#: Bound of the sample the weights start on; of a longer text one stretch of characters is taken.
SAMPLE_TOKENS = 400_000
SAMPLE_DOCS = 3000
SAMPLE_CHARS = 20_000
#: Rounds that together learn from every training text once; a hash of id and text deals the texts to them.
ROUNDS = 2
ROUND_RATE = 0.005
ROUND_LANES = 512
#: Tokens that a task of a round holds and trains on at a time.
STRETCH = 1 << 19
#: Bytes of text that are scored side by side (a longer text alone).
SCORE_BYTES = 24 << 20
#: Weights of one row of the sums that are averaged, and sums that one task adds at a time.
CHUNK = 1 << 14
TEAM = 64
#: Words whose counts tasks hold (16 bytes each).
TABLE = 500_000
END = np.uint64(0x0E17D0F7E87B0001)


def held_out(modulus: int = 7, remainder: int = 2) -> Column:
    """``crc32(doc_id as text) mod modulus = remainder``."""
    return F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % modulus == remainder


def rare_class(words: Words) -> np.ndarray:
    """Class of each word by its last two bytes (A-Z lower-cased)."""
    low = np.arange(256, dtype=np.int64)
    low[0x41:0x5B] += 32
    last = low[words.data[words.end - 1]]
    before = np.where(words.end - words.start > 1, low[words.data[np.maximum(words.end - 2, 0)]], 0)
    return (mix64((last * 256 + before).astype(np.uint64)) % np.uint64(RARE_CLASSES)).astype(np.int64)


def token_stream(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and rare classes of a step's tokens, an end after each text, and the texts' bounds."""
    n = words.last - words.first
    bounds = words.bounds() + np.arange(n + 1)
    hashes = np.empty(len(words.hash) + n, np.uint64)
    rare = np.zeros(len(hashes), np.int64)
    at = np.arange(len(words.hash)) + words.text
    hashes[at], rare[at] = words.hash, rare_class(words)
    hashes[bounds[1:] - 1] = END
    return hashes, rare, bounds


def token_counts(docs: DataFrame) -> DataFrame:
    """``token, rare, c``: how often each token occurs in ``docs``, ends included."""

    def count(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches(records, 4096):
            for words in batch_words(batch.column(0)):
                hashes, rare, _ = token_stream(words)
                token, first, n = np.unique(hashes, return_index=True, return_counts=True)
                held.append((token, rare[first], n))
                size += len(token)
                if size > 2_000_000:
                    held = [_merged(held)]
                    size = len(held[0][0])
                    if size > 1_500_000:
                        yield _count_batch(held.pop())
                        size = 0
        if held:
            yield _count_batch(_merged(held))

    return (docs.select("text").mapInArrow(count, "token long, rare int, c long")
            .groupBy("token").agg(F.max("rare").alias("rare"), F.sum("c").alias("c")))


def _merged(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    token, rare, n = (np.concatenate(x) for x in zip(*held, strict=True))
    key, first, at = np.unique(token, return_index=True, return_inverse=True)
    return key, rare[first], np.bincount(at, n, len(key)).astype(np.int64)


def _count_batch(counts: tuple) -> pa.RecordBatch:
    token, rare, n = counts
    return pa.RecordBatch.from_arrays(
        [pa.array(token.view(np.int64)), pa.array(rare.astype(np.int32)), pa.array(n.astype(np.int64))], ["token", "rare", "c"])


@dataclass
class Counts:
    """What tasks need of the corpus counts."""

    token: np.ndarray     # sorted hashes of the words held here
    c: np.ndarray
    symbol: np.ndarray    # index in the vocabulary, or -1
    total: int            # N
    distinct: int         # V
    least: int            # words counted less often are not held
    rare_sum: np.ndarray  # by rare class: sum of c + 1 over its words
    size: int             # of the vocabulary

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and vocabulary index of tokens (0 and -1 if not held)."""
        if not len(self.token):
            return np.zeros(len(hashes), np.int64), np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.token, hashes), len(self.token) - 1)
        hit = self.token[at] == hashes
        return np.where(hit, self.c[at], 0), np.where(hit, self.symbol[at], -1)


def gather_counts(counts: DataFrame, most: int = TABLE, vocabulary: int = VOCABULARY) -> Counts:
    """Totals over all counts, and the table of the most frequent words (at most ``most``)."""
    sums = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    least, left = 1, sums["v"] or 0
    if left > most:
        # Words by count: the least count whose words fit the table.  A few thousand rows at most here:
        # counts of 1 to 4096 apart, above that by powers of two.
        tier = F.when(F.col("c") <= 4096, F.col("c")).otherwise(
            F.pow(F.lit(2.0), F.floor(F.log2(F.col("c").cast("double")))).cast("long"))
        for row in counts.groupBy(tier.alias("tier")).count().orderBy("tier").collect():
            if left <= most:
                break
            least = row["tier"] + 1 if row["tier"] < 4096 else 2 * row["tier"]
            left -= row["count"]
    held = counts.where(F.col("c") >= least).toPandas()
    held = held.sort_values(["c", "token"], ascending=[False, True], kind="stable")
    symbol = np.full(len(held), -1)
    symbol[:vocabulary] = np.arange(min(vocabulary, len(held)))
    token = held["token"].to_numpy(np.int64).view(np.uint64)
    end = np.flatnonzero(token == END)
    if len(end) and symbol[end[0]] < 0:
        symbol[end[0]], symbol[vocabulary - 1] = vocabulary - 1, -1
    size = int((symbol >= 0).sum())
    sums_by = counts.groupBy("rare").agg(F.sum(F.col("c") + 1).alias("s")).collect()
    rare_sum = np.zeros(RARE_CLASSES)
    for r in sums_by:
        rare_sum[r["rare"]] = r["s"]
    known = symbol >= 0
    np.subtract.at(rare_sum, held["rare"].to_numpy()[known], held["c"].to_numpy()[known] + 1)
    order = np.argsort(token)
    return Counts(token[order], held["c"].to_numpy(np.int64)[order], symbol[order], int(sums["n"] or 0),
                  int(sums["v"] or 0), int(least), rare_sum, size)


def _log_share(z: np.ndarray, bias: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Log softmax of the columns of ``z + bias`` at row ``hit``; ``z`` is overwritten."""
    z += bias[:, None]
    z -= z.max(axis=0)
    own = z[hit, np.arange(len(hit))]
    return own - np.log(np.exp(z, out=z).sum(axis=0))


def _share_error(z: np.ndarray, bias: np.ndarray, hit: np.ndarray, over: int) -> np.ndarray:
    """Softmax of the columns of ``z + bias`` less 1 at row ``hit``, divided by ``over``; ``z`` is overwritten."""
    z += bias[:, None]
    z -= z.max(axis=0)
    np.exp(z, out=z)
    z *= F32(1 / over) / z.sum(axis=0)
    z[hit, np.arange(len(hit))] -= F32(1 / over)
    return z


class Model:
    """GRU over tokens; classes of vocabulary words first, then the rare classes."""

    def __init__(self, size: int, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.size = size
        self.groups = -(-size // CLASS_WORDS)
        inputs, classes = self.groups * CLASS_WORDS + RARE_CLASSES, self.groups + RARE_CLASSES
        self.gate = rng.normal(0, 0.3, (inputs, 3 * HIDDEN)).astype(F32)  # a token's gate inputs
        self.u = recurrent(rng, HIDDEN)
        self.cls = rng.normal(0, 0.1, (HIDDEN, classes)).astype(F32)
        self.cls_bias = np.zeros(classes, F32)
        self.word = rng.normal(0, 0.1, (max(self.groups, 1), HIDDEN, CLASS_WORDS)).astype(F32)
        self.word_bias = np.zeros((max(self.groups, 1), CLASS_WORDS), F32)
        if size % CLASS_WORDS:
            self.word_bias[-1, size % CLASS_WORDS:] = -30

    def index(self, symbol: np.ndarray, rare: np.ndarray) -> np.ndarray:
        """Input number of each token."""
        return np.where(symbol >= 0, symbol, self.groups * CLASS_WORDS + rare)

    def classes(self, index: np.ndarray) -> np.ndarray:
        edge = self.groups * CLASS_WORDS
        return np.where(index < edge, index // CLASS_WORDS, self.groups + index - edge)

    def start(self, end: int) -> int:
        """The token before the first: an end."""
        return end

    def log_likelihood(self, states: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Natural log of P(class), times P(word | class) for vocabulary words, of each token.

        Classes and words run down the rows of the products, so that sums over them go through whole rows.
        """
        cls = self.classes(index)
        out = np.empty(len(index), F32)
        for at in range(0, len(index), BLOCK):
            part = slice(at, at + BLOCK)
            out[part] = _log_share(self.cls.T @ states[part].T, self.cls_bias, cls[part])
        order, states, groups = self._by_group(cls, states)
        within, word = index[order] % CLASS_WORDS, np.empty(len(order), F32)
        for g, part in groups:
            word[part] = _log_share(self.word[g].T @ states[part].T, self.word_bias[g], within[part])
        out[order] += word
        return out

    def _by_group(self, cls: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, slice]]]:
        """Places and states of the vocabulary words in order of their classes, and each class's slice of these."""
        order = np.argsort(cls.astype(np.int16), kind="stable")
        edges = np.searchsorted(cls[order], np.arange(self.groups + 1))
        order = order[:edges[-1]]
        groups = [(g, slice(edges[g], edges[g + 1])) for g in np.flatnonzero(np.diff(edges))]
        return order, states.take(order, axis=0), groups

    def copy(self) -> Model:
        """A model with weights of its own."""
        return deepcopy(self)

    def params(self) -> list[np.ndarray]:
        return [self.gate, self.u, self.cls, self.cls_bias, self.word, self.word_bias]

    def train(self, stream: np.ndarray, first: int, lanes: int = LANES, epochs: int = EPOCHS, rate: float = RATE) -> Model:
        """Truncated back-propagation through time over ``lanes`` parallel stretches of the stream."""
        lanes = max(1, min(lanes, len(stream) // 64))
        length = len(stream) // lanes
        if not length:
            return self
        rows = stream[:lanes * length].reshape(lanes, length)
        # The output biases start at the sample's frequencies.
        cls = self.classes(rows.ravel())
        self.cls_bias[:] = np.log(np.bincount(cls, minlength=len(self.cls_bias)) + 0.5)
        n = np.bincount(rows[rows < self.groups * CLASS_WORDS], minlength=self.groups * CLASS_WORDS)
        if self.groups:
            start = np.log(n + 0.5).reshape(self.groups, CLASS_WORDS)
            self.word_bias = np.where(self.word_bias < -1, self.word_bias, start).astype(F32)
        adam = Adam(self.params(), rate)
        for epoch in range(epochs):
            adam.rate = rate * (1.0, 1.0, 0.5, 0.2)[min(3, epoch * 4 // max(epochs, 1))]
            self.learn(rows, first, adam)
        return self

    def learn(self, rows: np.ndarray, first: int, adam: Adam) -> None:
        """One pass over stretches of a stream, side by side."""
        h = np.zeros((len(rows), HIDDEN), F32)
        before = np.full(len(rows), first)
        for at in range(0, rows.shape[1], WINDOW):
            target = rows[:, at:at + WINDOW]
            given = np.concatenate([before[:, None], target[:, :-1]], axis=1)
            grads, h = self._window(given, target, h)
            adam.update(grads)
            before = target[:, -1]

    def _window(self, given: np.ndarray, target: np.ndarray, h: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        lanes, time = given.shape
        inputs, index = given.T.ravel(), target.T.ravel()
        states, h, trace = run_traced(self.gate, given.T, h, self.u)
        flat, cls, n = states.reshape(-1, HIDDEN), self.classes(index), lanes * time
        back = np.empty((n, HIDDEN), F32)
        g_cls, g_cls_bias = np.zeros_like(self.cls), np.zeros_like(self.cls_bias)
        g_word, g_bias = np.zeros_like(self.word), np.zeros_like(self.word_bias)
        for at in range(0, n, BLOCK):
            part = slice(at, at + BLOCK)
            z = _share_error(self.cls.T @ flat[part].T, self.cls_bias, cls[part], lanes)
            g_cls += (z @ flat[part]).T
            g_cls_bias += z.sum(axis=1)
            back[part] = z.T @ self.cls.T
        order, flat, groups = self._by_group(cls, flat)
        within, from_word = index[order] % CLASS_WORDS, np.empty((len(order), HIDDEN), F32)
        for g, part in groups:
            w = _share_error(self.word[g].T @ flat[part].T, self.word_bias[g], within[part], lanes)
            g_word[g], g_bias[g] = (w @ flat[part]).T, w.sum(axis=1)
            np.matmul(w.T, self.word[g].T, out=from_word[part])
        back[order] += from_word
        gates, g_u = run_back(back.reshape(time, lanes, HIDDEN), trace, self.u)
        g_gate = np.zeros_like(self.gate)
        order = np.argsort(inputs.astype(np.int16), kind="stable")
        gates = gates.reshape(n, -1)
        for at in range(0, n, BLOCK):
            part = order[at:at + BLOCK]
            token, start = np.unique(inputs[part], return_index=True)
            g_gate[token] += np.add.reduceat(gates.take(part, axis=0), start, axis=0)
        return [g_gate, g_u, g_cls, g_cls_bias, g_word, g_bias], h

    def score(self, index: np.ndarray, bounds: np.ndarray, first: int, block: int = 1 << 15) -> np.ndarray:
        """Log-likelihood (natural) of each text's tokens, whole texts side by side.

        Texts run from the longest; each window of steps hands its states to
        the next, and texts that have ended drop out between windows.
        """
        size = np.diff(bounds)
        order = np.argsort(-size, kind="stable")
        size, begin = size[order], bounds[:-1][order]
        total = np.zeros(len(size))
        h = np.zeros((len(size), HIDDEN), F32)
        cell = Cell(self.gate, self.u)
        at = 0
        while at < (size[0] if len(size) else 0):
            live = int(np.searchsorted(-size, -at, side="left"))
            # At least until the shortest text ends, so that a few long ones run in few windows.
            many = min(int(size[0]) - at, max(WINDOW, int(size[live - 1]) - at), max(1, block // live))
            steps = np.arange(at, at + many)[:, None]
            place = np.minimum(begin[:live] + steps, begin[:live] + size[:live] - 1)
            before = index[np.maximum(place - 1, 0)]
            if not at:
                before[0] = first
            states, h = cell.run(before, h[:live])
            on = np.flatnonzero((steps < size[:live]).ravel())
            states, target = states.reshape(-1, HIDDEN), index[place].ravel()
            if len(on) < len(target):
                states, target = states.take(on, axis=0), target[on]
            total[:live] += np.bincount(on % live, self.log_likelihood(states, target), live)
            at += many
        out = np.empty(len(total))
        out[order] = total
        return out


def sample_stream(docs: DataFrame, counts: Counts, model: Model, tokens: int = SAMPLE_TOKENS) -> np.ndarray:
    """At most ``tokens`` tokens of at most :data:`SAMPLE_DOCS` training texts, chosen by a hash of id and text."""
    n = docs.count()
    share = min(1.0, 1.2 * SAMPLE_DOCS / max(n, 1))
    cell = F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(1 << 30))
    stretches = F.greatest(F.ceil(F.length("text") / SAMPLE_CHARS), F.lit(1))
    some = F.substring(F.col("text"), (cell % stretches * SAMPLE_CHARS + 1).cast("int"), F.lit(SAMPLE_CHARS))
    rows = (docs.where(cell < int(share * (1 << 30))).select("doc_id", some.alias("text"), cell.alias("cell"))
            .orderBy("cell", "doc_id", "text").limit(SAMPLE_DOCS))
    parts, size = [], 0
    for batch in [rows.toArrow().combine_chunks().to_batches()] if n else []:
        for b in batch:
            for words in batch_words(b.column(1)):
                hashes, rare, _ = token_stream(words)
                parts.append(model.index(counts.look_up(hashes)[1], rare))
                size += len(hashes)
                if size >= tokens:
                    return np.concatenate(parts)[:tokens]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def pieces(records: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Cut batches of ``doc_id, text`` into pieces of at most ``most`` bytes of text, one row at least."""
    for batch in records:
        offsets, at = utf8(batch.column(1))[0], 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def stretches(records: Iterator[pa.RecordBatch], counts: Counts, model: Model, most: int) -> Iterator[np.ndarray]:
    """The token stream of a task's texts, in pieces of at least ``most`` tokens but for the last."""
    parts, size = [], 0
    for batch in batches(records):
        for words in batch_words(batch.column(0)):
            hashes, rare, _ = token_stream(words)
            parts.append(model.index(counts.look_up(hashes)[1], rare))
            size += len(hashes)
            if size >= most:
                yield np.concatenate(parts)
                parts, size = [], 0
    if size:
        yield np.concatenate(parts)


def side_by_side(stream: np.ndarray, lanes: int, every: bool) -> np.ndarray:
    """A stream as at most ``lanes`` stretches of one length.

    ``every``: the last stretch begins early enough to end with the stream; else tokens beyond full stretches are left.
    """
    if not every:
        return stream[:len(stream) // lanes * lanes].reshape(lanes, -1)
    length = -(-len(stream) // lanes)
    begin = np.minimum(np.arange(-(-len(stream) // length)) * length, len(stream) - length)
    return stream[begin[:, None] + np.arange(length)]


SUMS = "member int, chunk int, n long, w binary"


def _added(rows: pa.Table) -> pa.Table:
    """Sum of the copies of one chunk, in order of their members."""
    rows = rows.sort_by("member")
    total = np.zeros(0)
    for w in rows.column("w"):
        w = np.frombuffer(w.as_buffer(), np.float64)
        total = w + total if len(total) else w
    return pa.table({"member": pa.array([rows.column("member")[0].as_py() // TEAM], pa.int32()),
                     "chunk": pa.array([rows.column("chunk")[0].as_py()], pa.int32()),
                     "n": pa.array([sum(rows.column("n").to_pylist())], pa.int64()), "w": pa.array([total.tobytes()], pa.binary())})


def averaged_round(spark: SparkSession, docs: DataFrame, counts: Counts, model: Model, first: int, rate: float = ROUND_RATE,
                   every: bool = False) -> int:
    """Every task trains a copy of ``model`` on its texts; the model becomes the mean of the copies by tokens.

    The copies' weights are added up in Spark, chunk by chunk, first in teams of
    :data:`TEAM` tasks, again until one team is left; one model reaches the driver.
    Returns the number of tokens learnt from (with ``every`` all, see :func:`side_by_side`); without any the model stays.
    """
    shared = spark.sparkContext.broadcast((counts, model, first, rate))
    tasks = docs.rdd.getNumPartitions()

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, start, first, rate = shared.value
        own, seen = start.copy(), 0
        adam = Adam(own.params(), rate)
        for stream in stretches(records, counts, own, STRETCH):
            lanes = max(1, min(ROUND_LANES, len(stream) // 64))
            rows = side_by_side(stream, lanes, every)
            own.learn(rows, first, adam)
            seen += min(rows.size, len(stream))
        if seen:
            flat = np.concatenate([p.ravel() for p in own.params()]).astype(np.float64) * seen
            member = TaskContext.get().partitionId()
            cut = [flat[i:i + CHUNK].tobytes() for i in range(0, len(flat), CHUNK)]
            yield pa.RecordBatch.from_arrays([
                pa.array([member] * len(cut), pa.int32()), pa.array(range(len(cut)), pa.int32()),
                pa.array([seen] * len(cut), pa.int64()), pa.array(cut, pa.binary())], ["member", "chunk", "n", "w"])

    copies = stage(spark, docs.select("text").mapInArrow(run, SUMS), "lm-copies")
    sums = copies
    while True:
        sums = sums.groupBy(F.floor(F.col("member") / TEAM).alias("team"), "chunk").applyInArrow(_added, SUMS)
        tasks = -(-tasks // TEAM)
        if tasks <= 1:
            break
    parts = sums.orderBy("chunk").toArrow()
    shared.destroy()
    unstage(spark, copies)
    if not parts.num_rows:
        return 0
    seen = parts.column("n")[0].as_py()
    flat = np.concatenate([np.frombuffer(w.as_buffer(), np.float64) for w in parts.column("w")]) / seen
    at = 0
    for p in model.params():
        p[...] = flat[at:at + p.size].reshape(p.shape)
        at += p.size
    return seen


def corpus_rounds(spark: SparkSession, docs: DataFrame, counts: Counts, model: Model, first: int) -> int:
    """:data:`ROUNDS` rounds of averaging, which together learn from every token of ``docs``.  Returns their number."""
    part = F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(ROUNDS))
    return sum(averaged_round(spark, docs.where(part == r), counts, model, first, ROUND_RATE / (1 + r), every=True) for r in range(ROUNDS))


def lm_scores(spark: SparkSession, docs: DataFrame, learn: Column, table_size: int = TABLE) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every whole text.

    ``docs``: ``doc_id`` and ``text``; ``learn`` says which rows the model learns from.
    """
    prepared(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    counts = stage(spark, token_counts(docs.where(learn)), "token-counts")
    known = gather_counts(counts, table_size)
    model = Model(known.size)
    end_symbol = known.look_up(np.array([END]))[1][0]
    first = int(end_symbol) if end_symbol >= 0 else 0
    if known.total:
        model.train(sample_stream(docs.where(learn), known, model), first)
        corpus_rounds(spark, docs.where(learn), known, model, first)
    shared = spark.sparkContext.broadcast((known, model, first))

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model, first = shared.value
        norm = np.log10(known.total + known.distinct + 1)
        shares = np.log10(known.rare_sum + 1)
        for batch in pieces(records, SCORE_BYTES):
            ids, columns = batch.column(0), [[] for _ in range(4)]
            index_parts, bound_parts, extra = [], [np.zeros(1, np.int64)], []
            rare_hash, rare_n, rare_size = [], [], [0]
            at = 0
            for words in batch_words(batch.column(1)):
                hashes, rare, bounds = token_stream(words)
                c, symbol = known.look_up(hashes)
                index = model.index(symbol, rare).astype(np.int32)
                texts = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                n = len(bounds) - 1
                value = np.log10(c + 1.0)
                columns[0].append(np.diff(bounds))
                columns[1].append(np.bincount(texts, c > 0, n).astype(np.int64))
                columns[2].append(np.bincount(texts, value - norm, n))
                lone = symbol < 0
                extra.append(np.bincount(texts[lone], (value - shares[rare])[lone], n))
                index_parts.append(index)
                bound_parts.append(bounds[1:] + at)
                at += len(hashes)
                if known.least > 1:  # words of the long tail: their counts are joined later
                    off = np.flatnonzero(c == 0)
                    order = off[np.lexsort((hashes[off], texts[off]))]
                    t, h = texts[order], hashes[order]
                    new = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (h[1:] != h[:-1])])) if len(t) else order
                    rare_hash.append(h[new])
                    rare_n.append(np.diff(np.append(new, len(t))))
                    rare_size += np.bincount(t[new], minlength=n).tolist()
                else:
                    rare_size += [0] * n
            score = model.score(np.concatenate(index_parts), np.concatenate(bound_parts), first) / np.log(10) \
                if known.total else np.zeros(batch.num_rows)
            n_tokens, n_known, base = (np.concatenate(x) for x in columns[:3])
            score = score + np.concatenate(extra) if known.total else base
            lists = pa.array(np.cumsum(rare_size).astype(np.int32))
            flat_h = np.concatenate(rare_hash) if rare_hash else np.zeros(0, np.uint64)
            flat_n = np.concatenate(rare_n) if rare_n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(n_tokens.astype(np.int64)), pa.array(n_known), pa.array(base), pa.array(score),
                pa.ListArray.from_arrays(lists, pa.array(flat_h.view(np.int64))),
                pa.ListArray.from_arrays(lists, pa.array(flat_n.astype(np.int64)))],
                ["doc_id", "n_tokens", "n_known", "base_score", "score", "tail", "tail_n"])

    scored = docs.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double, "
                                  "tail array<long>, tail_n array<long>")
    total = F.lit(known.total).cast("long").alias("train_tokens")
    if known.least == 1:  # the table holds every word
        return scored.select("doc_id", "n_tokens", "n_known", total, "base_score", "score")
    scored = stage(spark, scored.withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    tail = (scored.select("row", F.explode(F.arrays_zip("tail", "tail_n")).alias("t"))
            .select("row", F.col("t.tail").alias("token"), F.col("t.tail_n").alias("n")))
    found = (tail.join(counts.where(F.col("c") < known.least).select("token", "c"), "token")
             .groupBy("row").agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("gain")))
    gain, more = F.coalesce("gain", F.lit(0.0)), F.coalesce("more", F.lit(0))
    return scored.join(found, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + more).alias("n_known"), total,
        (F.col("base_score") + gain).alias("base_score"), (F.col("score") + gain).alias("score"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = lm_scores(spark, docs, ~held_out())
    return scores.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
