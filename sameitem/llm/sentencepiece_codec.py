"""Operator 9: SentencePiece encoding (unigram Viterbi over a double-array trie) and decoding.

The vocabulary file of a public tokenizer is read once on the driver; its
pieces, log scores and byte pieces become a :class:`Vocabulary` of numpy
arrays (a few hundred kB, bounded by the vocabulary) that tasks share.

Encoding: a space becomes U+2581, one is put in front, and the best path over
the pieces by summed log scores is taken; ties go to the path whose last piece
starts first.  A character that no piece of just that character covers may be
passed at the least score minus 10, and then becomes its UTF-8 byte pieces (or
the unknown id where the vocabulary has none).  Decoding joins the pieces and
bytes, turns U+2581 into a space and drops the one put in front; ill-formed
bytes become U+FFFD.

No piece of the public vocabularies has U+2581 after another character, so the
best path of a text is the best paths of its chunks (markers, then other
characters) side by side; each task keeps the chunks it has solved.  Where a
vocabulary has such a piece, whole texts are the chunks.

Defined cases: null and empty text have no ids and decode to the empty string;
a text with a literal U+2581 decodes to a space there; repeated rows are
encoded alike; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sameitem.llm.common import batches, prepared, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: A character without a piece costs this much more than the worst piece.
UNKNOWN_PENALTY = 10.0
#: Solved chunks that a task keeps before it starts anew.
CACHE = 400_000
#: Chunks solved together, and places in them (some 40 bytes each).
GROUP = 20_000
CELLS = 1 << 18


@dataclass
class Vocabulary:
    base: np.ndarray      # double array: next state = base[state] + byte
    check: np.ndarray     # owner of a state
    value: np.ndarray     # piece id that ends in a state, or -1
    score: np.ndarray     # by piece id
    pieces: list[bytes]   # what each id decodes to
    byte_ids: np.ndarray  # id of each byte piece, or -1
    unknown: int
    longest: int          # bytes of the longest piece
    chunked: bool
    newline: bool         # some piece has a line feed

    @property
    def unknown_score(self) -> float:
        return float(self.score[self.value[self.value >= 0]].min()) - UNKNOWN_PENALTY


def double_array(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Double-array trie (Aoe, 1989) of ``words``; the value is the index in the list."""
    root: dict = {}
    for i, w in enumerate(words):
        node = root
        for b in w:
            node = node.setdefault(b, {})
        node[-1] = i
    size = 1 << 16
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used = np.zeros(size, bool)
    used[0] = True
    todo, free, window = [(0, root)], 1, 1024
    for state, node in todo:
        value[state] = node.get(-1, -1)
        keys = np.array(sorted(k for k in node if k >= 0), dtype=np.int64)
        if not len(keys):
            continue
        at = max(1, free - int(keys[0]))
        while True:
            while at + window + 512 > size:
                base, check, value = (np.concatenate([a, np.full(size, f, np.int32)])
                                      for a, f in ((base, 0), (check, -1), (value, -1)))
                used, size = np.concatenate([used, np.zeros(size, bool)]), 2 * size
            fits = ~used[at + keys[0]:at + keys[0] + window]
            for k in keys[1:]:
                fits &= ~used[at + k:at + k + window]
            first = int(fits.argmax())
            if fits[first]:
                at += first
                break
            at += window
        base[state] = at
        used[at + keys] = True
        check[at + keys] = state
        while used[free]:
            free += 1
        todo.extend((at + int(k), node[int(k)]) for k in keys)
    pad = 512
    return base, np.concatenate([check, np.full(pad, -1, np.int32)]), np.concatenate([value, np.full(pad, -1, np.int32)])


@lru_cache(maxsize=2)
def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Read pieces, scores and byte pieces of a SentencePiece file (driver side)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    score = np.array([sp.get_score(i) for i in range(n)])
    byte_ids, pieces, words, ids = np.full(256, -1), [], [], []
    for i in range(n):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte = int(piece[3:5], 16)
            byte_ids[byte] = i
            pieces.append(bytes([byte]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            pieces.append(" ⁇ ".encode() if sp.is_unknown(i) else b"")
        else:
            pieces.append(piece.encode())
            words.append(piece)
            ids.append(i)
    base, check, value = double_array([w.encode() for w in words])
    value = np.where(value >= 0, np.array(ids + [0])[value], -1).astype(np.int32)
    return Vocabulary(base, check, value, score, pieces, byte_ids, sp.unk_id(),
                      max(len(w.encode()) for w in words),
                      not any(MARK in w.lstrip(MARK) for w in words), any("\n" in w for w in words))


def viterbi(vocab: Vocabulary, chunks: list[bytes]) -> list[bytes]:
    """Ids (int32, as bytes) of the best path of each chunk, all chunks at a time."""
    n = len(chunks)
    length = np.array([len(c) for c in chunks])
    width = int(length.max())
    text = np.zeros((n, width + 1), np.int32)
    flat = np.frombuffer(b"".join(chunks), np.uint8)
    row = np.repeat(np.arange(n), length)
    text[row, np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
    best = np.full((n, width + 1), -np.inf)
    best[:, 0] = 0.0
    back = np.zeros((n, width + 1), np.int32)
    piece = np.full((n, width + 1), -1, np.int32)
    lead = text[:, :width]
    char = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
    unknown = vocab.unknown_score
    for i in range(width):
        alive = np.flatnonzero((best[:, i] > -np.inf) & (i < length))
        if not len(alive):
            continue
        here, size = best[alive, i], char[alive, i]
        single = np.zeros(len(alive), bool)
        rows, index = alive, np.arange(len(alive))
        state = np.zeros(len(alive), np.int32)
        for d in range(min(vocab.longest, width - i)):
            step = vocab.base[state] + text[rows, i + d]
            ok = (vocab.check[step] == state) & (i + d < length[rows])
            rows, index, state = rows[ok], index[ok], step[ok]
            if not len(rows):
                break
            found = vocab.value[state]
            hit = np.flatnonzero(found >= 0)
            if len(hit):
                r, k, end = rows[hit], index[hit], i + d + 1
                single[k[size[k] == d + 1]] = True
                value = here[k] + vocab.score[found[hit]]
                up = value > best[r, end]
                r = r[up]
                best[r, end], back[r, end], piece[r, end] = value[up], i, found[hit][up]
        lone = np.flatnonzero(~single)
        if len(lone):
            r = alive[lone]
            end = np.minimum(i + size[lone], length[r])
            value = here[lone] + unknown
            up = value > best[r, end]
            r, end = r[up], end[up]
            best[r, end], back[r, end], piece[r, end] = value[up], i, -1
    out: list[list[int]] = [[] for _ in range(n)]
    many: list[bytes] = []
    at = length.copy()
    steps_row, steps_piece, steps_from, steps_to = [], [], [], []
    rows = np.flatnonzero(at > 0)
    while len(rows):
        end = at[rows]
        steps_row.append(rows)
        steps_piece.append(piece[rows, end])
        steps_from.append(back[rows, end])
        steps_to.append(end)
        at[rows] = back[rows, end]
        rows = rows[at[rows] > 0]
    if not steps_row:
        return [b""] * n
    r, p = np.concatenate(steps_row), np.concatenate(steps_piece)
    f, t = np.concatenate(steps_from), np.concatenate(steps_to)
    order = np.lexsort((f, r))
    r, p, f, t = r[order], p[order], f[order], t[order]
    odd = set(r[p < 0].tolist())
    ends = np.searchsorted(r, np.arange(n + 1))
    ids = p.astype(np.int32).tobytes()
    for w in range(n):
        a, b = int(ends[w]), int(ends[w + 1])
        if w not in odd:
            many.append(ids[4 * a:4 * b])
            continue
        for k in range(a, b):
            if p[k] >= 0:
                out[w].append(int(p[k]))
            else:
                raw = vocab.byte_ids[text[w, f[k]:t[k]]]
                out[w].extend(raw.tolist() if (raw >= 0).all() else [vocab.unknown])
        many.append(np.array(out[w], np.int32).tobytes())
    return many


def viterbi_one(vocab: Vocabulary, chunk: bytes) -> bytes:
    """The same best path for one chunk, in memory that grows with its length alone (long chunks)."""
    n = len(chunk)
    best, back, piece = [float("-inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
    best[0] = 0.0
    base, check, value, score = vocab.base, vocab.check, vocab.value, vocab.score
    unknown = vocab.unknown_score
    for i in range(n):
        here = best[i]
        if here == float("-inf"):
            continue
        b = chunk[i]
        size = 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
        state, single = 0, False
        for d in range(min(vocab.longest, n - i)):
            step = int(base[state]) + chunk[i + d]
            if check[step] != state:
                break
            state = step
            found = int(value[state])
            if found >= 0:
                single |= d + 1 == size
                s = here + score[found]
                if s > best[i + d + 1]:
                    best[i + d + 1], back[i + d + 1], piece[i + d + 1] = s, i, found
        end = min(n, i + size)
        if not single and here + unknown > best[end]:
            best[end], back[end], piece[end] = here + unknown, i, -1
    out: list[int] = []
    at = n
    while at > 0:
        if piece[at] >= 0:
            out.append(piece[at])
        else:
            raw = [int(vocab.byte_ids[c]) for c in chunk[back[at]:at]]
            out.extend(reversed(raw) if min(raw) >= 0 else [vocab.unknown])
        at = back[at]
    return np.array(out[::-1], np.int32).tobytes()


class Encoder:
    """Encodes texts, keeping the chunks solved so far (at most :data:`CACHE`)."""

    LONG = 64

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.known = vocab, {}
        split = f"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if not vocab.newline else f"{MARK}*[^{MARK}]+|{MARK}+"
        self.find = re.compile(split).findall if vocab.chunked else (lambda t: [t])

    def _solve(self, new: list[str]) -> None:
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
        pairs = sorted(((c.encode(), c) for c in new), key=lambda x: len(x[0]))
        short = [x for x in pairs if len(x[0]) <= self.LONG]
        at = 0
        while at < len(short):  # the shortest first: a group is as wide as its last chunk
            end = at + 1
            while end < len(short) and end - at < GROUP and (end + 1 - at) * (len(short[end][0]) + 1) <= CELLS:
                end += 1
            part, at = short[at:end], end
            self.known.update(zip([c for _, c in part], viterbi(self.vocab, [b for b, _ in part]), strict=True))
        for raw, c in pairs[len(short):]:
            self.known[c] = viterbi_one(self.vocab, raw)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        cut = [self.find((MARK + t.replace(" ", MARK))) if t else [] for t in texts]
        new = {c for chunks in cut for c in chunks} - self.known.keys()
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = {c for chunks in cut for c in chunks}
        if new:
            self._solve(list(new))
        known = self.known
        return [b"".join([known[c] for c in chunks]) for chunks in cut]


def decode_ids(vocab: Vocabulary, ids: np.ndarray) -> str:
    """Text of one document's ids."""
    raw = b"".join([vocab.pieces[i] for i in ids.tolist()]).decode("utf-8", "replace").replace(MARK, " ")
    return raw[1:] if raw[:1] == " " else raw


def encode_documents(spark: SparkSession, docs: DataFrame, path: str = MODEL, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default ``doc_id``) plus ``ids`` of every document's whole text."""
    keep = keep or ["doc_id"]
    vocab = prepared(spark).sparkContext.broadcast(load_vocabulary(path))
    picked = docs.select(*[F.col(c) for c in keep], F.col("text").alias("_text"))
    schema = picked.drop("_text").withColumn("ids", F.array().cast("array<int>")).schema

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocab.value)
        for batch in batches(records, 512):
            ids = encoder.encode(batch.column(len(keep)).to_pylist())
            size = np.array([0, *[len(x) // 4 for x in ids]], np.int64).cumsum().astype(np.int32)
            values = pa.ListArray.from_arrays(pa.array(size), pa.array(np.frombuffer(b"".join(ids), np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], values], [*keep, "ids"])

    return picked.mapInArrow(run, schema)


def decode_documents(spark: SparkSession, encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """Add ``decoded``: the text of each row's ``ids`` (null ids: empty)."""
    vocab = prepared(spark).sparkContext.broadcast(load_vocabulary(path))
    keep = [c for c in encoded.columns if c != "decoded"]
    source = encoded.select(*keep)
    schema = source.withColumn("decoded", F.lit("").cast("string")).schema
    at = keep.index("ids")

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(records, 512):
            ids = batch.column(at)
            bounds = ids.offsets.to_numpy()
            flat = np.asarray(ids.values)
            texts = [decode_ids(vocab.value, flat[bounds[i]:bounds[i + 1]]) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*keep, "decoded"])

    return source.mapInArrow(run, schema)


def encode_checked(spark: SparkSession, docs: DataFrame, path: str = MODEL) -> DataFrame:
    """Encode every whole text and decode it again, in one pass.

    Returns ``doc_id, n_tokens, ids, round_trip, decoded_crc32``: ``round_trip``
    says whether decoding gave the text back (null: the empty string).
    """
    vocab = prepared(spark).sparkContext.broadcast(load_vocabulary(path))

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        encoder = Encoder(vocab.value)
        for batch in batches(records, 512):
            texts = batch.column(1).to_pylist()
            ids = encoder.encode(texts)
            decoded = [decode_ids(vocab.value, np.frombuffer(x, np.int32)) for x in ids]
            size = np.array([0, *[len(x) // 4 for x in ids]], np.int64).cumsum().astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array(np.diff(size).astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(size), pa.array(np.frombuffer(b"".join(ids), np.int32))),
                pa.array([d == (t or "") for d, t in zip(decoded, texts, strict=True)], pa.bool_()),
                pa.array([zlib.crc32(d.encode()) for d in decoded], pa.int64()),
            ], ["doc_id", "n_tokens", "ids", "round_trip", "decoded_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids array<int>, round_trip boolean, decoded_crc32 long")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_checked(spark, table(spark, sf_dir, "documents"))
