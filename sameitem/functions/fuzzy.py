"""Indel-based string ratios (M1a-M1d), all pairs of an Arrow batch at a time.

Definitions: ``sim(s, t) = 2 * LCS(s, t) / (len s + len t)`` (1 when both are
empty).  The score is the mean of three ratios of two titles:

* token sort: ``sim`` of the titles with their words sorted;
* token set: with ``x`` the shared words and ``p``, ``q`` the words of one title
  only (each sorted and joined), the best ``sim`` among ``x``/``x p``/``x q``,
  where the shared words align with themselves; 0 when a title has no word;
* partial: the best ``sim`` of the shorter title with any window of its length
  of the longer one, windows that hang over either end included; for titles of
  one length, either as the shorter.

LCS lengths come from the bit-parallel recurrence (Hyyro, 2004) in numpy: the
state of one (pair, window start) is a few 64-bit words, and every step advances
all windows of all pairs by one character.  Words are sorted and intersected by
column expressions before the UDF, and the ratios are put together after it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Character comparisons of one numpy step; longer pairs are taken alone.
CELLS = 1 << 23
_NONE = np.uint64(0)


def _codes(texts: list[str], fill: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, padded with ``fill``, and the lengths."""
    size = np.array([len(t) for t in texts], np.int64)
    out = np.full((len(texts), max(1, int(size.max(initial=0)))), fill, np.int32)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out, size


def _masks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair and character of ``b``: the positions of it in ``a``, as words of 64 bits."""
    n, width = a.shape
    padded = np.full((n, -(-width // 64) * 64), -3, np.int32)
    padded[:, :width] = a
    bits = np.packbits(padded[:, None, :] == b[:, :, None], axis=2, bitorder="little")
    return bits.view(np.uint64)


def _advance(state: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """One character: ``(V + (V & m)) | (V - (V & m))`` over several words."""
    out = np.empty_like(state)
    carry = np.zeros(len(state), np.uint64)
    for w in range(state.shape[1]):
        v = state[:, w]
        u = v & mask[:, w]
        s = v + u
        t = s + carry
        carry = ((s < v) | (t < s)).astype(np.uint64)
        out[:, w] = t | (v ^ u)
    return out


def _common(state: np.ndarray, size: np.ndarray) -> np.ndarray:
    """LCS length: zero bits among the first ``size``."""
    bits = np.arange(state.shape[1]) * 64
    keep = np.clip(size[:, None] - bits, 0, 64)
    full = np.where(keep == 64, ~_NONE, (np.uint64(1) << (keep % 64).astype(np.uint64)) - np.uint64(1))
    return size - np.bitwise_count(state & full).sum(axis=1, dtype=np.int64)


def _chunks(a: list[str], b: list[str], windows: bool):
    """Runs of pairs, like lengths together, of at most :data:`CELLS` comparisons."""
    order = sorted(range(len(a)), key=lambda i: (len(a[i]), len(b[i])))
    at = 0
    while at < len(order):
        end, wide, tall = at, 1, 1
        while end < len(order):
            x, y = max(wide, len(a[order[end]])), max(tall, len(b[order[end]]))
            if end > at and (end - at + 1) * y * max(x, y if windows else 1) > CELLS:
                break
            wide, tall, end = x, y, end + 1
        yield order[at:end]
        at = end


def lcs_many(a: list[str], b: list[str]) -> np.ndarray:
    """LCS length of each pair."""
    out = np.zeros(len(a), np.int64)
    for part in _chunks(a, b, False):
        ca, la = _codes([a[i] for i in part], -1)
        cb, lb = _codes([b[i] for i in part], -2)
        masks = _masks(ca, cb)
        state = np.full((len(part), masks.shape[2]), ~_NONE)
        for t in range(int(lb.max(initial=0))):
            state = _advance(state, masks[:, t])
        out[part] = _common(state, la)
    return out


def _windows(short: list[str], long_: list[str]) -> np.ndarray:
    """Best ``sim`` of each short text with the windows of its long one (short not empty, not longer)."""
    out = np.zeros(len(short))
    for part in _chunks(short, long_, True):
        ca, la = _codes([short[i] for i in part], -1)
        cb, lb = _codes([long_[i] for i in part], -2)
        masks = _masks(ca, cb)
        pair = np.repeat(np.arange(len(part)), lb)
        start = np.arange(len(pair)) - np.repeat(np.cumsum(lb) - lb, lb)
        steps = np.minimum(la[pair], lb[pair] - start)
        order = np.argsort(-steps, kind="stable")
        pair, start, steps = pair[order], start[order], steps[order]
        state = np.full((len(pair), masks.shape[2]), ~_NONE)
        best = np.zeros(len(part))
        for t in range(int(steps[0])):
            live = int(np.searchsorted(-steps, -t, side="left"))
            state[:live] = _advance(state[:live], masks[pair[:live], start[:live] + t])
            # A window is whole at its last step; those that hang over the start are the prefixes.
            done = np.flatnonzero((steps[:live] == t + 1) | (start[:live] == 0))
            p = pair[done]
            value = 2.0 * _common(state[done], la[p]) / (la[p] + t + 1)
            np.maximum.at(best, p, value)
        out[part] = best
    return out


def partial_many(a: list[str], b: list[str]) -> np.ndarray:
    """Partial similarity (0..1) of each pair."""
    out = np.zeros(len(a))
    short = [x if len(x) <= len(y) else y for x, y in zip(a, b, strict=True)]
    long_ = [y if len(x) <= len(y) else x for x, y in zip(a, b, strict=True)]
    empty = np.array([not s for s in short], bool)
    out[[i for i in np.flatnonzero(empty) if not long_[i]]] = 1.0
    todo = np.flatnonzero(~empty)
    out[todo] = _windows([short[i] for i in todo], [long_[i] for i in todo])
    even = [i for i in todo if len(short[i]) == len(long_[i]) and out[i] < 1.0]
    if even:
        out[even] = np.maximum(out[even], _windows([long_[i] for i in even], [short[i] for i in even]))
    return out


_MEASURES = T.StructType([T.StructField("lcs_sort", T.LongType()), T.StructField("lcs_rest", T.LongType()),
                          T.StructField("partial", T.DoubleType())])


@F.pandas_udf(_MEASURES)
def _measures(a: pd.Series, b: pd.Series, sort_a: pd.Series, sort_b: pd.Series,
              rest_a: pd.Series, rest_b: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"lcs_sort": lcs_many(sort_a.tolist(), sort_b.tolist()),
                         "lcs_rest": lcs_many(rest_a.tolist(), rest_b.tolist()),
                         "partial": partial_many(a.tolist(), b.tolist())})


def _words(t: Column) -> Column:
    return F.filter(F.split(t, r"(?U)\s+"), lambda w: w != "")


def with_fuzzy(df, left: str, right: str, name: str = "fuzzy"):
    """Append M1, the mean of the three ratios on a 0..1 scale (null counts as empty)."""
    a, b = (F.coalesce(F.col(c), F.lit("")) for c in (left, right))
    df = df.withColumns({"_wa": _words(a), "_wb": _words(b)})
    df = df.withColumns({
        "_sa": F.array_join(F.array_sort("_wa"), " "), "_sb": F.array_join(F.array_sort("_wb"), " "),
        "_ra": F.array_join(F.array_sort(F.array_except("_wa", "_wb")), " "),
        "_rb": F.array_join(F.array_sort(F.array_except("_wb", "_wa")), " "),
        "_x": F.length(F.array_join(F.array_intersect("_wa", "_wb"), " "))})
    df = df.withColumn("_m", _measures(a, b, "_sa", "_sb", "_ra", "_rb"))
    la, lb, ra, rb, x = (F.length(c) if c != "_x" else F.col(c) for c in ("_sa", "_sb", "_ra", "_rb", "_x"))
    gap = F.when(x > 0, 1).otherwise(0)
    sort = F.when(la + lb == 0, 100.0).otherwise(200.0 * F.col("_m.lcs_sort") / (la + lb))

    def near(distance: Column, total: Column) -> Column:
        return F.when(total == 0, 100.0).otherwise(100.0 - 100.0 * distance / total)

    rest = near(ra + rb - 2 * F.col("_m.lcs_rest"), 2 * (x + gap) + ra + rb)
    words = (F.when((F.size("_wa") == 0) | (F.size("_wb") == 0), 0.0)
             .when((x > 0) & ((ra == 0) | (rb == 0)), 100.0)
             .when(x == 0, rest)
             .otherwise(F.greatest(rest, near(gap + ra, 2 * x + gap + ra), near(gap + rb, 2 * x + gap + rb))))
    return (df.withColumn(name, (sort + words + 100.0 * F.col("_m.partial")) / 300.0)
            .drop("_wa", "_wb", "_sa", "_sb", "_ra", "_rb", "_x", "_m"))
