"""Operator 4: n-gram Jaccard self-join through a token-group matrix.

A document is the set of hashes of its 5-word shingles.  Two documents link
when their Jaccard similarity is at least 0.8; the result is each document's
component.  The join never emits the pairs inside a group of copies:

1. :func:`shingle_sets` - one pass over the texts gives each set's size, its
   128-bit key (documents of equal sets are one *set* from here on), its tokens
   as a bitmap (:func:`set_bits`, half a byte to a byte a token) and its
   *prefix*: the first ``n - ceil(0.8 n) + 1`` tokens, rarest first.  Two sets
   that link share a token of their prefixes, whatever the order (Chaudhuri et
   al., 2006); the tokens counted most often come last, so shared passages
   stay out of nearly all prefixes.
2. Tokens in the prefixes of two sets at least are *contested*; all other sets
   are alone already.  Only contested rows are kept.
3. Grouping - :data:`ROUNDS` times, each set meets the least set of another
   group under the tokens it shares most (at most :data:`HUBS` a set, of a size
   and with tokens near to what a link takes), and what links becomes one group.
4. Token-group matrix - similar sets are one group, linked or not: a set's
   group is the least component that holds the most of its tokens.  The matrix says which
   groups' token unions have a contested token, and the sizes of the sets that hold
   it; a set meets the groups that hold as many of its own as a link takes
   (:func:`least_shared`), so a token or two in common bring nobody together.
   Only the bitmaps of sets in such meetings are fetched.  Groups are cut into chunks
   of about :data:`CHUNK` sets of one band of sizes.  A chunk is opened if the set's
   overlap with the chunk's whole token union, as a bitmap, can reach the threshold,
   and then its members of other components are compared.

A bitmap has a bit for each residue of the token hashes.  A bit of one set that
another lacks is a token that the other lacks, so bits bound the overlap from
above and drop no link.  Pairs that pass are compared exactly, from the texts;
only the texts of sets in such pairs are fetched.

Step 4 alone is exact, step 3 may pass over links; it makes step 4 cheap, because tokens that only one
group holds leave the matrix.  So no link between two groups is lost, and
links inside one group are not needed for the components.

Hashes have 64 bits for tokens and 128 for sets.

Defined cases: null, empty and wordless texts have no set (``n_shingles`` 0)
and are their own component; with fewer words than five the whole sequence is
the one shingle; a null ``doc_id`` takes part but never names a component;
repeated rows are rows of one set; an empty table gives no rows; columns other
than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sameitem.llm.common import SMALL_STEP, batch_words, batches, mix64, prepared, shingle_hashes, small_batches, stage, table, unstage
from sameitem.operators.components import connected_components

WORDS = 5
THRESHOLD = 80  # per cent
#: Tokens that a task counts together.
COUNTED = 1 << 21
#: Tokens ordered last, by their count over all documents.  Only the order depends on the bound.
COMMON = 1 << 19
ROUNDS = 2
HUBS = 2
#: Part of the tokens that a link takes which a set must share with a hub (it may share the rest under other hubs).
HUB_SHARE = 4
CHUNK = 32
#: Bits of the filters of contested tokens and of wanted documents (false hits only cost work).
TOKEN_BITS = 27
DOCUMENT_BITS = 24


# -- sets ------------------------------------------------------------------
def text_sets(column: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a batch."""
    for step in batch_words(column, most=SMALL_STEP):
        at = step.bounds()
        for i in range(step.last - step.first):
            yield np.unique(shingle_hashes(step.hash[at[i]:at[i + 1]], words))


def prefix_size(n: int, threshold: int = THRESHOLD) -> int:
    return n - -(-threshold * n // 100) + 1 if n else 0


def least_shared(n: Column, low: Column, high: Column, threshold: int = THRESHOLD) -> Column:
    """Tokens, at least, that the prefixes of a set of size ``n`` and of one of a size from ``low`` to ``high`` share if they link.

    Sets of sizes n and m that link have ``both = ceil(t * (n + m) / (1 + t))`` tokens in common.  The k-th of
    them has ``both - k`` more after it in either set, so it lies in the first ``n - both + k`` of one and
    ``m - both + k`` of the other: the prefixes share as many as their sizes exceed ``n - both`` and ``m - both``.
    The first of these two grows with m, the second (rounded down) falls.
    """
    t, either = threshold, 100 + threshold
    low, high = F.greatest(low, F.ceil(t * n / 100)), F.least(high, F.floor(100 * n / t))
    return F.least(1 - F.ceil(t * n / 100) + F.ceil(t * (n + low) / either), 1 + F.floor((100 * t * n - t * t * high) / (100 * either)))


def sizes_near(n: Column, low: Column, high: Column, threshold: int = THRESHOLD) -> Column:
    """Whether a set of size ``n`` can link with one of a size from ``low`` to ``high``."""
    return (100 * high >= threshold * n) & (100 * n >= threshold * low)


def linked(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    """Whether two sorted sets are similar enough: ``100 * both >= threshold * either``."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < threshold * len(large):
        return False
    both = overlap(small, large)
    return 100 * both >= threshold * (len(a) + len(b) - both)


def overlap(small: np.ndarray, large: np.ndarray) -> int:
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    return int(np.count_nonzero(large[at] == small)) if len(large) else 0


def set_key(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that do not depend on order (as signed numbers)."""
    a = mix64(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    b = mix64(tokens ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    n = np.array([len(tokens)], np.uint64)
    both = np.concatenate([mix64(a + n), mix64(b ^ n)]).view(np.int64)
    return int(both[0]), int(both[1])


def set_bits(tokens: np.ndarray) -> bytes:
    """Bitmap of a set: ``size`` bits, a power of two of at least four times the tokens; bit ``token mod size``."""
    size = max(64, 1 << (4 * len(tokens) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[(tokens & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """The same bitmap at a smaller size (bytes, a power of two)."""
    while len(bits) > size:
        half = len(bits) // 2
        bits = bits[:half] | bits[half:]
    return bits


def missing(a: np.ndarray, b: np.ndarray) -> int:
    """Tokens, at least, of the set of bitmap ``a`` that the set of bitmap ``b`` lacks."""
    size = min(len(a), len(b))
    return int(np.bitwise_count(fold(a, size) & ~fold(b, size)).sum())


def may_link(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int, threshold: int = THRESHOLD) -> bool:
    """Whether the bitmaps of two sets leave the threshold within reach."""
    if 100 * min(n_a, n_b) < threshold * max(n_a, n_b):
        return False
    both = min(n_a - missing(a, b), n_b - missing(b, a))
    return 100 * both >= threshold * (n_a + n_b - both)


def common_tokens(docs: DataFrame, most: int = COMMON) -> np.ndarray:
    """The tokens counted in most documents, rarest first (sorted by count, then hash).

    A task counts some :data:`COUNTED` tokens at a time, of whole texts, and passes on what
    it meets three times, so the rows that are shuffled stay few; the order needs no exact counts.
    """

    def often(tokens: np.ndarray) -> pa.RecordBatch:
        tokens.sort()
        third = tokens[2:][tokens[2:] == tokens[:-2]]  # a token's third place and all after it
        token, n = np.unique(third, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64) + 2)], ["token", "n"])

    def count(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(0, np.uint64)
        size = 0
        for batch in batches(records):
            for tokens in text_sets(batch.column(0)):
                if size and size + len(tokens) > COUNTED:
                    yield often(held[:size])
                    size = 0
                if size + len(tokens) > len(held):  # grows with what the task meets
                    held, old = np.empty(max(size + len(tokens), min(2 * len(held), COUNTED)), np.uint64), held
                    held[:size] = old[:size]
                    del old
                held[size:size + len(tokens)] = tokens
                size += len(tokens)
        if size:
            yield often(held[:size])

    rows = (docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "token").limit(most).select("token").toPandas())
    return rows["token"].to_numpy(np.int64)[::-1].copy().view(np.uint64)


def shingle_sets(spark: SparkSession, docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> tuple[DataFrame, list[int]]:
    """``doc_id, text_hash, n, k1, k2, prefix, bits`` of every document; keys are null and the prefix empty without words.

    Also the keys that two sets shared, which go by ``k2``.
    """
    common = common_tokens(docs)
    order = np.argsort(common)
    shared = spark.sparkContext.broadcast((common[order], order))

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        for batch in batches(records):
            n, k1, k2, prefix, bits = [], [], [], [], []
            for tokens in text_sets(batch.column(1), words):
                n.append(len(tokens))
                a, b = set_key(tokens) if len(tokens) else (None, None)
                k1.append(a)
                k2.append(b)
                bits.append(set_bits(tokens) if len(tokens) else None)
                want = prefix_size(len(tokens), threshold)
                if len(known) and want:
                    at = np.searchsorted(known, tokens)
                    at[at == len(known)] = 0
                    hit = known[at] == tokens
                    rare = tokens[~hit]
                    if len(rare) < want:  # the rest from the common ones, by their rank
                        late = tokens[hit][np.argsort(rank[at[hit]], kind="stable")]
                        rare = np.concatenate([rare, late[:want - len(rare)]])
                    tokens = rare
                prefix.append(tokens[:want])
            size = np.cumsum([0, *map(len, prefix)]).astype(np.int32)
            flat = np.concatenate(prefix).view(np.int64) if prefix else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(size), pa.array(flat)), pa.array(bits, pa.binary())],
                ["doc_id", "text_hash", "n", "k1", "k2", "prefix", "bits"])

    sets = stage(spark, docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, "doc_id long, text_hash long, n long, k1 long, k2 long, prefix array<long>, "
             "bits binary"), "shingle-sets")
    # Two sets with one k1 (about one in 2^64 pairs): these go by k2.
    twice = sets.where("n > 0").groupBy("k1").agg(F.min("k2").alias("a"), F.max("k2").alias("b")).where("a <> b").select("k1")
    clash = [r["k1"] for r in twice.collect()]
    if clash:
        sets = (sets.join(twice.withColumn("twice", F.lit(True)), "k1", "left")
                .withColumn("k1", F.when("twice", F.col("k2")).otherwise(F.col("k1"))).drop("twice"))
    return sets, clash


# -- candidate generation ---------------------------------------------------
def bit_filter(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bitmap of ``2**bits`` of the values of a long column, modulo its size (16 MB at 27 bits, whatever the rows)."""
    place = F.pmod(F.col(column), F.lit(1 << bits)) + 1
    rows = (df.select(place.alias("p"))
            .groupBy(F.expr("bitmap_bucket_number(p)").alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits")).collect())
    width = 4096
    out = np.zeros(max((1 << bits) // 8, width), np.uint8)
    for r in rows:
        at = (r["bucket"] - 1) * width
        out[at:at + width] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def in_filter(bitmap: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    place = values.view(np.uint64) & np.uint64((1 << bits) - 1)
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def prefix_rows(spark: SparkSession, sets: DataFrame, members: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """``token, k1, n`` of the prefixes; of ``tokens`` only those that their filter lets through.

    A set is taken where its first document is, once a task.  It may come more than once all the same
    (repeated rows, false hits of the filter), which makes counts of shared tokens larger, never less.
    """
    own = lambda doc_id: F.xxhash64("k1", doc_id).alias("h")
    first = bit_filter(members.select(own("first.doc_id")), "h", TOKEN_BITS)
    shared = spark.sparkContext.broadcast((first, None if tokens is None else bit_filter(tokens, "token", TOKEN_BITS)))

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, contested = shared.value
        seen: set[int] = set()
        for batch in batches(records, 1024):
            h, k1 = (batch.column(i).to_numpy() for i in (0, 1))
            take = []
            for i in np.flatnonzero(in_filter(first, h, TOKEN_BITS)).tolist():
                if int(k1[i]) not in seen:
                    seen.add(int(k1[i]))
                    take.append(i)
            batch = batch.take(pa.array(take, pa.int64()))
            flat = batch.column(3).flatten()
            row = np.repeat(np.arange(len(take)), np.diff(batch.column(3).offsets.to_numpy()))
            if contested is not None:
                at = np.flatnonzero(in_filter(contested, flat.to_numpy(), TOKEN_BITS))
                flat, row = flat.take(pa.array(at)), row[at]
            yield pa.RecordBatch.from_arrays([flat, batch.column(1).take(pa.array(row)), batch.column(2).take(pa.array(row))],
                                             ["token", "k1", "n"])

    return sets.where("n > 0").select(own("doc_id"), "k1", "n", "prefix").mapInArrow(run, "token long, k1 long, n long")


def by_token(rows: DataFrame) -> DataFrame:
    """Rows dealt by token, for an aggregate and a join on it: both read one exchange, as the filters they imply are here."""
    return rows.where(" and ".join(f"{c} is not null" for c in rows.columns)).repartition("token")


def set_bitmaps(spark: SparkSession, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """``k1, bits`` of the sets ``wanted`` (``k1``)."""
    shared = spark.sparkContext.broadcast(bit_filter(wanted, "k1", DOCUMENT_BITS))

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches(records):
            k1 = batch.column(0).to_numpy()
            take = []
            for i in np.flatnonzero(in_filter(shared.value, k1, DOCUMENT_BITS)).tolist():
                if int(k1[i]) not in seen:
                    seen.add(int(k1[i]))
                    take.append(i)
            yield batch.take(pa.array(take, pa.int64()))

    return (sets.where("n > 0").select("k1", "bits").mapInArrow(run, "k1 long, bits binary")
            .join(wanted, "k1", "left_semi").dropDuplicates(["k1"]))


def set_texts(spark: SparkSession, docs: DataFrame, members: DataFrame, wanted: DataFrame, clash: list[int]) -> DataFrame:
    """``k1, text`` of the sets ``wanted`` (``k1``): the text of one document each."""
    rep = members.join(wanted, "k1", "left_semi").select(F.xxhash64("first.doc_id").alias("h"))
    shared = spark.sparkContext.broadcast((bit_filter(rep, "h", DOCUMENT_BITS), set(clash)))

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, second = shared.value
        for batch in batches(records):
            h = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            text = batch.column(1).take(pa.array(np.flatnonzero(in_filter(bitmap, h, DOCUMENT_BITS))))
            keys = [set_key(s) if len(s) else (None, None) for s in text_sets(text)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b if a in second else a for a, b in keys], pa.int64()), text], ["k1", "text"])

    return (docs.select(F.xxhash64("doc_id").alias("h"), "text").mapInArrow(run, "k1 long, text string")
            .join(wanted, "k1", "left_semi").dropDuplicates(["k1"]))


# -- comparison ---------------------------------------------------------------
def _one(text) -> np.ndarray:
    return next(text_sets(pa.array([text], pa.string())))


def _bits(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.uint8)


def within_reach(pairs: DataFrame, bitmaps: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs ``x, y`` of sets (of sizes ``nx, ny``) whose bitmaps leave a link possible."""
    side = lambda c: bitmaps.select(F.col("k1").alias(c), F.col("bits").alias(f"b{c}"))
    both = pairs.join(side("x"), "x").join(side("y"), "y").select("x", "y", "nx", "ny", "bx", "by")

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(records):
            _, _, nx, ny, bx, by = (c.to_pylist() for c in batch.columns)
            keep = [may_link(_bits(a), i, _bits(b), j, threshold) for i, j, a, b in zip(nx, ny, bx, by, strict=True)]
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], ["x", "y"])

    return both.mapInArrow(run, "x long, y long")


def compare(pairs: DataFrame, texts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs ``x, y`` of sets that link, as ``src, dst``."""
    both = (pairs.join(texts.select(F.col("k1").alias("x"), F.col("text").alias("tx")), "x")
            .join(texts.select(F.col("k1").alias("y"), F.col("text").alias("ty")), "y").select("x", "y", "tx", "ty"))

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, right = None, None
        for batch in batches(records, 256):
            x, y = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            src, dst = [], []
            for i, left in enumerate(text_sets(batch.column(2))):
                if y[i] != last or right is None:
                    last, right = y[i], _one(batch.column(3)[i].as_py())
                if linked(left, right, threshold):
                    src.append(x[i])
                    dst.append(y[i])
            if src:
                yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["src", "dst"])

    return both.mapInArrow(run, "src long, dst long")


def group_pairs(spark: SparkSession, rows: DataFrame, sets: DataFrame, threshold: int = THRESHOLD,
                used: list[DataFrame] | None = None) -> DataFrame:
    """Pairs ``x, y`` of sets of different components within reach, through the token-group matrix.

    ``rows``: ``token, k1, n, comp`` by contested token.  A set's group is the
    least component that holds the most of its tokens.  A set meets a group
    once, whatever the tokens and members it shares with it, so nothing grows with
    the pairs of members before the chunks are opened.  A chunk holds one band of
    sizes.  Of the two sets of a link the one of the greater ``k1`` must meet the other's group,
    and each token that they share is held there by a set of another component, a smaller
    ``k1`` and a size near enough; meetings by fewer such tokens than a link takes are dropped
    before any bitmap is read.  ``used`` gets the staged tables that the result reads.
    """
    mixed = (rows.groupBy("token").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("token"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(np.log(100 / threshold + 0.01))).cast("int")
    rows = stage(spark, rows.join(mixed, "token", "left_semi").withColumn("band", band), "mixed-rows")
    hub = rows.groupBy("token").agg(F.min("comp").alias("group"))
    shared = rows.join(hub, "token").groupBy("k1", "group").count()
    near = shared.groupBy("k1").agg(F.min(F.struct(-F.col("count"), "group")).alias("g")).select("k1", "g.group")
    mixed_rows, rows = rows, stage(spark, rows.join(near, "k1"), "mixed-tokens")
    unstage(spark, mixed_rows)
    dealt = by_token(rows)
    matrix = (dealt.groupBy("token", F.col("group").alias("g_group"), F.col("band").alias("g_band"))
              .agg(F.min("k1").alias("first"), F.min("comp").alias("a"), F.max("comp").alias("b"), F.min("n").alias("low"), F.max("n").alias("high")))
    n, low, high = F.col("n"), F.col("low"), F.col("high")
    meet = stage(spark, dealt.select("token", "k1", "n", "comp").join(matrix, "token")
                 .where((F.col("first") < F.col("k1")) & ((F.col("a") != F.col("comp")) | (F.col("b") != F.col("comp"))))
                 .where(sizes_near(n, low, high, threshold))
                 .groupBy("k1", "g_group", "g_band").agg(
                     F.first("n").alias("n"), F.first("comp").alias("comp"), F.count(F.lit(1)).alias("count"),
                     F.min("low").alias("low"), F.max("high").alias("high"))
                 .where(F.col("count") >= least_shared(n, low, high, threshold)).select("k1", "n", "comp", "g_group", "g_band"), "meetings")
    own = stage(spark, rows.select("k1", "n", "comp", F.col("group").alias("g_group"), F.col("band").alias("g_band"))
                .join(meet.select("g_group", "g_band").distinct(), ["g_group", "g_band"], "left_semi").distinct(), "met-sets")
    bitmaps = stage(spark, set_bitmaps(spark, sets, meet.select("k1").unionByName(own.select("k1")).distinct()), "met-bitmaps")
    held = _chunks(spark, own, bitmaps, "held", "group-chunks")
    asked = _chunks(spark, meet, bitmaps, "asked", "query-chunks")
    unstage(spark, own, meet, bitmaps)
    unstage(spark, rows)
    if used is not None:
        used += [held, asked]
    opened = held.join(asked, ["g_group", "g_band"]).select("g_group", "g_band", "held_part", "held", "asked")

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sets, union = None, [], np.zeros(0, np.uint8)
        for batch in batches(records, 16):
            x, y = [], []
            group, band_, part, chunk, queries = batch.columns
            for i in range(batch.num_rows):
                key = (group[i].as_py(), band_[i].as_py(), part[i].as_py())
                if key != last:
                    sets = [(m["k1"], m["n"], m["comp"], _bits(m["bits"])) for m in chunk[i].as_py()]
                    size = min(len(m[3]) for m in sets)
                    last, union = key, np.bitwise_or.reduce([fold(m[3], size) for m in sets])
                for q in queries[i].as_py():
                    query, n_q, mine, of = _bits(q["bits"]), q["n"], q["k1"], q["comp"]
                    # No member shares more tokens with the query than their union does.
                    if 100 * (n_q - missing(query, union)) < threshold * n_q:
                        continue
                    for k, n_k, c, b in sets:  # of two sets that meet each other, the greater asks
                        if k < mine and c != of and may_link(query, n_q, b, n_k, threshold):
                            x.append(mine)
                            y.append(k)
            if x:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])

    return opened.mapInArrow(run, "x long, y long")


def _chunks(spark: SparkSession, sets: DataFrame, bitmaps: DataFrame, name: str, file: str) -> DataFrame:
    """Sets by (g_group, g_band) in lists of about :data:`CHUNK`, as column ``name``, numbered by ``<name>_part``."""
    by = ["g_group", "g_band"]
    sizes = stage(spark, sets.groupBy(*by).count(), file + "-sizes")
    part = F.pmod(F.xxhash64("k1"), F.ceil(F.col("count") / CHUNK)).alias(name + "_part")
    out = stage(spark, sets.join(sizes, by).select("k1", "n", "comp", *by, part).join(bitmaps, "k1")
                .groupBy(*by, name + "_part").agg(F.collect_list(F.struct("k1", "n", "comp", "bits")).alias(name)), file)
    unstage(spark, sizes)
    return out


def set_components(spark: SparkSession, docs: DataFrame, sets: DataFrame, members: DataFrame, clash: list[int],
                   threshold: int = THRESHOLD) -> DataFrame:
    """``k1, comp`` of every set that links with another."""
    tokens = stage(spark, prefix_rows(spark, sets, members).groupBy("token").count().where("count > 1").select("token"), "contested")
    # Of two sets alone with a token that are too far apart in size neither needs it.
    every = Window.partitionBy("token")
    low, high = F.col("low"), F.col("high")
    rows = stage(spark, prefix_rows(spark, sets, members, tokens).withColumns({
        "count": F.count(F.lit(1)).over(every), "a": F.min("k1").over(every), "b": F.max("k1").over(every),
        "low": F.min("n").over(every), "high": F.max("n").over(every)})
        .where("a <> b").where((F.col("count") > 2) | sizes_near(low, high, high, threshold)).select("token", "k1", "n"), "contested-rows")
    links, labels = None, spark.createDataFrame([], "k1 long, comp long")

    def joined() -> DataFrame:
        return rows.join(labels, "k1", "left").withColumn("comp", F.coalesce("comp", "k1"))

    def grow(pairs: DataFrame, used: list[DataFrame]) -> bool:
        """Compare pairs exactly; whether new links came of it.  What only this step reads is deleted after it."""
        nonlocal links, labels
        pairs = stage(spark, pairs.distinct(), "near-pairs")
        unstage(spark, *used)
        if not pairs.head(1):
            return False
        wanted = stage(spark, pairs.select(F.col("x").alias("k1")).unionByName(pairs.select(F.col("y").alias("k1"))).distinct(), "wanted-sets")
        texts = stage(spark, set_texts(spark, docs, members, wanted, clash), "set-texts")
        new = stage(spark, compare(pairs, texts, threshold), "links")
        unstage(spark, pairs, wanted, texts)
        if not new.head(1):
            return False
        links = new if links is None else links.unionByName(new)
        before, labels = labels, stage(spark, connected_components(links).select(
            F.col("node").alias("k1"), F.col("component").alias("comp")), "labels")
        unstage(spark, before)
        return True

    tested = spark.createDataFrame([], "x long, y long")
    for _ in range(ROUNDS):
        here = by_token(joined())
        hub = (here.groupBy("token").agg(F.min(F.struct("comp", "k1", "n")).alias("hub"), F.max("comp").alias("last"))
               .where("hub.comp <> last").select("token", F.col("hub.comp").alias("h_comp"), F.col("hub.k1").alias("y"), F.col("hub.n").alias("ny")))
        best = Window.partitionBy("x").orderBy(F.desc("count"), "y")
        nx, ny = F.col("nx"), F.col("ny")
        pairs = stage(spark, here.withColumnRenamed("n", "nx").join(hub, "token").where("comp <> h_comp").where(sizes_near(nx, ny, ny, threshold))
                      .groupBy(F.col("k1").alias("x"), "y").agg(F.first("nx").alias("nx"), F.first("ny").alias("ny"), F.count(F.lit(1)).alias("count"))
                      .where(HUB_SHARE * F.col("count") >= least_shared(nx, ny, ny, threshold))
                      .join(tested, ["x", "y"], "left_anti")
                      .withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= HUBS).select("x", "y", "nx", "ny"), "hub-pairs")
        wanted = pairs.select(F.col("x").alias("k1")).unionByName(pairs.select(F.col("y").alias("k1"))).distinct()
        bitmaps = stage(spark, set_bitmaps(spark, sets, wanted), "hub-bitmaps")
        if not grow(within_reach(pairs, bitmaps, threshold), [bitmaps]):
            break
        tested = tested.unionByName(pairs.select("x", "y"))
    used: list[DataFrame] = []
    found = group_pairs(spark, joined(), sets, threshold, used)
    unstage(spark, rows, tokens)
    grow(found, used)
    return labels


def _labelled(spark: SparkSession, docs: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, text_hash, n, k1`` of every document, and ``k1, comp, component_id`` of every set.

    Every task in Python runs in here: a row of two chunks of sets or two texts may be wide.
    """
    with small_batches(prepared(spark)):
        return _named_sets(spark, docs, threshold)


def _named_sets(spark: SparkSession, docs: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    sets, clash = shingle_sets(spark, docs, threshold=threshold)
    # One row a set; its first document is the one whose text stands for it.
    members = stage(spark, sets.where("n > 0").groupBy("k1").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("first")), "sets")
    labels = set_components(spark, docs, sets, members, clash, threshold)
    least = members.select("k1", F.col("first.doc_id").alias("least"))
    named = stage(spark, least.join(labels, "k1", "left").withColumn("comp", F.coalesce("comp", "k1")), "set-labels")
    first = stage(spark, named.groupBy("comp").agg(F.min("least").alias("component_id")), "component-names")
    return (sets.select("doc_id", "text_hash", "n", "k1"),
            stage(spark, named.join(first, "comp").select("k1", "comp", "component_id"), "set-components"))


def jaccard_components(spark: SparkSession, docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``."""
    sets, names = _labelled(spark, docs, threshold)
    return (sets.where("n > 0").join(names, "k1")
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
            .unionByName(sets.where("n = 0").select(
                "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))))


def representatives(spark: SparkSession, docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each component: the least ``doc_id``, then the least text hash.

    Rows without a set are components of their own and all stay.
    """
    sets, names = _labelled(spark, docs, threshold)
    rows = sets.where("n > 0").join(names.select("k1", "comp"), "k1")
    first = rows.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("f"))
    keep = stage(spark, first.select(F.col("f.doc_id").alias("_id"), F.col("f.text_hash").alias("_hash"))
                 .unionByName(sets.where("n = 0").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))).distinct(),
                 "representatives")
    same = docs["doc_id"].cast("long").eqNullSafe(keep["_id"]) & (F.xxhash64(docs["text"]) == keep["_hash"])
    left = docs.join(keep, same, "left_semi")
    # A chosen row that occurs more than once stays once.
    twice = sets.where("n > 0").groupBy("doc_id", "text_hash").count().where("count > 1")
    if not twice.head(1):
        return left
    names_ = docs.columns
    nth = F.row_number().over(Window.partitionBy("doc_id", "_hash").orderBy(*[F.col(c) for c in names_]))
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    left = left.withColumn("_hash", F.xxhash64("text"))
    return (left.where(~wordless).withColumn("_nth", nth).where("_nth = 1").select(*names_)
            .unionByName(left.where(wordless).select(*names_)))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark, table(spark, sf_dir, "documents"))
