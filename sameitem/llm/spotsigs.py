"""Operator 10: document fingerprints by SpotSigs (Theobald, Siddharth and Paepcke, 2008).

Only DataFrame functions.  A text is lower-cased and cut into words (runs of
letters and digits).  At every *anchor* (common word) a chain starts: the anchor,
the content word after it and the next content words, :data:`CHAIN` in all;
other common words are passed over, and anchors in a row start one chain.  The
fingerprint is the set of the chains' 64-bit hashes, as sorted hexadecimal
numbers in one string.  Likeness is the Jaccard similarity of two such sets.

:func:`similar_texts` joins fingerprints: equal sets are one row first, then sets
are partitioned by length, so that only a set's own partition and the next can
hold a partner, meet by one of their rarest signatures, and are compared
exactly after the length bound.

Defined cases: null counts as empty; an empty text (no word) has the empty
fingerprint; a text with words but no chain has one signature, of all its words;
two empty fingerprints are alike (1), one empty fingerprint is unlike (0);
repeated rows and equal ``doc_id`` follow each other in order of the text's hash;
a null ``doc_id`` comes last; the only row of a table follows itself; an empty
table gives no rows; columns other than ``doc_id`` and ``text`` are not read.

Scale: "the next document" is a ``lead`` inside buckets of about
:data:`BUCKET_ROWS` rows, cut at quantiles of ``doc_id`` and, where one id
(or null) fills several, at its texts' hashes; one row, the first of the bucket
below, is copied into each, so texts move once.  The driver holds one cut
point and one top row's id a bucket (:data:`MOST_BUCKETS` at most).
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sameitem.llm.common import table

# Anchors (common words that start a chain), English, French, German, Spanish.
ANCHORS = ("the", "a", "is", "was", "that", "le", "la", "est", "un", "une", "der", "die", "ist", "ein", "eine",
           "el", "es", "una")
# Other common words that a chain passes over.
PASSED = ("of", "and", "to", "in", "it", "for", "on", "with", "as", "be", "by", "are", "this", "at", "from", "an",
          "de", "des", "et", "du", "les", "que", "qui", "par", "pour", "sur", "au", "aux", "en", "dans", "il", "elle",
          "und", "den", "das", "mit", "von", "zu", "nicht", "sich", "auf", "dem", "im",
          "y", "los", "las", "del", "por", "con", "para", "al", "se", "no", "lo")
CHAIN = 3
BUCKET_ROWS = 2000
MOST_BUCKETS = 4095
SIMILAR = 0.8
_TIE = "\u0001"


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated a single time (a bound lambda variable)."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    """The words of a text, each with a space before and one at the end; a text without words is one space or empty."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "), F.lit(" "))


def signatures(text: Column, anchors: tuple = ANCHORS, passed: tuple = PASSED, chain: int = CHAIN) -> Column:
    """Sorted distinct signatures (long) of a text."""
    skip = f"(?<= )(?:{'|'.join(passed)}) "
    tie = f"(?<= )({'|'.join(anchors)}) "

    def content(t: Column, i: Column) -> Column:
        return F.substring_index(F.coalesce(F.get(t, i), F.lit("")), _TIE, -1)

    def spots(t: Column) -> Column:
        # Anchors without a content word after them, at the text's end, start no chain.
        at = F.filter(F.sequence(F.lit(0), F.size(t) - 1),
                      lambda i: F.contains(F.get(t, i), F.lit(_TIE)) & ~F.endswith(F.get(t, i), F.lit(_TIE)))
        return F.transform(at, lambda i: F.xxhash64(F.get(t, i), *[content(t, i + k) for k in range(1, chain)]))

    def chosen(w: Column) -> Column:
        tied = F.regexp_replace(F.regexp_replace(w, skip, ""), tie, "$1" + _TIE)
        found = once(F.split(F.trim(tied), " "), spots)
        whole = F.array(F.xxhash64(F.lit("whole"), F.trim(F.regexp_replace(w, " +", " "))))
        return once(found, lambda s: F.when(F.trim(w) == "", F.array().cast("array<bigint>"))
                    .when(F.size(s) == 0, whole).otherwise(F.array_sort(F.array_distinct(s))))

    return once(words_of(text), chosen)


def fingerprint_text(sigs: Column) -> Column:
    """A signature set as one string: 16 hexadecimal digits each, with a blank between."""
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.lower(F.hex(s)), 16, "0")), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets."""
    def of(both: Column) -> Column:
        either = F.size(a) + F.size(b) - both
        return F.when(either == 0, F.lit(1.0)).otherwise(both / either)

    return once(F.size(F.array_intersect(a, b)), of)


def _bucket(cuts: list[int], key: Column) -> Column:
    """Number of cut points below ``key``, by binary search."""
    top = 1
    while top <= len(cuts):
        top *= 2
    padded = F.array(*[F.lit(c).cast("long") for c in [*cuts, *[(1 << 63) - 1] * (top - len(cuts))]])
    steps, s = [], top // 2
    while s:
        steps.append(s)
        s //= 2
    if not steps:
        return F.lit(0)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda at, s: F.when(F.element_at(padded, at + s) < key, at + s).otherwise(at))


def with_next(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, Window]:
    """Rows of ``docs`` (``doc_id, text``) in buckets, with copies of each bucket's follower.

    Returns the rows (``doc_id, text, key, bucket, copy``) and the window in
    which the next row is the next document by falling ``doc_id``.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)).cast("long"))
    docs = docs.withColumn("key", key)
    n = docs.count()
    buckets = max(1, min(MOST_BUCKETS, n // bucket_rows))
    cuts, tie = [], F.xxhash64("text")
    if buckets > 1:
        at = [i / buckets for i in range(1, buckets)]
        cuts = docs.agg(F.percentile_approx("key", at, 20_000)).first()[0]
    # A key that several cut points fall on has as many parts by its texts' hash, above its bucket's other rows.
    parts = [(k, c) for k, c in Counter(cuts).items() if c > 1]
    docs = docs.withColumn("bucket", _bucket(sorted(set(cuts)), F.col("key")).cast("long") * (MOST_BUCKETS + 1))
    if parts:
        share = F.least(F.floor((tie / F.lit(2.0 ** 64) + 0.5) * F.col("parts")), F.col("parts") - 1)
        docs = (docs.join(F.broadcast(docs.sparkSession.createDataFrame(parts, "key long, parts long")), "key", "left")
                .withColumn("bucket", F.col("bucket") + F.coalesce(F.col("parts") - share, F.lit(0))).drop("parts"))
    tops = sorted(((r["bucket"], r["top"]) for r in docs.groupBy("bucket").agg(F.max("key").alias("top")).collect()))
    # The top row of a bucket follows the last row of the bucket above; that of the highest, the lowest bucket's.
    follow = [(b, top, tops[i + 1][0] if i + 1 < len(tops) else tops[0][0]) for i, (b, top) in enumerate(tops)]
    follow = docs.sparkSession.createDataFrame(follow, "bucket long, key long, above long")
    first = (docs.join(F.broadcast(follow), ["bucket", "key"]).groupBy("above", "key")
             .agg(F.first("doc_id").alias("doc_id"), F.min_by("text", tie).alias("text")))
    placed = (docs.select("doc_id", "text", "key", "bucket", F.lit(False).alias("copy"), tie.alias("tie"))
              .unionByName(first.select("doc_id", "text", "key", F.col("above").alias("bucket"), F.lit(True).alias("copy"),
                                        tie.alias("tie"))))
    return placed, Window.partitionBy("bucket").orderBy("copy", F.desc("key"), "tie")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last half replaced by the start of the next document.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    placed, order = with_next(docs)
    half = F.floor(F.length("text") / 2).cast("int")
    rows = placed.withColumn("next_text", F.lead("text").over(order))
    rows = rows.withColumn("sigs", signatures(F.col("text")))
    rows = rows.withColumn("next_sigs", F.lead("sigs").over(order)).where(~F.col("copy"))
    rows = rows.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - half),
        F.substring(F.col("next_text"), F.lit(1), half)))
    rows = rows.withColumn("edited_sigs", signatures(F.col("edited")))
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        fingerprint_text(F.col("sigs")).alias("fingerprint"),
        fingerprint_text(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))


def similar_texts(docs: DataFrame, threshold: float = SIMILAR) -> DataFrame:
    """Pairs ``a < b`` of different signature sets at least ``threshold`` alike, each named by its least ``doc_id``.

    Documents of equal sets are one row, ``members`` many.  Partition ``p`` has the lengths from ``threshold ** -p``
    to ``threshold ** -(p + 1)``, so partners are in one partition or in neighbours.
    """
    sets = (docs.select("doc_id", signatures(F.col("text")).alias("sigs")).where(F.size("sigs") > 0)
            .groupBy("sigs").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("members")))
    sets = sets.withColumn("n", F.size("sigs")).withColumn(
        "part", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / threshold)) + F.lit(1e-9)).cast("int"))
    each = sets.select("id", "n", "part", F.explode("sigs").alias("sig"))
    seen = each.groupBy("sig").count()
    rank = F.row_number().over(Window.partitionBy("id").orderBy("count", "sig"))
    rare = (each.join(seen, "sig").withColumn("rank", rank)
            .where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).select("id", "n", "part", "sig"))
    left = rare.select(F.col("id").alias("a_id"), F.col("n").alias("a_n"), "sig",
                       F.explode(F.array(F.col("part") - 1, F.col("part"), F.col("part") + 1)).alias("part"))
    met = (left.join(rare, ["sig", "part"]).where("a_id < id")
           .where(F.least("a_n", "n") >= F.greatest("a_n", "n") * threshold - 1e-9).select("a_id", "id").distinct())
    full = sets.select("id", "sigs", "members")
    both = (met.join(full.select(F.col("id").alias("a_id"), F.col("sigs").alias("a"), F.col("members").alias("a_members")), "a_id")
            .join(full, "id"))
    return both.withColumn("likeness", likeness(F.col("a"), F.col("sigs"))).where(
        F.col("likeness") >= threshold - 1e-12).select(
        F.col("a_id").alias("a"), F.col("id").alias("b"), "likeness", "a_members", F.col("members").alias("b_members"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
