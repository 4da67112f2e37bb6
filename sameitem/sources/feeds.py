"""Listing feeds of mixed charsets, read in splits.

A feed is a CSV file with a header, quoted fields that may hold line breaks, and
one of several charsets.  Spark's line reader deals each file out in splits; from
there:

1. :func:`feed_chunks` packs consecutive lines into chunks and notes of each what
   a reader outside quotes and one inside quotes would be after it, where a record
   begins for a reader that enters inside quotes, and which charsets refuse it.
   The chunks are written once, so no later step depends on how files were split.
2. :func:`placed_chunks` runs these notes together per file: whether a chunk begins
   inside quotes, and which chunk holds the beginning of a record that runs on.
   Only the notes (some 60 bytes a chunk) are ordered, never the text.
3. :func:`feed_charsets` takes per file the first charset that no chunk refuses.
4. :func:`read_feeds` hands each chunk the continuation of its last record and
   parses its records.

All charsets of the list agree on ASCII, so line breaks, commas and quotes are
found in the bytes.  A record is held by one task, whatever its length.  Defined
cases: blank lines are no records; a file without records gives no rows; a quote
within an unquoted field is text; a record of another number of fields, an unclosed
quote and an id that is no number end the job.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sameitem.session import ship_package, stage

FIELDS = ["listing_id", "title", "price", "source", "currency"]
# Charsets tried in order for a feed file, as Python and Java name them.
CHARSETS = (("utf-8", "UTF-8"), ("utf-8-sig", "UTF-8"), ("cp1255", "windows-1255"), ("iso-8859-8", "ISO-8859-8"),
            ("cp1252", "windows-1252"), ("latin1", "ISO-8859-1"))
#: Bytes of consecutive lines that a chunk takes; a longer line makes a longer chunk.
CHUNK_BYTES = 256 * 1024

CHUNKS = "path string, start long, no long, body binary, outside boolean, inside boolean, entry long, refused int"


def quoted_after(line: bytes, quoted: bool) -> bool:
    """Whether a reader is inside quotes after a line that it entered inside quotes or not."""
    if b'"' not in line:
        return quoted
    at, end = 0, len(line)
    while True:
        if quoted:
            at = line.find(b'"', at)
            if at < 0:
                return True
            if line[at + 1:at + 2] == b'"':  # a doubled quote is text
                at += 2
                continue
            quoted = False
        elif line[at:at + 1] == b'"':  # a quote opens a field at its beginning only
            quoted, at = True, at + 1
            continue
        at = line.find(b",", at) + 1
        if not at or at > end:
            return False


def refusals(body: bytes) -> int:
    """Bit i is set when charset i can't decode the bytes."""
    out = 0
    if body.isascii():
        return out
    for i, (name, _) in enumerate(CHARSETS):
        try:
            body.decode(name)
        except UnicodeDecodeError:
            out |= 1 << i
    return out


class _Chunk:
    """Lines of one chunk, read both ways at once."""

    def __init__(self) -> None:
        self.lines: list[bytes] = []
        self.size, self.outside, self.inside, self.entry = 0, False, True, -1

    def add(self, line: bytes) -> None:
        if self.entry < 0 and not self.inside:
            self.entry = self.size
        self.outside, self.inside = quoted_after(line, self.outside), quoted_after(line, self.inside)
        self.lines.append(line)
        self.size += len(line) + 1

    def row(self, path: str, start: int, no: int) -> tuple:
        # The body of each chunk ends in a line break, so bodies can be put together.
        body = b"\n".join(self.lines) + b"\n"
        if self.entry < 0 and not self.inside:
            self.entry = self.size  # the record ends with the chunk
        return path, start, no, body, self.outside, self.inside, self.entry, refusals(body)


def _chunked(size: int):
    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, no, chunk = None, 0, _Chunk()
        schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("no", pa.int64()), ("body", pa.binary()), ("outside", pa.bool_()),
                            ("inside", pa.bool_()), ("entry", pa.int64()), ("refused", pa.int32())])
        emit = lambda: pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(chunk.row(*key, no), schema)], schema=schema)
        for batch in records:
            for line, path, start in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (path, start) != key or chunk.size >= size:
                    if chunk.lines:
                        yield emit()
                    no = no + 1 if (path, start) == key else 0
                    key, chunk = (path, start), _Chunk()
                chunk.add(line)
        if chunk.lines:
            yield emit()

    return run


def feed_chunks(spark: SparkSession, paths, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunks of whole lines of all files under ``paths`` (:data:`CHUNKS`), staged."""
    ship_package(spark)
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"))
    return stage(lines.mapInArrow(_chunked(chunk_bytes), CHUNKS), "feed-chunks")


def placed_chunks(chunks: DataFrame) -> DataFrame:
    """Per chunk: ``first`` of its file, ``quoted`` (it begins inside quotes), and the place ``owner`` of its beginning.

    A chunk maps (outside, inside) to what follows it: it keeps the state, turns it
    round, or sets it.  Turns are counted; the last chunk that sets gives the rest.
    """
    before = Window.partitionBy("path").orderBy("start", "no").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("path").orderBy("start", "no")
    at = chunks.select("path", "start", "no", "outside", "inside", "entry")
    sets = F.col("outside") == F.col("inside")
    turns = (F.col("outside") & ~F.col("inside")).cast("long")
    at = at.withColumns({"_turned": F.sum(turns).over(upto), "first": F.row_number().over(upto) == 1})
    # What a setting chunk leaves, less the turns up to it.
    base = F.when(sets, (F.col("outside").cast("long") + F.col("_turned")) % 2)
    state = (F.coalesce(F.last(base, ignorenulls=True).over(before), F.lit(0))
             + F.coalesce(F.last("_turned").over(before), F.lit(0))) % 2 == 1
    at = at.withColumn("quoted", state)
    begins = ~F.col("quoted") | ((F.col("entry") >= 0) & (F.col("entry") < F.col("_size")))
    return at.join(chunks.select("path", "start", "no", F.octet_length("body").alias("_size")), ["path", "start", "no"]) \
        .withColumn("owner", F.last(F.when(begins, F.struct("start", "no")), ignorenulls=True).over(before)) \
        .select("path", "start", "no", "first", "quoted", "entry", "owner")


def feed_charsets(chunks: DataFrame) -> DataFrame:
    """``path, charset`` (Java name) of every file: the first charset that no chunk refuses."""
    refused = chunks.groupBy("path").agg(F.bit_or("refused").alias("_r"))
    out = None
    for i, (_, java) in enumerate(CHARSETS):
        fits = F.col("_r").bitwiseAND(1 << i) == 0
        out = F.when(fits, F.lit(java)) if out is None else out.when(fits, F.lit(java))
    return refused.select("path", out.alias("charset"))


def _parsed(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    python = {java: name for name, java in reversed(CHARSETS)}
    for batch in records:
        for row in batch.to_pylist():
            body = row["body"][row["entry"]:] if row["quoted"] else row["body"]
            text = (body + (row["tail"] or b"")).decode(python[row["charset"]])
            found = []
            # Trailing carriage returns belong to the line break; strict: an unclosed quote is an error.
            for values in csv.reader(io.StringIO(text, newline=""), strict=True):
                if values and not (len(values) == 1 and not values[0].strip()):
                    if len(values) != len(FIELDS):
                        raise ValueError(f"{row['path']}: a record of {len(values)} fields: {values!r:.200}")
                    found.append(values)
            if row["first"]:
                found = found[1:]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([row["path"]] * len(found)), *[pa.array(c, pa.string()) for c in zip(*found)]],
                                                 ["path", *FIELDS])


def read_feeds(spark: SparkSession, paths, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``path, charset`` and the five fields, as text, of every record of the files under ``paths``."""
    chunks = feed_chunks(spark, paths, chunk_bytes)
    places = stage(placed_chunks(chunks), "feed-places")
    met = chunks.drop("entry").join(places, ["path", "start", "no"])
    begins = ~F.col("quoted") | ((F.col("entry") >= 0) & (F.col("entry") < F.octet_length("body")))
    # What runs on from an earlier chunk: up to the first record's beginning, or all of the chunk.
    head = F.when(F.col("entry") >= 0, F.substring("body", F.lit(1), F.col("entry").cast("int"))).otherwise(F.col("body"))
    tails = (met.where("quoted").select("path", F.col("owner.start").alias("start"), F.col("owner.no").alias("no"),
                                        F.struct(F.col("start").alias("s"), F.col("no").alias("n"), head.alias("b")).alias("part"))
             .groupBy("path", "start", "no").agg(F.sort_array(F.collect_list("part")).alias("_p"))
             .select("path", "start", "no", F.aggregate("_p", F.lit(b""), lambda a, p: F.concat(a, p["b"])).alias("tail")))
    charsets = feed_charsets(chunks)
    rows = (met.where(begins).join(tails, ["path", "start", "no"], "left").join(charsets, "path")
            .select("path", "charset", "first", "quoted", "entry", "body", "tail"))
    schema = "path string, " + ", ".join(f"{c} string" for c in FIELDS)
    return rows.mapInArrow(_parsed, schema).join(charsets, "path")
