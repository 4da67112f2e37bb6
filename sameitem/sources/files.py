"""Listing CSV source and result sinks.

The CSV reader takes an explicit schema (price as text, cast later by the
quality rules) and maps the NA spellings of the reference's CSV reader to
null.  Sinks write parquet by default; CSV output turns array columns into
JSON text because the CSV writer rejects arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sameitem.session import stage
from sameitem.sources.feeds import CHARSETS, feed_charsets, feed_chunks, read_feeds

LISTING_SCHEMA = "listing_id long, title string, price string, source string, currency string"
# Text read as missing by the reference's CSV reader.
NA_VALUES = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def detect_charset(content: bytes) -> str:
    """The first charset (Java name) that decodes every byte."""
    for name, java in CHARSETS:
        try:
            content.decode(name)
            return java
        except UnicodeDecodeError:
            continue
    raise ValueError("no charset fits")  # not reached: latin1 takes any byte


def file_charsets(spark: SparkSession, paths) -> DataFrame:
    """``path, charset`` of every feed file under ``paths``, one row a file."""
    return feed_charsets(feed_chunks(spark, paths))


def _without_na(df: DataFrame) -> DataFrame:
    na = F.array(*[F.lit(x) for x in NA_VALUES])
    return df.withColumns({c: F.when(F.array_contains(na, F.col(c)), F.lit(None)).otherwise(F.col(c))
                           for c in ("title", "price", "source", "currency")})


def read_listings_csv(spark: SparkSession, paths, encoding: str = "UTF-8", multi_line: bool = True) -> DataFrame:
    """Listings from CSV files with a header, NA spellings -> null.

    Quotes inside quoted fields are doubled.  ``multi_line=False`` splits files
    between tasks, for feeds without line breaks inside fields.  A malformed row
    ends the job (``FAILFAST``) rather than becoming a row of nulls.
    """
    df = (spark.read.schema(LISTING_SCHEMA).option("header", True).option("encoding", encoding)
          .option("quote", '"').option("escape", '"').option("mode", "FAILFAST")
          .option("multiLine", multi_line).csv(paths))
    return _without_na(df)


def read_listing_feeds(spark: SparkSession, paths, with_charset: bool = False) -> DataFrame:
    """Listings from feed files of mixed charsets, split within files (:mod:`sameitem.sources.feeds`).

    Line breaks inside quoted fields are kept; the driver sees no content and no file names.
    """
    df = _without_na(read_feeds(spark, paths))
    return df.select(F.col("listing_id").cast("long").alias("listing_id"), "title", "price", "source", "currency",
                     *(["charset"] if with_charset else []))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", order: list[str] | None = None, bom: bool = False,
                partition_by: str | None = None) -> None:
    """K1-K5: overwrite ``path``, sorted by ``order``; CSV gets a header and JSON text for arrays.

    ``bom=True`` puts U+FEFF before the CSV's first column name.
    """
    if order:
        # A sort reads its input twice, for the ranges and for the rows: staged, it is computed once.
        df = stage(df, "unsorted").orderBy(*order)
    writer = df.write
    if fmt == "csv":
        arrays = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
        df = df.withColumns({c: F.to_json(c) for c in arrays})
        if bom:
            df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
        writer = df.write.option("header", True).option("quote", '"').option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.mode("overwrite").format(fmt).save(path)


def read_table_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV table of :func:`write_table` without line breaks in its fields, as text, with ``row_no`` (from 1) in written order.

    Part files are numbered in the order of a sorted table; a row's place in its file
    is that of the line in its split.  One row per file and split gives the offsets.
    """
    rows = (spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
            .withColumns({"_file": F.col("_metadata.file_name"), "_start": F.col("_metadata.file_block_start"), "_at": F.monotonically_increasing_id()}))
    first = rows.columns[0]
    rows = stage(rows.withColumnRenamed(first, first.removeprefix("\ufeff")), "table-rows")
    counts = rows.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_from"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return (rows.join(offsets, ["_file", "_start"])
            .withColumn("row_no", F.col("_before") + F.row_number().over(Window.partitionBy("_file", "_start").orderBy("_at")))
            .drop("_file", "_start", "_at", "_before", "_from"))


def write_outputs(run, out_dir: str, fmt: str = "parquet") -> None:
    """The reference's output set from one :class:`sameitem.plans.pipeline.Run`."""
    from sameitem.operators import analysis
    write_table(run.final_pairs.drop(*[c for c in run.final_pairs.columns if c.endswith(("_1", "_2"))
                                       and c not in ("listing_id_1", "listing_id_2", "title_1", "title_2",
                                                     "normalized_title_1", "normalized_title_2")]),
                f"{out_dir}/match_decisions", fmt, ["listing_id_1", "listing_id_2"])
    write_table(run.groups, f"{out_dir}/grouped_products", fmt, ["group_id"])
    write_table(run.group_members, f"{out_dir}/group_members", fmt, ["group_id", "row_seq"])
    write_table(run.attributed, f"{out_dir}/products_with_attributes", fmt, ["row_seq"])
    write_table(run.usage(), f"{out_dir}/llm_usage_summary", fmt)
    write_table(analysis.error_analysis_table(run.final_pairs, run.weighted, run.variant_conflicts),
                f"{out_dir}/llm_error_analysis", fmt)
    # The requests are what a first run is for: there are no verdicts yet.
    write_table(run.requests, f"{out_dir}/verdict_outbox", fmt, partition_by="review_bucket")
