"""Cleaning, data-quality flags and the matchable filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REQUIRED_COLUMNS = ("listing_id", "title", "price", "source", "currency")

# A number the way a float parser reads it: optional sign, digits with an
# optional fraction, optional exponent, surrounding blanks allowed.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def check_required_columns(df: DataFrame, required=REQUIRED_COLUMNS) -> None:
    """S3: fail at analysis time, naming the sorted missing columns."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns in CSV: {missing}")


def ustrip(c: Column) -> Column:
    """Unicode strip (Python ``str.strip``); Spark ``trim`` only strips spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def parse_price(c: Column) -> Column:
    """Numeric text -> double, anything else -> null (``to_numeric(errors='coerce')``).

    The guard matters: ``try_cast`` alone accepts ``'nan'`` and ``'1.5d'``.
    """
    s = c.cast("string")
    return F.when(s.rlike(_NUMBER), s.try_cast("double"))


def clean_listings(df: DataFrame) -> DataFrame:
    """Keep non-blank titles that are not the text ``nan`` and positive prices.

    A null title reads as the string ``nan`` in the reference, so it is dropped.
    """
    check_required_columns(df)
    title = ustrip(F.col("title"))
    price = parse_price(F.col("price"))
    keep = (F.col("title").isNotNull() & (title != "") & (F.lower(title) != "nan")
            & price.isNotNull() & (price > 0))
    return df.where(keep)


def add_quality_flags(df: DataFrame, low_price: float = 200.0, compat: bool = True) -> DataFrame:
    """Trim text columns, cast price, add four ``dq_*`` flags, blank -> null.

    ``compat=True`` keeps the reference quirk that a missing source/currency
    becomes the literal text ``nan``.
    """
    def text(name: str) -> Column:
        c = F.col(name)
        if compat and name != "title":
            c = F.coalesce(c.cast("string"), F.lit("nan"))
        return ustrip(c)

    price = parse_price(F.col("price"))
    title = text("title")
    # One ``inline`` of one row: flags and filters below read the values, not their expressions.
    read = F.struct(title.alias("title"), text("source").alias("source"), text("currency").alias("currency"), price.alias("price"))
    out = df.select(*[c for c in df.columns if c not in ("title", "source", "currency", "price")], F.inline(F.array(read)))
    out = out.withColumns({
        "dq_missing_title": F.col("title").isNull() | (F.col("title") == ""),
        "dq_missing_price": F.col("price").isNull(),
        "dq_nonpositive_price": F.coalesce(F.col("price"), F.lit(0.0)) <= 0,
        "dq_suspicious_low_price": F.coalesce(F.col("price"), F.lit(0.0)) < low_price,
    })
    # Blank strings become null in every string column.
    blanks = {f.name: F.when(F.col(f.name).rlike(r"(?U)^\s*$"), None).otherwise(F.col(f.name))
              for f in out.schema.fields if f.dataType.simpleString() == "string"}
    return out.withColumns(blanks)


def latest_listings(df: DataFrame) -> DataFrame:
    """One row per ``listing_id``: that of the highest ``row_seq`` (the last one read).

    Rows without an id are kept.  Ties take the greatest of (title, price,
    source, currency).  The aggregate combines rows before the shuffle, so an id
    that repeats a million times is a few rows there.
    """
    order = F.struct("row_seq", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("title", "price", "source", "currency")])
    named = df.where(F.col("listing_id").isNotNull())
    last = named.groupBy("listing_id").agg(F.max_by(F.struct(*df.columns), order).alias("_row"))
    return last.select("_row.*").unionByName(df.where(F.col("listing_id").isNull()))


def prepare_listings(df: DataFrame, mode: str = "drop", low_price: float = 200.0,
                     compat: bool = True) -> DataFrame:
    """Cleaned + flagged listings.

    ``mode="drop"`` follows the reference code (invalid rows removed before
    flagging); ``mode="flag"`` follows its README (rows kept, flags set).
    A ``row_seq`` column (input order) is added when absent; of rows of one
    ``listing_id`` the last in that order stays.
    """
    if mode not in ("drop", "flag"):
        raise ValueError("mode must be 'drop' or 'flag'")
    check_required_columns(df)
    if "row_seq" not in df.columns:
        df = df.withColumn("row_seq", F.col("listing_id").cast("long"))
    if mode == "drop":
        df = clean_listings(df)
    df = latest_listings(df)
    return add_quality_flags(df, low_price=low_price, compat=compat)


def matchable(df: DataFrame) -> DataFrame:
    """P10: rows eligible for matching."""
    return df.where(~F.col("dq_missing_title") & ~F.col("dq_missing_price")
                    & ~F.col("dq_nonpositive_price"))
