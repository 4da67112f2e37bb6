"""Listings derived from the driver's ``part`` table.

None of the driver tables holds shop listings, so listings are computed by
one SQL text that both Spark and DuckDB run (the oracle uses the same text as
a leading CTE).  Every derived table here grows with ``part``.  No table holds
replies of a verdict service either; :func:`replay_verdicts` and
:func:`messy_verdicts` derive them from the requests.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sameitem.session import checkpoint_dir, spread
from sameitem.sources.feeds import CHARSETS

# The listing formula agreed for the test data (FIXTURES.md §4).
LISTINGS_SQL = """
with k as (
  select p_partkey as k, cast(floor(p_partkey/4) as bigint) as q, p_partkey % 4 as r from {part}),
m as (
  select k, q, r, q % 6 as f, cast(floor(q/6) as bigint) % 4 as n,
         cast(floor(q/24) as bigint) % 3 as st, cast(floor(q/72) as bigint) % 3 as c,
         cast(floor(q/216) as bigint) % 3 as v from k),
w as (
  select *,
    case f when 0 then 'samsung galaxy s' when 1 then 'apple iphone ' when 2 then 'xiaomi redmi note '
           when 3 then 'apple watch series ' when 4 then 'sony wh-1000-xm' else 'lenovo ideapad ' end as en,
    case f when 0 then 'סמסונג גלקסי s' when 1 then 'אפל אייפון ' when 2 then 'שיאומי רדמי נוט '
           when 3 then 'אפל ווטש series ' when 4 then 'סוני wh1000xm' else 'לנובו אידיאפד ' end as he,
    case f when 0 then 21+n when 1 then 12+n when 2 then 10+n when 3 then 7+n
           when 4 then 3+(n % 3) else 1+n end as num,
    case st when 0 then '128' when 1 then '256' else '512' end as gb,
    case c when 0 then 'black' when 1 then 'white' else 'silver' end as col,
    case c when 0 then 'שחור' when 1 then 'לבן' else 'כסוף' end as colhe,
    case v when 0 then '' when 1 then ' pro' else ' ultra' end as tier
  from m)
select k+1 as listing_id,
  case when k % 41 = 40 then null
       when r=0 then concat(en,cast(num as varchar(9)),tier,' ',gb,'GB ',col)
       when r=1 then concat(he,cast(num as varchar(9)),tier,' ',colhe,' ',gb,' גיגה')
       when r=2 then concat(col,' ',en,cast(num as varchar(9)),tier,' (',gb,' gb)')
       else concat('Sale original ',en,cast(num as varchar(9)),tier,' ',gb,'gb/',col,' new') end as title,
  case when k % 29 = 28 then 'n/a' when k % 37 = 36 then '-5' when k % 23 = 22 then '100'
       else cast(cast(1500 + (q % 50)*20 + r*25 as int) as varchar(9)) end as price,
  concat('store_', cast(k % 5 as varchar(9))) as source,
  'ILS' as currency, q as true_product
from w
"""

# Partner offsets used to derive labelled pairs from the fixture (listing k is
# paired with k+d): next rendering of the same product, next model number,
# next colour, next tier, and the repeat of the same attribute combination.
GOLD_OFFSETS = (1, 24, 288, 864, 2592)


# What each feed file's titles end in, by listing_id modulo 6.  Each mark has bytes that the
# charsets before its own refuse (feeds.CHARSETS), so the reader has to find that very charset.
FEED_MARKS = ("סוני", "לנובו", "ש", "ש‗", "ü", "ü\x81")
FEED_SQL = """
select listing_id, case when listing_id % 6 < 4 or title is null then title
    else concat('listing ', cast(listing_id as varchar(20)), ', "used"') end
  || case when listing_id % 7 = 0 then concat(chr(10), 'second line, "quoted"', chr(10)) else ' ' end
  || case listing_id % 6 when 0 then '{0}' when 1 then '{1}' when 2 then '{2}' when 3 then '{3}' when 4 then '{4}' else '{5}' end as title,
  price, source, currency from {listings}
"""


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fixture_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings: ``listing_id, title, price (string), source, currency, true_product``.

    The keys are dealt over the cores, as ``part`` may be one split however many rows it has.
    """
    name = f"part_keys_{hashlib.md5(sf_dir.encode()).hexdigest()[:10]}"
    spread(read_table(spark, sf_dir, "part").select("p_partkey"), held=True).createOrReplaceTempView(name)
    return spark.sql(LISTINGS_SQL.format(part=name))


def listing_vectors(spark: SparkSession, sf_dir: str, listings: DataFrame | None = None) -> DataFrame:
    """Per-listing vectors: ``embeddings.vec_id = true_product modulo the number of vectors``.

    The embeddings table is small per vec_id but the join is a plain equi
    join; Spark broadcasts it only when its measured size is under the
    autoBroadcastJoinThreshold.
    """
    listings = listings if listings is not None else fixture_listings(spark, sf_dir)
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    vectors = max(1, emb.count())
    return (listings.select("listing_id", (F.col("true_product") % vectors).alias("vec_id"))
            .join(emb, "vec_id", "inner")
            .select("listing_id", "embedding"))


def true_match_key(df: DataFrame, q: str = "true_product") -> DataFrame:
    """Append the fixture's true match key (f, num, st, c, v) as one string."""
    qc = F.col(q)
    f = qc % 6
    n = F.floor(qc / 6) % 4
    num = F.when(f == 4, 3 + (n % 3)).otherwise(n)
    st = F.floor(qc / 24) % 3
    c = F.floor(qc / 72) % 3
    v = F.floor(qc / 216) % 3
    return df.withColumn("true_key", F.concat_ws("|", f, num, st, c, v))


def gold_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled pairs ``listing_id_1, listing_id_2, label`` derived from the fixture.

    Each listing is paired with a fixed set of offsets; label 1 when both
    listings carry the same true match key.  Linear in the listing count.
    """
    base = true_match_key(fixture_listings(spark, sf_dir)).select("listing_id", "true_key")
    a = base.select("*", F.explode(F.array(*[F.lit(d) for d in GOLD_OFFSETS])).alias("d")).alias("a")
    b = base.alias("b")
    return (a.join(b, F.col("b.listing_id") == F.col("a.listing_id") + F.col("d"))
            .select(F.col("a.listing_id").alias("listing_id_1"),
                    F.col("b.listing_id").alias("listing_id_2"),
                    (F.col("a.true_key") == F.col("b.true_key")).cast("int").alias("label")))


# Reply shapes of the replay table (test fixture), chosen per request by id.
_REPLY_SHAPES = [
    '{{"match": "{m}", "confidence": "high", "reason": "{r}"}}',
    '```json\n{{"match": "{m}", "confidence": "medium", "reason": "{r}"}}\n```',
    'Sure: {{"match": "{M}", "confidence": "High", "reason": " {r} "}} hope this helps',
    '{{"match": "{m}", "confidence": "low", "reason": "{r}"}}',
    '{{"match": "{m}", "confidence": 0.9}}',
    'not json at all',
    '',
    '[{{"match": "{m}"}}]',
]


def replay_verdicts(requests: DataFrame) -> DataFrame:
    """Verdict table derived from the outbox (test fixture for S5).

    Answers ``yes`` when both products agree on tier and colour (null-safe)
    and cycles through well-formed, fenced, chatty, malformed, empty and list
    replies; one in 13 requests gets a provider error instead.
    """
    pa = F.get_json_object("request_json", "$.product_a.tier_variant")
    pb = F.get_json_object("request_json", "$.product_b.tier_variant")
    ca = F.get_json_object("request_json", "$.product_a.color")
    cb = F.get_json_object("request_json", "$.product_b.color")
    requests = requests.select("listing_id_1", "listing_id_2",
                               (pa.eqNullSafe(pb) & ca.eqNullSafe(cb)).alias("_yes"))
    yes = F.col("_yes")
    m = F.when(yes, "yes").otherwise("no")
    r = F.when(yes, "same model and colour").otherwise("tier variant or colour differs")
    shape = (F.col("listing_id_1") * 7 + F.col("listing_id_2") * 13) % len(_REPLY_SHAPES)
    text = None
    for i, tpl in enumerate(_REPLY_SHAPES):
        parts = tpl.replace("{{", "\u0002").replace("}}", "\u0003").split("{")
        pieces = [F.lit(parts[0].replace("\u0002", "{").replace("\u0003", "}"))]
        for p in parts[1:]:
            key, rest = p.split("}", 1)
            val = {"m": m, "M": F.upper(m), "r": r}[key]
            pieces += [val, F.lit(rest.replace("\u0002", "{").replace("\u0003", "}"))]
        expr = F.concat(*pieces)
        text = F.when(shape == i, expr) if text is None else text.when(shape == i, expr)
    err = F.when((F.col("listing_id_1") * 3 + F.col("listing_id_2") * 5) % 13 == 0, F.lit("RateLimitError"))
    return requests.select("listing_id_1", "listing_id_2",
                           F.when(err.isNull(), text).alias("raw_response"), err.alias("error"))


def messy_verdicts(replies: DataFrame, last_of: DataFrame) -> DataFrame:
    """A verdict table as several runs and services leave it, from the replay table.

    Besides each reply, by the sum of its ids: replies again, replies of the pair
    the other way round, replies under the last listing of a title (``last_of``:
    ``node_id, last_id``), second replies that say no, and replies to a listing that
    isn't there.
    """
    a, b = F.col("listing_id_1"), F.col("listing_id_2")
    rest = ["raw_response", "error"]
    last = (replies.join(last_of.select(F.col("node_id").alias("listing_id_1"), F.col("last_id").alias("_l1")), "listing_id_1")
            .join(last_of.select(F.col("node_id").alias("listing_id_2"), F.col("last_id").alias("_l2")), "listing_id_2"))
    second = F.lit('{"match": "no", "confidence": "medium", "reason": "second opinion"}')
    parts = [
        replies.where((a + b) % 7 == 3).select(a, b, *rest),
        replies.where((a + b) % 3 == 0).select(b.alias("listing_id_1"), a.alias("listing_id_2"), *rest),
        last.where((a + b) % 4 == 1).select(F.col("_l2").alias("listing_id_1"), F.col("_l1").alias("listing_id_2"), *rest),
        replies.where((a + b) % 5 == 2).select(b.alias("listing_id_1"), a.alias("listing_id_2"), second.alias("raw_response"),
                                               F.lit(None).cast("string").alias("error")),
        replies.where((a + b) % 11 == 5).select(a, (-b).alias("listing_id_2"), *rest),
    ]
    out = replies.where((a + b) % 4 != 1).select(a, b, *rest)
    for part in parts:
        out = out.unionByName(part)
    return out


def feed_sql(listings: str) -> str:
    """The listings of the feeds, as Spark and DuckDB run it."""
    return FEED_SQL.format(*FEED_MARKS, listings=listings)


def write_feeds(spark: SparkSession, listings: DataFrame) -> str:
    """Write listings as CSV feeds of all charsets to the shared folder, and return the folder.

    Titles hold commas, doubled quotes and line breaks.  Spark writes some of the
    charsets only with ``spark.sql.legacy.javaCharsets``, set for the writing.
    """
    name = f"feed_listings_{uuid.uuid4().hex[:10]}"
    listings.createOrReplaceTempView(name)
    rows = spark.sql(feed_sql(name))
    folder = f"{checkpoint_dir(spark).rstrip('/')}/feeds/{uuid.uuid4().hex}"
    key = "spark.sql.legacy.javaCharsets"
    old = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        for i, (python, java) in enumerate(CHARSETS):
            own = rows.where(F.col("listing_id") % len(CHARSETS) == i)
            if python == "utf-8-sig":
                own = own.withColumnRenamed("listing_id", "\ufefflisting_id")
            (own.write.option("header", True).option("quote", '"').option("escape", '"').option("encoding", java)
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/c{i}"))
    finally:
        spark.conf.set(key, old)
    return f"{folder}/*"
