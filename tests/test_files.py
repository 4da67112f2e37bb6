"""S1-S3 and K*: CSV feeds in and result files out."""
import os
import tempfile

import pytest

from sameitem.operators.quality import check_required_columns
from sameitem.operators.evaluation import read_labels_csv
from sameitem.plans.pipeline import Run
from sameitem.sources.files import detect_charset, read_listing_feeds, read_listings_csv, write_outputs, write_table

from conftest import SF001

HEAD = "listing_id,title,price,source,currency\n"


def feed(text, encoding="utf-8"):
    path = os.path.join(tempfile.mkdtemp(prefix="sameitem-csv-"), "listings.csv")
    with open(path, "wb") as f:
        f.write((HEAD + text).encode(encoding))
    return path


def test_csv_round_trip(spark):
    df = read_listings_csv(spark, feed("1,סמסונג גלקסי S23 שחור 128 גיגה,3099,store_a,ILS\n2,NA,n/a,store_b,ILS\n"))
    rows = {r["listing_id"]: r for r in df.collect()}
    assert rows[1]["title"].startswith("סמסונג")
    assert rows[2]["title"] is None and rows[2]["price"] is None
    out = tempfile.mkdtemp(prefix="sameitem-csv-") + "/out"
    write_table(df.selectExpr("listing_id", "array(title) as t"), out, fmt="csv", order=["listing_id"])
    assert spark.read.option("header", True).option("escape", '"').csv(out).count() == 2


def test_quotes_commas_and_line_breaks(spark):
    title = 'Lenovo 15" IdeaPad, 5'
    df = read_listings_csv(spark, feed('1,"Lenovo 15"" IdeaPad, 5",2000,store_a,ILS\n2,"two\nlines",5,s,ILS\n'))
    rows = {r["listing_id"]: tuple(r)[1:] for r in df.collect()}
    assert rows[1] == (title, "2000", "store_a", "ILS") and rows[2][0] == "two\nlines"
    out = tempfile.mkdtemp(prefix="sameitem-csv-") + "/out"
    write_table(df, out, fmt="csv")
    assert {r["listing_id"]: tuple(r)[1:] for r in read_listings_csv(spark, out).collect()} == rows


def test_malformed_rows_end_the_job(spark):
    with pytest.raises(Exception):
        read_listings_csv(spark, feed("x1,title,5,s,ILS\n")).collect()


def test_feeds_of_several_charsets(spark):
    folder = tempfile.mkdtemp(prefix="sameitem-feeds-")
    text = {"utf-8": "1,סמסונג,10,a,ILS\n", "utf-8-sig": "2,אייפון,10,a,ILS\n", "cp1255": "3,שיאומי,10,a,ILS\n", "cp1252": "4,café €,10,a,ILS\n"}
    for k, (enc, row) in enumerate(text.items()):
        with open(f"{folder}/f{k}.csv", "wb") as f:
            f.write((HEAD + row).encode(enc))
    old = spark.conf.get("spark.sql.legacy.javaCharsets")
    rows = {r.listing_id: r.title for r in read_listing_feeds(spark, folder).collect()}
    spark.conf.set("spark.sql.legacy.javaCharsets", old)
    assert rows[1] == "סמסונג" and rows[2] == "אייפון" and rows[3] == "שיאומי" and len(rows) == 4
    assert detect_charset("שלום".encode("cp1255")) == "windows-1255" and detect_charset(bytes(range(128, 256))) == "ISO-8859-1"


def test_required_columns_and_labels(spark):
    with pytest.raises(ValueError, match="currency.*price"):
        check_required_columns(spark.createDataFrame([(1, "t", "s")], "listing_id long, title string, source string"))
    path = os.path.join(tempfile.mkdtemp(prefix="sameitem-csv-"), "labels.csv")
    with open(path, "w") as f:
        f.write("listing_id_1,listing_id_2,label\n1,2,1\n1,3,0\n")
    assert [tuple(r) for r in read_labels_csv(spark, path).orderBy("listing_id_2").collect()] == [(1, 2, 1), (1, 3, 0)]


def test_outputs_of_a_first_run(spark):
    run = Run.from_fixture(spark, SF001, verdict_source=None)
    out = tempfile.mkdtemp(prefix="sameitem-out-") + "/run"
    write_outputs(run, out)
    box = spark.read.parquet(f"{out}/verdict_outbox")
    assert box.count() > 0 and set(r.review_bucket for r in box.select("review_bucket").distinct().collect()) <= {"review", "verify"}
    decisions = [tuple(r) for r in spark.read.parquet(f"{out}/match_decisions").select("listing_id_1", "listing_id_2").collect()]
    assert len(decisions) == run.scored.count()
    assert spark.read.parquet(f"{out}/llm_usage_summary").first().llm_used == 0
    csv = tempfile.mkdtemp(prefix="sameitem-out-") + "/g"
    write_table(run.groups, csv, "csv", ["group_id"], bom=True)
    part = next(p for p in sorted(os.listdir(csv)) if p.endswith(".csv"))
    assert open(f"{csv}/{part}", "rb").read(3) == b"\xef\xbb\xbf"


def test_sorted_output_computes_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    out = tempfile.mkdtemp(prefix="sameitem-csv-") + "/out"
    write_table(spark.range(50).repartition(3).mapInPandas(count, "id long"), out, fmt="csv", order=["id"])
    assert seen.value == 50
    assert spark.read.option("header", True).csv(out).count() == 50


def test_listings_of_one_split_are_cleaned_in_as_many_tasks_as_cores(spark):
    from sameitem.sources.fixture import fixture_listings
    raw = fixture_listings(spark, SF001)
    assert spark.read.parquet(f"{SF001}/part.parquet").rdd.getNumPartitions() == 1
    kept = raw.where("price like '1%' and title is not null")
    assert kept.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()  # nothing before the deal


def test_one_extraction_serves_matching_and_the_attribute_table(spark):
    r = Run.from_fixture(spark, SF001)
    assert r.listings.columns == [c for c in r.extracted.columns if c not in ("dq_missing_title", "dq_missing_price", "dq_nonpositive_price")]
    assert "listings-" in r.listings.inputFiles()[0] and r.listings.inputFiles() == r.extracted.inputFiles()
    cols = ["listing_id", "row_seq", "normalized_title", "brand", "model_family", "storage"]
    assert sorted(map(str, r.extracted.select(*cols).collect())) == sorted(map(str, r.attributed.select(*cols).collect()))
