"""Feeds in splits give what one reader of the whole file gives."""
import csv
import io
import random
import tempfile

import pytest

from sameitem.sources import feeds as X
from sameitem.sources.files import detect_charset, file_charsets, read_listing_feeds

HEAD = "listing_id,title,price,source,currency\n"
MARK = {"utf-8": "סוני", "utf-8-sig": "לנובו", "cp1255": "ש€", "iso-8859-8": "ש‗", "cp1252": "ü€", "latin1": "ü\x81"}


def feed_rows(rng, n, first, mark):
    bits = [mark, "plain", 'say "so"', ",", "line\nbreak", "\r\n", '"', '""', " ", "15\" wide", "a,b\n\n,c"]
    return [[str(first + i), "".join(rng.choice(bits) for _ in range(rng.choice([1, 3, 6]))) + mark, rng.choice(["10", "n/a", "1,5"]),
             rng.choice(["s1", "store, two"]), "ILS"] for i in range(n)]


def write_feeds(n=60, seed=1):
    rng, folder, want = random.Random(seed), tempfile.mkdtemp(prefix="sameitem-feeds-"), {}
    for k, (enc, mark) in enumerate(MARK.items()):
        rows = feed_rows(rng, n, 1000 * k, mark)
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"])).writerows(rows)
        text = out.getvalue().rstrip("\n\r") if k % 2 else out.getvalue() + "\n\n"  # no last line break, or blank lines
        with open(f"{folder}/f{k}.csv", "wb") as f:
            f.write((HEAD + text).encode(enc))
        want |= {int(r[0]): tuple(None if v == "n/a" else v for v in r[1:]) for r in rows}
    return folder, want


@pytest.mark.parametrize("split,chunk", [(1 << 27, X.CHUNK_BYTES), (700, 200), (150, 1)])
def test_records_of_all_charsets_survive_every_cut(spark, split, chunk):
    folder, want = write_feeds()
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        if split < 1000:
            assert X.feed_chunks(spark, f"{folder}/f0.csv", chunk).select("start").distinct().count() > 3
        rows = X.read_feeds(spark, folder, chunk).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = {int(r.listing_id): tuple(None if v == "n/a" else v for v in (r.title, r.price, r.source, r.currency)) for r in rows}
    assert len(rows) == len(want) and got == want
    names = {java for _, java in X.CHARSETS}
    assert {r.charset for r in rows} == names


def test_state_after_a_line():
    for line, outside, inside in ((b"a,b", False, True), (b'a,"b', True, False), (b'b",c', False, False), (b'"a"",b', True, False),
                                  (b'a 15" b,c', False, False), (b'"a","b"', False, False), (b'"","', True, False), (b"", False, True),
                                  (b'x"",y', False, True), (b'",",', False, True), (b'""""', False, True)):
        assert (X.quoted_after(line, False), X.quoted_after(line, True)) == (outside, inside), line


def test_charsets_and_odd_files(spark):
    folder, _ = write_feeds(5)
    found = {r.path[-6:]: r.charset for r in file_charsets(spark, folder).collect()}
    assert [found[f"f{k}.csv"] for k in range(6)] == [java for _, java in X.CHARSETS]
    for k in range(6):
        assert detect_charset(open(f"{folder}/f{k}.csv", "rb").read()) == found[f"f{k}.csv"]
    empty = tempfile.mkdtemp(prefix="sameitem-feeds-")
    for name, text in (("a", ""), ("b", HEAD), ("c", HEAD + "\n\n"), ("d", HEAD + '1,"NA",2,s,x\n')):
        open(f"{empty}/{name}.csv", "w").write(text)
    assert [tuple(r) for r in read_listing_feeds(spark, empty).collect()] == [(1, None, "2", "s", "x")]


@pytest.mark.parametrize("text", ["1,two,3\n", '1,"open,3,s,x\n', "x1,title,5,s,ILS\n"])
def test_malformed_records_end_the_job(spark, text):
    folder = tempfile.mkdtemp(prefix="sameitem-feeds-")
    open(f"{folder}/a.csv", "w").write(HEAD + text)
    with pytest.raises(Exception):
        read_listing_feeds(spark, folder).collect()
