"""Median selection of price groups against plain Python."""

import random
from statistics import median

import pytest

from sameitem.operators import groups as G


def price_rows():
    rng = random.Random(4)
    rows = [(1, float(p)) for p in rng.sample(range(1, 400_000), 12_000)]  # a heavy component
    rows += [(2, float(rng.choice([5, 10, 1000, 1000, 1001])) ) for _ in range(3000)]  # ties across the middle
    for c in range(3, 60):
        rows += [(c, round(rng.lognormvariate(3, 3), 2)) for _ in range(rng.randint(1, 9))]
    rows += [(60, None), (60, None), (61, None), (61, 7.0), (62, -4.0), (62, 0.0), (62, 8.0), (63, 3.0), (63, 3.0)]
    return rows


def test_medians_and_low_prices_whatever_the_sketch_says(spark):
    rows = price_rows()
    held = {}
    for c, p in rows:
        if p is not None:
            held.setdefault(c, []).append(p)
    want = {c: median(v) for c, v in held.items() if len(v) >= 2}
    low = {(c, p) for c, v in held.items() if c in want for p in v if p < 0.5 * want[c]}
    members = spark.createDataFrame(rows, "component long, price double").repartition(6)
    prices = members.where("price is not null").groupBy("component", "price").count().withColumnRenamed("count", "n")
    for accuracy in (2, 10, G.SKETCH):  # a coarse sketch costs rows, not results
        near = G.around_median(members, prices, accuracy)
        assert {r.component: r.median for r in G.median_prices(near).collect()} == pytest.approx(want)
        assert {tuple(r) for r in G.low_prices(members, accuracy).collect()} == low
    assert len(low) > 1000


def test_only_prices_near_the_median_meet_in_one_task(spark):
    members = spark.range(200_000).selectExpr("1L as component", "cast(id * 7919 % 200003 as double) as price").repartition(8)
    prices = members.groupBy("component", "price").count().withColumnRenamed("count", "n")
    near = G.around_median(members, prices)
    assert 1 <= near.count() < 400
    values = sorted(i * 7919 % 200003 for i in range(200_000))
    assert G.median_prices(near).first().median == median(values)


def test_a_sketch_that_misses_the_median_is_put_right(spark, monkeypatch):
    rows = [(1, float(p)) for p in range(101)]
    members = spark.createDataFrame(rows, "component long, price double")
    prices = members.groupBy("component", "price").count().withColumnRenamed("count", "n")
    real = G.F.percentile_approx
    for shares in ([0.0, 0.2], [0.8, 1.0]):  # both ends under the median, both above it
        monkeypatch.setattr(G.F, "percentile_approx", lambda c, _, a, shares=shares: real(c, shares, a))
        assert G.median_prices(G.around_median(members, prices)).first().median == 50.0


def test_no_prices(spark):
    members = spark.createDataFrame([(1, None), (2, 4.0)], "component long, price double")
    assert G.low_prices(members).collect() == []
    assert G.low_prices(members.limit(0)).collect() == []
