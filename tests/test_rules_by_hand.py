"""Edge cases of merges, budgets, robots rules, cells and listing keys, each with its result written out."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallymart.functions import geo, marketplace, variants
from tallymart.operators import merge, runs
from tallymart.sources import semistructured


def day(n):
    return dt.datetime(2024, 1, n)


def test_newer_wins(spark):
    schema = "k int, price double, in_stock boolean, observed_at timestamp"
    stored = [(1, 10.0, True, day(5)), (2, 10.0, True, None), (3, 10.0, True, day(1)), (4, 10.0, True, day(1)), (6, 10.0, None, day(1))]
    incoming = [(1, 8.0, True, day(4)), (2, 8.0, None, day(1)), (3, None, None, day(2)), (4, 8.0, False, None), (5, None, False, day(1)), (7, 9.0, None, None)]
    got = merge.newer_wins(spark.createDataFrame(stored, schema), spark.createDataFrame(incoming, schema), ["k"]).collect()
    want = [(1, 10.0, True, day(5)), (2, 8.0, None, day(1)), (3, 10.0, False, day(2)), (4, 10.0, True, day(1)), (6, 10.0, None, day(1)), (7, 9.0, None, None)]
    assert sorted(tuple(r) for r in got) == want


def test_a_refused_call_consumes_nothing(spark):
    calls = spark.createDataFrame([(1, 1, 30), (1, 2, 20), (1, 3, 5), (2, 1, 41), (2, 2, 40)], "day int, at int, cost int")
    got = runs.within_budget(calls, ["day"], ["at"], "cost", 40).orderBy("day", "at").collect()
    assert [(r.accepted, r.spent) for r in got] == [(True, 30), (False, 30), (True, 35), (False, 0), (True, 40)]


def test_robots(spark):
    rules = spark.createDataFrame([("h", False, "/private"), ("h", True, "/private/open"), ("h", False, "/*.pdf$"), ("h", False, "/a?b"), ("h", True, "/same"), ("h", False, "/same"), ("h", False, "")], "host string, allow boolean, prefix string")
    paths = {"/private/x": False, "/private/open/x": True, "/x/y.pdf": False, "/x/y.pdf?z": True, "/a?b": False, "/ab": True, "/same": True, "/": True}
    urls = spark.createDataFrame([("h", p) for p in paths] + [("other", "/private")], "host string, path string")
    assert {(r.host, r.path): r.allowed for r in semistructured.robots_allow(rules, urls).collect()} == {("h", p): ok for p, ok in paths.items()} | {("other", "/private"): True}


def test_near_pairs_everywhere(spark):
    """High latitudes, the date line and the poles against all pairs."""
    import random

    rng = random.Random(4)
    pins = []
    for lat, lng in [(0, 0), (24, 54), (60, 10), (-78, 179.999), (78, -179.999), (89.9985, 20), (-89.999, -100), (41.5, 180)]:
        pins += [(lat + rng.uniform(-0.004, 0.004), (lng + rng.uniform(-0.03, 0.03) + 180) % 360 - 180) for _ in range(30)]
    pins = [(max(-90.0, min(90.0, a)), b) for a, b in pins]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pins)], "id int, lat double, lng double")
    got = {(r.id1, r.id2) for r in geo.near_pairs(df, df, 500).collect()}
    every = df.selectExpr("id AS id1", "lat AS a", "lng AS b").crossJoin(df.selectExpr("id AS id2", "lat AS c", "lng AS d"))
    want = {(r.id1, r.id2) for r in every.where(geo.distance_m(F.col("a"), F.col("b"), F.col("c"), F.col("d")) <= 500).collect()}
    assert got == want and len(want) > 400


def test_keys_of_listings(spark):
    rows = [
        ("amazon", "https://www.amazon.ae/x/dp/B0ABCDEF12?tag=1", "B0ABCDEF12", "https://amazon.ae/dp/B0ABCDEF12", True),
        ("amazon", "https://amzn.to/abc", None, "https://amzn.to/abc", True),
        ("noon", "https://www.noon.com/uae-en/p-q/N123456A/p/", "N123456A", "https://noon.com/uae-en/p-q/n123456a/p", False),
        ("shop", "https://shop.example.com/", None, "https://shop.example.com/", False),
        ("shop", "mailto:x", None, None, False),
        ("shop", None, None, None, False),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "r string, url string")
    got = df.select(marketplace.marketplace_id(F.col("r"), F.col("url")), marketplace.canonical_product_url(F.col("url")), marketplace.is_affiliate(F.col("url"))).collect()
    assert [tuple(g) for g in got] == [r[2:] for r in rows]


@pytest.mark.parametrize("price, others, want", [(10.0, [25.0], True), (10.0, [20.0], False), (None, [1.0], False), (10.0, [], False), (10.0, [0.0, 12.0], False)])
def test_price_conflict(spark, price, others, want):
    df = spark.createDataFrame([(price, others)], "p double, o array<double>")
    assert df.select(variants.price_conflict(F.col("p"), F.col("o"))).first()[0] is want
