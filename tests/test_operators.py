"""Operators on authored rows: what the rules say in the cases that matter."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallymart.functions import geo, text
from tallymart.operators import merge, pricing, search
from tallymart.streaming import windows

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
OFFER = "product_id long, retailer_id long, price double, in_stock boolean, observed_at timestamp"


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "title, key",
    [
        ("Fresh Full-Fat Milk 1L", "fat full milk#1l"),
        ("Milk, full fat 1L", "fat full milk#1l"),
        ("Milk full fat 2L", "fat full milk#2l"),
        ("Water 4 x 1L", "water#4x1l"),
        ("Eggs 6 pieces", "eggs#6pc"),
        ("Milk", None),
        ("500g", None),
        (None, None),
        ("", None),
    ],
)
def test_grocery_key(spark, title, key):
    assert one(spark, text.grocery_match_key, title) == key


def test_scalar_rules(spark):
    assert one(spark, text.storage_gb, "Phone 8GB RAM 256GB") == 256
    assert one(spark, text.storage_gb, "Disk 2TB") == 2048
    assert one(spark, text.storage_gb, "Phone") is None
    assert one(spark, text.canonical_url, "http://www.Shop.example/A/b/?x=1#y") == "https://shop.example/a/b"
    assert [one(spark, text.price_tier, p, "double") for p in (199.0, 200.0, 500.0, 1500.0, 5000.0, None)] == ["budget", "affordable", "mid-range", "premium", "luxury", None]
    assert one(spark, text.name_tokens, "The NEW Widget, a widget x2") == ["widget", "x2"]


def test_newer_wins(spark):
    stored = spark.createDataFrame([(1, 1, 10.0, True, T1), (2, 1, 10.0, True, T0), (3, 1, 5.0, True, T0)], OFFER)
    came = spark.createDataFrame([(1, 1, 8.0, True, T0), (2, 1, None, False, T1), (4, 1, 7.0, None, T1)], OFFER)
    got = {r.product_id: (r.price, r.in_stock, r.observed_at) for r in merge.newer_wins(stored, came, ["product_id", "retailer_id"]).collect()}
    assert got == {1: (10.0, True, T1), 2: (10.0, False, T1), 3: (5.0, True, T0), 4: (7.0, None, T1)}


def test_prices(spark):
    rows = [(1, 1, 5.0, False, T1), (1, 2, 9.0, None, T1), (1, 3, 12.0, True, T1), (1, 4, 1.0, True, T0)]
    marked = pricing.mark_stale(spark.createDataFrame(rows, OFFER), "2024-01-15")
    r = pricing.price_ranges(marked).first()
    assert (r.lowest_price, r.highest_price, r.best_confirmed, r.n_comparable) == (9.0, 12.0, 12.0, 2)


def test_diff_reports_no_vanished_row(spark):
    before = spark.createDataFrame([(1, "a"), (2, None), (3, "x")], "id long, v string")
    after = spark.createDataFrame([(1, "b"), (2, None), (4, "y")], "id long, v string")
    got = {tuple(r) for r in merge.field_diff(before, after, "id", ["v"]).collect()}
    assert got == {(1, "updated", "v", "a", "b"), (4, "created", "v", None, "y")}


def test_near_pairs(spark):
    pins = spark.createDataFrame([(1, 25.0, 55.0), (2, 25.0003, 55.0), (3, 25.1, 55.0)], "id long, lat double, lng double")
    got = {(r.id1, r.id2) for r in geo.near_pairs(pins, pins, 75).collect() if r.id1 < r.id2}
    assert got == {(1, 2)}


def test_token_pairs_equal_all_pairs(spark):
    rows = [(i, [f"w{(i * k) % 11}" for k in range(1, 2 + i % 5)]) for i in range(30)]
    rows = [(i, list(dict.fromkeys(t))) for i, t in rows]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    want = {(i, j) for i, a in rows for j, b in rows if i < j and len(set(a) & set(b)) / len(set(a) | set(b)) >= 0.4}
    assert {(r.id1, r.id2) for r in search.token_pairs(df, df, text.jaccard, 0.4).collect()} == want


def test_stream_merge_survives_late_and_repeated_rows(spark, tmp_path):
    source = tmp_path / "in"
    write = lambda n, rows: spark.createDataFrame(rows, OFFER).coalesce(1).write.parquet(str(source / n))
    write("b0", [(1, 1, 10.0, True, T1)])
    run = lambda: windows.merge_offers(spark.readStream.schema(OFFER).parquet(str(source / "*")), str(tmp_path / "out"), str(tmp_path / "cp"), ["product_id", "retailer_id"]).awaitTermination()
    run()
    write("b1", [(1, 1, 8.0, True, T0), (2, 1, 3.0, None, T0)])
    run()
    got = {(r.product_id, r.price) for r in spark.read.parquet(str(tmp_path / "out" / "1")).collect()}
    assert got == {(1, 10.0), (2, 3.0)}


def test_rules_and_folding(spark):
    from tallymart.functions import identity_text, rules

    assert one(spark, rules.product_type, "Apple iPad Air with iPhone case") == "tablet"
    assert one(spark, rules.product_type, "Galaxy S24 phone") == "phone" and one(spark, rules.product_type, "Mug") is None
    assert one(spark, rules.brand, "New SONY headphones") == "sony" and one(spark, rules.brand, "one two three four sony") is None
    assert [identity_text.fold(x) for x in ("Café  & Co.", "أحمة", "--", None)] == ["cafe and co", "احمه", None, None]
    assert one(spark, identity_text.identity_text, "É-b") == "e b"
