"""The order and the cheapest of offers, worked out by hand."""

import pytest
from pyspark.sql import functions as F

from tallymart.operators import offer_ranking

COLUMNS = "item long, offer_id string, platform string, price double, currency string, item_active boolean, restaurant_active boolean, status string, available boolean, rank int"
OFFERS = [
    (1, "b", "talabat", 5.0, "AED", True, True, None, True, 0), (1, "a", "talabat", 5.0, "aed ", True, True, "available", True, 0), (1, "z", "deliveroo", 5.0, "AED", True, True, None, True, 0), (1, "c", "careem", 1.0, "AED", True, None, None, True, 0),
    (1, "d", "x", None, "AED", True, True, None, True, 0), (2, "a", "careem", 0.0, "AED", True, True, None, True, 0), (2, "b", "careem", 9.0, "USD", True, True, None, True, 0),
    (3, "a", "careem", -1.0, None, None, False, "available", False, 0), (3, "b", "careem", float("nan"), "AEDX", True, True, None, False, 0), (3, "c", "careem", float("inf"), "AED", True, True, "sold", True, 0), (None, "a", None, 2.0, "AED", True, True, None, True, 0),
]


@pytest.fixture(scope="module")
def rows(spark):
    return offer_ranking.judged(spark.createDataFrame(OFFERS, COLUMNS).drop("rank"))


def test_reasons(rows):
    found = {(r.item, r.offer_id): (r.availability, r.price, r.reasons) for r in rows.collect()}
    assert found[1, "c"] == ("available", 1.0, ["RESTAURANT_INACTIVE"]) and found[1, "a"] == ("available", 5.0, []) and found[1, "d"] == ("available", None, ["PRICE_MISSING"])
    assert found[3, "a"] == ("unknown", None, ["ITEM_INACTIVE", "ITEM_AVAILABILITY_UNKNOWN", "RESTAURANT_INACTIVE", "PRICE_INVALID", "CURRENCY_INVALID"])
    assert found[3, "b"] == ("unavailable", None, ["ITEM_UNAVAILABLE", "PRICE_INVALID", "CURRENCY_INVALID"]) and found[3, "c"] == ("unknown", None, ["ITEM_AVAILABILITY_UNKNOWN", "PRICE_INVALID"])


def test_order(rows):
    found = [r.offer_id for r in offer_ranking.ranked(rows, "item").where("item = 1").orderBy("rank").collect()]
    assert found == ["z", "a", "b", "c", "d"]


def test_cheapest(rows):
    found = {(r.item, r.currency): (r.price, r.platform, r.offer_id, r.tied, r.verdict) for r in offer_ranking.cheapest_offers(rows.where("item IS NOT NULL"), "item").collect()}
    assert found == {
        (1, "AED"): (5.0, "deliveroo", "z", ["a", "b"], "OK"), (2, "AED"): (0.0, "careem", "a", [], "MIXED_CURRENCIES"), (2, "USD"): (9.0, "careem", "b", [], "MIXED_CURRENCIES"), (3, None): (None, None, None, None, "NO_ELIGIBLE_OFFERS"),
    }


def test_availability_and_no_offers(spark, rows):
    cases = [("unknown", True, "unknown"), ("available", None, "unknown"), ("unavailable", True, "unknown"), ("unavailable", False, "unavailable"), (None, None, "unknown"), (None, False, "unavailable"), ("", True, "unknown")]
    d = spark.createDataFrame(cases, "s string, f boolean, want string")
    assert d.where(offer_ranking.availability(F.col("s"), F.col("f")) != F.col("want")).count() == 0
    assert offer_ranking.ranked(rows.limit(0), "item").collect() == [] and offer_ranking.cheapest_offers(rows.limit(0), "item").collect() == []
