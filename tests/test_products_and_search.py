"""Upsert, search and evidence on rows written out by hand: nulls, empty tables, ties and repeats."""

import datetime as dt

from tallymart.operators import item_evidence, menu_search, products

DAY = lambda n: dt.datetime(2024, 1, n)
STORED = "id long, name string, match_key string, keys array<string>"
INCOMING = "seq long, name string, match_key string, keys array<string>"
OFFER = "k long, price double, in_stock boolean, observed_at timestamp"


def test_targets_by_priority(spark):
    stored = spark.createDataFrame([(1, "Cup", "g1", ["a"]), (2, "cup ", "g1", ["b"]), (3, "Mug", None, ["b", None]), (4, None, None, None)], STORED)
    incoming = spark.createDataFrame([(1, " CUP", "g9", ["b"]), (2, "Mug", "g1", []), (3, "mug", None, None), (4, None, None, [None]), (5, "new", "g9", ["z"])], INCOMING)
    got = {r.seq: (r.id, r.kind) for r in products.match_targets(incoming, stored).collect()}
    assert got == {1: (2, 1), 2: (1, 2), 3: (3, 3), 4: (None, None), 5: (None, None)}
    assert products.match_targets(incoming.limit(0), stored).count() == 0
    assert {r.id for r in products.match_targets(incoming, stored.limit(0)).collect()} == {None}


def test_offers_fold_in_order(spark):
    stored = spark.createDataFrame([(1, 10.0, True, DAY(5)), (2, 10.0, True, None), (3, 10.0, True, DAY(5))], OFFER)
    new = [
        (1, 1, 8.0, True, DAY(4)),  # older: nothing
        (1, 2, None, False, DAY(9)),  # unavailable: stock goes
        (1, 3, 7.0, True, DAY(7)),  # older than the last one that counts
        (2, 1, 8.0, None, None),  # no time on either side
        (2, 2, 9.0, True, DAY(1)),
        (3, 1, None, None, DAY(9)),  # says nothing
        (4, 1, None, False, DAY(1)),  # unavailable before there is an offer
        (5, 1, None, False, DAY(9)),
        (5, 2, 5.0, True, DAY(2)),  # opens the offer, as the one before it was dropped
        (5, 3, -1.0, False, DAY(3)),
    ]
    got = products.folded_offers(stored, spark.createDataFrame(new, "k long, seq long, price double, in_stock boolean, observed_at timestamp"), ["k"])
    assert {r.k: (r.price, r.in_stock, r.observed_at) for r in got.collect()} == {1: (10.0, False, DAY(9)), 2: (9.0, True, DAY(1)), 3: (10.0, True, DAY(5)), 5: (5.0, False, DAY(3))}


def test_several_rows_of_one_product(spark):
    stored = spark.createDataFrame([(1, "Cup", None, None), (2, "Jug", "b", 1.0)], "id long, name string, brand string, rating double")
    incoming = spark.createDataFrame([(1, "cup", None, 2.0, False), (2, "cup", "x", None, True), (3, "cup", "y", 3.0, True), (4, "New", "n", 1.0, False), (5, "new ", None, 2.0, True), (6, "NEW", "m", None, False), (7, "never", "q", 1.0, False)], "seq long, name string, brand string, rating double, insertable boolean")
    targets = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "seq long, id long")
    got = products.written_products(stored, incoming, targets, ["name", "brand"], ["rating"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "Cup", "x", 3.0, "updated", 3), (2, "Jug", "b", 1.0, "kept", 0), (None, "new ", "m", 2.0, "created", 2)], key=str)


def test_promotions_end_only_where_a_source_was_read(spark):
    stored = spark.createDataFrame([(1, "m", "a", True, DAY(1), None), (1, "m", "b", True, DAY(1), None), (1, "l", "c", True, DAY(1), None), (1, "m", "d", False, DAY(1), DAY(2)), (2, "m", "e", True, DAY(1), None)], "restaurant long, source string, offer_key string, active boolean, first_seen timestamp, ended_at timestamp")
    shown = spark.createDataFrame([(1, "m", "a"), (1, "m", "a"), (1, "m", "d"), (1, "m", "n"), (2, "m", None)], "restaurant long, source string, offer_key string")
    got = {r.offer_key: (r.active, r.action) for r in menu_search.synced_promotions(stored, shown, DAY(9)).collect()}
    assert got == {"a": (True, "shown"), "b": (False, "ended"), "c": (True, "kept"), "d": (True, "reactivated"), "e": (False, "ended"), "n": (True, "created")}


def test_two_close_candidates_go_to_review(spark):
    scores = spark.createDataFrame([(1, 7, 0.8, "m", True, True), (1, 8, 0.71, "m", True, True), (2, 7, 0.8, "m", True, True), (2, 8, 0.7, "m", True, False), (3, 7, 0.9, "m", False, False)], "item long, canonical long, confidence double, method string, plausible boolean, matchable boolean")
    items = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id long")
    got = {r.item: (r.canonical, r.status) for r in item_evidence.decided(items, scores).collect()}
    assert got == {1: (7, "REVIEW"), 2: (7, "MATCHED"), 3: (None, "UNMATCHED"), 4: (None, "UNMATCHED")}
