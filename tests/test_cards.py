"""Cards of listing pages of different make, worked out by hand."""

import json

import pytest

from tallymart.sources import cards


def card(own, name, badges=(), href=None, **more):
    node = {"partner-name.content": name, "x.on-tap": {"action": {"parameters": {"restaurant_id": own, **({"restaurant_href": href} if href else {})}}}}
    return node | {f"promotional-{i}-label.content": b for i, b in enumerate(badges)} | more


def deep(node, levels):
    for _ in range(levels):
        node = {"n": [node]}
    return node


def page(state):
    return f'<html><script id="__NEXT_DATA__" type="application/json">{state if isinstance(state, str) else json.dumps(state)}</script></html>'


PAGES = {
    1: page({"a": [card("7", " Two  words‎", ["B", "A"], "/m/7?x=1"), card("8", "Eight"), {"z": card("7", "other", ["A", "C ", " ", "B"], "/no")}]}),
    2: page(deep(card(5, "Five", ["30% off entire menu"], inner=card(6.0, "Six", ["x"])), 600)),
    3: page({"c": [card(True, "no id"), card(None, "none"), {"partner-name.content": 3}, {"partner-name.content": "no tap"}, card("", "empty id")]}),
    4: page('{"partner-name.content": broken'), 5: "partner-name.content without a state", 6: None, 7: "",
    8: page({"partner-name.content": "tap is a text", "on-tap": "x", "b.on-tap": {"action": {"parameters": {"restaurant_id": 1}}}}),
    9: page("[" * 200_000),
}


@pytest.fixture(scope="module")
def found(spark):
    rows = spark.createDataFrame([(k, h, "x", 0) for k, h in PAGES.items()], "page_id long, html string, id string, at int")
    return cards.listed_places(rows)


def test_places(found):
    rows = {(r.page_id, r.id): (r["at"], r["name"], r["path"], r["labels"]) for r in found.collect()}
    assert rows == {
        (1, "7"): (0, "Two words", "/m/7", ["B", "A", "C"]), (1, "8"): (1, "Eight", None, []), (2, "5"): (0, "Five", None, ["30% off entire menu"]), (2, "6"): (1, "Six", None, ["x"]), (3, ""): (0, "empty id", None, []),
    }


def test_offers(found):
    rows = sorted((r.page_id, r.id, r.place, r.type, r.percentage) for r in cards.listed_offers(found).collect())
    assert rows == [(1, "7", 0, "OTHER", None), (1, "7", 1, "OTHER", None), (1, "7", 2, "OTHER", None), (2, "5", 0, "PERCENT_OFF_MENU", 30.0), (2, "6", 0, "OTHER", None)]


def test_no_pages(spark):
    assert cards.listed_places(spark.createDataFrame([], "page_id long, html string")).collect() == []
