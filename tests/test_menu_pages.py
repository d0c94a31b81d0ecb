"""Menu pages of the second shape, worked out by hand from pages of different make."""

import json

import pytest

from tallymart.sources.menu_pages import MenuPages


def page(root=None, header=None, layouts=None, lang="en", script=True, raw=None):
    menu = {"metas": {"root": root}, "header": header, "layoutGroups": layouts}
    state = raw if raw is not None else json.dumps({"props": {"initialState": {"menuPage": {"menu": menu}}}})
    return f'<html lang="{lang}"><head><link rel="canonical" href="https://x.example/menu/place"></head><h1> Shown <b>name</b> </h1>' + (f'<script id="__NEXT_DATA__" type="application/json">{state}</script>' if script else "") + "</html>"


def spans(*texts):
    return {"spans": [{"typeName": "UISpanText", "text": t} for t in texts]}


aed = lambda n: {"fractional": n, "code": "AED"}

PAGES = {
    1: page(
        {
            "restaurant": {"id": 12, "drnId": "d-1", "uname": "the place", "name": "‎The  Place ", "currencyCode": "AED", "location": {"address": {"address1": "1 Road", "neighborhood": "Marina", "city": "Dubai", "country": " "}, "cityId": 3, "zoneId": 2.5}, "menuDisabled": False},
            "categories": [{"id": "c1", "name": "Mains"}, {"id": "", "name": "x"}, "odd", {"id": 7, "name": "Sides"}, {"id": "c9"}],
            "modifierGroups": [
                {"id": "g1", "name": "Size", "minSelection": 1, "maxSelection": 1.5, "multiselect": True, "modifierOptions": [{"id": 50, "name": "Large", "price": aed(300)}, {"name": " "}, {"id": "o2", "name": "Small", "price": {"fractional": "3", "code": "AED"}, "modifierGroupIds": ["g2", 4, True, "a b"]}]},
                {"name": "no id"},
                {"id": "g1", "name": "Sizes", "modifierOptions": [{"id": 51, "name": "Huge"}]},
                {"id": "g2", "name": "Dips"},
            ],
            "items": [
                {"id": 1, "name": "Soup", "categoryId": "c1", "price": aed(2050), "priceDiscounted": aed(1500), "image": {"url": "https://i.example/a/b.jpg?width={w}"}, "modifierGroupIds": ["g1", "gx"], "available": "yes", "popular": True},
                {"id": 51, "name": "Huge", "price": aed(0)},
                {"id": 50, "name": "Large", "price": aed(100)},
                {"id": 51, "name": "Huge", "categoryId": 7, "price": aed(0)},
                {"id": 2, "name": "Bread", "categoryId": "c1", "price": aed(400), "priceDiscounted": aed(400)},
                {"id": 3, "name": "Oil", "categoryId": "none", "price": {"fractional": 1234, "code": "KWD"}, "priceDiscounted": {"fractional": 1, "code": "AED"}, "image": {"url": "data:x"}},
                {"id": 4, "categoryId": "c1", "price": aed(1)},
                {"id": 5, "name": "Free?", "price": {"fractional": 1.5, "code": "AED"}},
                {"id": 6, "name": "Odd", "price": {"fractional": 3, "code": "aed"}},
                None,
                [1],
            ],
            "customerLocation": {"lat": 25.5, "lon": 55.5},
        },
        {"image": {"url": "http://i.example/h.jpg?x"}, "headerTags": {"lines": [spans("Italian", "·", " Pizza "), spans("(3+)"), spans("4,8 Good", "(1,200+)"), spans("AED 20 minimum", "AED 4.95 delivery", "Opens at 9"), {"spans": None}]}},
        [{"layouts": [{"actionId": "other", "blocks": [{"map": {"pins": [{"lat": 1, "lon": 1}]}}]}, {"actionId": "layout-list-map", "blocks": [{"map": {"pins": [{"lat": 25.1, "lon": 55.2}, {"lat": 25.1, "lon": 55.2}, {"lat": "25", "lon": 55}, {"lat": 0, "lon": 55}]}}]}]}],
    ),
    2: page({"items": [], "restaurant": None, "customerLocation": {"lat": 25.1, "lon": 55.2}}, layouts=[{"layouts": [{"actionId": "layout-list-map", "blocks": [{"map": {"pins": [{"lat": 25.1, "lon": 55.2}]}}]}]}], lang="ar-AE"),
    3: page(script=False),
    4: page(raw="{broken"),
    5: page({"items": "none"}),
    6: page({"items": [{"name": "No id", "price": aed(5)}]}, layouts=[{"layouts": [{"actionId": "layout-list-map", "blocks": [{"map": {"pins": [{"lat": 1, "lon": 2}, {"lat": 1, "lon": 3}]}}]}]}]),
    7: page({"restaurant": {"id": "r"}, "items": [{"id": 1, "name": "شاي", "price": aed(5)}]}, {"headerTags": {"lines": [spans("الحد الأدنى AED ٢٠", "رسوم التوصيل AED 5", "يغلق الساعة 23:00")]}}, lang="ar"),
}


@pytest.fixture(scope="module")
def menus(spark):
    rows = [(k, h, "ar" if k == 7 else "en", "x", "y") for k, h in PAGES.items()] + [(8, None, "en", "x", "y")]
    return MenuPages(spark.createDataFrame(rows, "page_id long, html string, locale string, v string, root string"))


def rows(df, *columns, page=1):
    return [tuple(r[c] for c in columns) for r in sorted(df.where(f"page_id = {page}").collect(), key=str)]


def test_restaurant(menus):
    r = menus.restaurants.where("page_id = 1").collect()[0]
    assert (r.restaurant_id, r.drn_id, r.slug, r["name"], r.url, r.currency) == ("12", "d-1", None, "The Place", "https://x.example/menu/place", "AED")
    assert (r.address, r.area, r.city, r.country, r.city_id, r.zone_id, r.menu_disabled) == ("1 Road", "Marina", "Dubai", None, 3, None, False)
    assert (r.cuisines, r.rating, r.rating_text, r.rating_count_text, r.minimum_order, r.delivery_fee, r.opening_status) == (["Italian", "Pizza"], 4.8, "4,8 Good", "(1,200+)", 20.0, 4.95, "Opens at 9")
    assert (r.image_url, r.image_anchor, r.lat, r.lng) == ("http://i.example/h.jpg", "h.jpg", 25.1, 55.2)
    assert rows(menus.restaurants, "restaurant_id", "name", "lat", page=2) == [(None, "Shown name", None)]
    assert rows(menus.restaurants, "minimum_order", "delivery_fee", "opening_status", page=7) == [(20.0, 5.0, "يغلق الساعة 23:00")]
    assert {r.page_id for r in menus.restaurants.collect()} == {1, 2, 6, 7}


def test_lists(menus):
    assert rows(menus.categories, "sort_order", "category_id", "name") == [(0, "c1", "Mains"), (1, "7", "Sides")]
    assert rows(menus.modifier_groups, "group_id", "name", "min_selections", "max_selections", "multiselect") == [("g1", "Sizes", None, None, None), ("g2", "Dips", None, None, None)]
    assert rows(menus.options, "group_id", "position", "option_id", "name", "price_delta") == [("g1", 0, "51", "Huge", None)]
    assert rows(menus.item_modifiers, "source_index", "at", "group_id", "known") == [(0, 0, "g1", True), (0, 1, "gx", False)]


def test_items(menus):
    assert sorted(rows(menus.items, "source_index", "item_id", "category_index", "position", "name", "price", "original_price", "currency")) == [
        (0, "1", 0, 0, "Soup", 15.0, 20.5, "AED"), (2, "50", None, None, "Large", 1.0, None, "AED"), (3, "51", 1, 0, "Huge", 0.0, None, "AED"), (4, "2", 0, 1, "Bread", 4.0, None, "AED"), (5, "3", None, None, "Oil", 1.234, None, "KWD"),
    ]
    soup = [r for r in menus.items.where("page_id = 1").collect() if r.source_index == 0][0]
    assert (soup.image_url, soup.image_anchor, soup.available, soup.popular, soup.modifier_group_ids) == ("https://i.example/a/b.jpg", "a/b.jpg", None, True, ["g1", "gx"])
    assert rows(menus.stats, "items_seen", "items_parsed", "items_rejected", "hidden_options", "modifier_groups") == [(11, 5, 5, 1, 2)]
    assert rows(menus.items, "item_id", "name", page=6) == [(None, "No id")]


def test_warnings(menus):
    got = lambda p: sorted(rows(menus.warnings, "code", "at", "value", page=p), key=str)
    assert got(1) == sorted([
        ("INVALID_COORDINATES", None, None), ("INVALID_COORDINATES", None, None), ("INVALID_CATEGORY", 1, None), ("INVALID_CATEGORY", 2, None), ("INVALID_CATEGORY", 4, None),
        ("INVALID_MODIFIER_GROUP", 1, None), ("INVALID_MODIFIER_OPTION", 1, None), ("MISSING_MODIFIER_GROUP", 0, "gx"), ("INVALID_DISCOUNT_PRICE", 5, None), ("UNKNOWN_CATEGORY", 5, "none"),
        ("MISSING_NAME", 6, None), ("INVALID_PRICE", 7, None), ("INVALID_PRICE", 8, None), ("INVALID_ITEM", 9, None), ("INVALID_ITEM", 10, None),
    ], key=str)
    assert [x[0] for x in got(2)] == ["COORDINATES_MATCH_CUSTOMER_LOCATION", "LOCALE_MISMATCH", "MISSING_RESTAURANT_ID", "NO_ITEMS"]
    for p in (3, 4, 5, 8):
        assert [x[0] for x in got(p)] == ["MISSING_RESTAURANT_NAME", "NEXT_DATA_UNAVAILABLE", "NO_ITEMS"]
    assert [x[0] for x in got(6)] == ["AMBIGUOUS_COORDINATES", "MISSING_RESTAURANT_ID"] and got(7) == []


def test_no_pages(spark):
    none = MenuPages(spark.createDataFrame([], "page_id long, html string, locale string"))
    assert all(t.count() == 0 for t in (none.restaurants, none.categories, none.items, none.modifier_groups, none.options, none.item_modifiers, none.stats, none.warnings))
