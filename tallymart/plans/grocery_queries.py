"""Queries on grocery pages, prices that pages mention, canonical items and discovery."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.functions.item_text import item_key
from tallymart.operators import upkeep
from tallymart.plans.catalog import register
from tallymart.plans.menu_queries import _column, _dealt, _expected
from tallymart.sources import grocery
from tallymart.sources.tables import table

c = F.col


def _pages(spark, sf, before: str, after: str):
    """A page for each part with the given state; `@` stands for the part's size."""
    page = F.concat(F.lit(f'<html><script id="__NEXT_DATA__" type="application/json">{before}'), c("p_size"), F.lit(f"{after}</script></html>"))
    return table(spark, sf, "part").select(c("p_partkey").alias("page_id"), F.when(c("p_partkey") % 4 != 0, page).otherwise("<html></html>").alias("html"))


@register(
    "grocery_listing",
    """SELECT p_partkey AS page_id, x.* FROM part, LATERAL (VALUES (0, 's1', 'Green Tea', p_size + 0.5::DOUBLE, 99.0::DOUBLE, 'a b', 3.0::DOUBLE, NULL), (1, NULL, 'Jam', 2.0, NULL, 'c', 0.0, NULL), (2, NULL, NULL, 2.0, NULL, '', NULL, 'NO_TITLE'), (3, NULL, 'Bun', NULL, NULL, '', 1.0, 'NO_PRICE')) x("at", sku, title, price, original_price, images, stock, problem) WHERE p_partkey % 4 <> 0""",
)
def grocery_listing(spark, sf):
    """X10; each fourth page has no state."""
    before = '{"props": {"pageProps": {"initialState": {"itemsData": {"pageCount": 3, "currentPage": 0, "items": [{"id": "1", "sku": "s1", "title": " Green  Tea ", "originalPrice": 99, "images": ["a", "", "b"], "image": "z", "stockAmount": 3, "price": '
    after = '.5}, {"title": "Jam", "price": "2", "image": "c", "inStock": false}, {"title": " ", "price": 2}, null, {"title": "Bun", "price": 0, "inStock": true}]}}}}}'
    rows = grocery.listed_items(_pages(spark, sf, before, after))
    return rows.select("page_id", F.when(c("at") > 3, c("at") - 1).otherwise(c("at")).alias("at"), "sku", "title", "price", "original_price", F.array_join("images", " ").alias("images"), "stock", "problem")


@register(
    "grocery_menu",
    """SELECT p_partkey AS page_id, x.* FROM part, LATERAL (VALUES (0, '7', 'Tea', 'tea-1', p_size + 0.99::DOUBLE, 120.5::DOUBLE, 'u', 5.0::DOUBLE, NULL), (1, '8', 'Jam', '8', 3.0, 3.0, '', 1.0, NULL), (2, '9', 'Bun', '9', NULL, NULL, '', NULL, 'NO_PRICE')) x("at", id, title, slug, price, original_price, images, stock, problem) WHERE p_partkey % 4 <> 0""",
)
def grocery_menu(spark, sf):
    """X13; each fourth page has no state."""
    before = '{"props": {"initialState": {"menuPage": {"menu": {"metas": {"root": {"items": [{"id": 7, "name": "Tea", "uid": "tea-1", "image": {"url": "u"}, "price": {"fractional": 12050}, "stockCount": 5, "available": false, "priceDiscounted": {"fractional": '
    after = '99}}, {"id": "8", "name": "Jam", "price": {"fractional": 300}, "available": true}, {"id": "9", "name": "Bun", "price": {"fractional": -1}}]}}}}}}}'
    rows = grocery.menu_items(_pages(spark, sf, before, after))
    return rows.select("page_id", "at", "id", "title", "slug", "price", "original_price", F.array_join("images", " ").alias("images"), "stock", "problem")


@register(
    "menu_promotions",
    """SELECT p_partkey AS page_id, x.* FROM part, LATERAL (VALUES ('PERCENT_OFF_MENU', 'FullMenuPercentOff', p_size::DOUBLE, 50.0::DOUBLE, 20.0::DOUBLE, NULL), ('PERCENT_OFF_ITEMS', 'itemSpecificPercentOffV2', 25.0, NULL, NULL, '1 2'), ('OTHER', 'Mystery', NULL, NULL, NULL, NULL), ('FREE_DELIVERY', 'FreeDelivery', NULL, 30.5, NULL, NULL), ('BUY_ONE_GET_ONE', 'ItemBogo', NULL, NULL, NULL, '3')) x(kind, name, percentage, least_order, most_off, items) WHERE p_partkey % 4 <> 0""",
)
def menu_promotions(spark, sf):
    """X15; each fourth page has no state."""
    first = '{"typeName": "FullMenuPercentOff", "minimumOrderValue": {"fractional": 5000, "currency_code": "AED"}, "maxDiscount": {"fractional": 2000}, "percentageDiscount": '
    before = '{"props": {"initialState": {"menuPage": {"menu": {"metas": {"root": {"restaurant": {"id": 1}, "offer": {"progressBar": {"offer": {"typeName": "FreeDelivery", "minimumOrderValue": {"fractional": 3050}}}, "offers": [{"typeName": "itemSpecificPercentOffV2", "percentageDiscount": 25, "itemIds": [1, "2"], "maxDiscount": {"fractional": 0}}, {"typeName": "Mystery"}, {"x": 1}, {"typeName": "Mystery"}, {"typeName": "ItemBogo", "itemIds": ["3"]}], "offer": ' + first
    rows = grocery.menu_promotions(_pages(spark, sf, before, "}}}}}}}}}"))
    return rows.select("page_id", "kind", "name", "percentage", "least_order", "most_off", F.array_join("items", " ").alias("items"))


#: text, price, anchor, original price
MENTIONED = [
    ('{"sku":"A1","regular_price":{"currency":"AED","value":120},"final_price":{"value":99.5}}', 99.5, "A1", 120.0),
    ('\\"regular_price\\":150,\\"final_price\\":99.5', 99.5, None, 150.0),
    ("base_regular_price:150, final_price:99.5", 99.5, None, None),
    ("regular_price:150, final_price:99.5" + " " * 2000 + "regular_price:160, final_price:99.5", 99.5, None, None),
    ("A1 regular_price:150, final_price:99.5" + " " * 4000 + "B2 regular_price:160, final_price:99.5", 99.5, "B2", 160.0),
    ("regular_price:150, final_price:99.5", 99.5, "C3", None), ("regular_price:99.5, final_price:99.5", 99.5, None, None), ("regular_price:150, final_price:80", 99.5, None, None), ("regular_price:150, final_price:80", None, None, None), (None, 1.0, None, None),
]


@register("original_prices", _expected(original=_column(MENTIONED, 3)))
def original_prices(spark, sf):
    """X16."""
    found = grocery.original_price("regular_price", "final_price")
    return _dealt(spark, sf, *[(n, _column(MENTIONED, i)) for i, n in enumerate(("text", "price", "anchor"))]).select("id", found("text", "price", "anchor").alias("original"))


@register(
    "canonical_enrichment",
    """WITH p AS (SELECT p_partkey AS k, p_name, p_partkey % 3 <> 0 AS held, p_partkey % 5 <> 0 AS seen, p_partkey % 2 = 0 AS renamed, p_partkey % 7 = 0 AS arabic FROM part)
 SELECT k AS item, CASE WHEN held AND renamed THEN 'Was ' || k ELSE p_name END AS en, CASE WHEN seen AND arabic THEN 'ar' END AS ar, CASE WHEN held THEN CASE WHEN seen AND renamed THEN CASE WHEN k % 4 = 0 THEN 'old' ELSE 'old,' || p_name END ELSE 'old' END ELSE '' END AS aliases,
  CASE WHEN NOT held THEN 'created' WHEN NOT seen THEN 'kept' WHEN arabic OR (renamed AND k % 4 <> 0) THEN 'enriched' ELSE 'unchanged' END AS status FROM p WHERE held OR seen""",
)
def canonical_enrichment(spark, sf):
    """Two thirds of the parts have a canonical item, every second of them under another name; each fourth of those shows its stored name again in other case."""
    k, p = c("p_partkey"), table(spark, sf, "part")
    text = lambda en, ar=None: F.struct(en.alias("en"), F.lit(ar).cast("string").alias("ar") if not hasattr(ar, "alias") else ar.alias("ar"))
    none = F.lit(None).cast("struct<en: string, ar: string>")
    was = F.concat(F.lit("Was "), k)
    stored = p.where(k % 3 != 0).select(k.alias("item"), text(F.when(k % 2 == 0, was).otherwise(c("p_name"))).alias("name"), none.alias("description"), none.alias("category"), F.array(F.lit("old")).alias("aliases"), F.array(F.lit("old")).alias("alias_keys"))
    shown = F.when((k % 4 == 0) & (k % 3 != 0), F.upper(was)).otherwise(c("p_name"))
    items = p.where(k % 5 != 0).select(k.alias("item"), text(F.concat(F.lit(" "), shown), F.when(k % 7 == 0, "ar").otherwise(" ")).alias("name"), none.alias("description"), none.alias("category"))
    made = upkeep.canonical_items(items, stored, item_key)
    return made.select("item", "name.en", "name.ar", F.array_join("aliases", ",").alias("aliases"), "status")


@register("discovered_listings", "SELECT c_custkey AS id, CASE WHEN c_custkey % 6 = 0 THEN 'NOT_A_RESTAURANT' END AS reason FROM customer")
def discovered_listings(spark, sf):
    """E25."""
    k = c("c_custkey")
    rows = table(spark, sf, "customer").select(k.alias("id"), F.when(k % 6 != 0, True).when(k % 12 == 0, False).alias("restaurant"))
    good, others = upkeep.discovered(rows, c("restaurant"))
    return good.select("id", F.lit(None).cast("string").alias("reason")).union(others.select("id", "reason"))
