"""Queries on menu pages of the second shape. The pages are made of the tables: a supplier's page sells its parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.plans.catalog import register
from tallymart.sources.menu_pages import MenuPages
from tallymart.sources.tables import branches, table

c = F.col

#: The same pages as SQL sees them. Parts of size 1 to 3 are options of their type's group and no items of their own; part 17, 34, ...
#: has no name, part 19, 38, ... no price, Brand#5 is a category without a name; every third part has a lower price, every third one in
#: another currency; each seventh supplier's page has no state.
_SQL = """WITH sold AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_suppkey % 7 <> 0),
item AS (SELECT s, p, row_number() OVER (PARTITION BY s ORDER BY p) - 1 AS source_index, p_brand, p_type, p_size, CASE WHEN p % 17 <> 0 THEN p_name END AS name,
  CASE WHEN p % 19 <> 0 THEN floor(p_retailprice * 100 + 0.5) END AS cents, CASE WHEN s % 2 = 0 THEN 'AED' ELSE 'KWD' END AS currency, CASE WHEN s % 2 = 0 THEN 100.0 ELSE 1000.0 END AS minor
  FROM sold JOIN part ON p = p_partkey),
category AS (SELECT s, p_brand AS category_id, row_number() OVER (PARTITION BY s ORDER BY p_brand) - 1 AS sort_order FROM (SELECT DISTINCT s, p_brand FROM item WHERE p_size > 3 AND p_brand <> 'Brand#5')),
choice AS (SELECT s, p_type AS group_id, row_number() OVER (PARTITION BY s, p_type ORDER BY p) - 1 AS position, p, name, p_size, minor, currency FROM item WHERE p_size <= 3),
judged AS (SELECT item.*, CASE WHEN p_size > 3 THEN p_brand END AS category_id, sort_order AS category_index,
  CASE WHEN p_size <= 3 AND name IS NOT NULL THEN 'HIDDEN_OPTION' WHEN name IS NULL THEN 'MISSING_NAME' WHEN cents IS NULL THEN 'INVALID_PRICE' END AS problem
  FROM item LEFT JOIN category ON item.s = category.s AND p_size > 3 AND p_brand = category.category_id),
shown AS (SELECT * FROM judged WHERE problem IS NULL) """


def pages(spark, sf):
    s, p = c("l_suppkey"), c("l_partkey")
    # dealt by part once, for the distinct lines and their parts, and by supplier once, as plain columns
    sold = table(spark, sf, "lineitem").select(s, p).repartition(p).distinct().join(table(spark, sf, "part"), c("l_partkey") == c("p_partkey")).repartition(s)
    code = F.when(s % 2 == 0, "AED").otherwise("KWD")
    money = lambda x, of=code: F.struct(x.cast("long").alias("fractional"), of.alias("code"))
    name = F.when(p % 17 == 0, "  ").otherwise(F.concat(F.lit(" "), F.replace(c("p_name"), F.lit(" "), F.lit("  "))))
    cents = F.floor(c("p_retailprice") * 100 + 0.5)
    cut = F.when(p % 3 == 0, money(cents - c("p_size"))).when(p % 3 == 2, money(cents - 1, F.lit("USD")))
    item = F.struct(
        p.alias("id"), name.alias("name"), F.when(c("p_size") > 3, c("p_brand")).alias("categoryId"), money(F.when(p % 19 == 0, -1).otherwise(cents)).alias("price"), cut.alias("priceDiscounted"),
        F.when(p % 5 == 0, F.array("p_type", F.lit("none"))).otherwise(F.array("p_type")).alias("modifierGroupIds"), (p % 2 == 0).alias("available"), F.struct(F.concat(F.lit("https://img.example/p/"), p, F.lit(".jpg?w=1")).alias("url")).alias("image"),
    )
    option = F.struct(p.cast("string").alias("id"), name.alias("name"), money(c("p_size") * 50).alias("price"))
    options = sold.where("p_size <= 3").groupBy(s, "p_type").agg(F.sort_array(F.collect_list(F.struct(p.alias("k"), option.alias("o")))).alias("o"))
    groups = options.groupBy(s).agg(F.sort_array(F.collect_list(F.struct(c("p_type").alias("id"), c("p_type").alias("name"), F.lit(1).alias("minSelection"), c("o.o").alias("modifierOptions")))).alias("modifierGroups"))
    brands = F.array_sort(F.collect_set(F.when(c("p_size") > 3, c("p_brand"))))
    items = sold.groupBy(s).agg(F.sort_array(F.collect_list(F.struct(p.alias("k"), item.alias("i")))).alias("i"), F.when(F.count_if(c("p_size") > 3) > 0, brands).alias("brands"))
    place = branches(spark, sf, "supplier", "s").select(c("id").alias("s_suppkey"), "lat", "lng")
    rows = table(spark, sf, "supplier").join(place, "s_suppkey").join(table(spark, sf, "nation"), c("s_nationkey") == c("n_nationkey"))
    for part in (items, groups):
        rows = rows.join(part, c("s_suppkey") == c("l_suppkey"), "left").drop("l_suppkey")
    k = c("s_suppkey")
    line = lambda *texts: F.struct(F.array(*(F.struct(F.lit("UISpanText").alias("typeName"), t.alias("text")) for t in texts)).alias("spans"))
    lit = F.lit
    root = F.struct(
        F.struct(k.cast("string").alias("id"), c("s_name").alias("name"), F.when(k % 2 == 0, "AED").otherwise("KWD").alias("currencyCode"), F.struct(F.struct(c("n_name").alias("city")).alias("address"), c("s_nationkey").alias("cityId")).alias("location")).alias("restaurant"),
        F.transform("brands", lambda b: F.struct(b.alias("id"), F.when(b == "Brand#5", " ").otherwise(b).alias("name"))).alias("categories"),
        c("modifierGroups"),
        F.coalesce(c("i.i"), F.array()).alias("items"),
        F.struct(F.when(k % 5 == 0, c("lat")).alias("lat"), F.when(k % 5 == 0, c("lng")).alias("lon")).alias("customerLocation"),
    )
    pin = F.struct(c("lat"), c("lng").alias("lon"))
    blocks = F.array(F.struct(F.struct(F.when(k % 3 == 0, F.array(pin, pin, F.struct(lit(0.0).alias("lat"), c("lng").alias("lon")))).otherwise(F.array(pin)).alias("pins")).alias("map")))
    layouts = F.array(F.struct(F.array(F.struct(lit("layout-list-map").alias("actionId"), blocks.alias("blocks"))).alias("layouts")))
    lines = F.array(line(c("n_name"), lit("·"), lit("Grill")), line(F.concat(k % 6, lit(".5 Good")), F.concat(lit("("), k, lit("+)")), lit("Closes at 23:00")), line(F.concat(lit("AED "), k + 10, lit(" minimum")), lit("AED 4.95 delivery")))
    menu = F.struct(F.struct(root.alias("root")).alias("metas"), layouts.alias("layoutGroups"), F.struct(F.struct(lines.alias("lines")).alias("headerTags")).alias("header"))
    state = F.to_json(F.struct(F.struct(F.struct(F.struct(menu.alias("menu")).alias("menuPage")).alias("initialState")).alias("props")))
    script = F.when(k % 7 != 0, F.concat(lit('<script id="__NEXT_DATA__" type="application/json">'), state, lit("</script>"))).otherwise("")
    html = F.concat(F.when(k % 11 == 0, '<html lang="ar-AE">').otherwise('<html lang="en">'), lit("<h1>Menu <b>of</b> "), k, lit("</h1>"), script, lit("</html>"))
    return MenuPages(rows.select(k.alias("page_id"), lit("en").alias("locale"), html.alias("html")))


@register(
    "menu_page_restaurants",
    """SELECT s_suppkey AS page_id, CAST(s_suppkey AS VARCHAR) AS restaurant_id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'AED' ELSE 'KWD' END AS currency, n_name AS city, CAST(s_nationkey AS BIGINT) AS city_id,
 n_name || ',Grill' AS cuisines, CASE WHEN s_suppkey % 6 + 0.5 <= 5 THEN CAST(s_suppkey % 6 + 0.5 AS DOUBLE) END AS rating, CAST(s_suppkey + 10 AS DOUBLE) AS minimum_order, 4.95::DOUBLE AS delivery_fee, 'Closes at 23:00' AS opening_status,
 CASE WHEN s_suppkey % 5 <> 0 THEN 24.0 + (s_suppkey * 7919 % 5000) / 10000.0::DOUBLE END AS lat FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 7 <> 0""",
)
def menu_page_restaurants(spark, sf):
    """A place that equals the customer's, or is one of several, is none."""
    return pages(spark, sf).restaurants.select("page_id", "restaurant_id", "name", "currency", "city", "city_id", F.array_join("cuisines", ",").alias("cuisines"), "rating", "minimum_order", "delivery_fee", "opening_status", "lat")


@register("menu_page_categories", _SQL + "SELECT s AS page_id, CAST(sort_order AS INTEGER) AS sort_order, category_id, category_id AS name FROM category")
def menu_page_categories(spark, sf):
    """X9."""
    return pages(spark, sf).categories


@register(
    "menu_page_items",
    _SQL + """SELECT s AS page_id, CAST(source_index AS INTEGER) AS source_index, CAST(p AS VARCHAR) AS item_id, category_id, CASE WHEN category_index IS NOT NULL THEN category_id END AS category_name,
 CASE WHEN category_index IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY s, category_index ORDER BY source_index) - 1 AS INTEGER) END AS position, name,
 (cents - CASE WHEN p % 3 = 0 AND p_size > 0 THEN p_size ELSE 0 END) / minor AS price, CASE WHEN p % 3 = 0 AND p_size > 0 THEN cents / minor END AS original_price, currency, p % 2 = 0 AS available, 'p/' || p || '.jpg' AS image_anchor FROM shown""",
)
def menu_page_items(spark, sf):
    """X9."""
    return pages(spark, sf).items.select("page_id", "source_index", "item_id", "category_id", "category_name", "position", "name", "price", "original_price", "currency", "available", "image_anchor")


@register("menu_page_groups", _SQL + "SELECT DISTINCT s AS page_id, group_id, group_id AS name, CAST(1 AS BIGINT) AS min_selections FROM choice")
def menu_page_groups(spark, sf):
    """X9."""
    return pages(spark, sf).modifier_groups.select("page_id", "group_id", "name", "min_selections")


@register("menu_page_options", _SQL + "SELECT s AS page_id, group_id, CAST(position AS INTEGER) AS position, CAST(p AS VARCHAR) AS option_id, name, p_size * 50 / minor AS price_delta, currency FROM choice WHERE name IS NOT NULL")
def menu_page_options(spark, sf):
    """X9."""
    return pages(spark, sf).options.select("page_id", "group_id", "position", "option_id", "name", "price_delta", "currency")


@register(
    "menu_page_stats",
    _SQL + """SELECT s_suppkey AS page_id, count(p) AS items_seen, count(p) FILTER (problem IS NULL) AS items_parsed, count(p) FILTER (problem IN ('MISSING_NAME', 'INVALID_PRICE')) AS items_rejected, count(p) FILTER (problem = 'HIDDEN_OPTION') AS hidden_options,
 (SELECT count(DISTINCT group_id) FROM choice WHERE choice.s = s_suppkey) AS modifier_groups FROM supplier LEFT JOIN judged ON s = s_suppkey WHERE s_suppkey % 7 <> 0 GROUP BY s_suppkey""",
)
def menu_page_stats(spark, sf):
    """X9."""
    return pages(spark, sf).stats


@register(
    "menu_page_warnings",
    _SQL + """, w AS (
 SELECT s_suppkey AS page_id, 'NEXT_DATA_UNAVAILABLE' AS code, NULL::INTEGER AS "at", NULL AS value FROM supplier WHERE s_suppkey % 7 = 0
 UNION ALL SELECT s_suppkey, 'MISSING_RESTAURANT_NAME', NULL, NULL FROM supplier WHERE s_suppkey % 7 = 0
 UNION ALL SELECT s_suppkey, 'LOCALE_MISMATCH', NULL, 'ar' FROM supplier WHERE s_suppkey % 11 = 0
 UNION ALL SELECT s_suppkey, 'NO_ITEMS', NULL, NULL FROM supplier WHERE s_suppkey NOT IN (SELECT s FROM shown)
 UNION ALL SELECT s_suppkey, 'COORDINATES_MATCH_CUSTOMER_LOCATION', NULL, NULL FROM supplier WHERE s_suppkey % 7 <> 0 AND s_suppkey % 5 = 0
 UNION ALL SELECT s_suppkey, 'INVALID_COORDINATES', NULL, NULL FROM supplier WHERE s_suppkey % 7 <> 0 AND s_suppkey % 3 = 0
 UNION ALL SELECT s, 'INVALID_CATEGORY', "at", NULL FROM (SELECT s, p_brand, CAST(row_number() OVER (PARTITION BY s ORDER BY p_brand) - 1 AS INTEGER) AS "at" FROM (SELECT DISTINCT s, p_brand FROM item WHERE p_size > 3)) WHERE p_brand = 'Brand#5'
 UNION ALL SELECT s, 'INVALID_MODIFIER_OPTION', CAST(position AS INTEGER), NULL FROM choice WHERE name IS NULL
 UNION ALL SELECT s, problem, CAST(source_index AS INTEGER), NULL FROM judged WHERE problem IN ('MISSING_NAME', 'INVALID_PRICE')
 UNION ALL SELECT s, 'INVALID_DISCOUNT_PRICE', CAST(source_index AS INTEGER), NULL FROM shown WHERE p % 3 = 2
 UNION ALL SELECT s, 'UNKNOWN_CATEGORY', CAST(source_index AS INTEGER), category_id FROM shown WHERE category_id IS NOT NULL AND category_index IS NULL
 UNION ALL SELECT s, 'MISSING_MODIFIER_GROUP', CAST(source_index AS INTEGER), p_type FROM shown WHERE NOT EXISTS (SELECT 1 FROM choice WHERE choice.s = shown.s AND group_id = p_type)
 UNION ALL SELECT s, 'MISSING_MODIFIER_GROUP', CAST(source_index AS INTEGER), 'none' FROM shown WHERE p % 5 = 0)
 SELECT * FROM w""",
)
def menu_page_warnings(spark, sf):
    """X9."""
    return pages(spark, sf).warnings.select("page_id", "code", "at", "value")
