"""Queries on menus: texts, portions, amounts, promotions, search, offers behind canonical items, upkeep.

Texts and what is expected of them are written out by hand below and dealt to parts by key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallymart.functions import item_text as T
from tallymart.operators import menu_search
from tallymart.plans.catalog import register
from tallymart.sources.tables import table

c = F.col


def _dealt(spark, sf, *columns):
    """Parts as id, with the value of each column's list at the key's place."""
    at = lambda values: F.element_at(F.array(*map(F.lit, values)), (c("p_partkey") % len(values) + 1).cast("int"))
    return table(spark, sf, "part").select(c("p_partkey").alias("id"), *[at(values).alias(name) for name, values in columns])


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    return f"{v}::DOUBLE" if isinstance(v, float) else "'" + v.replace("'", "''") + "'"


def _expected(**columns) -> str:
    """SQL that deals the expected values to parts."""
    return "SELECT p_partkey AS id, " + ", ".join(f"[{', '.join(map(_literal, v))}][p_partkey % {len(v)} + 1] AS {n}" for n, v in columns.items()) + " FROM part"


_column = lambda rows, i: [r[i] for r in rows]

#: name, label, quantity, unit, size, core name
PORTIONS = [
    ("Plain Dosa (2 Pcs)", "2 Pcs", 2.0, "pcs", None, "plain dosa"),
    ("Pizza 12 inch", "12 inch", 12.0, "inch", "12 inch", "pizza"),
    ("Cola 330ml", "330ml", 330.0, "ml", "330 ml", "cola"),
    ("Water 1,5 L", "1,5 L", 1.5, "l", "1.5 l", "water"),
    ("Paneer 65", None, None, None, None, "paneer 65"),
    ("3 Cheese Sandwich", None, None, None, None, "3 cheese sandwich"),
    ("Large Fries", "Large", None, None, "large", "fries"),
    ("شاورما ٢ قطع", "2 قطع", 2.0, "pcs", None, "شاورما"),
    ("بيتزا كبير", "كبير", None, None, "large", "بيتزا"),
    ("XL Burger 0 g", "XL", None, None, "xl", "burger"),
    ("", None, None, None, None, None),
    (None, None, None, None, None, None),
]


@register("item_portions", _expected(label=_column(PORTIONS, 1), quantity=_column(PORTIONS, 2), unit=_column(PORTIONS, 3), size=_column(PORTIONS, 4), core=_column(PORTIONS, 5)))
def item_portions(spark, sf):
    """T29/T30."""
    p = _dealt(spark, sf, ("name", _column(PORTIONS, 0))).withColumn("v", T.portion(c("name")))
    return p.select("id", "v.label", "v.quantity", "v.unit", "v.size", T.core_name(c("name")).alias("core"))


#: English name, Arabic name, alias, keywords, signals
NAMED = [
    ("The Chicken & Rice", "دجاج مع أرز", "2 Pieces", "chicken rice دجاج ارز 2 pieces", "the chicken and rice|دجاج مع ارز|2 pieces"),
    ("Café Crème", None, "cafe creme", "cafe creme", "cafe creme"),
    ("A 7 Up", "٧ اب", None, "7 up اب", "a 7 up|7 اب"),
    ("!!!", None, None, "", ""),
]


@register("item_keywords", _expected(keywords=_column(NAMED, 3), signals=_column(NAMED, 4)))
def item_keywords(spark, sf):
    """T25-T28."""
    p = _dealt(spark, sf, *[(n, _column(NAMED, i)) for i, n in enumerate(("en", "ar", "alias"))])
    keys = p.select("id", *[T.item_key(c(n)).alias(n) for n in ("en", "ar", "alias")])
    all3 = (c("en"), c("ar"), c("alias"))
    return keys.select("id", F.array_join(T.search_keywords(*all3), " ").alias("keywords"), F.array_join(T.signals(*all3), "|").alias("signals"))


#: two areas, whether they are compatible, a branch's name and its brand
PLACES = [
    ("business bay", "dubai business bay", True, "Chipotle - City Walk", "chipotle"),
    ("d i f c", "difc", True, "KFC – Deira", "kfc"),
    ("ibn batutta mall", "ibn battuta", True, "Al - Baik", None),
    ("al wasl road", "city walk", True, "Burger-King", None),
    ("jumeirah 1", "jumeirah 2", False, "Café Noir — Mall", "cafe noir"),
    ("marina", "al marinade", False, None, None),
    ("a b cd", "ab", True, "-", None),
]


@register("place_rules", _expected(compatible=_column(PLACES, 2), brand=_column(PLACES, 4)))
def place_rules(spark, sf):
    """T32/T34."""
    p = _dealt(spark, sf, ("a", _column(PLACES, 0)), ("b", _column(PLACES, 1)), ("name", _column(PLACES, 3)))
    return p.select("id", T.areas_compatible(c("a"), c("b")).alias("compatible"), T.brand_from_name(c("name")).alias("brand"))


#: text, amount, currency, plain number, amount of 12345 smallest units of the second text
AMOUNTS = [
    ("AED 1,234.50", 1234.5, "AED", None),
    ("12,50 AED", 12.5, "AED", None),
    ("٢٥٫٥ AED", 25.5, "AED", None),
    ("from KWD 3 on", 3.0, "KWD", None),
    ("AED 1.2.3", None, None, None),
    ("-4.25", None, None, -4.25),
    (" ١٢٫٥ ", None, None, 12.5),
    ("free", None, None, None),
]
CODES = [("KWD", 12.345), ("AED", 123.45), ("aed", None)]


@register("amounts_of_texts", _expected(amount=_column(AMOUNTS, 1), currency=_column(AMOUNTS, 2), number=_column(AMOUNTS, 3), minor=_column(CODES, 1)))
def amounts_of_texts(spark, sf):
    """T40."""
    p = _dealt(spark, sf, ("t", _column(AMOUNTS, 0)), ("code", _column(CODES, 0))).withColumn("m", T.money(c("t")))
    return p.select("id", "m.amount", "m.currency", T.plain_number(c("t")).alias("number"), T.money_of_minor_units(F.lit(12345), c("code")).alias("minor"))


#: label, type, percentage, minimum, maximum
LABELS = [
    ("Spend AED 1,050, unlock 30% off up to AED 100", "PERCENT_OFF_MENU", 30.0, 1050.0, 100.0),
    ("Spend AED 50, get 20% off", "PERCENT_OFF_MENU", 20.0, 50.0, None),
    ("Spend AED 60 to get free delivery", "FREE_DELIVERY", None, 60.0, None),
    ("25% off entire menu", "PERCENT_OFF_MENU", 25.0, None, None),
    ("40% off selected  items on AED 30+", "PERCENT_OFF_ITEMS", 40.0, 30.0, None),
    ("Buy 1, get 1 free", "BUY_ONE_GET_ONE", None, None, None),
    ("Offers available", "OTHER", None, None, None),
    (None, None, None, None, None),
]


@register("promotion_labels", _expected(type=_column(LABELS, 1), percentage=_column(LABELS, 2), minimum=_column(LABELS, 3), maximum=_column(LABELS, 4)))
def promotion_labels(spark, sf):
    """T43."""
    return _dealt(spark, sf, ("label", _column(LABELS, 0))).withColumn("o", T.promotion(c("label"))).select("id", "o.type", "o.percentage", "o.minimum", "o.maximum")


TITLES = [
    ("Buy Sony TV | Best Price UAE", "Sony TV"),
    ("iPhone 15 Pro | Natural Titanium | Free Delivery", "iPhone 15 Pro | Natural Titanium"),
    ("Baby Crib in UAE | Mumzworld", "Baby Crib"),
    ("Tom &amp; Jerry   Mug | 1 Year Warranty", "Tom & Jerry Mug"),
    ("  ", None),
]
TEXTS = [("<p>Hi&nbsp;<b>you</b></p>", "Hi you"), ("<br>", None), ("a  b", "a b")]


@register("clean_titles", _expected(title=_column(TITLES, 1), text=_column(TEXTS, 1)))
def clean_titles(spark, sf):
    """T42."""
    p = _dealt(spark, sf, ("t", _column(TITLES, 0)), ("d", _column(TEXTS, 0)))
    return p.select("id", T.clean_name(c("t")).alias("title"), T.clean_text(c("d")).alias("text"))


#: name, likely a restaurant, has all words of "baby strollers"-like category; page, blocked
SHOPS = [("Lulu Hypermarket", False, False), ("Operator Bistro", True, False), ("Baby Strollers", True, True), ("BaBylissPRO stroller", True, False), ("Flower Bar", False, False)]
HTML = [("<title>Access Denied</title>", True), ("<title>Menu</title>", False), ("<p>cf-chl-1</p>", True), ("<title> Just a moment...", True)]


@register("listing_rules", _expected(restaurant=_column(SHOPS, 1), fits=_column(SHOPS, 2), blocked=_column(HTML, 1)))
def listing_rules(spark, sf):
    """P9/P10/P12."""
    p = _dealt(spark, sf, ("name", _column(SHOPS, 0)), ("html", _column(HTML, 0)))
    return p.select("id", T.likely_restaurant(c("name")).alias("restaurant"), T.has_all_words(c("name"), "baby stroller").alias("fits"), T.block_page(c("html")).alias("blocked"))


IMAGES = [(["x/logo.png", "own/1.jpg", "cdn/2.jpg"], "own/1.jpg"), (["cdn/2.jpg", "x/logo.png"], "cdn/2.jpg"), (["x/logo.png"], None), (["own/1.jpg"], None), ([], None)]


@register("cleaned_images", _expected(kept=_column(IMAGES, 1)))
def cleaned_images(spark, sf):
    """P13."""
    p = _dealt(spark, sf, ("all", ["|".join(u) for u, _ in IMAGES]))
    urls = F.when(c("all") == "", F.array().cast("array<string>")).otherwise(F.split("all", "\\|"))
    return p.select("id", F.array_join(T.cleaned_images(urls, "logo", ("^own/", "^cdn/")), "|").alias("kept"))


DISHES = ["chicken biryani", "chicken tikka rice", "birch salad", "rice pudding", "lamb chops", "spicy rice bowl", "chick pea soup"]
QUERIES = [(1, "Chicken  BIRYANI 7"), (2, "spicy rice"), (3, "chicken"), (4, "chi bir"), (5, "the"), (6, "7"), (7, "rice 12"), (8, "zzz"), (9, None)]
_PLAIN = {1: ("chicken biryani 7", ["chicken", "biryani", "7"]), 2: ("spicy rice", ["spicy", "rice"]), 3: ("chicken", ["chicken"]), 4: ("chi bir", ["chi", "bir"]), 5: ("the", []), 6: ("7", ["7"]), 7: ("rice 12", ["rice", "12"]), 8: ("zzz", ["zzz"])}
_QUERY_ROWS = ", ".join(f"({q}, '{n}', {t}::VARCHAR[])" for q, (n, t) in _PLAIN.items())
PAGE = 20


@register(
    "menu_search",
    f"""WITH q(qid, normalized, tokens) AS (VALUES {_QUERY_ROWS}),
 i AS (SELECT p_partkey AS id, {DISHES}[p_partkey % {len(DISHES)} + 1] || ' ' || p_partkey % 50 AS name, CASE WHEN p_partkey % 5 = 0 THEN ['spicy rice'] ELSE []::VARCHAR[] END AS aliases, p_brand AS category FROM part WHERE p_size > 2),
 w AS (SELECT *, list_distinct(string_split(name, ' ') || flatten(list_transform(aliases, lambda a: string_split(a, ' ')))) AS own FROM i),
 k AS (SELECT *, own || list_filter(string_split(trim(regexp_replace(lower(category), '[^a-z0-9]+', ' ', 'g')), ' '), lambda t: NOT list_contains(own, t) AND (length(t) > 1 OR regexp_matches(t, '^[0-9]'))) AS keywords FROM w),
 s AS (SELECT qid, id, name, normalized = name AS is_name, list_contains(aliases, normalized) AS is_alias, len(tokens) AS n, len(list_filter(tokens, lambda t: list_contains(keywords, t))) AS matched,
   len(list_filter(tokens, lambda t: NOT list_contains(keywords, t) AND length(t) >= 3 AND NOT regexp_matches(t, '^[0-9]') AND len(list_filter(keywords, lambda x: starts_with(x, t))) > 0)) AS prefixed,
   CASE WHEN len(tokens) > 0 THEN len(list_filter(tokens, lambda t: list_contains(own, t)))::DOUBLE / len(tokens) ELSE 0.0 END AS coverage FROM q, k),
 f AS (SELECT *, CASE WHEN is_name THEN 1 WHEN is_alias THEN 2 WHEN n > 0 AND matched = n THEN 3 ELSE 4 END AS tier FROM s WHERE is_name OR is_alias OR matched + prefixed > 0),
 r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY tier, coverage DESC, matched DESC, prefixed DESC, length(name), name, id) AS place, count(*) OVER (PARTITION BY qid) AS total FROM f)
 SELECT qid, place, id, tier, coverage, matched, prefixed, total > {PAGE} AS truncated FROM r WHERE place <= {PAGE}""",
)
def menu_search_pages(spark, sf):
    """Q2-Q5, Q8, O2: the SQL meets every item with every query."""
    queries = menu_search.normalized_queries(spark.createDataFrame(QUERIES, "qid int, query string"))
    p = table(spark, sf, "part").where("p_size > 2")
    dish = F.element_at(F.array(*map(F.lit, DISHES)), (c("p_partkey") % len(DISHES) + 1).cast("int"))
    rows = p.select(c("p_partkey").alias("id"), F.concat(dish, F.lit(" "), (c("p_partkey") % 50).cast("string")).alias("name"), F.when(c("p_partkey") % 5 == 0, "Spicy Rice").alias("alias"), "p_brand")
    keyed = rows.select("id", T.item_key(c("name")).alias("name"), T.item_key(c("alias")).alias("alias"), T.item_key(c("p_brand")).alias("category"))
    names, aliases = F.array_compact(F.array("name")), F.array_compact(F.array("alias"))
    items = keyed.select("id", names.alias("names"), aliases.alias("aliases"), T.search_keywords(c("name"), c("alias"), c("category")).alias("keywords"), T.search_keywords(c("name"), c("alias")).alias("name_tokens"), c("name").alias("display"))
    return menu_search.ranked(items, queries, PAGE)


@register(
    "confirmed_offers",
    """WITH good AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber % 3 AS item, l_partkey AS id FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O'),
 one AS (SELECT item, min(id) AS id FROM good GROUP BY item HAVING count(DISTINCT id) = 1),
 place AS (SELECT o_custkey AS restaurant, min(length(o_orderpriority) % 3) AS grp FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey HAVING count(DISTINCT length(o_orderpriority) % 3) = 1)
 SELECT p_partkey AS id, one.item, place.restaurant, place.grp, o_totalprice AS price FROM one JOIN part ON p_partkey = one.id JOIN orders ON o_orderkey = one.item // 10 AND o_orderstatus <> 'P'
 JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0 JOIN place ON place.restaurant = o_custkey AND place.grp = p_size % 3""",
)
def confirmed_offers(spark, sf):
    """Parts as canonical items, lines as mappings, orders as menu items, customers as restaurants."""
    line, order, customer = (table(spark, sf, n) for n in ("lineitem", "orders", "customer"))
    mappings = line.select((c("l_orderkey") * 10 + c("l_linenumber") % 3).alias("item"), c("l_partkey").alias("id"), F.when(c("l_returnflag") == "N", "MATCHED").alias("status"), (c("l_linestatus") == "O").alias("active"))
    items = order.select(F.explode(F.array(*[c("o_orderkey") * 10 + i for i in range(3)])).alias("item"), c("o_custkey").alias("restaurant"), c("o_totalprice").alias("price"), (c("o_orderstatus") != "P").alias("active"))
    groups = order.select(c("o_custkey").alias("restaurant"), (F.length("o_orderpriority") % 3).alias("grp"), F.lit("MATCHED").alias("status"), (c("o_orderstatus") == "O").alias("active"))
    canonical = table(spark, sf, "part").select(c("p_partkey").alias("id"), (c("p_size") % 3).alias("grp"))
    return menu_search.confirmed_offers(canonical, mappings, items, customer.select(c("c_custkey").alias("restaurant"), (c("c_acctbal") > 0).alias("active")), groups)


NOW = dt.datetime(1999, 1, 1)


@register(
    "synced_promotions",
    """WITH stored AS (SELECT o_custkey AS restaurant, o_orderstatus AS source, o_orderpriority AS offer_key, bool_or(o_orderkey % 3 <> 0) AS active, min(o_orderdate) AS first_seen FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY ALL),
 shown AS (SELECT o_custkey AS restaurant, o_orderstatus AS source, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS offer_key FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'),
 keys AS (SELECT restaurant, source, offer_key FROM stored UNION SELECT restaurant, source, offer_key FROM shown WHERE offer_key IS NOT NULL),
 m AS (SELECT k.*, s.active AS was, s.first_seen AS seen, s.restaurant IS NOT NULL AS old, EXISTS (SELECT 1 FROM shown h WHERE h.restaurant = k.restaurant AND h.source = k.source AND h.offer_key = k.offer_key) AS new,
  EXISTS (SELECT 1 FROM shown h WHERE h.restaurant = k.restaurant AND h.source = k.source) AS was_read FROM keys k LEFT JOIN stored s ON s.restaurant = k.restaurant AND s.source = k.source AND s.offer_key = k.offer_key)
 SELECT restaurant, source, offer_key, CASE WHEN new THEN true WHEN was_read THEN false ELSE was END AS active, coalesce(seen, TIMESTAMP '1999-01-01') AS first_seen,
  CASE WHEN new THEN NULL WHEN was AND was_read THEN TIMESTAMP '1999-01-01' WHEN NOT was THEN TIMESTAMP '1990-01-01' END AS ended_at,
  CASE WHEN NOT old THEN 'created' WHEN new AND NOT was THEN 'reactivated' WHEN new THEN 'shown' WHEN was AND was_read THEN 'ended' ELSE 'kept' END AS action FROM m""",
)
def synced_promotions(spark, sf):
    """Orders before 1996 as what is stored, later ones as what is shown; each fourth of these shows that a source was read and nothing else."""
    o = table(spark, sf, "orders").select(c("o_custkey").alias("restaurant"), c("o_orderstatus").alias("source"), c("o_orderpriority").alias("offer_key"), "o_orderkey", "o_orderdate")
    kind = o.schema["o_orderdate"].dataType
    split = F.lit("1996-01-01").cast(kind)
    stored = o.where(c("o_orderdate") < split).groupBy("restaurant", "source", "offer_key").agg(F.bool_or(c("o_orderkey") % 3 != 0).alias("active"), F.min("o_orderdate").alias("first_seen"))
    stored = stored.withColumn("ended_at", F.when(~c("active"), F.lit("1990-01-01").cast(kind)))
    shown = o.where(c("o_orderdate") >= split).select("restaurant", "source", F.when(c("o_orderkey") % 4 != 0, c("offer_key")).alias("offer_key"))
    return menu_search.synced_promotions(stored, shown, F.lit(NOW.strftime("%Y-%m-%d")).cast(kind))


@register(
    "inactive_marking",
    """WITH m AS (SELECT l_suppkey AS id, count(*) FILTER (WHERE l_linenumber <= 2 AND l_suppkey % 9 <> 0) AS seen, count(*) FILTER (WHERE l_linestatus = 'O') AS previous, count(*) FILTER (WHERE l_quantity > 45) AS rejected, l_suppkey % 8 <> 0 AS complete, l_suppkey % 7 = 0 AS downgrade, l_suppkey % 13 <> 0 AS allowed FROM lineitem GROUP BY l_suppkey),
 r AS (SELECT *, list_filter([CASE WHEN NOT allowed THEN 'DISABLED_BY_CALLER' END, CASE WHEN NOT complete THEN 'INCOMPLETE' END, CASE WHEN seen = 0 THEN 'NO_ITEMS' END, CASE WHEN downgrade THEN 'IDENTITY_DOWNGRADE' END,
   CASE WHEN seen > 0 AND rejected::DOUBLE > seen * 0.1::DOUBLE THEN 'TOO_MANY_REJECTED_ITEMS' END, CASE WHEN previous > 0 AND 2 * seen < previous THEN 'SUSPICIOUS_ITEM_DROP' END], lambda x: x IS NOT NULL) AS reasons FROM m)
 SELECT id, seen, previous, rejected, coalesce(array_to_string(reasons, ','), '') AS reasons, len(reasons) = 0 AS applied FROM r""",
)
def inactive_marking(spark, sf):
    """M12."""
    s = c("l_suppkey")
    counts = table(spark, sf, "lineitem").groupBy(s.alias("id")).agg(
        F.count_if((c("l_linenumber") <= 2) & (s % 9 != 0)).alias("seen"), F.count_if(c("l_linestatus") == "O").alias("previous"), F.count_if(c("l_quantity") > 45).alias("rejected")
    )
    menus = counts.withColumns({"complete": c("id") % 8 != 0, "downgrade": c("id") % 7 == 0, "allowed": c("id") % 13 != 0})
    return menu_search.inactive_marking(menus).select("id", "seen", "previous", "rejected", F.array_join("reasons", ",").alias("reasons"), "applied")


@register(
    "identity_strength",
    """SELECT l_orderkey, l_linenumber, l_linestatus = 'O' OR NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = l_suppkey AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS accepted FROM lineitem""",
)
def identity_strength(spark, sf):
    """M13."""
    kind = lambda ok: F.when(ok, "id").otherwise("position")
    stored = table(spark, sf, "orders").select(c("o_custkey").alias("scope"), kind(c("o_orderpriority") == "1-URGENT").alias("kind"), (c("o_orderstatus") == "F").alias("active"))
    incoming = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", c("l_suppkey").alias("scope"), kind(c("l_linestatus") == "O").alias("kind"))
    return menu_search.stronger_identities(incoming, stored, "scope").select("l_orderkey", "l_linenumber", "accepted")


@register(
    "group_candidates",
    """SELECT c_custkey AS id1, s_suppkey AS id2 FROM customer, supplier WHERE (c_custkey % 97 = s_suppkey % 97 OR c_custkey % 31 = s_suppkey % 31)
 AND (c_custkey % 5 = 0 OR s_suppkey % 7 = 0 OR c_nationkey = s_nationkey)""",
)
def group_candidates(spark, sf):
    """Cities are nations, missing for each fifth customer and each seventh supplier."""
    keys = lambda k: F.array(F.concat(F.lit("n"), (k % 97).cast("string")), F.concat(F.lit("b"), (k % 31).cast("string")))
    side = lambda name, key, nation, m: table(spark, sf, name).select(c(key).alias("id"), keys(c(key)).alias("keys"), F.when(c(key) % m != 0, c(nation)).alias("city"))
    return menu_search.group_candidates(side("customer", "c_custkey", "c_nationkey", 5), side("supplier", "s_suppkey", "s_nationkey", 7))
