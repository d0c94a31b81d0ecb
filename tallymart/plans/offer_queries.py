"""Queries on offers: observation merging, pricing, histories, diffs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymart.operators import merge, pricing
from tallymart.plans.catalog import register
from tallymart.sources.tables import OFFERS_SQL, offers, table

CUTOFF = "1997-01-01"
_LATEST = f"""WITH {OFFERS_SQL}, latest AS (SELECT * FROM offers QUALIFY row_number() OVER (PARTITION BY product_id, retailer_id ORDER BY observed_at DESC, ord DESC, line DESC, price DESC) = 1)"""


def _latest(spark, sf):
    return merge.latest(offers(spark, sf), ["product_id", "retailer_id"], F.desc("observed_at"), F.desc("ord"), F.desc("line"), F.desc("price"))


@register("latest_offer_per_retailer", _LATEST + " SELECT product_id, retailer_id, price, in_stock, observed_at FROM latest")
def latest_offer_per_retailer(spark, sf):
    return _latest(spark, sf).select("product_id", "retailer_id", "price", "in_stock", "observed_at")


_STALE = f", marked AS (SELECT *, observed_at < TIMESTAMP '{CUTOFF}' AS is_stale FROM latest)"


@register("stale_offers", _LATEST + _STALE + " SELECT product_id, retailer_id, is_stale, CASE WHEN NOT is_stale THEN in_stock END AS in_stock FROM marked")
def stale_offers(spark, sf):
    return pricing.mark_stale(_latest(spark, sf), CUTOFF).select("product_id", "retailer_id", "is_stale", "in_stock")


@register(
    "price_range_derived",
    _LATEST + _STALE + """ SELECT product_id, min(price) FILTER (WHERE NOT is_stale AND coalesce(in_stock, true)) AS lowest_price,
 max(price) FILTER (WHERE NOT is_stale AND coalesce(in_stock, true)) AS highest_price, min(price) FILTER (WHERE NOT is_stale AND in_stock) AS best_confirmed,
 count(DISTINCT retailer_id) FILTER (WHERE NOT is_stale AND coalesce(in_stock, true)) AS n_comparable FROM marked GROUP BY product_id""",
)
def price_range_derived(spark, sf):
    return pricing.price_ranges(pricing.mark_stale(_latest(spark, sf), CUTOFF))


@register(
    "cheapest_per_currency_with_ties",
    _LATEST + """, fit AS (SELECT product_id, ['AED', 'SAR', 'KWD'][retailer_id % 3 + 1] AS currency, price, retailer_id FROM latest WHERE in_stock AND price IS NOT NULL),
 low AS (SELECT product_id, currency, min(price) AS price FROM fit GROUP BY ALL),
 ties AS (SELECT product_id, currency, price, array_to_string(list_sort(list(DISTINCT retailer_id)), ',') AS sellers FROM fit JOIN low USING (product_id, currency, price) GROUP BY ALL)
 SELECT *, count(*) OVER (PARTITION BY product_id) AS n_currencies, CASE WHEN count(*) OVER (PARTITION BY product_id) > 1 THEN 'MIXED_CURRENCIES' ELSE 'OK' END AS verdict FROM ties""",
)
def cheapest_per_currency_with_ties(spark, sf):
    currency = F.element_at(F.array(F.lit("AED"), F.lit("SAR"), F.lit("KWD")), (F.col("retailer_id") % 3 + 1).cast("int"))
    return pricing.cheapest(_latest(spark, sf).withColumn("currency", currency), "product_id", "currency")


@register(
    "newer_wins_merge",
    f"""WITH {OFFERS_SQL}, half AS (SELECT *, line % 2 AS side FROM offers QUALIFY row_number() OVER (PARTITION BY product_id, retailer_id, line % 2 ORDER BY observed_at DESC, ord DESC, line DESC, price DESC) = 1),
 s AS (SELECT product_id, retailer_id, price, in_stock, CASE WHEN product_id % 11 <> 0 THEN observed_at END AS seen FROM half WHERE side = 1),
 i AS (SELECT product_id, retailer_id, CASE WHEN in_stock = false OR product_id % 7 = 0 THEN NULL ELSE price END AS price, in_stock, CASE WHEN product_id % 13 <> 0 THEN observed_at END AS seen FROM half WHERE side = 0),
 both AS (SELECT s.product_id, s.retailer_id, s.price AS sp, i.price AS ip, s.in_stock AS ss, i.in_stock AS si, s.seen AS st, i.seen AS it FROM s JOIN i ON s.product_id = i.product_id AND s.retailer_id = i.retailer_id)
 SELECT product_id, retailer_id, sp AS price, ss AS in_stock, st AS observed_at FROM both WHERE st IS NOT NULL AND (it IS NULL OR it < st)
 UNION ALL SELECT product_id, retailer_id, coalesce(ip, sp), CASE WHEN ip IS NULL THEN false ELSE si END, coalesce(it, st) FROM both WHERE st IS NULL OR it >= st
 UNION ALL SELECT product_id, retailer_id, price, in_stock, seen FROM s WHERE NOT EXISTS (SELECT 1 FROM i WHERE s.product_id = i.product_id AND s.retailer_id = i.retailer_id)
 UNION ALL SELECT product_id, retailer_id, price, in_stock, seen FROM i WHERE price IS NOT NULL AND NOT EXISTS (SELECT 1 FROM s WHERE s.product_id = i.product_id AND s.retailer_id = i.retailer_id)""".replace("both AS", "matched AS").replace("FROM both", "FROM matched"),
)
def newer_wins_merge(spark, sf):
    """M3. Some stored and some incoming rows have no time, and some incoming ones neither price nor stock."""
    o = offers(spark, sf).withColumn("side", F.col("line") % 2)
    half = merge.latest(o, ["product_id", "retailer_id", "side"], F.desc("observed_at"), F.desc("ord"), F.desc("line"), F.desc("price"))
    timed = lambda df, n: df.withColumn("observed_at", F.when(F.col("product_id") % n != 0, F.col("observed_at")))
    told = F.coalesce(F.col("in_stock"), F.lit(True)) & (F.col("product_id") % 7 != 0)
    incoming = half.where("side = 0").withColumn("price", F.when(told, F.col("price")))
    return merge.newer_wins(timed(half.where("side = 1"), 11), timed(incoming, 13), ["product_id", "retailer_id"])


#: Stored and incoming sides overlap in a third of the parts, and each part is on a side.
_FILL_ONLY = """WITH s AS (SELECT p_partkey AS id, CASE WHEN p_size > 10 THEN p_name END AS name, p_brand AS brand, p_retailprice AS rating FROM part WHERE p_partkey % 3 <> 0),
 i AS (SELECT p_partkey AS id, 'incoming ' || p_name AS name, p_type AS brand, CASE WHEN p_size > 20 THEN CAST(p_size AS DOUBLE) END AS rating FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 2 = 0)
 SELECT coalesce(s.id, i.id) AS id, coalesce(s.name, i.name) AS name, coalesce(s.brand, i.brand) AS brand, coalesce(i.rating, s.rating) AS rating,
 CASE WHEN s.id IS NULL THEN 'created' WHEN i.id IS NULL THEN 'kept' ELSE 'updated' END AS action FROM s FULL JOIN i ON s.id = i.id"""


@register("fill_only_merge", _FILL_ONLY)
@register("fill_only_merge_all_parts", _FILL_ONLY)
def fill_only_merge(spark, sf):
    p = table(spark, sf, "part")
    stored = p.where("p_partkey % 3 <> 0").selectExpr("p_partkey AS id", "CASE WHEN p_size > 10 THEN p_name END AS name", "p_brand AS brand", "p_retailprice AS rating")
    incoming = p.where("p_partkey % 3 = 0 OR p_partkey % 2 = 0").selectExpr("p_partkey AS id", "'incoming ' || p_name AS name", "p_type AS brand", "CASE WHEN p_size > 20 THEN double(p_size) END AS rating")
    return merge.fill_only(stored, incoming, "id", ["name", "brand"], ["rating"])


def _state(spark, sf, until):
    o = table(spark, sf, "orders")
    o = o.where(F.col("o_orderdate") < F.lit(until).cast("timestamp")) if until else o
    last = merge.latest(o, ["o_custkey"], F.desc("o_orderdate"), F.desc("o_orderkey"), F.desc("o_totalprice"))
    return last.selectExpr("o_custkey AS id", "o_orderstatus AS status", "o_orderpriority AS priority", "o_orderkey AS last_order")


@register(
    "snapshot_diff_fields",
    """WITH a AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) = 1),
 b AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) = 1),
 j AS (SELECT a.o_custkey AS id, CASE WHEN b.o_custkey IS NULL THEN 'created' ELSE 'updated' END AS action, unnest([
   {'field': 'status', 'before': b.o_orderstatus, 'after': a.o_orderstatus}, {'field': 'priority', 'before': b.o_orderpriority, 'after': a.o_orderpriority},
   {'field': 'last_order', 'before': CAST(b.o_orderkey AS VARCHAR), 'after': CAST(a.o_orderkey AS VARCHAR)}]) AS e FROM a LEFT JOIN b ON a.o_custkey = b.o_custkey)
 SELECT id, action, e.field AS field, e.before AS before, e.after AS after FROM j WHERE e.before IS DISTINCT FROM e.after""",
)
def snapshot_diff_fields(spark, sf):
    return merge.field_diff(_state(spark, sf, "1998-01-01"), _state(spark, sf, None), "id", ["status", "priority", "last_order"])


@register(
    "scd_active_history",
    """SELECT o_custkey AS item, o_orderkey AS id, o_orderstatus AS status, lead(o_orderdate) OVER w AS superseded_at, lag(o_orderkey) OVER w AS supersedes,
 lead(o_orderdate) OVER w IS NULL AS active FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def scd_active_history(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_custkey AS item", "o_orderkey AS id", "o_orderstatus AS status", "o_orderdate AS at")
    return merge.history(o, "item", "at", "id").select("item", "id", "status", "superseded_at", "supersedes", "active")


@register("mark_missing_inactive", "SELECT DISTINCT l_partkey AS product_id FROM lineitem WHERE l_quantity < 25 AND l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 44)")
def mark_missing_inactive(spark, sf):
    """Products of one listing that the next one does not show."""
    line = table(spark, sf, "lineitem")
    stored = line.where("l_quantity < 25").select(F.col("l_partkey").alias("product_id")).distinct()
    return merge.missing_from(stored, line.where("l_quantity >= 44").select(F.col("l_partkey").alias("product_id")), "product_id")


@register(
    "offer_discount_tristate",
    """SELECT l_orderkey AS ord, l_linenumber AS line, CASE l_linenumber % 3 WHEN 0 THEN 'not reported' WHEN 1 THEN 'cleared' ELSE 'discounted' END AS state,
 CASE WHEN l_linenumber % 3 = 2 AND p_retailprice > floor(l_extendedprice / l_quantity * (1 - l_discount) * 100 + 0.5) / 100 THEN p_retailprice END AS original_price,
 floor(l_extendedprice / l_quantity * (1 - l_discount) * 100 + 0.5) / 100 AS price FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def offer_discount_tristate(spark, sf):
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * (1 - F.col("l_discount")) * 100 + 0.5) / 100
    j = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    state = F.when(F.col("l_linenumber") % 3 == 0, "not reported").when(F.col("l_linenumber") % 3 == 1, "cleared").otherwise("discounted")
    original = F.when((F.col("l_linenumber") % 3 == 2) & (F.col("p_retailprice") > price), F.col("p_retailprice"))
    return j.select(F.col("l_orderkey").alias("ord"), F.col("l_linenumber").alias("line"), state.alias("state"), original.alias("original_price"), price.alias("price"))


@register(
    "comparable_multi_source",
    "SELECT l_partkey AS product_id, count(DISTINCT l_suppkey) AS n_sources, count(DISTINCT s_nationkey) AS n_groups FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) >= 2",
)
def comparable_multi_source(spark, sf):
    # one row per pair first: the distinct counts then work on what the partial aggregation leaves
    pairs = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("product_id"), "l_suppkey").distinct()
    j = pairs.join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return j.groupBy("product_id").agg(F.count("*").alias("n_sources"), F.count_distinct("s_nationkey").alias("n_groups")).where("n_sources >= 2")


@register(
    "survivor_selection",
    "SELECT o_custkey AS cluster, o_orderkey AS survivor, count(*) OVER (PARTITION BY o_custkey) AS members FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS LAST, o_orderkey) = 1",
)
def survivor_selection(spark, sf):
    o = table(spark, sf, "orders")
    key = F.struct(F.col("o_orderdate").isNull(), "o_orderdate", "o_orderkey")
    return o.groupBy(F.col("o_custkey").alias("cluster")).agg(F.min(key)["o_orderkey"].alias("survivor"), F.count("*").alias("members"))


@register("conflicting_targets", "SELECT p_name AS item, count(DISTINCT p_brand) AS targets FROM part GROUP BY p_name HAVING count(DISTINCT p_brand) > 1")
def conflicting_targets(spark, sf):
    return table(spark, sf, "part").groupBy(F.col("p_name").alias("item")).agg(F.count_distinct("p_brand").alias("targets")).where("targets > 1")


@register("unambiguous_group", "SELECT l_orderkey AS ord, min(l_suppkey) AS retailer FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) = 1")
def unambiguous_group(spark, sf):
    g = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("ord")).agg(F.min("l_suppkey").alias("retailer"), F.max("l_suppkey").alias("_hi"))
    return g.where("retailer = _hi").drop("_hi")


@register(
    "brand_capped_fill",
    "SELECT p_type AS platform, p_brand AS brand, p_partkey AS id FROM part QUALIFY row_number() OVER (PARTITION BY p_type, p_brand ORDER BY p_retailprice DESC, p_partkey) <= 2",
)
def brand_capped_fill(spark, sf):
    w = Window.partitionBy("p_type", "p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")
    p = table(spark, sf, "part").withColumn("at", F.row_number().over(w)).where("at <= 2")
    return p.selectExpr("p_type AS platform", "p_brand AS brand", "p_partkey AS id")
