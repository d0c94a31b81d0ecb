"""Queries on the order of an item's offers and its cheapest ones; order lines are the offers of parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.operators import offer_ranking
from tallymart.plans.catalog import register
from tallymart.sources.tables import table

c, lit = F.col, F.lit

_JUDGED = """WITH raw AS (SELECT l_partkey AS item_id, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS offer_id, CAST(l_suppkey % 3 AS INTEGER) AS place,
  CASE WHEN l_quantity >= 3 THEN floor(l_extendedprice / 1000) END AS price, CASE WHEN l_quantity < 2 THEN 'MISSING' WHEN l_quantity < 3 THEN 'INVALID' ELSE 'OK' END AS price_status,
  CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber % 5 = 0 THEN 'USD' ELSE 'AED' END AS currency, CASE WHEN l_returnflag = 'A' THEN 'available' WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'unavailable' ELSE 'unknown' END AS availability,
  l_tax < 0.07 AS item_active, l_suppkey % 11 <> 0 AS restaurant_active FROM lineitem),
judged AS (SELECT *, concat_ws(',', CASE WHEN NOT item_active THEN 'ITEM_INACTIVE' END, CASE availability WHEN 'unavailable' THEN 'ITEM_UNAVAILABLE' WHEN 'unknown' THEN 'ITEM_AVAILABILITY_UNKNOWN' END, CASE WHEN NOT restaurant_active THEN 'RESTAURANT_INACTIVE' END,
  CASE WHEN price_status <> 'OK' THEN 'PRICE_' || price_status END, CASE WHEN currency IS NULL THEN 'CURRENCY_INVALID' END) AS reasons FROM raw) """


def _offers(spark, sf):
    """A returned line's status contradicts its flag unless it is open."""
    platform = F.element_at(F.array(*(lit(p) for p in offer_ranking.PLATFORMS)), (c("l_suppkey") % 3 + 1).cast("int"))
    price = F.when(c("l_quantity") < 2, None).when(c("l_quantity") < 3, -1.0).otherwise(F.floor(c("l_extendedprice") / 1000).cast("double"))
    rows = table(spark, sf, "lineitem").select(
        c("l_partkey").alias("item_id"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", c("l_shipdate").cast("date").cast("string")).alias("offer_id"), platform.alias("platform"), price.alias("price"),
        F.when(c("l_linenumber") == 1, "AE").when(c("l_linenumber") % 5 == 0, " usd ").otherwise("AED").alias("currency"), F.when(c("l_returnflag") == "A", True).when(c("l_returnflag") == "R", False).alias("available"),
        F.when(c("l_linestatus") == "F", "available").alias("status"), (c("l_tax") < 0.07).alias("item_active"), (c("l_suppkey") % 11 != 0).alias("restaurant_active"),
    )
    return offer_ranking.judged(rows)


@register(
    "ranked_offers",
    _JUDGED + "SELECT item_id, offer_id, price, currency, price_status, availability, reasons, CAST(row_number() OVER (PARTITION BY item_id ORDER BY reasons = '' DESC, price ASC NULLS LAST, place, offer_id) AS INTEGER) AS rank FROM judged",
)
def ranked_offers(spark, sf):
    """Q6, O3."""
    rows = offer_ranking.ranked(_offers(spark, sf), "item_id")
    return rows.select("item_id", "offer_id", "price", "currency", "price_status", "availability", F.array_join("reasons", ",").alias("reasons"), "rank")


@register(
    "cheapest_offers",
    _JUDGED
    + """, best AS (SELECT *, min(price) OVER (PARTITION BY item_id, currency) AS low FROM judged WHERE reasons = ''), spot AS (SELECT *, row_number() OVER (PARTITION BY item_id, currency ORDER BY place, offer_id) AS n FROM best WHERE price = low),
per AS (SELECT item_id, currency, low AS price, min(offer_id) FILTER (WHERE n = 1) AS offer_id, coalesce(string_agg(offer_id, ',' ORDER BY n) FILTER (WHERE n > 1), '') AS tied FROM spot GROUP BY ALL), kinds AS (SELECT item_id, count(*) AS k FROM per GROUP BY 1)
SELECT i.item_id, currency, price, offer_id, coalesce(tied, '') AS tied, CASE WHEN k IS NULL THEN 'NO_ELIGIBLE_OFFERS' WHEN k > 1 THEN 'MIXED_CURRENCIES' ELSE 'OK' END AS verdict
 FROM (SELECT DISTINCT item_id FROM judged) i LEFT JOIN kinds ON i.item_id = kinds.item_id LEFT JOIN per ON i.item_id = per.item_id""",
)
def cheapest_offers(spark, sf):
    """With the others at that price, and items without any eligible offer."""
    found = offer_ranking.cheapest_offers(_offers(spark, sf), "item_id")
    return found.select("item_id", "currency", "price", "offer_id", F.coalesce(F.array_join("tied", ","), lit("")).alias("tied"), "verdict")


@register("plans_by_category", "SELECT p_type AS category, count(*) AS n, count(*) FILTER (WHERE p_size > 25) AS enabled FROM part GROUP BY p_type")
def plans_by_category(spark, sf):
    """Planned queries of each category, a part being one, and those that are switched on."""
    return table(spark, sf, "part").groupBy(c("p_type").alias("category")).agg(F.count("*").alias("n"), F.count_if(c("p_size") > 25).alias("enabled"))
