"""Queries on the upsert of products: targets, folded offers, the next snapshot, versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.operators import products
from tallymart.plans.catalog import register
from tallymart.sources.tables import OFFERS_SQL, offers, table

c = F.col


def _stored(spark, sf):
    """Parts but each fifth, some without a brand or rating."""
    k = c("p_partkey")
    return table(spark, sf, "part").where(k % 5 != 0).select(
        k.alias("id"),
        F.concat(F.lit("Item "), k.cast("string")).alias("name"),
        F.when(k % 3 != 0, F.concat(F.lit("g"), (k % 300).cast("string"))).alias("match_key"),
        F.array_compact(F.array(F.concat(F.lit("r1:id:"), k.cast("string")), F.when(k % 7 == 0, F.concat(F.lit("r2:url:"), (k % 100).cast("string"))))).alias("keys"),
        F.when(k % 4 != 0, c("p_brand")).alias("brand"),
        F.when(k % 6 != 0, c("p_size").cast("double") / 10).alias("rating"),
    )


def _incoming(spark, sf):
    """Orders as products: a third with a listing's key, a third with a match key, names in another case and spacing."""
    k, n = c("o_orderkey"), c("o_custkey")
    return table(spark, sf, "orders").select(
        k.alias("seq"),
        F.when(k % 11 != 0, F.concat(F.lit("ITEM   "), (n % 2500).cast("string"))).alias("name"),
        F.when(k % 3 == 1, F.concat(F.lit("g"), (n % 350).cast("string"))).alias("match_key"),
        F.when(k % 3 == 0, F.array(F.when(n % 2 == 0, F.concat(F.lit("r1:id:"), (n % 2600).cast("string"))), F.concat(F.lit("r2:url:"), (n % 90).cast("string")))).alias("keys"),
        F.when(k % 2 == 0, c("o_orderpriority")).alias("brand"),
        F.when(k % 5 != 0, F.floor(c("o_totalprice")) % 50 / 10.0).alias("rating"),
        (c("o_orderstatus") != "P").alias("insertable"),
    )


_ROWS = """stored AS (SELECT p_partkey AS id, 'Item ' || p_partkey AS name, CASE WHEN p_partkey % 3 <> 0 THEN 'g' || p_partkey % 300 END AS match_key,
  CASE WHEN p_partkey % 7 = 0 THEN ['r1:id:' || p_partkey, 'r2:url:' || p_partkey % 100] ELSE ['r1:id:' || p_partkey] END AS keys,
  CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS brand, CASE WHEN p_partkey % 6 <> 0 THEN p_size::DOUBLE / 10 END AS rating FROM part WHERE p_partkey % 5 <> 0),
 incoming AS (SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 11 <> 0 THEN 'item ' || o_custkey % 2500 END AS key, CASE WHEN o_orderkey % 3 = 1 THEN 'g' || o_custkey % 350 END AS match_key,
  CASE WHEN o_orderkey % 3 = 0 THEN [CASE WHEN o_custkey % 2 = 0 THEN 'r1:id:' || o_custkey % 2600 END, 'r2:url:' || o_custkey % 90] END AS keys,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS brand, CASE WHEN o_orderkey % 5 <> 0 THEN floor(o_totalprice)::BIGINT % 50 / 10.0::DOUBLE END AS rating,
  'ITEM   ' || o_custkey % 2500 AS shown, o_orderstatus <> 'P' AS insertable FROM orders),
 by_key AS (SELECT seq, min(id) AS id FROM (SELECT seq, unnest(keys) AS k FROM incoming) JOIN (SELECT id, unnest(keys) AS k FROM stored) USING (k) GROUP BY seq),
 by_match AS (SELECT seq, min(s.id) AS id FROM incoming JOIN stored s USING (match_key) GROUP BY seq),
 by_name AS (SELECT seq, min(s.id) AS id FROM incoming i JOIN stored s ON lower(s.name) = i.key GROUP BY seq),
 targets AS (SELECT seq, coalesce(a.id, b.id, n.id) AS id, CASE WHEN a.id IS NOT NULL THEN 1 WHEN b.id IS NOT NULL THEN 2 WHEN n.id IS NOT NULL THEN 3 END AS kind
  FROM incoming LEFT JOIN by_key a USING (seq) LEFT JOIN by_match b USING (seq) LEFT JOIN by_name n USING (seq))"""


@register("product_targets", f"WITH {_ROWS} SELECT seq, id, kind FROM targets")
def product_targets(spark, sf):
    """J1/P1."""
    return products.match_targets(_incoming(spark, sf), _stored(spark, sf))


@register(
    "product_upsert",
    f"""WITH {_ROWS}, j AS (SELECT i.*, t.id FROM incoming i JOIN targets t USING (seq)),
 known AS (SELECT id, arg_min(brand, seq) FILTER (WHERE brand IS NOT NULL) AS brand, arg_max(rating, seq) FILTER (WHERE rating IS NOT NULL) AS rating, arg_max(shown, seq) FILTER (WHERE key IS NOT NULL) AS name, count(*) AS n FROM j WHERE id IS NOT NULL GROUP BY id),
 fresh AS (SELECT *, min(seq) FILTER (WHERE insertable) OVER (PARTITION BY key) AS opens FROM j WHERE id IS NULL AND key IS NOT NULL)
 SELECT s.id, s.name, coalesce(s.brand, k.brand) AS brand, coalesce(k.rating, s.rating) AS rating, CASE WHEN k.id IS NULL THEN 'kept' ELSE 'updated' END AS status, coalesce(n, 0) AS n_incoming FROM stored s LEFT JOIN known k ON s.id = k.id
 UNION ALL SELECT NULL, arg_min(shown, seq), arg_min(brand, seq) FILTER (WHERE brand IS NOT NULL), arg_max(rating, seq) FILTER (WHERE rating IS NOT NULL), 'created', count(*) FROM fresh WHERE seq >= opens GROUP BY key""",
)
def product_upsert(spark, sf):
    """M5/K1."""
    stored, incoming = _stored(spark, sf), _incoming(spark, sf)
    return products.written_products(stored, incoming, products.match_targets(incoming, stored), ["name", "brand"], ["rating"])


@register(
    "folded_offers",
    f"""WITH RECURSIVE {OFFERS_SQL}, obs AS (SELECT product_id, retailer_id, CASE WHEN line <> 1 THEN price END AS price, in_stock, CASE WHEN line <> 3 THEN observed_at END AS observed_at,
   row_number() OVER (PARTITION BY product_id, retailer_id ORDER BY ord, line) AS rn FROM offers WHERE line <> 1 OR in_stock = false),
 fold AS (SELECT p_partkey AS product_id, s_suppkey AS retailer_id, 0::BIGINT AS rn, (p_partkey + s_suppkey) % 3 = 0 AS has, CASE WHEN (p_partkey + s_suppkey) % 3 = 0 THEN 10.0::DOUBLE END AS price,
   CASE WHEN (p_partkey + s_suppkey) % 3 = 0 THEN true END AS in_stock, CASE WHEN (p_partkey + s_suppkey) % 6 = 0 THEN TIMESTAMP '1995-01-01' END AS observed_at FROM (SELECT DISTINCT product_id AS p_partkey, retailer_id AS s_suppkey FROM offers)
  UNION ALL SELECT f.product_id, f.retailer_id, f.rn + 1, f.has OR e.price IS NOT NULL,
   CASE WHEN f.has AND f.observed_at IS NOT NULL AND (e.observed_at IS NULL OR e.observed_at < f.observed_at) THEN f.price ELSE coalesce(e.price, f.price) END,
   CASE WHEN f.has AND f.observed_at IS NOT NULL AND (e.observed_at IS NULL OR e.observed_at < f.observed_at) THEN f.in_stock WHEN e.price IS NULL THEN CASE WHEN f.has THEN false END ELSE e.in_stock END,
   CASE WHEN f.has AND f.observed_at IS NOT NULL AND (e.observed_at IS NULL OR e.observed_at < f.observed_at) THEN f.observed_at WHEN e.price IS NULL AND NOT f.has THEN f.observed_at ELSE coalesce(e.observed_at, f.observed_at) END
  FROM fold f JOIN obs e ON e.product_id = f.product_id AND e.retailer_id = f.retailer_id AND e.rn = f.rn + 1)
 SELECT product_id, retailer_id, arg_max(price, rn) FILTER (WHERE has) AS price, arg_max({{'v': in_stock}}, rn)['v'] AS in_stock, arg_max({{'v': observed_at}}, rn)['v'] AS observed_at FROM fold GROUP BY ALL HAVING bool_or(has)""",
)
def folded_offers(spark, sf):
    """M2/M3/M5: the SQL takes one observation after another, the query none."""
    o = offers(spark, sf)
    seq = c("ord") * 10 + c("line")
    new = o.select("product_id", "retailer_id", seq.alias("seq"), F.when(c("line") != 1, c("price")).alias("price"), "in_stock", F.when(c("line") != 3, c("observed_at")).alias("observed_at"))
    both = c("product_id") + c("retailer_id")
    old = o.select("product_id", "retailer_id").distinct().where(both % 3 == 0)
    old = old.select("product_id", "retailer_id", F.lit(10.0).alias("price"), F.lit(True).alias("in_stock"), F.when(both % 6 == 0, F.lit("1995-01-01").cast("timestamp_ntz")).alias("observed_at"))
    observed = old.withColumn("observed_at", c("observed_at").cast(o.schema["observed_at"].dataType))
    return products.folded_offers(observed, new, ["product_id", "retailer_id"])


@register(
    "version_conflicts",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderdate END AS updated_at, o_orderkey % 5 <> 0 AND (o_orderkey % 6 = 0 OR o_orderkey % 4 <> 0) AS writable FROM orders""",
)
def version_conflicts(spark, sf):
    """M6: of the orders read, each fifth is gone by now and each fourth with a version has another one."""
    o = table(spark, sf, "orders").select(c("o_orderkey").alias("id"), F.when(c("o_orderkey") % 6 != 0, c("o_orderdate")).alias("updated_at"))
    changed = F.when(c("id") % 4 == 0, c("updated_at") + F.expr("INTERVAL 1 DAY")).otherwise(c("updated_at"))
    return products.unchanged_since(o, o.where("id % 5 <> 0").select("id", changed.alias("updated_at")))
