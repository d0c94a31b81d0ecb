"""Queries on identity: rules, blocking, decisions, exclusion reasons."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.functions import rules
from tallymart.operators import identity, item_match
from tallymart.plans.catalog import register
from tallymart.sources.tables import OFFERS_SQL, offers, table

#: Category queries that stand for part sizes.
CATEGORIES = ["iPhone 16", "gaming laptop", "Galaxy Tab", "air fryer", "smart tv", "robot vacuum", "lego", "running sneaker", "perfume", "garden hose"]
_CATEGORY_SQL = "[" + ", ".join(f"'{c}'" for c in CATEGORIES) + "][p_size % 10 + 1]"
_CASES = lambda i: " ".join("WHEN regexp_matches(c, '(?i){}') THEN '{}'".format(p, (b, s)[i]) for p, b, s in rules.TAXONOMY)


@register("rule_taxonomy", f"SELECT id, CASE {_CASES(0)} ELSE 'Electronics' END AS broad, CASE {_CASES(1)} ELSE 'General' END AS sub FROM (SELECT p_partkey AS id, {_CATEGORY_SQL} AS c FROM part)")
def rule_taxonomy(spark, sf):
    category = F.element_at(F.array(*map(F.lit, CATEGORIES)), (F.col("p_size") % 10 + 1).cast("int"))
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), rules.taxonomy(category).alias("t"))
    return p.select("id", "t.broad", "t.sub")


_PLACES = """WITH places AS (SELECT 'c' AS side, c_custkey AS id, c_nationkey % 3 AS city, c_custkey % 2 AS platform, c_custkey AS k FROM customer
   UNION ALL SELECT 's', s_suppkey, s_nationkey % 3, s_suppkey % 2, s_suppkey FROM supplier),
 pins AS (SELECT *, 'shop ' || k % 7 AS name, 'brand ' || k % 3 AS brand, 24.0 + (k * 7919 % 500) / 10000.0 AS lat, 54.0 + (k * 104729 % 500) / 10000.0 AS lng FROM places),
 j AS (SELECT c.id AS id1, s.id AS id2, c.name = s.name AS n, c.brand = s.brand AS b, c.city = s.city AS same_city, c.platform = s.platform AS same,
   2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin(radians(s.lat - c.lat) / 2), 2) + cos(radians(c.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lng - c.lng) / 2), 2)))) AS m
   FROM pins c JOIN pins s ON c.side = 'c' AND s.side = 's' AND abs(c.lat - s.lat) < 0.01 AND abs(c.lng - s.lng) < 0.01),
 v AS (SELECT id1, id2, n AND floor(m + 0.5) <= 75 AND NOT same AS is_match, CASE WHEN n AND floor(m + 0.5) <= 75 AND NOT same THEN 0.9 ELSE 0.5 END AS confidence FROM j WHERE m <= 500 AND (n OR b) AND same_city),
 per AS (SELECT id1, count(*) FILTER (WHERE is_match) AS hits, min(id2) FILTER (WHERE is_match) AS first_hit, max(confidence) AS top, min_by(id2, (-confidence, id2)) AS best FROM v GROUP BY id1)"""


@register(
    "identity_decisions",
    _PLACES + """ SELECT c_custkey AS id, CASE WHEN hits = 1 THEN 'match' WHEN top IS NOT NULL THEN 'review' ELSE 'new' END AS kind, CASE WHEN hits >= 1 THEN first_hit ELSE best END AS target,
 CASE WHEN hits = 1 THEN 0.9 WHEN hits > 1 THEN 0.5 ELSE top END::DOUBLE AS confidence, CASE WHEN hits > 1 THEN 'MULTIPLE_CANDIDATES' END AS conflict FROM customer LEFT JOIN per ON id1 = c_custkey""",
)
def identity_decisions(spark, sf):
    def places(name, prefix, key):
        k = F.col(f"{prefix}_{key}")
        cols = {"name": F.concat(F.lit("shop "), (k % 7).cast("string")), "brand": F.concat(F.lit("brand "), (k % 3).cast("string")), "city": F.col(f"{prefix}_nationkey") % 3, "platform": k % 2}
        cols |= {"lat": 24.0 + (k * 7919 % 500) / 10000.0, "lng": 54.0 + (k * 104729 % 500) / 10000.0}
        return table(spark, sf, name).select(k.alias("id"), *[c.alias(n) for n, c in cols.items()])

    sources = places("customer", "c", "custkey")
    return identity.decisions(sources, places("supplier", "s", "suppkey"))


@register(
    "search_offers_explain",
    f"""WITH {OFFERS_SQL} SELECT ord, line, o.product_id, CASE WHEN p_partkey IS NULL THEN 'NO_PRODUCT' WHEN s_suppkey IS NULL THEN 'NO_RETAILER' WHEN observed_at < TIMESTAMP '1997-01-01' THEN 'STALE'
 WHEN in_stock = false THEN 'UNAVAILABLE' WHEN in_stock IS NULL THEN 'UNKNOWN_STOCK' WHEN s_acctbal < 0 THEN 'RETAILER_SUSPENDED' ELSE 'ELIGIBLE' END AS reason
 FROM offers o LEFT JOIN part ON product_id = p_partkey AND p_size > 5 LEFT JOIN supplier ON retailer_id = s_suppkey""",
)
def search_offers_explain(spark, sf):
    """Every offer with the first check it fails."""
    o = offers(spark, sf)
    j = o.join(table(spark, sf, "part").where("p_size > 5").select("p_partkey"), F.col("product_id") == F.col("p_partkey"), "left")
    j = j.join(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"), F.col("retailer_id") == F.col("s_suppkey"), "left")
    reason = (
        F.when(F.col("p_partkey").isNull(), "NO_PRODUCT")
        .when(F.col("s_suppkey").isNull(), "NO_RETAILER")
        .when(F.col("observed_at") < F.lit("1997-01-01").cast("timestamp"), "STALE")
        .when(~F.col("in_stock"), "UNAVAILABLE")
        .when(F.col("in_stock").isNull(), "UNKNOWN_STOCK")
        .when(F.col("s_acctbal") < 0, "RETAILER_SUSPENDED")
        .otherwise("ELIGIBLE")
    )
    return j.select("ord", "line", "product_id", reason.alias("reason"))


@register(
    "held_duplicate_targets",
    "SELECT l_orderkey AS item, l_linenumber AS line, l_partkey AS target, count(*) OVER (PARTITION BY l_orderkey, l_suppkey) > 1 AS held FROM lineitem",
)
def held_duplicate_targets(spark, sf):
    """Plans of one order that meet in one target are held back for a decision."""
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey")
    n = line.groupBy("l_orderkey", "l_suppkey").agg(F.count("*").alias("n"))
    return line.join(n, ["l_orderkey", "l_suppkey"]).selectExpr("l_orderkey AS item", "l_linenumber AS line", "l_partkey AS target", "n > 1 AS held")


@register(
    "snapshot_diff_actions",
    """WITH b AS (SELECT l_partkey AS id, bool_or(l_linestatus = 'O') AS active FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01' GROUP BY 1), a AS (SELECT l_partkey AS id, bool_or(l_returnflag = 'N') AS active FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01' GROUP BY 1)
 SELECT a.id, CASE WHEN b.id IS NULL THEN 'created' WHEN b.active AND NOT a.active THEN 'deactivated' WHEN a.active AND NOT b.active THEN 'reactivated' ELSE 'unchanged' END AS action FROM a LEFT JOIN b ON a.id = b.id""",
)
def snapshot_diff_actions(spark, sf):
    line = table(spark, sf, "lineitem")
    day = lambda d: F.lit(d).cast("timestamp")
    b = line.where(F.col("l_shipdate") < day("1997-01-01")).groupBy(F.col("l_partkey").alias("id")).agg(F.some(F.col("l_linestatus") == "O").alias("was"))
    a = line.where(F.col("l_shipdate") >= day("1999-01-01")).groupBy(F.col("l_partkey").alias("id")).agg(F.some(F.col("l_returnflag") == "N").alias("now"))
    action = F.when(F.col("was").isNull(), "created").when(F.col("was") & ~F.col("now"), "deactivated").when(F.col("now") & ~F.col("was"), "reactivated").otherwise("unchanged")
    return a.join(b, "id", "left").select("id", action.alias("action"))


_ITEM_MATCH = """WITH p AS (SELECT p_partkey AS id, p_brand || '/' || p_size AS grp, list_distinct(string_split(lower(p_name), ' ')) AS tokens, p_type AS category, CASE WHEN p_partkey % 4 > 0 THEN p_retailprice END AS size FROM part),
 a AS (SELECT * FROM p WHERE id % 2 = 0), b AS (SELECT * FROM p WHERE id % 2 = 1),
 s AS (SELECT a.id AS item, b.id AS canonical, CASE WHEN a.size IS NULL AND b.size IS NULL THEN 1.0 WHEN a.size IS NULL OR b.size IS NULL THEN 0.5 WHEN a.size = b.size THEN 1.0 ELSE 0.0 END AS v,
   2 * len(list_intersect(a.tokens, b.tokens)) / (len(a.tokens) + len(b.tokens)) AS d, a.category = b.category AS c FROM a JOIN b USING (grp) WHERE list_has_any(a.tokens, b.tokens)),
 r AS (SELECT item, canonical, v, floor((0.5::DOUBLE * d + 0.1::DOUBLE * c::INT + 0.2::DOUBLE * v) / (0.5::DOUBLE + 0.1::DOUBLE + 0.2::DOUBLE) * 1000 + 0.5) / 1000 AS confidence FROM s),
 o AS (SELECT *, row_number() OVER w AS place, lead(confidence) OVER w AS nxt FROM r WINDOW w AS (PARTITION BY item ORDER BY confidence DESC, canonical))
 SELECT a.id AS item, canonical, confidence, CASE WHEN confidence >= 0.75 AND v > 0 AND (nxt IS NULL OR confidence - nxt >= 0.1) THEN 'MATCHED' WHEN confidence >= 0.5 THEN 'REVIEW' ELSE 'UNMATCHED' END AS status
 FROM a LEFT JOIN o ON a.id = o.item AND place = 1"""


@register("item_match_scores", _ITEM_MATCH)
@register("item_match_scores_all_tokens", _ITEM_MATCH)
def item_match_scores(spark, sf):
    """Even parts against all odd ones of their brand and size that share any token."""
    items, canon = _even_and_odd_parts(spark, sf)
    return item_match.matched(items, canon)


def _even_and_odd_parts(spark, sf):
    size = F.when(F.col("p_partkey") % 4 > 0, F.col("p_retailprice"))
    p = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat("p_brand", F.lit("/"), "p_size").alias("grp"),
        F.array_distinct(F.split(F.lower("p_name"), " ")).alias("tokens"),
        F.col("p_type").alias("category"),
        size.alias("size"),
    )
    return p.where("id % 2 = 0"), p.where("id % 2 = 1")
