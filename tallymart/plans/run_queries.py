"""Queries on runs, queues, branches and data quality."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymart.functions import geo
from tallymart.operators import runs
from tallymart.plans.catalog import register
from tallymart.sources.tables import branches, table


@register(
    "consecutive_failures",
    """WITH e AS (SELECT user_id, event_id, ts, (event_type = 'error')::INT AS f FROM events), i AS (SELECT *, sum(1 - f) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM e),
 r AS (SELECT user_id, island, sum(f) AS n FROM i GROUP BY ALL) SELECT user_id, max(n)::BIGINT AS longest, max_by(n, island)::BIGINT AS current FROM r GROUP BY user_id""",
)
def consecutive_failures(spark, sf):
    return runs.failure_streaks(table(spark, sf, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")


@register(
    "budget_running_cap",
    """WITH RECURSIVE e AS (SELECT event_id, CAST(ts AS DATE) AS day, user_id, 1 + event_id % 25 AS cost, row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY ts, event_id) AS n FROM events),
 r AS (SELECT event_id, day, user_id, n, cost AS used, true AS accepted FROM e WHERE n = 1
   UNION ALL SELECT e.event_id, e.day, e.user_id, e.n, r.used + CASE WHEN r.used + e.cost <= 40 THEN e.cost ELSE 0 END, r.used + e.cost <= 40 FROM r JOIN e ON e.day = r.day AND e.user_id = r.user_id AND e.n = r.n + 1)
 SELECT event_id, day, user_id, used::BIGINT AS spent, accepted FROM r""",
)
def budget_running_cap(spark, sf):
    """R6."""
    e = table(spark, sf, "events").selectExpr("event_id", "CAST(ts AS DATE) AS day", "user_id", "ts", "1 + event_id % 25 AS cost")
    return runs.within_budget(e, ["day", "user_id"], ["ts", "event_id"], "cost", 40).select("event_id", "day", "user_id", "spent", "accepted")


@register("status_rollup", "SELECT l_orderkey AS job, CASE WHEN bool_and(l_linestatus = 'F') THEN 'complete' WHEN NOT bool_or(l_linestatus = 'F') THEN 'failed' ELSE 'partial' END AS status, count(*) AS parts FROM lineitem GROUP BY l_orderkey")
def status_rollup(spark, sf):
    return runs.status_rollup(table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "job"), "job", "l_linestatus")


@register("queue_grouping_sets", "SELECT o_orderpriority AS platform, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY GROUPING SETS ((), (o_orderpriority), (o_orderpriority, o_orderstatus))")
def queue_grouping_sets(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderpriority AS platform", "o_orderstatus AS status")
    return o.groupingSets([[], ["platform"], ["platform", "status"]], "platform", "status").agg(F.count("*").alias("n"))


@register(
    "site_run_counters",
    "SELECT CAST(ts AS DATE) AS run, user_id AS site, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE event_type = 'purchase') AS scraped, max_by(event_type, event_id) AS last_status FROM events GROUP BY ALL",
)
def site_run_counters(spark, sf):
    e = table(spark, sf, "events").withColumn("run", F.col("ts").cast("date"))
    count = lambda kind: F.count_if(F.col("event_type") == kind)
    return e.groupBy("run", F.col("user_id").alias("site")).agg(F.count("*").alias("n"), count("error").alias("failed"), count("purchase").alias("scraped"), F.max_by("event_type", "event_id").alias("last_status"))


@register(
    "reaped_stale_runs",
    """WITH e AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM events)
 SELECT event_id, user_id, coalesce(next_ts > ts + INTERVAL 6 HOUR, true) AS reaped FROM e WHERE event_type = 'view'""",
)
def reaped_stale_runs(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf, "events").withColumn("next_ts", F.lead("ts").over(w)).where("event_type = 'view'")
    return e.select("event_id", "user_id", F.coalesce(F.col("next_ts") > F.col("ts") + F.expr("INTERVAL 6 HOURS"), F.lit(True)).alias("reaped"))


@register(
    "coverage_pct",
    """SELECT source, count(*) AS n, floor(100.0 * count(*) FILTER (WHERE length(text) > 200) / count(*) + 0.5)::BIGINT AS with_text, floor(100.0 * count(lang) / count(*) + 0.5)::BIGINT AS with_lang,
 floor(100.0 * count(*) FILTER (WHERE contains(text, 'http')) / count(*) + 0.5)::BIGINT AS with_link FROM documents GROUP BY source""",
)
def coverage_pct(spark, sf):
    share = lambda c: F.floor(100.0 * F.count_if(c) / F.count("*") + 0.5)
    d = table(spark, sf, "documents")
    return d.groupBy("source").agg(F.count("*").alias("n"), share(F.length("text") > 200).alias("with_text"), share(F.col("lang").isNotNull()).alias("with_lang"), share(F.contains("text", F.lit("http"))).alias("with_link"))


@register(
    "quality_flags",
    """WITH q AS (SELECT s_suppkey AS id, count(l_partkey) AS items, count(DISTINCT l_partkey) AS dishes, count(*) FILTER (WHERE l_returnflag = 'N') AS unknown FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_suppkey),
 f AS (SELECT *, list_filter([CASE WHEN items = 0 THEN 'NO_ITEMS' END, CASE WHEN dishes < 5 THEN 'FEW_ITEMS' END, CASE WHEN unknown * 2 > items THEN 'UNKNOWN_STOCK' END], lambda x: x IS NOT NULL) AS flags FROM q)
 SELECT id, items, dishes, array_to_string(flags, ',') AS flags, len(flags) = 0 AS ok FROM f""",
)
def quality_flags(spark, sf):
    line = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("items"), F.count_distinct("l_partkey").alias("dishes"), F.count_if(F.col("l_returnflag") == "N").alias("unknown"))
    q = table(spark, sf, "supplier").join(line, F.col("s_suppkey") == F.col("l_suppkey"), "left").select(F.col("s_suppkey").alias("id"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("items", "dishes", "unknown")])
    flags = F.array_compact(F.array(F.when(F.col("items") == 0, "NO_ITEMS"), F.when(F.col("dishes") < 5, "FEW_ITEMS"), F.when(F.col("unknown") * 2 > F.col("items"), "UNKNOWN_STOCK")))
    return q.select("id", "items", "dishes", F.array_join(flags, ",").alias("flags"), (F.size(flags) == 0).alias("ok"))


@register("plan_fingerprint", "SELECT o_custkey AS scope, left(sha256(string_agg(line, chr(10) ORDER BY line)), 16) AS fingerprint FROM (SELECT o_custkey, o_orderkey || '>' || o_orderstatus AS line FROM orders) GROUP BY o_custkey")
def plan_fingerprint(spark, sf):
    line = F.concat(F.col("o_orderkey").cast("string"), F.lit(">"), F.col("o_orderstatus"))
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("scope")).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    return o.select("scope", F.substring(F.sha2(F.array_join("lines", "\n"), 256), 1, 16).alias("fingerprint"))


@register("offer_key_hash", "SELECT p_partkey AS id, left(sha1(p_brand || '|' || p_type || '|' || coalesce(CAST(p_size AS VARCHAR), '')), 16) AS offer_key FROM part")
def offer_key_hash(spark, sf):
    parts = F.concat_ws("|", "p_brand", "p_type", F.coalesce(F.col("p_size").cast("string"), F.lit("")))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.substring(F.sha1(parts), 1, 16).alias("offer_key"))


@register(
    "round_robin_interleave",
    "SELECT c_custkey AS id, c_nationkey AS platform, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey)::BIGINT AS turn FROM customer",
)
def round_robin_interleave(spark, sf):
    """(turn, platform) is the order of the interleaved list; the list itself is a sort by it."""
    w = Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey")
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("platform"), F.row_number().over(w).cast("long").alias("turn"))


_PINS = """WITH l AS (SELECT s_suppkey AS id, 24.0 + (s_suppkey * 7919 % 5000) / 10000.0 AS lat, 54.0 + (s_suppkey * 104729 % 5000) / 10000.0 AS lng FROM supplier),
 r AS (SELECT c_custkey AS id, 24.0 + (c_custkey * 7919 % 5000) / 10000.0 AS lat, 54.0 + (c_custkey * 104729 % 5000) / 10000.0 AS lng FROM customer)"""


@register(
    "haversine_near_pairs",
    _PINS + """, p AS (SELECT l.id AS id1, r.id AS id2, 2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin(radians(r.lat - l.lat) / 2), 2) + cos(radians(l.lat)) * cos(radians(r.lat)) * pow(sin(radians(r.lng - l.lng) / 2), 2)))) AS m
   FROM l JOIN r ON r.lat BETWEEN l.lat - 0.02 AND l.lat + 0.02 AND r.lng BETWEEN l.lng - 0.02 AND l.lng + 0.02)
 SELECT id1, id2, floor(m + 0.5)::BIGINT AS metres FROM p WHERE m <= 500""",
)
def haversine_near_pairs(spark, sf):
    pairs = geo.near_pairs(branches(spark, sf, "supplier", "s"), branches(spark, sf, "customer", "c"), 500)
    return pairs.select("id1", "id2", F.floor(F.col("metres") + 0.5).alias("metres"))


@register(
    "unique_partner_pairs",
    _PINS + """, p AS (SELECT l.id AS id1, r.id AS id2 FROM l JOIN r ON floor(l.lat / 0.01) = floor(r.lat / 0.01) AND floor(l.lng / 0.01) = floor(r.lng / 0.01))
 SELECT id1, id2 FROM p QUALIFY count(*) OVER (PARTITION BY id1) = 1 AND count(*) OVER (PARTITION BY id2) = 1""",
)
def unique_partner_pairs(spark, sf):
    """Pairs in one cell, where neither end has another partner."""
    y, x = geo.cell(F.col("lat"), F.col("lng"), 0.01)
    left = branches(spark, sf, "supplier", "s").select(F.col("id").alias("id1"), y.alias("y"), x.alias("x"))
    right = branches(spark, sf, "customer", "c").select(F.col("id").alias("id2"), y.alias("y"), x.alias("x"))
    # a cell with one row of either side is the only place where both ends are unique: no pair of a fuller cell is ever made
    alone = lambda df, c: df.groupBy("y", "x").agg(F.min(c).alias(c), F.count("*").alias("n")).where("n = 1").drop("n")
    return alone(left, "id1").join(alone(right, "id2"), ["y", "x"]).select("id1", "id2")


@register(
    "event_windows",
    "SELECT date_trunc('hour', ts) AS starts, event_type, count(*) AS n, floor(sum(value) * 100 + 0.5)::BIGINT AS cents FROM events GROUP BY ALL",
)
def event_windows(spark, sf):
    """Extension: hourly tumbling windows; streaming/windows.py runs the same aggregate on a stream."""
    from tallymart.streaming.windows import hourly

    return hourly(table(spark, sf, "events")).selectExpr("window.start AS starts", "event_type", "n", "floor(v * 100 + 0.5) AS cents")


@register(
    "geohash_cells",
    """WITH p AS (SELECT c_custkey AS id, 24.0 + (c_custkey * 7919 % 5000) / 10000.0 AS lat, 54.0 + (c_custkey * 104729 % 5000) / 10000.0 AS lng FROM customer),
 b AS (SELECT id, list_reduce(list_transform(range(30), lambda i: CASE WHEN i % 2 = 0 THEN (floor((lng + 180) / 360 * 32768)::BIGINT >> (14 - i // 2)) & 1 ELSE (floor((lat + 90) / 180 * 32768)::BIGINT >> (14 - i // 2)) & 1 END), lambda a, x: a * 2 + x) AS code FROM p)
 SELECT array_to_string(list_transform(range(6), lambda k: substr('0123456789bcdefghjkmnpqrstuvwxyz', ((code >> (25 - 5 * k)) & 31)::INT + 1, 1)), '') AS cell, count(*) AS n FROM b GROUP BY 1""",
)
def geohash_cells(spark, sf):
    """Customers by geohash cell of six characters."""
    c = branches(spark, sf, "customer", "c")
    return c.groupBy(geo.geohash(F.col("lat"), F.col("lng")).alias("cell")).agg(F.count("*").alias("n"))
