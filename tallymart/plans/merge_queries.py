"""Queries whose rows depend on the rows before them: bundles merged in order, identities decided in order."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.operators import backfill, batch_selection, bundle_merge, duplicate_listings
from tallymart.operators.files import written
from tallymart.operators.menu_store import MenuStore
from tallymart.plans.catalog import register
from tallymart.sources.tables import branches, table

c = F.col


@register(
    "merged_bundles",
    """WITH RECURSIVE line AS (SELECT l_orderkey AS seq, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS pos, 'r' || l_suppkey % 4 AS retailer,
  l_partkey || '-' || l_orderkey % 10 AS external_id, l_extendedprice AS price, l_returnflag AS flag, l_shipdate AS observed_at FROM lineitem),
bundle AS (SELECT o_orderkey AS seq, 'Name ' || o_custkey AS name, CASE WHEN o_orderkey % 5 = 0 THEN 'd' || o_orderkey END AS description, CASE WHEN o_orderkey % 7 > 0 THEN o_orderkey % 7 END AS reviews, o_orderkey % 4 AS images FROM orders),
listed AS (SELECT seq, 0 AS pos, 'name:' || lower(name) AS key FROM bundle UNION ALL SELECT seq, pos + 1, retailer || ':id:' || external_id FROM line WHERE seq IN (SELECT seq FROM bundle)),
keyed AS (SELECT seq, key, min(pos) AS pos FROM listed GROUP BY seq, key),
prior AS (SELECT seq, pos, lag(seq) OVER (PARTITION BY key ORDER BY seq) AS earlier FROM keyed),
parent AS (SELECT seq, coalesce(min_by(earlier, pos) FILTER (earlier IS NOT NULL), seq) AS parent FROM prior GROUP BY seq),
up AS (SELECT seq, parent AS above FROM parent UNION ALL SELECT up.seq, p.parent FROM up JOIN parent p ON up.above = p.seq WHERE p.parent <> up.above),
root AS (SELECT seq, min(above) AS survivor FROM up GROUP BY seq),
b AS (SELECT bundle.*, survivor, count(*) OVER (PARTITION BY survivor) AS members FROM bundle JOIN root USING (seq)),
offer AS (SELECT survivor, line.*, CASE WHEN line.seq = survivor THEN row_number() OVER (PARTITION BY line.seq, retailer ORDER BY pos) - 1 ELSE 0 END AS again FROM line JOIN root USING (seq)),
kept AS (SELECT survivor, retailer, again, min((seq, pos)) AS place, max_by((price, flag), (observed_at, seq, pos)) AS o FROM offer GROUP BY survivor, retailer, again),
shops AS (SELECT survivor, string_agg(retailer || '=' || CAST(o[1] AS VARCHAR), ' ' ORDER BY place) AS retailers, count(*) AS n, min(o[1]) FILTER (o[2] <> 'R' AND o[1] > 0) AS low, max(o[1]) FILTER (o[2] <> 'R' AND o[1] > 0) AS high FROM kept GROUP BY survivor),
tag AS (SELECT survivor, flag, min((seq, pos)) AS place FROM offer GROUP BY survivor, flag),
tags AS (SELECT survivor, string_agg(flag, ',' ORDER BY place) AS tags FROM tag GROUP BY survivor)
SELECT survivor AS seq, min_by(name, seq) AS name, count(*) AS members, any_value(retailers) AS retailers, any_value(tags) AS tags, CAST(max(images) AS INTEGER) AS images, min_by(description, seq) FILTER (description IS NOT NULL) AS description,
  CAST(max(reviews) AS BIGINT) AS review_count, CASE WHEN count(*) > 1 THEN CAST(coalesce(any_value(n), 0) AS INTEGER) END AS retailer_count, CASE WHEN count(*) > 1 THEN any_value(low) END AS lowest_price, CASE WHEN count(*) > 1 THEN any_value(high) END AS highest_price
FROM b LEFT JOIN shops USING (survivor) LEFT JOIN tags USING (survivor) GROUP BY survivor""",
)
def merged_bundles(spark, sf):
    """Orders as bundles, named by their customer, with their lines as listings."""
    k = c("o_orderkey")
    offer = F.struct(F.concat(F.lit("r"), c("l_suppkey") % 4).alias("retailer"), F.concat_ws("-", "l_partkey", c("l_orderkey") % 10).alias("external_id"), F.lit(None).cast("string").alias("url"), c("l_extendedprice").alias("price"), F.when(c("l_returnflag") == "A", True).when(c("l_returnflag") == "R", False).alias("in_stock"), c("l_shipdate").cast("string").alias("observed_at"), c("l_returnflag").alias("flag"))
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", offer.alias("o"))
    lines = table(spark, sf, "lineitem").groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.transform(F.sort_array(F.collect_list(order)), lambda x: x["o"]).alias("retailers"))
    none = lambda t: F.lit(None).cast(t)
    bundles = table(spark, sf, "orders").join(lines, "o_orderkey", "left").select(
        k.alias("seq"), F.concat(F.lit("Name "), c("o_custkey")).alias("name"), "retailers", F.transform("retailers", lambda o: o["flag"]).alias("tags"), F.array_repeat(F.lit("i"), (k % 4).cast("int")).alias("images"),
        F.when(k % 5 == 0, F.concat(F.lit("d"), k)).alias("description"), none("double").alias("rating"), F.when(k % 7 > 0, k % 7).alias("review_count"), none("int").alias("retailer_count"), none("double").alias("lowest_price"), none("double").alias("highest_price"),
    )
    shown = F.transform("retailers", lambda o: F.concat(o["retailer"], F.lit("="), o["price"]))
    return bundle_merge.merged(bundles).select("seq", "name", "members", F.nullif(F.array_join(shown, " "), F.lit("")).alias("retailers"), F.nullif(F.array_join("tags", ","), F.lit("")).alias("tags"), F.size("images").alias("images"), "description", "review_count", "retailer_count", "lowest_price", "highest_price")


def identity_inputs(spark, sf):
    """Suppliers and customers as listings of two platforms: names, brands, addresses and areas by their keys, cities by nation; each fifth supplier is the group that it started."""

    def listed(name, prefix, key, platform):
        k = F.col(f"{prefix}_{key}")
        place = branches(spark, sf, name, prefix).select(c("id").alias("key"), "lat", "lng", "nation")
        at = lambda step: (c("key") % step).cast("string")
        pinned = k % 3 != 0
        return table(spark, sf, name).join(place, k == c("key")).select(
            F.concat(F.lit(platform), c("key")).alias("id"), F.when(c("key") % 11 != 0, c("key") * 7919 % 1000).alias("created_at"), F.lit(platform).alias("platform"),
            F.array(F.concat(F.lit("place "), at(37))).alias("names"), F.when(c("key") % 2 == 0, F.array(F.concat(F.lit("brand "), at(7)))).otherwise(F.array().cast("array<string>")).alias("brands"),
            F.when(c("key") % 13 != 0, F.concat(F.lit("city "), (c("nation") % 5).cast("string"))).alias("city"), F.when(c("key") % 4 == 0, F.concat(F.lit("area "), at(6))).alias("area"), F.when(c("key") % 3 == 1, F.concat(at(10), F.lit(" road"))).alias("address"),
            F.when(pinned, c("lat")).alias("lat"), F.when(pinned, c("lng")).alias("lng"),
        )

    suppliers = listed("supplier", "s", "suppkey", "t")
    first = F.substring("id", 2, 20).cast("long") % 5 == 0
    groups = suppliers.where(first).select(F.concat(F.lit("G"), "id").alias("group_id"), *backfill.SIGNALS)
    mappings = suppliers.where(first).select("id", F.concat(F.lit("G"), "id").alias("group_id"), F.lit("MATCHED").alias("status"), "platform")
    customers = listed("customer", "c", "custkey", "d")
    rejected = customers.where(F.substring("id", 2, 20).cast("long") % 2 == 0).select("id", F.lit("Gt0").alias("group_id"))
    return suppliers.unionByName(customers), groups, mappings, rejected


@register("identity_backfill")
def identity_backfill(spark, sf):
    """E7. Without SQL, as each decision sees those before it; a test takes them one after the other."""
    return backfill.plan(*identity_inputs(spark, sf))


@register(
    "menu_writes",
    """WITH line AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p, l_linestatus AS status FROM lineitem),
item AS (SELECT s, p, status, p % 23 <> 0 AS named FROM line),
one AS (SELECT s, count(*) AS seen, count(*) FILTER (named) AS created, count(*) FILTER (NOT named) AS rejected FROM item WHERE status = 'F' GROUP BY s),
two AS (SELECT o.s, count(*) AS seen, count(*) FILTER (named AND f.p IS NULL) AS created, count(*) FILTER (named AND f.p IS NOT NULL AND o.p % 3 = 0) AS updated, count(*) FILTER (named AND f.p IS NOT NULL AND o.p % 3 <> 0) AS unchanged,
  count(*) FILTER (NOT named) AS rejected FROM (SELECT * FROM item WHERE status = 'O') o LEFT JOIN (SELECT s, p FROM item WHERE status = 'F') f ON o.s = f.s AND o.p = f.p GROUP BY o.s),
gone AS (SELECT f.s, count(*) AS n FROM item f WHERE status = 'F' AND named AND NOT EXISTS (SELECT 1 FROM item o WHERE o.status = 'O' AND o.s = f.s AND o.p = f.p) GROUP BY f.s),
runs AS (SELECT s_suppkey AS s, 'first' AS run_id, coalesce(seen, 0) AS seen, coalesce(created, 0) AS created, 0 AS updated, 0 AS unchanged, coalesce(rejected, 0) AS rejected, 0 AS previous, 0 AS gone FROM supplier LEFT JOIN one ON s = s_suppkey
  UNION ALL SELECT s_suppkey, 'second', coalesce(two.seen, 0), coalesce(two.created, 0), coalesce(two.updated, 0), coalesce(two.unchanged, 0), coalesce(two.rejected, 0), coalesce(one.created, 0), coalesce(n, 0)
  FROM supplier LEFT JOIN two ON two.s = s_suppkey LEFT JOIN one ON one.s = s_suppkey LEFT JOIN gone ON gone.s = s_suppkey),
told AS (SELECT *, list_filter([CASE WHEN seen = 0 THEN 'NO_ITEMS' END, CASE WHEN seen > 0 AND rejected > seen * 0.1::DOUBLE THEN 'TOO_MANY_REJECTED_ITEMS' END, CASE WHEN previous > 0 AND seen < ceil(previous * 0.5) THEN 'SUSPICIOUS_ITEM_DROP' END], lambda x: x IS NOT NULL) AS reasons FROM runs)
SELECT 's' || s AS restaurant, run_id, CAST(seen AS BIGINT) AS items_seen, CAST(created AS BIGINT) AS items_created, CAST(updated AS BIGINT) AS items_updated, CAST(unchanged AS BIGINT) AS items_unchanged, CAST(rejected AS BIGINT) AS items_rejected,
  CAST(CASE WHEN len(reasons) = 0 THEN gone ELSE 0 END AS BIGINT) AS items_inactive, coalesce(array_to_string(reasons, ','), '') AS reasons FROM told""",
)
def menu_writes(spark, sf):
    """suppliers' menus as of filled lines, then as of open ones: a third of the parts at another price, each 23rd without a name."""
    place = F.concat(F.lit("s"), c("s_suppkey"))
    s, none = table(spark, sf, "supplier"), lambda kind: F.lit(None).cast(kind)
    # dealt by part once, for the distinct lines and their parts; written, as both menus and their counts are read from it
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_linestatus").repartition("l_partkey").distinct()
    lines = written(lines.join(table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_retailprice"), c("l_partkey") == c("p_partkey")))
    restaurants = s.select(place.alias("restaurant"), F.lit("d").alias("platform"), none("string").alias("platform_id"), c("s_name").alias("name"), none("string").alias("url"), F.lit("AED").alias("currency"), none("double").alias("lat"), none("double").alias("lng"))
    categories = s.select(place.alias("restaurant"), F.lit("all").alias("source_key"), F.lit("anchor").alias("kind"), none("string").alias("platform_id"), F.lit("All").alias("name"), F.lit(0).alias("sort_order"))
    store = MenuStore(spark, f"{bundle_merge.shared_folder(spark)}/menus", buckets=8)
    for run_id, status, dearer, day in (("first", "F", 0, "2024-01-01"), ("second", "O", 1, "2024-01-02")):
        p = c("l_partkey")
        items = lines.where(c("l_linestatus") == status).select(
            F.concat(F.lit("s"), c("l_suppkey")).alias("restaurant"), F.concat(F.lit("p"), p).alias("source_key"), F.lit("id").alias("kind"), p.cast("string").alias("platform_id"), F.lit("all").alias("category_key"), F.when(p % 23 != 0, c("p_name")).alias("name"), c("p_type").alias("description"),
            (c("p_retailprice") + F.when(p % 3 == 0, dearer).otherwise(0)).alias("price"), none("double").alias("original_price"), F.lit("AED").alias("currency"), none("string").alias("image_url"), F.lit(True).alias("available"),
        )
        seen = items.groupBy("restaurant").agg(F.count("*").alias("items_seen"))
        pages = restaurants.select("restaurant", F.lit(True).alias("complete")).join(seen, "restaurant", "left").select("restaurant", "complete", F.coalesce("items_seen", F.lit(0)).alias("items_seen"), F.lit(0).alias("items_rejected"))
        store.write(restaurants, categories, items, pages, "en", run_id, day)
    return store.read("runs").select("restaurant", "run_id", "items_seen", "items_created", "items_updated", "items_unchanged", "items_rejected", "items_inactive", F.array_join("inactive_reasons", ",").alias("reasons"))


def duplicate_inputs(spark, sf):
    """Suppliers and customers as listings of two platforms on one grid of pins, with menus by their keys; each third has a group of its own, each fifth shares one, others are in review."""

    def side(name, prefix, key, platform, step):
        k = F.col(f"{prefix}_{key}")
        return table(spark, sf, name).select(
            F.concat(F.lit(platform), k).alias("restaurant"), F.lit(platform).alias("platform"), (k % 17).cast("string").alias("brand"), F.array(F.concat(F.lit("b"), k % 29)).alias("brands"), F.when(k % 7 != 0, F.concat(F.lit("c"), k % 2)).alias("city"),
            F.lit(None).cast("string").alias("area"), F.lit(None).cast("string").alias("address"), F.when(k % 11 != 0, 24 + (k % 23) * 0.003).alias("lat"), (54 + (k * step % 31) * 0.0004).alias("lng"),
            F.transform(F.sequence(F.lit(1), (3 + k % 4).cast("int")), lambda i: F.concat(F.lit("d"), (k + i) % 8)).alias("dishes"),
            F.when(k % 3 == 0, F.concat(F.lit(f"g{platform}"), k)).when(k % 5 == 0, "shared").otherwise(F.concat(F.lit("r"), k)).alias("grp"), F.when((k % 3 == 0) | (k % 5 == 0), "MATCHED").otherwise("REVIEW").alias("status"),
        )

    return side("supplier", "s", "suppkey", "d", 7).unionByName(side("customer", "c", "custkey", "t", 11))


_SIDE = """SELECT '{p}' || k AS r, k % 17 AS brand, k % 29 AS brands, CASE WHEN k % 7 <> 0 THEN k % 2 END AS city, CASE WHEN k % 11 <> 0 THEN 24 + (k % 23) * 0.003::DOUBLE END AS lat, 54 + (k * {step} % 31) * 0.0004::DOUBLE AS lng,
  list_transform(range(1, 4 + k % 4), lambda i: (k + i) % 8) AS dishes, CASE WHEN k % 3 = 0 THEN 'g{p}' || k WHEN k % 5 = 0 THEN 'shared' ELSE 'r' || k END AS grp, k % 3 = 0 AS matched, k % 3 = 0 OR k % 5 <> 0 AS alone FROM (SELECT {key} AS k FROM {table})"""


@register(
    "duplicate_listings",
    f"""WITH d AS ({_SIDE.format(p="d", step=7, key="s_suppkey", table="supplier")}), t AS ({_SIDE.format(p="t", step=11, key="c_custkey", table="customer")}),
j AS (SELECT d.r AS id1, t.r AS id2, d.matched AS m1, t.matched AS m2, d.grp AS g1, t.grp AS g2, floor(2 * 6371000.0::DOUBLE * asin(least(1.0::DOUBLE, sqrt(pow(sin(radians(t.lat - d.lat) / 2), 2) + cos(radians(d.lat)) * cos(radians(t.lat)) * pow(sin(radians(t.lng - d.lng) / 2), 2)))) + 0.5) AS metres,
  len(list_intersect(d.dishes, t.dishes)) / least(len(list_distinct(d.dishes)), len(list_distinct(t.dishes))) AS overlap
  FROM d JOIN t ON d.alone AND t.alone AND d.lat IS NOT NULL AND t.lat IS NOT NULL AND (d.brand = t.brand OR d.brands = t.brands) AND coalesce(d.city = t.city, true)),
fit AS (SELECT *, count(*) OVER (PARTITION BY id1) AS n1, count(*) OVER (PARTITION BY id2) AS n2 FROM j WHERE metres <= 75 OR (metres <= 150 AND overlap >= 0.8))
SELECT id1, id2, CAST(metres AS BIGINT) AS metres, floor(overlap * 100 + 0.5) / 100 AS overlap, CASE WHEN m2 THEN id2 ELSE id1 END AS anchor, CASE WHEN m1 OR m2 THEN 'merged' ELSE 'ANCHOR_NOT_MATCHED' END AS outcome,
  CASE WHEN m2 THEN g2 WHEN m1 THEN g1 END AS joins, CASE WHEN m2 AND m1 THEN g1 END AS retired FROM fit WHERE n1 = 1 AND n2 = 1""",
)
def duplicate_listings_query(spark, sf):
    """J8, E11."""
    rows = duplicate_inputs(spark, sf)
    lone = duplicate_listings.alone(rows.select("restaurant", "grp", "status"))
    pairs = duplicate_listings.lone_pairs(rows.drop("grp", "status").join(lone, "restaurant"), "d", "t")
    return duplicate_listings.merges(pairs).select("id1", "id2", "metres", "overlap", "anchor", "outcome", "joins", "retired")


def selection_inputs(spark, sf):
    """Suppliers and customers as candidates of two platforms: brands and words of places by their keys, ratings by their balance."""

    def side(name, prefix, key, platform):
        k = F.col(f"{prefix}_{key}")
        return table(spark, sf, name).select(
            F.concat(F.lit(platform), F.lpad(k.cast("string"), 9, "0")).alias("id"), F.lit(platform).alias("platform"), F.when(k % 19 != 0, F.concat(F.lit("brand "), k % 37)).alias("brand"), F.array(F.concat(F.lit("area "), k % 11), F.concat(F.lit("area "), k % 5)).alias("areas"),
            F.when(k % 4 != 0, F.floor(F.col(f"{prefix}_acctbal") / 100)).alias("rating_count"), F.when(k % 3 != 0, (k % 50) / 10).alias("rating"),
        )

    return side("supplier", "s", "suppkey", "d").unionByName(side("customer", "c", "custkey", "t"))


@register("batch_selection")
def batch_selection_query(spark, sf):
    """J9, E26, W9. Without SQL, as each choice sees those before it; a test takes them one after the other."""
    return batch_selection.selected(selection_inputs(spark, sf), {"d": 40, "t": 60}, ("d", "t"), controls=5)
