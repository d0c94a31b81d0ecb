"""Statistics of runs, groups and catalogues; first-wins and capped orders; set operations. Each is named by its row of the survey."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymart.functions.text import rounded
from tallymart.operators import merge
from tallymart.plans.catalog import register
from tallymart.sources.tables import OFFERS_SQL, offers, table

c = F.col


@register("category_counts", "SELECT l_suppkey AS restaurant, count(DISTINCT p_type) AS categories FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey")
def category_counts(spark, sf):
    """A2."""
    j = table(spark, sf, "lineitem").join(table(spark, sf, "part"), c("l_partkey") == c("p_partkey")).select("l_suppkey", "p_type").distinct()
    return j.groupBy(c("l_suppkey").alias("restaurant")).agg(F.count("p_type").alias("categories"))


@register("offers_by_type", "SELECT l_returnflag AS type, count(*) AS n, count(DISTINCT l_suppkey) AS restaurants FROM lineitem GROUP BY l_returnflag")
def offers_by_type(spark, sf):
    """A3: pairs first, so the count of restaurants adds up what the partial aggregation leaves."""
    pairs = table(spark, sf, "lineitem").groupBy(c("l_returnflag").alias("type"), "l_suppkey").agg(F.count("*").alias("n"))
    return pairs.groupBy("type").agg(F.sum("n").alias("n"), F.count("l_suppkey").alias("restaurants"))


@register(
    "mapping_outcomes",
    """SELECT c_mktsegment AS grp, count(*) FILTER (WHERE o_orderstatus = 'F') AS matched, count(*) FILTER (WHERE o_orderstatus = 'P') AS review, count(*) FILTER (WHERE o_orderstatus = 'O') AS unmatched
 FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
)
def mapping_outcomes(spark, sf):
    """A5."""
    o = table(spark, sf, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))
    j = o.join(table(spark, sf, "customer"), c("o_custkey") == c("c_custkey"))
    of = lambda s: F.coalesce(F.sum(F.when(c("o_orderstatus") == s, c("n"))), F.lit(0))
    return j.groupBy(c("c_mktsegment").alias("grp")).agg(of("F").alias("matched"), of("P").alias("review"), of("O").alias("unmatched"))


@register(
    "group_stats",
    """WITH n AS (SELECT c_nationkey AS grp, c_mktsegment AS platform, count(*) AS n FROM customer GROUP BY ALL)
 SELECT grp, string_agg(platform, ',' ORDER BY platform) AS platforms, string_agg(platform || ':' || n, ',' ORDER BY platform) AS items, sum(n)::BIGINT AS total, count(*) > 1 AS comparable FROM n GROUP BY grp""",
)
def group_stats(spark, sf):
    """The platforms of each group and the items on each."""
    n = table(spark, sf, "customer").groupBy(c("c_nationkey").alias("grp"), c("c_mktsegment").alias("platform")).agg(F.count("*").alias("n"))
    held = F.array_sort(F.collect_list(F.struct("platform", "n")))  # one entry for each platform
    g = n.groupBy("grp").agg(held.alias("h"), F.sum("n").alias("total"))
    platforms, items = F.array_join("h.platform", ","), F.array_join(F.transform("h", lambda x: F.concat(x["platform"], F.lit(":"), x["n"].cast("string"))), ",")
    return g.select("grp", platforms.alias("platforms"), items.alias("items"), "total", (F.size("h") > 1).alias("comparable"))


@register(
    "pair_checks",
    """WITH p AS (SELECT s_nationkey AS pair, CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey % 2 END AS grp FROM supplier)
 SELECT pair, bool_or(grp IS NULL) AS pending, count(DISTINCT grp) = 1 AND NOT bool_or(grp IS NULL) AS merged, count(DISTINCT grp) AS groups FROM p GROUP BY pair""",
)
def pair_checks(spark, sf):
    """A10: whether both listings of a pair are in one group yet."""
    p = table(spark, sf, "supplier").select(c("s_nationkey").alias("pair"), F.when(c("s_suppkey") % 5 != 0, c("s_suppkey") % 2).alias("grp"))
    pending = F.some(c("grp").isNull())
    return p.groupBy("pair").agg(pending.alias("pending"), ((F.count_distinct("grp") == 1) & ~pending).alias("merged"), F.count_distinct("grp").alias("groups"))


@register(
    "bundle_ratings",
    """WITH o AS (SELECT l_partkey AS product_id, l_orderkey AS ord, l_linenumber AS line, CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity END AS rating,
   CASE WHEN l_linenumber % 2 = 0 THEN floor(l_tax * 100 + 0.5)::INT END AS reviews, l_extendedprice AS price FROM lineitem),
 b AS (SELECT * FROM o WHERE reviews IS NOT NULL QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY reviews DESC, ord, line, price) = 1),
 f AS (SELECT * FROM o WHERE rating IS NOT NULL QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ord, line, price) = 1)
 SELECT p.product_id, CASE WHEN b.product_id IS NOT NULL THEN b.rating ELSE f.rating END AS rating, b.reviews AS review_count FROM (SELECT DISTINCT product_id FROM o) p LEFT JOIN b USING (product_id) LEFT JOIN f USING (product_id)""",
)
def bundle_ratings(spark, sf):
    """Rating and count of the offer with most reviews, the first of equal ones; without reviews the first rating. One aggregation, no window."""
    o = table(spark, sf, "lineitem").select(c("l_partkey").alias("product_id"), F.when(c("l_linenumber") % 3 != 0, c("l_quantity")).alias("rating"), F.when(c("l_linenumber") % 2 == 0, rounded(c("l_tax") * 100, 1).cast("int")).alias("reviews"), F.struct("l_orderkey", "l_linenumber", "l_extendedprice").alias("at"))
    best = F.min(F.when(c("reviews").isNotNull(), F.struct((-c("reviews")).alias("r"), "at", "rating"))).alias("best")
    first = F.min(F.when(c("rating").isNotNull(), F.struct("at", "rating"))).alias("first")
    g = o.groupBy("product_id").agg(best, first)
    return g.select("product_id", F.when(c("best").isNotNull(), c("best.rating")).otherwise(c("first.rating")).alias("rating"), (-c("best.r")).alias("review_count"))


@register("benchmark_summary", "SELECT event_type AS page, count(*) AS pages, floor(avg(value) * 100 + 0.5)::BIGINT AS cents, floor(100.0 * count(*) FILTER (WHERE value > 50) / count(*) + 0.5)::BIGINT AS covered FROM events GROUP BY event_type")
def benchmark_summary(spark, sf):
    """A14."""
    e = table(spark, sf, "events").groupBy(c("event_type").alias("page"))
    return e.agg(F.count("*").alias("pages"), F.floor(F.avg("value") * 100 + 0.5).alias("cents"), F.floor(100.0 * F.count_if(c("value") > 50) / F.count("*") + 0.5).alias("covered"))


@register("confidence_by_status", "SELECT o_orderstatus AS status, min(o_totalprice) AS least, max(o_totalprice) AS most, floor(avg(o_totalprice) + 0.5)::BIGINT AS mean, count(*) AS n FROM orders GROUP BY o_orderstatus")
def confidence_by_status(spark, sf):
    """A15."""
    return table(spark, sf, "orders").groupBy(c("o_orderstatus").alias("status")).agg(F.min("o_totalprice").alias("least"), F.max("o_totalprice").alias("most"), F.floor(F.avg("o_totalprice") + 0.5).alias("mean"), F.count("*").alias("n"))


_REASONS = "[CASE WHEN o_orderstatus = 'P' THEN 'NOT_DUE' END, CASE WHEN o_totalprice < 50000 THEN 'LOW_VALUE' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'LOW_PRIORITY' END]"


def _reasons():
    return F.array_compact(F.array(F.when(c("o_orderstatus") == "P", "NOT_DUE"), F.when(c("o_totalprice") < 50000, "LOW_VALUE"), F.when(c("o_orderpriority") == "5-LOW", "LOW_PRIORITY")))


@register("first_skip_reasons", f"WITH r AS (SELECT list_filter({_REASONS}, lambda x: x IS NOT NULL) AS r FROM orders) SELECT coalesce(r[1], 'PLANNED') AS reason, count(*) AS n FROM r GROUP BY 1")
def first_skip_reasons(spark, sf):
    """Orders by the first reason against them."""
    return table(spark, sf, "orders").groupBy(F.coalesce(F.get(_reasons(), 0), F.lit("PLANNED")).alias("reason")).agg(F.count("*").alias("n"))


@register("warning_counts", f"WITH r AS (SELECT unnest(list_filter({_REASONS}, lambda x: x IS NOT NULL)) AS code FROM orders) SELECT code, count(*) AS n FROM r GROUP BY code")
def warning_counts(spark, sf):
    """Every reason counts."""
    return table(spark, sf, "orders").select(F.explode(_reasons()).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


@register(
    "job_totals",
    """SELECT o_custkey AS job, count(*) AS targets, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, count(*) FILTER (WHERE o_orderstatus = 'P') AS skipped,
 sum(floor(o_totalprice)::BIGINT)::BIGINT AS credits, max_by(o_orderstatus, (o_orderdate, o_orderkey)) AS last_status FROM orders GROUP BY o_custkey""",
)
def job_totals(spark, sf):
    """Counters added up over a job's targets, and what the last one left."""
    o = table(spark, sf, "orders").groupBy(c("o_custkey").alias("job"))
    count = lambda s: F.count_if(c("o_orderstatus") == s)
    return o.agg(F.count("*").alias("targets"), count("F").alias("done"), count("P").alias("skipped"), F.sum(F.floor("o_totalprice")).alias("credits"), F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("last_status"))


@register("plan_totals", "SELECT c_mktsegment AS platform, c_nationkey AS area, grouping(c_mktsegment, c_nationkey)::BIGINT AS level, count(*) AS targets FROM customer GROUP BY ROLLUP (c_mktsegment, c_nationkey)")
def plan_totals(spark, sf):
    """By platform and area, by platform, and in all; `level` tells a total from a null key."""
    return table(spark, sf, "customer").rollup(c("c_mktsegment").alias("platform"), c("c_nationkey").alias("area")).agg(F.grouping_id().alias("level"), F.count("*").alias("targets")).select("platform", "area", "level", "targets")


@register(
    "change_counts",
    """WITH a AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) = 1),
 b AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) = 1),
 n AS (SELECT CASE WHEN b.o_custkey IS NULL THEN 'created' ELSE 'updated' END AS action, count(*) AS n FROM a LEFT JOIN b ON a.o_custkey = b.o_custkey WHERE b.o_orderkey IS DISTINCT FROM a.o_orderkey GROUP BY 1)
 SELECT action, n, greatest(n - 500, 0) AS truncated FROM n""",
)
def change_counts(spark, sf):
    """Changes by action, and how many of them are beyond the 500 that are kept."""
    from tallymart.plans.offer_queries import _state

    changed = merge.field_diff(_state(spark, sf, "1998-01-01"), _state(spark, sf, None), "id", ["last_order"])
    n = changed.groupBy("action").agg(F.count("*").alias("n"))
    return n.withColumn("truncated", F.greatest(c("n") - 500, F.lit(0)))


@register("stored_changes", "SELECT o_custkey AS target, o_orderkey AS change FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) <= 5")
def stored_changes(spark, sf):
    """Q10: the first five changes of each target. A limit inside a window is applied before the shuffle as well."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf, "orders").withColumn("at", F.row_number().over(w)).where("at <= 5").select(c("o_custkey").alias("target"), c("o_orderkey").alias("change"))


@register("duplicate_owners", "SELECT p_name AS key, count(*) AS owners, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) AS ids FROM part GROUP BY p_name HAVING count(*) > 1")
def duplicate_owners(spark, sf):
    """Keys that several documents own."""
    g = table(spark, sf, "part").groupBy(c("p_name").alias("key")).agg(F.count("*").alias("owners"), F.array_sort(F.collect_list("p_partkey")).alias("ids")).where("owners > 1")
    return g.select("key", "owners", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


@register(
    "cluster_plan",
    """WITH g AS (SELECT p_name, count(*) AS n, count(DISTINCT p_brand) AS platforms FROM part GROUP BY p_name HAVING count(*) > 1)
 SELECT count(*) AS clusters, sum(n - 1)::BIGINT AS folded, count(*) FILTER (WHERE platforms > 1) AS cross_platform FROM g""",
)
def cluster_plan(spark, sf):
    """Clusters of equal key, the documents they fold away, and clusters over several platforms."""
    g = table(spark, sf, "part").groupBy("p_name").agg(F.count("*").alias("n"), (F.min("p_brand") != F.max("p_brand")).alias("cross")).where("n > 1")
    return g.agg(F.count("*").alias("clusters"), F.sum(c("n") - 1).alias("folded"), F.count_if("cross").alias("cross_platform"))


_FOLD = """WITH o AS (SELECT c_custkey AS id, c_nationkey AS cluster, c_custkey % 4 AS retailer, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS price, c_custkey * 7919 % 365 AS seen FROM customer),
 l AS (SELECT cluster, retailer, list({'id': id, 'price': price, 'seen': seen} ORDER BY id) AS l FROM o GROUP BY ALL)
 SELECT cluster, retailer, r.id AS id, r.price AS price FROM (SELECT cluster, retailer, list_reduce(l, lambda a, x: CASE WHEN (x.price IS NOT NULL AND a.price IS NULL) OR x.seen > a.seen THEN x ELSE a END) AS r FROM l)"""


@register("cluster_retailer_merge", _FOLD)
def cluster_retailer_merge(spark, sf):
    """In order of ids, an offer takes the place of the one so far if it alone has a price, or is newer. No total order gives
    that, so it is a fold over the offers of one retailer in one cluster, which are few."""
    o = table(spark, sf, "customer").select(c("c_nationkey").alias("cluster"), (c("c_custkey") % 4).alias("retailer"), F.struct(c("c_custkey").alias("id"), F.when(c("c_custkey") % 3 != 0, c("c_acctbal")).alias("price"), (c("c_custkey") * 7919 % 365).alias("seen")).alias("x"))
    g = o.groupBy("cluster", "retailer").agg(F.array_sort(F.collect_list("x")).alias("l"))
    takes = lambda a, x: (x["price"].isNotNull() & a["price"].isNull()) | (x["seen"] > a["seen"])
    r = F.aggregate(F.slice("l", 2, F.size("l")), F.get("l", 0), lambda a, x: F.when(takes(a, x), x).otherwise(a))
    return g.select("cluster", "retailer", r.alias("r")).select("cluster", "retailer", "r.id", "r.price")


@register("first_of_equal_ids", "SELECT l_partkey AS id, l_orderkey AS ord, l_linenumber AS line FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey) = 1")
def first_of_equal_ids(spark, sf):
    """The first in document order, as one minimum that is combined before the shuffle."""
    first = F.min(F.struct("l_orderkey", "l_linenumber", "l_suppkey")).alias("f")
    return table(spark, sf, "lineitem").groupBy(c("l_partkey").alias("id")).agg(first).select("id", c("f.l_orderkey").alias("ord"), c("f.l_linenumber").alias("line"))


@register("position_in_category", "SELECT p_partkey AS id, p_type AS category, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) - 1 AS position FROM part")
def position_in_category(spark, sf):
    """W5."""
    w = Window.partitionBy("p_type").orderBy("p_partkey")
    return table(spark, sf, "part").select(c("p_partkey").alias("id"), c("p_type").alias("category"), (F.row_number().over(w) - 1).cast("long").alias("position"))


@register("longest_names", "SELECT p_brand AS bundle, p_name AS name FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name) DESC, p_partkey) = 1")
def longest_names(spark, sf):
    """The longest name, the first of equal length."""
    best = F.min(F.struct((-F.length("p_name")).alias("n"), "p_partkey", "p_name")).alias("b")
    return table(spark, sf, "part").groupBy(c("p_brand").alias("bundle")).agg(best).select("bundle", c("b.p_name").alias("name"))


@register("first_seen_targets", "SELECT url, first FROM (SELECT user_id || '/' || event_type AS url, min(event_id) AS first FROM events GROUP BY 1) ORDER BY first LIMIT 200")
def first_seen_targets(spark, sf):
    """Addresses in the order they were first seen, up to the cap of a plan."""
    e = table(spark, sf, "events").groupBy(F.concat_ws("/", "user_id", "event_type").alias("url")).agg(F.min("event_id").alias("first"))
    return e.orderBy("first").limit(200)


_RANGE = f"WITH {OFFERS_SQL}, g AS (SELECT product_id, count(DISTINCT retailer_id) AS retailers, min(CASE WHEN in_stock THEN price END) AS lowest FROM offers GROUP BY product_id) "


@register("bundles_ranked", _RANGE + "SELECT product_id, retailers, lowest FROM g ORDER BY retailers DESC, lowest ASC NULLS LAST, product_id LIMIT 100")
def bundles_ranked(spark, sf):
    """O1: most retailers first, then the lowest price, those without one last."""
    o = offers(spark, sf).groupBy("product_id", "retailer_id").agg(F.min(F.when(c("in_stock"), c("price"))).alias("p"))
    g = o.groupBy("product_id").agg(F.count("*").alias("retailers"), F.min("p").alias("lowest"))
    return g.orderBy(F.desc("retailers"), F.asc_nulls_last("lowest"), "product_id").limit(100)


@register("due_job", "SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'F' ORDER BY o_orderstatus = 'P' DESC, o_orderdate, o_orderkey LIMIT 1")
def due_job(spark, sf):
    """Interrupted jobs first, then the most overdue; one is taken."""
    o = table(spark, sf, "orders").where("o_orderstatus <> 'F'")
    return o.orderBy(F.desc(c("o_orderstatus") == "P"), "o_orderdate", "o_orderkey").limit(1).select(c("o_orderkey").alias("id"))


@register("refresh_targets", "SELECT l_partkey AS id, min(l_shipdate) AS seen FROM lineitem GROUP BY l_partkey ORDER BY seen, id LIMIT 100")
def refresh_targets(spark, sf):
    """The hundred seen longest ago."""
    return table(spark, sf, "lineitem").groupBy(c("l_partkey").alias("id")).agg(F.min("l_shipdate").alias("seen")).orderBy("seen", "id").limit(100)


@register("queue_claim", "SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 1")
def queue_claim(spark, sf):
    """O7."""
    return table(spark, sf, "orders").where("o_orderstatus = 'O'").orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey").limit(1).select(c("o_orderkey").alias("id"))


@register("popularity_order", "SELECT p_partkey AS id, p_size * 10 + p_retailprice AS popularity FROM part ORDER BY popularity DESC, id LIMIT 50")
def popularity_order(spark, sf):
    """O8."""
    p = table(spark, sf, "part").select(c("p_partkey").alias("id"), (c("p_size") * 10 + c("p_retailprice")).alias("popularity"))
    return p.orderBy(F.desc("popularity"), "id").limit(50)


@register("capped_reads", "WITH r AS (SELECT p_type AS clause, p_partkey AS id, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS place, count(*) OVER (PARTITION BY p_type) AS n FROM part) SELECT clause, id, n > 200 AS capped FROM r WHERE place <= 200")
def capped_reads(spark, sf):
    """At most 200 candidates of a clause, the smallest ids, and whether there were more."""
    p, w = table(spark, sf, "part").select(c("p_type").alias("clause"), c("p_partkey").alias("id")), Window.partitionBy("clause").orderBy("id")
    first = p.withColumn("at", F.row_number().over(w)).where("at <= 200").drop("at")
    return first.join(p.groupBy("clause").agg((F.count("*") > 200).alias("capped")), "clause")


@register("recent_runs", "SELECT o_orderkey AS id, o_orderdate AS at FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20")
def recent_runs(spark, sf):
    """O10."""
    return table(spark, sf, "orders").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(20).select(c("o_orderkey").alias("id"), c("o_orderdate").alias("at"))


@register(
    "tag_union",
    "SELECT p_partkey AS id, array_to_string(list_filter(list_concat(string_split(p_name, ' '), string_split(lower(p_type), ' ')), lambda x, i: list_position(list_concat(string_split(p_name, ' '), string_split(lower(p_type), ' ')), x) = i), ' ') AS tags FROM part",
)
def tag_union(spark, sf):
    """Stored tags, then new ones that are not among them."""
    return table(spark, sf, "part").select(c("p_partkey").alias("id"), F.array_join(F.array_union(F.split("p_name", " "), F.split(F.lower("p_type"), " ")), " ").alias("tags"))


_MENUS = "menu AS (SELECT DISTINCT l_suppkey AS id, l_partkey % 40 AS dish FROM lineitem)"


@register(
    "menu_overlap",
    f"""WITH {_MENUS}, n AS (SELECT id, count(*) AS n FROM menu GROUP BY id), p AS (SELECT a.id AS id1, b.id AS id2, count(*) AS shared FROM menu a JOIN menu b ON a.dish = b.dish AND b.id = a.id + 1 GROUP BY ALL)
 SELECT id1, id2, shared, shared / least(x.n, y.n)::DOUBLE >= 0.8 AS same FROM p JOIN n x ON x.id = id1 JOIN n y ON y.id = id2""",
)
def menu_overlap(spark, sf):
    """The share of the smaller of two menus that the other has, for neighbouring listings."""
    menu = table(spark, sf, "lineitem").select(c("l_suppkey").alias("id"), (c("l_partkey") % 40).alias("dish")).distinct()
    n = menu.groupBy("id").agg(F.count("*").alias("n"))
    both = menu.select(c("id").alias("id1"), "dish").join(menu.select((c("id") - 1).alias("id1"), "dish"), ["id1", "dish"]).groupBy("id1").agg(F.count("*").alias("shared"))
    j = both.withColumn("id2", c("id1") + 1).join(n.select(c("id").alias("id1"), c("n").alias("n1")), "id1").join(n.select(c("id").alias("id2"), c("n").alias("n2")), "id2")
    return j.select("id1", "id2", "shared", (c("shared") / F.least("n1", "n2") >= 0.8).alias("same"))


@register("pending_jobs", "SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F') AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def pending_jobs(spark, sf):
    """All that are neither done nor failed."""
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linestatus", "l_returnflag")
    out = table(spark, sf, "orders").select(c("o_orderkey").alias("id"))
    for gone in ("l_linestatus = 'F'", "l_returnflag = 'R'"):
        out = out.join(line.where(gone).select(c("l_orderkey").alias("id")), "id", "left_anti")
    return out


@register("union_then_first", "WITH u AS (SELECT 0 AS b, l_partkey AS id, l_suppkey AS s FROM lineitem WHERE l_linenumber = 1 UNION ALL SELECT 1, l_partkey, l_suppkey FROM lineitem WHERE l_linenumber = 2) SELECT id, min(b) AS batch, count(*) AS seen FROM u GROUP BY id")
def union_then_first(spark, sf):
    """Two batches one after the other; the first that has a key keeps it."""
    line = table(spark, sf, "lineitem").where("l_linenumber IN (1, 2)")
    return line.groupBy(c("l_partkey").alias("id")).agg(F.min(c("l_linenumber") - 1).alias("batch"), F.count("*").alias("seen"))


@register("group_signals", "SELECT s_nationkey AS grp, string_agg(DISTINCT left(s_name, 8), ',' ORDER BY left(s_name, 8)) AS names, count(DISTINCT s_suppkey % 7) AS brands FROM supplier GROUP BY s_nationkey")
def group_signals(spark, sf):
    """Distinct signals of a group's members."""
    g = table(spark, sf, "supplier").groupBy(c("s_nationkey").alias("grp")).agg(F.array_sort(F.collect_set(F.substring("s_name", 1, 8))).alias("n"), F.count_distinct(c("s_suppkey") % 7).alias("brands"))
    return g.select("grp", F.array_join("n", ",").alias("names"), "brands")


@register("supported_split", "SELECT c_mktsegment AS site, c_mktsegment IN ('BUILDING', 'MACHINERY') AS supported, count(*) AS n FROM customer GROUP BY ALL")
def supported_split(spark, sf):
    """U7."""
    return table(spark, sf, "customer").groupBy(c("c_mktsegment").alias("site"), c("c_mktsegment").isin("BUILDING", "MACHINERY").alias("supported")).agg(F.count("*").alias("n"))


@register("unmapped_items", "SELECT p_type AS menu, count(*) AS unmapped FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 45) GROUP BY p_type")
def unmapped_items(spark, sf):
    """J11."""
    mapped = table(spark, sf, "lineitem").where("l_returnflag = 'A' AND l_quantity > 45").select(c("l_partkey").alias("p_partkey"))
    return table(spark, sf, "part").join(mapped, "p_partkey", "left_anti").groupBy(c("p_type").alias("menu")).agg(F.count("*").alias("unmapped"))


@register("singletons", "WITH g AS (SELECT s_suppkey // 3 AS grp, min(s_suppkey) AS id, min(s_nationkey) AS platform, count(*) AS n FROM supplier WHERE s_suppkey % 7 < 4 GROUP BY 1) SELECT grp, id FROM g WHERE n = 1 AND platform < 12")
def singletons(spark, sf):
    """Groups of one member, on one platform. One aggregation: the only member is its minimum."""
    s = table(spark, sf, "supplier").where("s_suppkey % 7 < 4").groupBy(F.floor(c("s_suppkey") / 3).alias("grp"))
    return s.agg(F.min("s_suppkey").alias("id"), F.min("s_nationkey").alias("platform"), F.count("*").alias("n")).where("n = 1 AND platform < 12").select("grp", "id")


@register(
    "last_run_address",
    """WITH l AS (SELECT o_custkey, max_by(o_orderpriority, (o_orderdate, o_orderkey)) AS p, max_by(o_orderstatus, (o_orderdate, o_orderkey)) AS s FROM orders GROUP BY o_custkey)
 SELECT c_custkey AS id, CASE WHEN s = 'F' THEN p ELSE c_mktsegment END AS address, s IS NOT DISTINCT FROM 'F' AS from_run FROM customer LEFT JOIN l ON c_custkey = o_custkey""",
)
def last_run_address(spark, sf):
    """What the last run used if that run passes the guard, else what is stored."""
    at = F.struct("o_orderdate", "o_orderkey")
    last = table(spark, sf, "orders").groupBy("o_custkey").agg(F.max_by("o_orderpriority", at).alias("p"), F.max_by("o_orderstatus", at).alias("s"))
    j = table(spark, sf, "customer").join(last, c("c_custkey") == c("o_custkey"), "left")
    return j.select(c("c_custkey").alias("id"), F.when(c("s") == "F", c("p")).otherwise(c("c_mktsegment")).alias("address"), c("s").eqNullSafe("F").alias("from_run"))


@register(
    "stored_product_check",
    """WITH s AS (SELECT l_partkey AS id, min(l_extendedprice / l_quantity) AS low, count(*) AS n FROM lineitem WHERE l_returnflag = 'N' GROUP BY l_partkey)
 SELECT p_partkey AS id, array_to_string(list_filter([CASE WHEN n IS NULL THEN 'NOT_STORED' END, CASE WHEN low > p_retailprice * 2 THEN 'PRICE_DIFFERS' END, CASE WHEN p_size < 5 THEN 'NO_IMAGE' END], lambda x: x IS NOT NULL), ',') AS problems FROM part LEFT JOIN s ON id = p_partkey""",
)
def stored_product_check(spark, sf):
    """What is wrong with a product as it is stored."""
    s = table(spark, sf, "lineitem").where("l_returnflag = 'N'").groupBy("l_partkey").agg(F.min(c("l_extendedprice") / c("l_quantity")).alias("low"), F.count("*").alias("n"))
    j = table(spark, sf, "part").join(s, c("p_partkey") == c("l_partkey"), "left")
    problems = F.array_compact(F.array(F.when(c("n").isNull(), "NOT_STORED"), F.when(c("low") > c("p_retailprice") * 2, "PRICE_DIFFERS"), F.when(c("p_size") < 5, "NO_IMAGE")))
    return j.select(c("p_partkey").alias("id"), F.array_join(problems, ",").alias("problems"))


@register(
    "benchmark_agreement",
    """WITH b AS (SELECT l_partkey AS id, min(l_discount) FILTER (WHERE l_linenumber = 1) AS x, min(l_discount) FILTER (WHERE l_linenumber = 2) AS y FROM lineitem GROUP BY l_partkey)
 SELECT count(*) AS pairs, count(*) FILTER (WHERE abs(x - y) < 0.005) AS agree FROM b WHERE x IS NOT NULL AND y IS NOT NULL""",
)
def benchmark_agreement(spark, sf):
    """Pairs measured before and after, and how many agree."""
    at = lambda i: F.min(F.when(c("l_linenumber") == i, c("l_discount")))
    b = table(spark, sf, "lineitem").where("l_linenumber IN (1, 2)").groupBy("l_partkey").agg(at(1).alias("x"), at(2).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    return b.agg(F.count("*").alias("pairs"), F.count_if(F.abs(c("x") - c("y")) < 0.005).alias("agree"))


@register(
    "target_plan",
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN 'UNSUPPORTED' WHEN o_totalprice < 20000 THEN 'TOO_SMALL' WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'FRESH'
 WHEN row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) > 1 THEN 'DUPLICATE' END AS skip FROM orders""",
)
def target_plan(spark, sf):
    """Q14: the first check that a target fails names why it is left out."""
    w = Window.partitionBy("o_custkey", "o_orderpriority").orderBy("o_orderdate", "o_orderkey")
    skip = F.when(c("o_orderstatus") == "P", "UNSUPPORTED").when(c("o_totalprice") < 20000, "TOO_SMALL").when(c("o_orderdate") >= F.lit("1998-01-01").cast("timestamp"), "FRESH").when(F.row_number().over(w) > 1, "DUPLICATE")
    return table(spark, sf, "orders").select(c("o_orderkey").alias("id"), skip.alias("skip"))


@register("fresh_and_due", "SELECT o_orderkey AS id, o_orderdate > TIMESTAMP '1998-06-01' - INTERVAL 30 DAY AND o_orderdate <= TIMESTAMP '1998-06-01' AS fresh, o_orderdate <= TIMESTAMP '1998-06-01' - INTERVAL 30 DAY AS due FROM orders")
def fresh_and_due(spark, sf):
    """Seen within the window up to now; seen before it. What claims to come from the future is neither."""
    now, edge = F.lit("1998-06-01").cast("timestamp"), F.lit("1998-06-01").cast("timestamp") - F.expr("INTERVAL 30 DAYS")
    return table(spark, sf, "orders").select(c("o_orderkey").alias("id"), ((c("o_orderdate") > edge) & (c("o_orderdate") <= now)).alias("fresh"), (c("o_orderdate") <= edge).alias("due"))


@register("error_log", "SELECT left(sha1(user_id || '|' || event_type || '|' || CAST(CAST(ts AS DATE) AS VARCHAR)), 16) AS error_key, max(event_id) AS last, count(*) AS seen FROM events WHERE event_type = 'error' GROUP BY 1")
def error_log(spark, sf):
    """Errors by a key that a repeated report has again; the last one stays."""
    key = F.substring(F.sha1(F.concat_ws("|", "user_id", "event_type", c("ts").cast("date").cast("string"))), 1, 16)
    return table(spark, sf, "events").where("event_type = 'error'").groupBy(key.alias("error_key")).agg(F.max("event_id").alias("last"), F.count("*").alias("seen"))


@register("retained_events", "SELECT event_type, count(*) AS n FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 3 DAY GROUP BY event_type")
def retained_events(spark, sf):
    """What a retention of three days before the newest row leaves."""
    e = table(spark, sf, "events")
    newest = F.broadcast(e.agg(F.max("ts").alias("newest")))  # one row
    return e.join(newest, e["ts"] >= newest["newest"] - F.expr("INTERVAL 3 DAYS")).groupBy("event_type").agg(F.count("*").alias("n"))


@register("vector_rows", "SELECT p_partkey AS id, left(sha256(lower(trim(p_name))), 24) AS vector_id, coalesce(CASE WHEN p_size > 10 THEN p_retailprice END, -1.0) AS price, replace(p_name, ' ', ',') AS tags FROM part")
def vector_rows(spark, sf):
    """Id and flat metadata of a product's vector; a missing price is -1."""
    p = table(spark, sf, "part")
    return p.select(c("p_partkey").alias("id"), F.substring(F.sha2(F.lower(F.trim("p_name")), 256), 1, 24).alias("vector_id"), F.coalesce(F.when(c("p_size") > 10, c("p_retailprice")), F.lit(-1.0)).alias("price"), F.replace("p_name", F.lit(" "), F.lit(",")).alias("tags"))


@register(
    "promotable_groups",
    "WITH m AS (SELECT o_custkey AS grp, o_orderkey AS id, o_orderkey % 11 = 0 AS known FROM orders) SELECT id, grp FROM m QUALIFY NOT bool_or(known) OVER (PARTITION BY grp)",
)
def promotable_groups(spark, sf):
    """K7: members of groups none of which the target has yet."""
    o = table(spark, sf, "orders").select(c("o_orderkey").alias("id"), c("o_custkey").alias("grp"))
    return o.join(o.where("id % 11 = 0").select("grp"), "grp", "left_anti").select("id", "grp")


@register(
    "log_levels",
    r"""SELECT CASE WHEN regexp_matches(text, '(?i)\b(error|failed|fatal)\b') THEN 'error' WHEN regexp_matches(text, '(?i)\bwarn') THEN 'warn' ELSE 'info' END AS level, count(*) AS n FROM conversations GROUP BY 1""",
)
def log_levels(spark, sf):
    """K8: lines by the first level whose words they hold."""
    level = F.when(c("text").rlike("(?i)\\b(error|failed|fatal)\\b"), "error").when(c("text").rlike("(?i)\\bwarn"), "warn").otherwise("info")
    return table(spark, sf, "conversations").groupBy(level.alias("level")).agg(F.count("*").alias("n"))


@register("element_matches", "SELECT l_orderkey AS ord FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45 GROUP BY l_orderkey")
def element_matches(spark, sf):
    """Documents one element of which meets all conditions, as a test on the array of their elements."""
    o = table(spark, sf, "lineitem").groupBy(c("l_orderkey").alias("ord")).agg(F.collect_list(F.struct("l_returnflag", "l_quantity")).alias("lines"))  # an order's lines are few
    return o.where(F.exists("lines", lambda x: (x["l_returnflag"] == "R") & (x["l_quantity"] > 45))).select("ord")


@register("job_ids", "SELECT o_orderkey AS id, left(md5(o_orderpriority || ':' || o_orderstatus), 12) AS job_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS utc_day, least(1000 * pow(2, o_orderkey % 12), 60000)::BIGINT AS backoff FROM orders")
def job_ids(spark, sf):
    """Ids of jobs, their UTC day, and the wait before the n-th try, doubled up to a minute."""
    o = table(spark, sf, "orders")
    return o.select(c("o_orderkey").alias("id"), F.substring(F.md5(F.concat_ws(":", "o_orderpriority", "o_orderstatus")), 1, 12).alias("job_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("utc_day"), F.least(1000 * F.pow(F.lit(2), c("o_orderkey") % 12), F.lit(60000)).cast("long").alias("backoff"))


@register("credit_estimates", "SELECT CASE WHEN o_orderstatus = 'F' AND o_totalprice > 150000 THEN 25 WHEN o_orderstatus = 'F' THEN 10 WHEN o_totalprice > 150000 THEN 5 ELSE 1 END AS credits, count(*) AS n FROM orders GROUP BY 1")
def credit_estimates(spark, sf):
    """What a request costs, by premium address and rendering."""
    premium, rendered = c("o_orderstatus") == "F", c("o_totalprice") > 150000
    return table(spark, sf, "orders").groupBy(F.when(premium & rendered, 25).when(premium, 10).when(rendered, 5).otherwise(1).alias("credits")).agg(F.count("*").alias("n"))


@register(
    "valid_prices",
    "SELECT c_custkey AS id, CASE WHEN c_custkey % 9 = 0 THEN 'MISSING' WHEN c_acctbal <= 0 THEN 'INVALID' ELSE 'OK' END AS price_state, CASE WHEN c_custkey % 9 <> 0 AND c_acctbal > 0 THEN c_acctbal END AS price, upper(left(c_mktsegment, 3)) AS currency FROM customer",
)
def valid_prices(spark, sf):
    """A price that is there and positive; a currency of three capitals."""
    p = F.when(c("c_custkey") % 9 != 0, c("c_acctbal"))
    state = F.when(p.isNull(), "MISSING").when(p <= 0, "INVALID").otherwise("OK")
    return table(spark, sf, "customer").select(c("c_custkey").alias("id"), state.alias("price_state"), F.when(p > 0, p).alias("price"), F.upper(F.substring("c_mktsegment", 1, 3)).alias("currency"))


@register(
    "valid_pins",
    """WITH p AS (SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN 0.0 WHEN 1 THEN 95.0 ELSE 24.5 END AS lat, CASE c_custkey % 5 WHEN 0 THEN 0.0 WHEN 2 THEN -181.0 ELSE 54.5 END AS lng FROM customer)
 SELECT id, abs(lat) <= 90 AND abs(lng) <= 180 AND NOT (lat = 0 AND lng = 0) AS valid FROM p""",
)
def valid_pins(spark, sf):
    """T36."""
    from tallymart.functions.geo import valid

    k = c("c_custkey") % 5
    lat, lng = F.when(k == 0, 0.0).when(k == 1, 95.0).otherwise(24.5), F.when(k == 0, 0.0).when(k == 2, -181.0).otherwise(54.5)
    return table(spark, sf, "customer").select(c("c_custkey").alias("id"), valid(lat, lng).alias("valid"))
