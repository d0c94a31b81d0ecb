"""Queries on bundling and upkeep: listings dealt to parts, clusters of parts, texts of a locale, modifiers, branches, jobs, requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.operators import bundles, upkeep
from tallymart.plans.catalog import register
from tallymart.plans.menu_queries import _column, _dealt, _expected, _literal
from tallymart.sources.tables import table

c = F.col

#: seq, retailer, external_id, name, price, available, images, description, rating, review_count; bundle, reason, similarity, candidate
BUNDLED = [
    (1, "A", "a1", "Apple iPhone 15 128GB Black", 3000.0, True, 1, "", 4.0, None, 1, None, None, None),
    (2, "B", "b1", "Apple iPhone 15 128GB", 2900.0, True, 3, "fine", 4.5, 10, 1, None, None, None),
    (3, "A", "a1", "Apple iPhone 15 128GB Black", 3000.0, True, 9, "x", 1.0, 99, None, None, None, None),
    (4, "B", "b2", "Apple iPhone 15 256GB Black", 3500.0, True, 0, None, None, None, 4, None, None, None),
    (5, "C", "c1", "Apple iPhone 15 128GB Black Dual SIM", 7000.0, None, 2, None, 3.0, None, 5, "price_ratio", 0.71, 1),
    (6, "C", None, "Spigen Case for iPhone 15 128GB Black", 50.0, True, 1, None, None, None, 6, None, None, None),
    (7, "D", "d1", "Samsung Galaxy S24 Black", 3000.0, True, 1, None, None, None, 7, None, None, None),
    (8, "C", None, "Galaxy S24 Ultra Black Titanium", 4000.0, True, 1, None, None, None, 8, "variant_mismatch", 0.5, 7),
    (9, "E", None, "Galaxy S24 phone", None, True, 1, None, None, None, 9, "low_similarity", 0.4, 7),
    (10, "E", None, "", 10.0, True, 1, None, None, None, None, None, None, None),
    (11, "D", "d2", "Apple iPhone 15 128GB", 2950.0, False, 3, "late", 5.0, 10, 1, None, None, None),
    (12, "F", "a1", "Galaxy S24 Black by Samsung", 2000.0, True, 1, "s", None, 0, 7, None, None, None),
]
_VALUES = "(VALUES " + ", ".join("(" + ", ".join(str(v) if isinstance(v, int) and not isinstance(v, bool) else _literal(v) for v in (r[0], *r[10:])) + ")" for r in BUNDLED if r[3]) + ") v(seq, bundle, reason, similarity, candidate)"


def _listings(spark, sf):
    """The listings above, once for each part as the query."""
    schema = "seq long, retailer string, external_id string, name string, price double, available boolean, n int, description string, rating double, review_count long"
    rows = spark.createDataFrame([r[:10] for r in BUNDLED], schema).withColumn("images", F.transform(F.slice(F.sequence(F.lit(0), "n"), 2, 99), lambda i: F.concat("retailer", i.cast("string")))).drop("n")
    one = rows.agg(F.collect_list(F.struct("*")).alias("rows"))  # the rows above
    return table(spark, sf, "part").select(c("p_partkey").cast("string").alias("query")).join(F.broadcast(one)).select("query", F.inline("rows"))


@register("bundle_places", f"SELECT p_partkey::VARCHAR AS query, seq, bundle, reason, similarity, candidate FROM part, {_VALUES}")
def bundle_places(spark, sf):
    """The listings of each query in order."""
    return bundles.placed(_listings(spark, sf))


#: bundle, name, images, description, lowest, highest, retailers, rating, reviews
PRODUCTS = [
    (1, "Apple iPhone 15 128GB Black", "B1 B2 B3", "fine", 2900.0, 3000.0, 3, 4.5, 10), (4, "Apple iPhone 15 256GB Black", "", None, 3500.0, 3500.0, 1, None, None),
    (5, "Apple iPhone 15 128GB Black Dual SIM", "C1 C2", None, 7000.0, 7000.0, 1, 3.0, None), (6, "Spigen Case for iPhone 15 128GB Black", "C1", None, 50.0, 50.0, 1, None, None),
    (7, "Galaxy S24 Black by Samsung", "D1", "s", 2000.0, 3000.0, 2, None, 0), (8, "Galaxy S24 Ultra Black Titanium", "C1", None, 4000.0, 4000.0, 1, None, None), (9, "Galaxy S24 phone", "E1", None, None, None, 1, None, None),
]
_PRODUCTS = "(VALUES " + ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else _literal(v) for v in r) + ")" for r in PRODUCTS) + ") v(bundle, name, images, description, lowest_price, highest_price, retailer_count, rating, review_count)"


@register("bundled_products", f"SELECT p_partkey::VARCHAR AS query, v.* FROM part, {_PRODUCTS}")
def bundled_products(spark, sf):
    """E1, A12."""
    items = _listings(spark, sf)
    return bundles.bundled(items, bundles.placed(items)).withColumn("images", F.array_join("images", " "))


def _documents(spark, sf):
    k = c("p_partkey")
    texts = lambda *v: F.array(*v).cast("array<string>")
    return table(spark, sf, "part").select(
        k.alias("id"), F.when(k % 6 != 0, F.concat(F.lit("k"), k % 97)).alias("match_key"), F.when(k % 5 != 0, k % 40).alias("created_at"), F.when(k % 4 != 0, texts(F.concat(F.lit("i"), k))).otherwise(texts()).alias("images"),
        texts(c("p_brand"), F.concat(F.lit("t"), k % 3)).alias("tags"), F.when(k % 3 != 0, k % 50 / 10).alias("rating"), F.when(k % 8 == 0, k).alias("review_count"),
    )


_CLUSTERS = """d AS (SELECT p_partkey AS id, 'k' || p_partkey % 97 AS key, p_partkey AS k, p_brand, row_number() OVER (PARTITION BY p_partkey % 97 ORDER BY CASE WHEN p_partkey % 5 <> 0 THEN p_partkey % 40 END NULLS LAST, p_partkey) AS n, count(*) OVER (PARTITION BY p_partkey % 97) AS size FROM part WHERE p_partkey % 6 <> 0),
 t AS (SELECT key, tag, min(place) AS place FROM (SELECT key, p_brand AS tag, n * 2 AS place FROM d UNION ALL SELECT key, 't' || k % 3, n * 2 + 1 FROM d) GROUP BY ALL)"""


@register(
    "cluster_survivors",
    f"""WITH {_CLUSTERS} SELECT arg_min(id, n) AS id, d.key AS match_key, coalesce('i' || arg_min(id, n) FILTER (WHERE k % 4 <> 0), '') AS images, any_value(x.tags) AS tags, arg_min(k % 50 / 10, n) FILTER (WHERE k % 3 <> 0) AS rating, arg_min(k, n) FILTER (WHERE k % 8 = 0) AS review_count
 FROM d JOIN (SELECT key, string_agg(tag, ' ' ORDER BY place) AS tags FROM t GROUP BY key) x ON x.key = d.key WHERE size > 1 GROUP BY d.key""",
)
def cluster_survivors(spark, sf):
    """E3, M20."""
    return upkeep.cluster_merge(_documents(spark, sf))[0].withColumns({n: F.array_join(n, " ") for n in ("images", "tags")})


@register("cluster_backup", f"WITH {_CLUSTERS} SELECT id, key AS match_key FROM d WHERE n > 1")
def cluster_backup(spark, sf):
    """The rows that go."""
    return upkeep.cluster_merge(_documents(spark, sf))[1].select("id", "match_key")


@register(
    "localized_writes",
    """SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN 'old' END AS ar, CASE WHEN p_partkey % 7 <> 0 THEN CASE WHEN p_partkey % 3 <> 0 THEN p_name WHEN p_partkey % 5 = 0 THEN 'was' END END AS en, p_partkey % 2 <> 0 AND (p_partkey % 7 = 0 OR (p_partkey % 3 = 0 AND p_partkey % 5 <> 0)) AS gone FROM part""",
)
def localized_writes(spark, sf):
    """M8: English texts written over stored ones; each seventh is cleared."""
    k = c("p_partkey")
    text = lambda en, ar: F.struct(en.alias("en"), ar.alias("ar"))
    stored = text(F.when(k % 5 == 0, "was"), F.when(k % 2 == 0, "old"))
    new = text(F.when(k % 3 != 0, c("p_name")), F.lit("not now"))
    p = table(spark, sf, "part").select(k.alias("id"), upkeep.set_locale(stored, new, "en", k % 7 == 0).alias("t"))
    return p.select("id", "t.en", "t.ar", c("t").isNull().alias("gone"))


@register(
    "merged_modifiers",
    """SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 'g1[Size/] o1[Small ' || p_size || '/] -[Extra/]; -[Milk/] -[Oat/]' ELSE 'g1[Size/الحجم] o1[Small ' || p_size || '/صغير] -[Extra/]; -[Milk/حليب] -[Oat/شوفان]' END AS groups FROM part""",
)
def merged_modifiers(spark, sf):
    """An English menu over a stored Arabic one; by id, and by place where there are no ids. Each third part has nothing stored."""
    text = lambda en=None, ar=None: F.struct((en if en is not None else F.lit(None).cast("string")).alias("en"), F.lit(ar).cast("string").alias("ar"))
    none = F.struct(F.lit(None).cast("string").alias("en"), F.lit(None).cast("string").alias("ar"))
    option = lambda id, name: F.struct(F.lit(id).cast("string").alias("id"), name.alias("name"), none.alias("description"))
    group = lambda id, name, *options: F.struct(F.lit(id).cast("string").alias("id"), name.alias("name"), none.alias("description"), F.array(*options).alias("options"))
    stored = F.array(group("g1", text(F.lit("Was"), "الحجم"), option("o9", text(None, "كبير")), option("o1", text(None, "صغير"))), group(None, text(None, "حليب"), option(None, text(None, "شوفان"))))
    new = F.array(group("g1", text(F.lit("Size")), option("o1", text(F.concat(F.lit("Small "), c("p_size")))), option(None, text(F.lit("Extra")))), group(None, text(F.lit("Milk")), option(None, text(F.lit("Oat")))))
    shown = lambda v: F.concat(F.coalesce(v["id"], F.lit("-")), F.lit("["), F.coalesce(v["name"]["en"], F.lit("")), F.lit("/"), F.coalesce(v["name"]["ar"], F.lit("")), F.lit("]"))
    p = table(spark, sf, "part").withColumns({"stored": F.when(c("p_partkey") % 3 != 0, stored), "new": new})
    groups = F.transform(upkeep.merged_modifiers(c("stored"), c("new"), "en"), lambda g: F.concat(shown(g), F.lit(" "), F.array_join(F.transform(g["options"], shown), " ")))
    return p.select(c("p_partkey").alias("id"), F.array_join(groups, "; ").alias("groups"))


@register(
    "nearby_branches",
    """SELECT c_custkey AS source, s_suppkey AS card, s_suppkey % 7 AS place FROM customer JOIN supplier ON c_nationkey = s_nationkey AND c_custkey % 5 = s_suppkey % 5 WHERE c_custkey % 5 <> 0 QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY s_suppkey % 7, s_suppkey) <= 2""",
)
def nearby_branches(spark, sf):
    """J15 with nations as cells; two branches a source."""
    at = lambda n, more: F.concat(F.lit("thrr"), F.lpad(n.cast("string"), 3, "0"), F.lit(more))
    brand = lambda k: F.when(k % 5 != 0, (k % 5).cast("string")).otherwise("")
    sources = table(spark, sf, "customer").select(c("c_custkey").alias("source"), at(c("c_nationkey"), "9q").alias("geohash"), brand(c("c_custkey")).alias("brand"))
    cards = table(spark, sf, "supplier").select(c("s_suppkey").alias("card"), at(c("s_nationkey"), "2").alias("geohash"), brand(c("s_suppkey")).alias("brand"), (c("s_suppkey") % 7).alias("place"))
    return upkeep.nearby_branches(sources, cards, most=2)


@register(
    "next_runs",
    """SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN o_orderdate + INTERVAL 1 HOUR WHEN 1 THEN o_orderdate + INTERVAL 1 HOUR WHEN 2 THEN date_trunc('day', o_orderdate) + INTERVAL 1 DAY + INTERVAL 1 MINUTE WHEN 3 THEN o_orderdate
 WHEN 4 THEN CASE WHEN o_custkey % 9 >= 8 THEN o_orderdate + INTERVAL 1 HOUR ELSE o_orderdate + to_seconds(least(3600, 60 * (2 ** greatest(o_custkey % 9 - 1, 0)))::BIGINT) END END::TIMESTAMP AS next_run FROM orders""",
)
def next_runs(spark, sf):
    """R5."""
    k = c("o_orderkey")
    outcome = F.element_at(F.array(*map(F.lit, ["complete", "partial", "budget_exhausted", "interrupted", "failed", "unknown"])), (k % 6 + 1).cast("int"))
    at = upkeep.next_run(c("o_orderdate").cast("timestamp"), outcome, c("o_custkey") % 9, F.lit(3600), 60, 8)
    return table(spark, sf, "orders").select(k.alias("id"), at.cast("timestamp_ntz").alias("next_run"))


@register(
    "recovered_jobs",
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'interrupted' ELSE 'idle' END AS status, CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '2000-01-01' ELSE TIMESTAMP '1999-01-01' END AS next_run, c_custkey % 4 AS attempts FROM customer WHERE c_custkey % 2 = 0
 UNION ALL SELECT c_custkey, 'idle', TIMESTAMP '2000-01-01', 0 FROM customer WHERE c_custkey % 2 <> 0""",
)
def recovered_jobs(spark, sf):
    """R5."""
    k = c("c_custkey")
    wanted = table(spark, sf, "customer").select(k.alias("id"))
    at = lambda t: F.lit(t).cast("timestamp")
    jobs = table(spark, sf, "customer").where(k % 2 == 0).select(k.alias("id"), F.when(k % 3 == 0, "running").otherwise("idle").alias("status"), at("1999-01-01").alias("next_run"), (k % 4).alias("attempts"))
    return upkeep.recovered_jobs(jobs, wanted, at("2000-01-01")).withColumn("next_run", c("next_run").cast("timestamp_ntz"))


#: query, locale, group, platforms, limit, issues
REQUESTS = [
    ("dosa", None, None, None, None, ""), ("dosa", "ar", "0123456789abcdef01234567", "talabat,deliveroo", "50", ""), (None, "fr", "12", "", "0", "query is required,locale is not supported,group is no id,platform is not supported,limit is out of range"),
    ("  ", "en", None, "talabat,x", "51", "query is required,platform is not supported,limit is out of range"), ("!?", None, None, None, "1", "query needs letters or digits"), ("x" * 101, None, None, None, None, "query is too long"), ("كباب", None, None, None, None, ""),
]


@register("request_issues", _expected(issues=_column(REQUESTS, 5)))
def request_issues(spark, sf):
    """P15."""
    r = _dealt(spark, sf, *[(n, _column(REQUESTS, i)) for i, n in enumerate(("query", "locale", "grp", "platforms", "most"))])
    return r.select("id", F.array_join(upkeep.request_issues(c("query"), c("locale"), c("grp"), F.split("platforms", ","), c("most").cast("int")), ",").alias("issues"))
