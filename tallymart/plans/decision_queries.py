"""Queries on decisions: suppliers stand for restaurants, parts for canonical items, orders and line items for mappings and requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.operators import decisions
from tallymart.plans.catalog import register
from tallymart.sources.tables import table

c = F.col


def _mappings(spark, sf):
    """Customers as restaurants, in groups of about three; each seventh mapping is inactive, each fifth in review, each eleventh made by hand."""
    k = c("c_custkey")
    return table(spark, sf, "customer").select(
        k.alias("restaurant"), F.concat(F.lit("p"), k % 2).alias("platform"), F.when(k % 13 != 0, F.floor(k / 3)).alias("group_id"),
        F.when(k % 13 == 0, "UNMATCHED").when(k % 5 == 0, "REVIEW").otherwise("MATCHED").alias("status"), F.when(k % 11 == 0, "manual").otherwise("auto").alias("decided_by"), (k % 7 != 0).alias("active"),
    )


_MAPPINGS = """mappings AS (SELECT c_custkey AS restaurant, 'p' || c_custkey % 2 AS platform, CASE WHEN c_custkey % 13 <> 0 THEN c_custkey // 3 END AS group_id,
  CASE WHEN c_custkey % 13 = 0 THEN 'UNMATCHED' WHEN c_custkey % 5 = 0 THEN 'REVIEW' ELSE 'MATCHED' END AS status, CASE WHEN c_custkey % 11 = 0 THEN 'manual' ELSE 'auto' END AS decided_by, c_custkey % 7 <> 0 AS active FROM customer)"""


def _requests(spark, sf):
    """Each order asks that its customer join the group of a neighbour."""
    k, n = c("o_orderkey"), c("o_custkey")
    texts = lambda *v: F.array(*map(F.lit, v)).cast("array<string>")
    return table(spark, sf, "orders").select(
        k.alias("request"), n.alias("restaurant"), F.concat(F.lit("p"), n % 2).alias("platform"), (n + k % 4).alias("anchor"), F.when(k % 9 == 0, "  ").when(k % 17 == 0, F.repeat(F.lit("x"), 501)).otherwise("seen").alias("note"),
        F.when(k % 8 == 0, F.floor(n / 3)).alias("expected_group"), (k % 2 == 0).alias("replace"), F.when(k % 3 != 0, texts("LOCATION_NEAR")).otherwise(texts()).alias("signals"),
        F.when(k % 10 == 1, texts("LOCATION_FAR")).otherwise(texts("BRAND_DIFFERENT")).alias("conflicts"), F.when(k % 6 == 0, 150).otherwise(151).alias("distance"), F.lit(0.8).alias("menu_overlap"),
    )


_REFUSALS = f"""{_MAPPINGS}, r AS (SELECT o_orderkey AS request, o_orderkey AS k, o_custkey AS restaurant, o_custkey + o_orderkey % 4 AS anchor, 'p' || o_custkey % 2 AS platform FROM orders),
 j AS (SELECT r.*, a.group_id AS grp, o.group_id AS own_group, o.status AS own_status, o.decided_by AS own_by,
   EXISTS (SELECT 1 FROM mappings s WHERE s.active AND s.status = 'MATCHED' AND s.group_id = a.group_id AND s.platform = r.platform AND s.restaurant <> r.restaurant) AS seated
  FROM r LEFT JOIN mappings a ON a.restaurant = r.anchor AND a.active AND a.status = 'MATCHED' AND a.group_id IS NOT NULL LEFT JOIN mappings o ON o.restaurant = r.restaurant AND o.active),
 d AS (SELECT *, coalesce(own_group <> grp AND own_status <> 'UNMATCHED', false) AS elsewhere,
   CASE WHEN k % 4 = 0 THEN 'SAME_RESTAURANT' WHEN k % 9 = 0 THEN 'NOTE_REQUIRED' WHEN grp IS NULL THEN 'ANCHOR_NOT_MAPPED' WHEN k % 8 = 0 AND restaurant // 3 <> grp THEN 'GROUP_MISMATCH' WHEN k % 10 = 1 THEN 'BRANCH_CONFLICT'
    WHEN k % 3 = 0 AND k % 6 <> 0 THEN 'WEAK_BRANCH_EVIDENCE' WHEN seated THEN 'SAME_PLATFORM_IN_GROUP' WHEN k % 17 = 0 THEN 'NOTE_TOO_LONG' WHEN elsewhere AND k % 2 <> 0 THEN 'RESTAURANT_ALREADY_MAPPED' END AS refusal FROM j),
 f AS (SELECT request, restaurant, platform, grp, refusal, CASE WHEN refusal IS NULL THEN CASE WHEN own_status IS NULL THEN 'created' WHEN own_group = grp AND own_status = 'MATCHED' AND own_by = 'manual' THEN 'unchanged' WHEN elsewhere THEN 'replaced' ELSE 'updated' END END AS status FROM d)"""


@register("assignment_refusals", f'WITH {_REFUSALS} SELECT request, restaurant, grp AS "group", refusal, status FROM f')
def assignment_refusals(spark, sf):
    """E8."""
    return decisions.assignment_refusals(_requests(spark, sf), _mappings(spark, sf))


@register(
    "reassigned_mappings",
    f"""WITH {_REFUSALS}, done AS (SELECT restaurant, platform, arg_min(grp, request) AS grp, arg_min(status, request) AS what FROM f WHERE status IN ('created', 'updated', 'replaced') GROUP BY ALL)
 SELECT m.restaurant, m.platform, group_id, CASE WHEN active AND what IS NOT NULL THEN 'REJECTED' ELSE status END AS status, CASE WHEN active AND what IS NOT NULL THEN 'manual' ELSE decided_by END AS decided_by, active AND what IS NULL AS active
  FROM mappings m LEFT JOIN done d ON m.restaurant = d.restaurant WHERE NOT (active AND coalesce(what, '') = 'updated')
 UNION ALL SELECT restaurant, platform, grp, 'MATCHED', 'manual', true FROM done""",
)
def reassigned_mappings(spark, sf):
    """The first request of each restaurant that may be written."""
    found = decisions.assignment_refusals(_requests(spark, sf), _mappings(spark, sf)).where("status IN ('created', 'updated', 'replaced')")
    first = found.groupBy("restaurant").agg(F.min(F.struct("request", "group", "status")).alias("r")).select("restaurant", "r.group", "r.status", F.concat(F.lit("p"), c("restaurant") % 2).alias("platform"))
    return decisions.reassigned(_mappings(spark, sf), first)


@register(
    "strict_pair_approvals",
    """SELECT o_orderkey AS restaurant, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS group_id, CASE WHEN o_orderkey % 7 <> 0 AND o_custkey % 3 <> 0 THEN o_custkey + 1 END AS anchor,
 CASE WHEN o_orderkey % 7 = 0 THEN 'NOT_A_SINGLE_CANDIDATE' WHEN o_orderkey % 5 = 0 THEN 'CONFLICTS: A,B' WHEN o_orderkey % 4 = 0 OR o_orderkey % 6 = 1 THEN 'WEAK_SIGNALS' WHEN o_orderkey % 10 = 3 OR o_orderkey % 90 > 75 THEN 'NOT_WITHIN_75M' WHEN o_custkey % 3 = 0 THEN 'GROUP_WITHOUT_ANCHOR' END AS skip_reason FROM orders""",
)
def strict_pair_approvals(spark, sf):
    """E9."""
    k, n = c("o_orderkey"), c("o_custkey")
    texts = lambda *v: F.array(*map(F.lit, v)).cast("array<string>")
    reviews = table(spark, sf, "orders").select(
        k.alias("restaurant"), F.when(k % 14 != 0, n).alias("group_id"), F.when(k % 14 == 7, F.array(n, n + 1)).when(k % 2 == 0, F.array(n).cast("array<bigint>")).alias("candidates"),
        F.when(k % 4 == 0, texts("NAME_EXACT")).when(k % 6 == 1, texts("LOCATION_NEAR")).otherwise(texts("LOCATION_NEAR", "BRAND_EXACT")).alias("signals"),
        F.when(k % 5 == 0, texts("A", "B")).otherwise(texts()).alias("conflicts"), F.when(k % 10 != 3, k % 90).alias("distance"),
    ).withColumn("candidates", F.when(c("restaurant") % 14 == 0, F.array().cast("array<bigint>")).otherwise(c("candidates")))
    groups = table(spark, sf, "customer").select(c("c_custkey").alias("group_id"), F.when(c("c_custkey") % 3 != 0, c("c_custkey") + 1).alias("anchor"))
    return decisions.strict_pairs(reviews, groups)


@register(
    "untouched_singletons",
    """WITH m AS (SELECT o_custkey AS grp, count(*) AS n, min(o_orderkey) AS restaurant, bool_and(o_orderstatus = 'F') AS seed FROM orders WHERE o_orderkey % 12 = 0 GROUP BY o_custkey)
 SELECT restaurant, grp AS group_id FROM m WHERE n = 1 AND seed AND grp % 3 <> 0 AND grp % 5 <> 0""",
)
def untouched_singletons(spark, sf):
    """E10 with each twelfth order as a mapping of its customer's group."""
    m = table(spark, sf, "orders").where("o_orderkey % 12 = 0").select(c("o_orderkey").alias("restaurant"), c("o_custkey").alias("group_id"), F.lit("MATCHED").alias("status"), F.when(c("o_orderstatus") == "F", "SEED").otherwise("MANUAL").alias("method"), F.lit(True).alias("active"))
    g = table(spark, sf, "customer").select(c("c_custkey").alias("group_id"), F.when(c("c_custkey") % 3 != 0, "auto").otherwise("verified").alias("identity_status"))
    return decisions.untouched_singletons(m, g, g.where("group_id % 5 = 0"))


@register(
    "decision_refusals",
    """WITH e AS (SELECT o_orderkey AS k, o_custkey AS item, ['APPROVE', 'MAP_UNMATCHED', 'REMAP', 'REJECT', 'KEEP_REVIEW'][o_orderkey % 5 + 1] AS d, CASE WHEN o_orderkey % 6 <> 0 THEN (o_custkey + o_orderkey % 3) % 200 END AS target FROM orders WHERE o_orderkey % 3 <> 1),
 a AS (SELECT c_custkey AS item, CASE c_custkey % 3 WHEN 0 THEN 'UNMATCHED' WHEN 1 THEN 'REVIEW' ELSE 'MATCHED' END AS status, c_custkey % 200 AS proposal, c_custkey % 9 = 0 AS manual, 'p' || c_custkey % 40 AS platform FROM customer WHERE c_custkey % 8 <> 0),
 j AS (SELECT e.*, a.item IS NULL OR k % 10 = 0 AS stale, status, proposal, manual, count(*) OVER (PARTITION BY e.item) AS n, count(*) FILTER (WHERE d IN ('APPROVE', 'MAP_UNMATCHED', 'REMAP') AND target IS NOT NULL) OVER (PARTITION BY target, k % 50) AS aims,
   EXISTS (SELECT 1 FROM a t WHERE t.status = 'MATCHED' AND t.proposal = e.target AND t.platform = 'p' || e.item % 40) AS taken FROM e LEFT JOIN a USING (item))
 SELECT k AS entry, item, d AS decision, target, array_to_string(list_filter([CASE WHEN n > 1 THEN 'DUPLICATE_ENTRY' END, CASE WHEN k % 7 = 0 THEN 'REASON_REQUIRED' END, CASE WHEN stale THEN 'STALE_DECISION' END, CASE WHEN NOT stale AND manual THEN 'NOT_MATCHER_DECISION' END,
  CASE WHEN NOT stale AND status <> CASE d WHEN 'MAP_UNMATCHED' THEN 'UNMATCHED' ELSE 'REVIEW' END THEN 'STATUS_MISMATCH' END, CASE WHEN NOT stale AND d <> 'KEEP_REVIEW' AND target IS NULL THEN 'TARGET_REQUIRED' END,
  CASE WHEN NOT stale AND target IS NOT NULL AND ((d IN ('APPROVE', 'REJECT') AND proposal <> target) OR (d = 'REMAP' AND proposal = target)) THEN 'TARGET_MISMATCH' END,
  CASE WHEN NOT stale AND d <> 'KEEP_REVIEW' AND target IS NOT NULL AND (target % 50 <> k % 50 OR target % 4 = 0) THEN 'CANONICAL_OUT_OF_SCOPE' END,
  CASE WHEN NOT stale AND d IN ('APPROVE', 'MAP_UNMATCHED', 'REMAP') AND target IS NOT NULL AND taken THEN 'PLATFORM_ALREADY_MAPPED' END, CASE WHEN d IN ('APPROVE', 'MAP_UNMATCHED', 'REMAP') AND target IS NOT NULL AND aims > 1 THEN 'DUPLICATE_TARGET' END], lambda x: x IS NOT NULL), ',') AS refusals FROM j""",
)
def decision_refusals(spark, sf):
    """E21."""
    k, n = c("o_orderkey"), c("o_custkey")
    kinds = F.array(*map(F.lit, ["APPROVE", "MAP_UNMATCHED", "REMAP", "REJECT", "KEEP_REVIEW"]))
    entries = table(spark, sf, "orders").where(k % 3 != 1).select(
        k.alias("entry"), (k % 50).alias("group_id"), F.concat(F.lit("p"), n % 40).alias("platform"), F.element_at(kinds, (k % 5 + 1).cast("int")).alias("decision"), n.alias("item"),
        F.when(k % 10 == 0, -n).otherwise(n).alias("mapping"), F.when(k % 6 != 0, (n + k % 3) % 200).alias("target"), F.when(k % 7 != 0, "why").otherwise("").alias("reason"),
    )
    i = c("c_custkey")
    active = table(spark, sf, "customer").where(i % 8 != 0).select(
        i.alias("mapping"), i.alias("item"), F.concat(F.lit("p"), i % 40).alias("platform"), F.when(i % 3 == 0, "UNMATCHED").when(i % 3 == 1, "REVIEW").otherwise("MATCHED").alias("status"),
        F.when(i % 9 == 0, "manual").otherwise("matcher").alias("decided_by"), (i % 200).alias("target"),
    )
    canonical = spark.range(200).select(c("id").alias("target"), (c("id") % 50).alias("group_id"), F.when(c("id") % 4 != 0, "active").otherwise("retired").alias("status"))
    return decisions.decision_refusals(entries, active, canonical).withColumn("refusals", F.array_join("refusals", ","))


@register(
    "approval_skips",
    """WITH p AS (SELECT p_partkey AS target, p_partkey % 60 AS grp, CASE WHEN p_partkey % 19 <> 0 THEN 'active' ELSE 'retired' END AS status, p_name AS en, CASE WHEN p_partkey % 3 = 0 THEN 'ar' || p_size END AS ar FROM part),
 r AS (SELECT o_orderkey AS item, (CASE WHEN o_orderkey % 23 = 0 THEN o_orderkey + 1 ELSE t END) % 60 AS grp, t AS target, o_orderkey AS k FROM (SELECT o_orderkey, o_orderkey % (SELECT count(*) * 11 // 10 FROM part) AS t FROM orders)),
 j AS (SELECT r.*, p.grp AS pgrp, p.status, p.en, p.ar, CASE WHEN k % 5 = 0 THEN 'other' ELSE p.en END AS name_en, p.ar AS name_ar FROM r LEFT JOIN p USING (target)),
 w AS (SELECT j.*, k % 4 = 1 AND (SELECT count(*) = 1 AND max(x.target) = j.target FROM p x WHERE x.status = 'active' AND x.grp = j.grp AND (x.en = j.name_en OR x.ar = j.name_ar)) AS waived FROM j)
 SELECT item, target, waived, array_to_string(list_filter([CASE WHEN k % 29 = 0 THEN 'NOT_MATCHER_DECISION' END, CASE WHEN status IS NULL THEN 'NO_CANONICAL_ITEM' END, CASE WHEN grp <> pgrp OR status <> 'active' THEN 'CANONICAL_OUT_OF_SCOPE' END, CASE WHEN status IS NOT NULL AND (k % 4 IN (1, 2)) AND NOT waived THEN 'HAS_CONFLICTS' END,
  CASE WHEN status IS NOT NULL AND k % 5 = 0 THEN 'NAME_EN_DIFFERS' END, CASE WHEN status IS NOT NULL AND ar IS NULL THEN 'NAME_AR_DIFFERS' END, CASE WHEN status IS NOT NULL AND k % 11 = 0 THEN 'CATEGORY_EN_DIFFERS' END, CASE WHEN status IS NOT NULL AND k % 6 = 0 THEN 'VARIANT_DIFFERS' END], lambda x: x IS NOT NULL), ',') AS skips FROM w""",
)
def approval_skips(spark, sf):
    """E20 with the waiver for unique twins."""
    p, k = table(spark, sf, "part"), c("o_orderkey")
    canonical = p.select(
        c("p_partkey").alias("target"), (c("p_partkey") % 60).alias("group_id"), F.when(c("p_partkey") % 19 != 0, "active").otherwise("retired").alias("status"), c("p_name").alias("name_en"),
        F.when(c("p_partkey") % 3 == 0, F.concat(F.lit("ar"), "p_size")).alias("name_ar"), F.lit("c").alias("category_en"), F.lit("d").alias("category_ar"), F.lit(None).cast("string").alias("portion"),
    )
    size = p.agg((F.floor(F.count("*") * 11 / 10)).alias("size"))  # one row
    texts = lambda *v: F.array(*map(F.lit, v)).cast("array<string>")
    o = table(spark, sf, "orders").join(F.broadcast(size)).select(k.alias("item"), (k % c("size")).alias("target"))
    own = canonical.select("target", c("name_en").alias("en"), "name_ar")
    reviews = o.join(own, "target", "left").select(
        "item", "target", (F.when(c("item") % 23 == 0, c("item") + 1).otherwise(c("target")) % 60).alias("group_id"), F.when(c("item") % 29 == 0, "manual").otherwise("matcher").alias("decided_by"),
        F.when(c("item") % 4 == 1, texts("AMBIGUOUS_CANDIDATES")).when(c("item") % 4 == 2, texts("AMBIGUOUS_CANDIDATES", "OTHER")).otherwise(texts()).alias("conflicts"),
        F.when(c("item") % 5 == 0, "other").otherwise(c("en")).alias("name_en"), "name_ar", F.when(c("item") % 11 == 0, "x").otherwise("c").alias("category_en"), F.lit("d").alias("category_ar"), F.when(c("item") % 6 == 0, "2 pcs").alias("portion"),
    )
    return decisions.approval_skips(reviews, canonical, unique_twins=True).withColumn("skips", F.array_join("skips", ","))


@register("seed_mappings", "SELECT DISTINCT p_partkey + 7 AS item, 'p' || (p_partkey + 7) % 2 AS platform, p_size AS group_id, p_partkey AS target FROM part WHERE p_partkey % 4 <> 0 AND p_partkey + 7 IN (SELECT o_orderkey FROM orders) AND (p_partkey + 7) % 3 <> 0")
def seed_mappings(spark, sf):
    """E22."""
    k = c("p_partkey")
    canonical = table(spark, sf, "part").select(k.alias("target"), c("p_size").alias("group_id"), (k + 7).alias("seed_item"), F.when(k % 4 != 0, "active").otherwise("retired").alias("status"))
    items = table(spark, sf, "orders").select(c("o_orderkey").alias("item"), F.concat(F.lit("p"), c("o_orderkey") % 2).alias("platform")).distinct()
    mapped = items.select("item", (c("item") % 3 == 0).alias("active"))
    return decisions.seed_mappings(canonical, items, mapped).select("item", "platform", "group_id", "target")


@register(
    "match_batch_plan",
    """WITH d AS (SELECT o_orderkey AS item, 'p' || o_orderkey % 4 AS platform, CASE WHEN o_orderkey % 3 = 0 THEN 'REVIEW' ELSE 'MATCHED' END AS status, o_custkey AS target FROM orders),
 a AS (SELECT o_orderkey AS item, 'p' || o_orderkey % 4 AS platform, CASE WHEN o_orderkey % 4 = 0 THEN 'REVIEW' ELSE 'MATCHED' END AS status, CASE WHEN o_orderkey % 5 = 0 THEN 'manual' ELSE 'matcher' END AS who, CASE WHEN o_orderkey % 7 = 0 THEN o_custkey + 1 ELSE o_custkey END AS target FROM orders WHERE o_orderkey % 10 < 8),
 j AS (SELECT d.*, a.item IS NULL AS fresh, a.status AS was, a.target AS had, a.who, count(*) FILTER (WHERE a.item IS NULL AND d.status = 'MATCHED') OVER (PARTITION BY d.target) AS n, EXISTS (SELECT 1 FROM a x WHERE x.status = 'MATCHED' AND x.target = d.target AND x.platform = d.platform) AS taken FROM d LEFT JOIN a USING (item)),
 r AS (SELECT *, CASE WHEN NOT fresh THEN CASE WHEN who <> 'matcher' THEN 'kept_existing' WHEN was = status AND had = target THEN 'unchanged' ELSE 'updated' END WHEN status = 'MATCHED' AND n > 1 THEN 'held' WHEN status = 'MATCHED' AND taken THEN 'clash' ELSE 'created' END AS outcome FROM j)
 SELECT item, target, status, outcome, outcome = 'created' AS written FROM r""",
)
def match_batch_plan(spark, sf):
    """E19."""
    k, n = c("o_orderkey"), c("o_custkey")
    o = table(spark, sf, "orders")
    platform = F.concat(F.lit("p"), k % 4).alias("platform")
    decided = o.select(k.alias("item"), platform, F.when(k % 3 == 0, "REVIEW").otherwise("MATCHED").alias("status"), n.alias("target"))
    active = o.where(k % 10 < 8).select(
        k.alias("item"), platform, F.when(k % 4 == 0, "REVIEW").otherwise("MATCHED").alias("status"), F.when(k % 5 == 0, "manual").otherwise("matcher").alias("decided_by"), F.when(k % 7 == 0, n + 1).otherwise(n).alias("target"),
    )
    return decisions.batch_plan(decided, active)
