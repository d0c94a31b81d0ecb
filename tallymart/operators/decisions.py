"""Decisions on mappings: manual assignment to groups, approval of reviews, reset of singletons, reviewed decisions, seeds.

Reasons are told, not thrown: a row without a reason may be written. Keys are unique in mappings, groups and canonical items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What rules two branches out, what proves a branch, and how near a branch with the same menu may be.
HARD_CONFLICTS = ("CITY_MISMATCH", "AREA_MISMATCH", "LOCATION_FAR")
STRONG_SIGNALS = ("ADDRESS_EXACT", "LOCATION_NEAR")
MENU_OVERLAP, MENU_METRES, NEAR_METRES, NOTE_LENGTH = 0.8, 150, 75, 500


def _has(array: str | Column, values) -> Column:
    return F.arrays_overlap(F.coalesce(array, F.array().cast("array<string>")), F.array(*map(F.lit, values)))


def assignment_refusals(requests: DataFrame, mappings: DataFrame) -> DataFrame:
    """Why a restaurant may not join the group of an anchor, null if it may, and `status`: what a write does then.

    requests (request, restaurant, platform, anchor, note, expected_group, replace, signals, conflicts, distance, menu_overlap);
    mappings (restaurant, platform, group_id, status, decided_by, active). The first reason in this order counts."""
    active = mappings.where("active")
    anchor = active.where("status = 'MATCHED' AND group_id IS NOT NULL").select(F.col("restaurant").alias("anchor"), F.col("group_id").alias("group"))
    own = active.select("restaurant", F.col("group_id").alias("own_group"), F.col("status").alias("own_status"), F.col("decided_by").alias("own_by"))
    # a group's restaurants by platform: their number and one of them tell whether another one is there
    seats = active.where("status = 'MATCHED'").groupBy(F.col("group_id").alias("group"), "platform").agg(F.min("restaurant").alias("least"), F.max("restaurant").alias("most"))
    r = requests.join(anchor, "anchor", "left").join(own, "restaurant", "left").join(seats, ["group", "platform"], "left")
    menu = (F.col("menu_overlap") >= MENU_OVERLAP) & (F.col("distance") <= MENU_METRES)
    elsewhere = F.col("own_group").isNotNull() & (F.col("own_group") != F.col("group")) & (F.col("own_status") != "UNMATCHED")
    reason = (
        F.when(F.col("restaurant") == F.col("anchor"), "SAME_RESTAURANT")
        .when(F.coalesce(F.trim("note"), F.lit("")) == "", "NOTE_REQUIRED")
        .when(F.col("group").isNull(), "ANCHOR_NOT_MAPPED")
        .when(F.col("expected_group") != F.col("group"), "GROUP_MISMATCH")
        .when(_has("conflicts", HARD_CONFLICTS), "BRANCH_CONFLICT")
        .when(~_has("signals", STRONG_SIGNALS) & ~F.coalesce(menu, F.lit(False)), "WEAK_BRANCH_EVIDENCE")
        .when((F.col("least") != F.col("restaurant")) | (F.col("most") != F.col("restaurant")), "SAME_PLATFORM_IN_GROUP")
        .when(F.length("note") > NOTE_LENGTH, "NOTE_TOO_LONG")
        .when(elsewhere & ~F.coalesce("replace", F.lit(False)), "RESTAURANT_ALREADY_MAPPED")
    )
    kept = (F.col("own_group") == F.col("group")) & (F.col("own_status") == "MATCHED") & (F.col("own_by") == "manual")
    status = F.when(F.col("own_status").isNull(), "created").when(kept, "unchanged").when(elsewhere, "replaced").otherwise("updated")
    return r.select("request", "restaurant", "group", reason.alias("refusal"), F.when(reason.isNull(), status).alias("status"))


def reassigned(mappings: DataFrame, assignments: DataFrame) -> DataFrame:
    """Mappings after assignments (restaurant, group, platform, status from `assignment_refusals`). A replaced mapping stays as
    REJECTED history, an updated one is overwritten; assigned ones are MATCHED by hand. One assignment a restaurant."""
    done = assignments.where("status IN ('created', 'updated', 'replaced')").select("restaurant", "group", "platform", F.col("status").alias("_what"))
    m = mappings.join(done.select("restaurant", "_what"), "restaurant", "left")
    hit = F.col("active") & F.col("_what").isNotNull()
    old = m.where(~(F.col("active") & F.coalesce(F.col("_what") == "updated", F.lit(False))))
    old = old.select(
        "restaurant", "platform", "group_id",
        F.when(hit, "REJECTED").otherwise(F.col("status")).alias("status"), F.when(hit, "manual").otherwise(F.col("decided_by")).alias("decided_by"), (F.col("active") & ~hit).alias("active"),
    )
    new = done.select("restaurant", "platform", F.col("group").alias("group_id"), F.lit("MATCHED").alias("status"), F.lit("manual").alias("decided_by"), F.lit(True).alias("active"))
    return old.unionByName(new)


def strict_pairs(reviews: DataFrame, groups: DataFrame) -> DataFrame:
    """Why a review (restaurant, group_id, candidates, signals, conflicts, distance) may not be approved, null if it may.
    groups (group_id, anchor). Candidates default to the review's own group."""
    listed = F.when(F.size("candidates") > 0, F.col("candidates")).otherwise(F.array_compact(F.array("group_id")))
    r = reviews.withColumn("_one", F.when(F.size(listed) == 1, F.get(listed, F.lit(0))))
    r = r.join(groups.select(F.col("group_id").alias("_one"), "anchor"), "_one", "left")
    weak = ~_has("signals", ["LOCATION_NEAR"]) | ~_has("signals", ["BRAND_EXACT", "NAME_EXACT"])
    reason = (
        F.when(F.col("_one").isNull(), "NOT_A_SINGLE_CANDIDATE")
        .when(F.size("conflicts") > 0, F.concat(F.lit("CONFLICTS: "), F.array_join("conflicts", ",")))
        .when(weak, "WEAK_SIGNALS")
        .when(F.col("distance").isNull() | (F.col("distance") > NEAR_METRES), "NOT_WITHIN_75M")
        .when(F.col("anchor").isNull(), "GROUP_WITHOUT_ANCHOR")
    )
    return r.select("restaurant", F.col("_one").alias("group_id"), "anchor", reason.alias("skip_reason"))


def untouched_singletons(mappings: DataFrame, groups: DataFrame, canonical: DataFrame) -> DataFrame:
    """Restaurants alone in a group that nobody touched: an active SEED mapping, automatic group, one mapping ever, no canonical items.
    mappings (restaurant, group_id, status, method, active), groups (group_id, identity_status), canonical (group_id)."""
    alone = mappings.groupBy("group_id").agg(F.count("*").alias("n"), F.first("restaurant").alias("restaurant"), F.bool_and(F.expr("active AND status = 'MATCHED' AND method = 'SEED'")).alias("seed"))
    auto = groups.where("identity_status = 'auto'").select("group_id")
    return alone.where("n = 1 AND seed").join(auto, "group_id", "left_semi").join(canonical.select("group_id").distinct(), "group_id", "left_anti").select("restaurant", "group_id")


def decision_refusals(entries: DataFrame, active: DataFrame, canonical: DataFrame, group: str = "group_id") -> DataFrame:
    """Reasons against each reviewed decision, in order; an empty array may be written (or kept, for KEEP_REVIEW).

    entries (entry, group_id, platform, decision, item, mapping, target, reason); active: the active item mappings (mapping, item,
    platform, status, decided_by, target); canonical (target, group_id, status). All or nothing is the caller's: any refusal stops a run."""
    known = active.select("item", F.col("mapping").alias("_mapping"), F.col("status").alias("_status"), F.col("decided_by").alias("_by"), F.col("target").alias("_proposal"))
    goal = canonical.select("target", F.col("group_id").alias("_group"), F.col("status").alias("_goal"))
    taken = active.where("status = 'MATCHED'").select("target", "platform", F.lit(True).alias("_taken")).distinct()
    writes = F.col("decision").isin("APPROVE", "MAP_UNMATCHED", "REMAP")
    twice = entries.groupBy("item").agg(F.count("*").alias("_entries"))
    aims = entries.where(writes & F.col("target").isNotNull()).groupBy("target", group).agg(F.count("*").alias("_aims"))
    e = entries.join(known, "item", "left").join(goal, "target", "left").join(taken, ["target", "platform"], "left").join(twice, "item", "left").join(aims, ["target", group], "left")
    stale = F.coalesce(F.col("_mapping") != F.col("mapping"), F.lit(True))
    same = F.coalesce(F.col("_proposal") == F.col("target"), F.lit(False))
    goes_on = ~stale & (F.col("decision") != "KEEP_REVIEW")
    aimed = goes_on & F.col("target").isNotNull()
    wanted = F.when(F.col("decision") == "MAP_UNMATCHED", "UNMATCHED").otherwise("REVIEW")
    mismatch = (F.col("decision").isin("APPROVE", "REJECT") & ~same) | ((F.col("decision") == "REMAP") & (F.col("_proposal").isNull() | same))
    outside = F.coalesce((F.col("_group") != F.col(group)) | (F.col("_goal") != "active"), F.lit(True))
    reasons = [
        (F.col("_entries") > 1, "DUPLICATE_ENTRY"), (F.coalesce("reason", F.lit("")) == "", "REASON_REQUIRED"), (stale, "STALE_DECISION"),
        (~stale & F.coalesce(F.col("_by") != "matcher", F.lit(True)), "NOT_MATCHER_DECISION"), (~stale & (F.col("_status") != wanted), "STATUS_MISMATCH"),
        (goes_on & F.col("target").isNull(), "TARGET_REQUIRED"), (aimed & mismatch, "TARGET_MISMATCH"), (aimed & outside, "CANONICAL_OUT_OF_SCOPE"),
        (aimed & writes & F.coalesce("_taken", F.lit(False)), "PLATFORM_ALREADY_MAPPED"), (writes & (F.col("_aims") > 1), "DUPLICATE_TARGET"),
    ]
    return e.select("entry", "item", "decision", "target", F.array_compact(F.array(*[F.when(test, name) for test, name in reasons])).alias("refusals"))


def approval_skips(reviews: DataFrame, canonical: DataFrame, unique_twins: bool = False) -> DataFrame:
    """Why an item's review may not be approved by rule, in order, and whether AMBIGUOUS_CANDIDATES was waived.

    reviews (unique item, group_id, decided_by, target, conflicts, name_en, name_ar, category_en, category_ar, portion); canonical (target,
    group_id, status, and the same texts). Texts are item keys already. A unique twin is the only active item of its group
    that shares a name with the source; with `unique_twins` its ambiguity is no conflict."""
    texts = ("name_en", "name_ar", "category_en", "category_ar", "portion")
    c = canonical.select("target", F.col("group_id").alias("_group"), F.col("status").alias("_status"), *[F.col(t).alias(f"_{t}") for t in texts])
    r = reviews.join(c, "target", "left")
    if unique_twins:
        live = canonical.where("status = 'active'")
        # the first and the last item of each name tell whether there is another one, so namesakes are not paired with reviews
        for n in ("name_en", "name_ar"):
            named = live.where(F.col(n).isNotNull()).groupBy("group_id", n).agg(F.min("target").alias(f"_first_{n}"), F.max("target").alias(f"_last_{n}"))
            r = r.join(named, ["group_id", n], "left")
        r = r.withColumns({"_first": F.least("_first_name_en", "_first_name_ar"), "_last": F.greatest("_last_name_en", "_last_name_ar")})
        only = F.size(F.filter("conflicts", lambda x: x != "AMBIGUOUS_CANDIDATES")) == 0
        waived = F.coalesce((F.size("conflicts") > 0) & only & (F.col("_first") == F.col("target")) & (F.col("_last") == F.col("target")), F.lit(False))
    else:
        waived = F.lit(False)
    there = F.col("_status").isNotNull()
    differs = lambda t: there & ~F.coalesce((F.col(t) == F.col(f"_{t}")) & (F.col(t) != ""), F.lit(False))
    reasons = [
        (F.coalesce(F.col("decided_by") != "matcher", F.lit(True)), "NOT_MATCHER_DECISION"), (~there, "NO_CANONICAL_ITEM"),
        (there & ((F.col("_group") != F.col("group_id")) | (F.col("_status") != "active")), "CANONICAL_OUT_OF_SCOPE"),
        (there & (F.size("conflicts") > 0) & ~waived, "HAS_CONFLICTS"), (differs("name_en"), "NAME_EN_DIFFERS"), (differs("name_ar"), "NAME_AR_DIFFERS"),
        (differs("category_en"), "CATEGORY_EN_DIFFERS"), (differs("category_ar"), "CATEGORY_AR_DIFFERS"), (there & ~F.col("portion").eqNullSafe(F.col("_portion")), "VARIANT_DIFFERS"),
    ]
    return r.select("item", "target", F.array_compact(F.array(*[F.when(test, name) for test, name in reasons])).alias("skips"), waived.alias("waived"))


def seed_mappings(canonical: DataFrame, items: DataFrame, mappings: DataFrame) -> DataFrame:
    """For active canonical items (target, group_id, seed_item, status) the mapping of their seed item (item, platform), at
    confidence 1, where the item has no active mapping. mappings (item, active)."""
    seeds = canonical.where("status = 'active'").select("target", "group_id", F.col("seed_item").alias("item"))
    new = seeds.join(items.select("item", "platform"), "item").join(mappings.where("active").select("item").distinct(), "item", "left_anti")
    return new.select("item", "platform", "group_id", "target", F.lit("MATCHED").alias("status"), F.lit("SEED").alias("method"), F.lit(1.0).alias("confidence"))


def batch_plan(decided: DataFrame, active: DataFrame) -> DataFrame:
    """What becomes of the matcher's decisions (item, platform, status, target), one an item: `outcome` and whether it is written.

    active: the active item mappings (item, platform, status, decided_by, target). Decisions by others stay (kept_existing); equal ones are
    unchanged, other ones updated. Of the new ones, those that would match one target twice are held; one whose target has a match on the
    platform already is a clash; the rest are created."""
    known = active.select("item", F.col("status").alias("_status"), F.col("target").alias("_target"), F.col("decided_by").alias("_by"))
    taken = active.where("status = 'MATCHED'").select("target", "platform", F.lit(True).alias("_taken")).distinct()
    fresh = decided.join(active.select("item"), "item", "left_anti").where("status = 'MATCHED'").groupBy("target").agg(F.count("*").alias("_n"))
    d = decided.join(known, "item", "left").join(taken, ["target", "platform"], "left").join(fresh, "target", "left")
    same = (F.col("_status") == F.col("status")) & F.col("_target").eqNullSafe(F.col("target"))
    matched = F.col("status") == "MATCHED"
    new = F.when(matched & (F.col("_n") > 1), "held").when(matched & F.coalesce("_taken", F.lit(False)), "clash").otherwise("created")
    old = F.when(F.coalesce(F.col("_by") != "matcher", F.lit(True)), "kept_existing").when(same, "unchanged").otherwise("updated")
    outcome = F.when(F.col("_status").isNull(), new).otherwise(old)
    return d.select("item", "target", "status", outcome.alias("outcome"), (outcome == "created").alias("written"))
