"""Two listings of one branch on two platforms that were not joined, and what joining them changes.

Listings are looked at while they are alone (in review, or the only matched one of their group). Pairs are found by pins within
MENU_M and a name or brand that both have, so no brand is paired with itself across a city; the branch's evidence is compared after that, and menus last,
as the share of the smaller menu that both have. A listing with several partners is left to a person.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.geo import near_pairs, valid
from tallymart.functions.item_text import areas_compatible
from tallymart.operators.backfill import NEAR_M
from tallymart.operators.files import written

MENU_M, LEAST_OVERLAP = 150, 0.8


def overlap(a: Column, b: Column) -> Column:
    """Share of the smaller set that is in the other; 0 if one is empty."""
    return F.coalesce(F.size(F.array_intersect(a, b)) / F.nullif(F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b))), F.lit(0)), F.lit(0.0))


def alone(mappings: DataFrame) -> DataFrame:
    """restaurant, grp, matched of listings in review and of the only matched ones of their groups, from active mappings (restaurant, grp, status)."""
    good = mappings.where("status IN ('MATCHED', 'REVIEW')")
    single = good.where("status = 'MATCHED'").groupBy("grp").agg(F.count("*").alias("n")).where("n = 1").select("grp", F.lit(True).alias("single"))
    return good.join(single, "grp", "left").where("status = 'REVIEW' OR single").select("restaurant", "grp", (F.col("status") == "MATCHED").alias("matched"))


def candidates(listings: DataFrame, first: str, second: str) -> DataFrame:
    """id1 (of platform `first`), id2 (of `second`), metres, overlap: every pair that fits, ambiguous ones too.

    listings: restaurant, platform, brand (a key of the name), brands, city, area, address, lat, lng, dishes (folded names), grp, matched."""
    pinned = listings.where(valid(F.col("lat"), F.col("lng")))
    side = lambda p: pinned.where(F.col("platform") == p)
    tagged = lambda kind, x: F.concat(F.lit(kind), x.cast("string"))
    brands = F.transform(F.coalesce("brands", F.array().cast("array<string>")), lambda x: tagged("b:", x))
    keyed = lambda df: df.withColumns({"id": F.col("restaurant"), "keys": F.concat(F.array(tagged("n:", F.col("brand"))), brands)})
    told = ("city", "area", "dishes", "grp", "matched")
    # evidence of a pair within MENU_M: its distance is known here, so cities and areas are what can still contradict
    plain = lambda df: keyed(df).withColumns({c: F.nullif(F.col(c), F.lit("")) for c in ("city", "area")})
    j = near_pairs(plain(side(first)), plain(side(second)), MENU_M + 1, "keys", told)
    metres = F.floor(F.col("metres") + 0.5)
    near, share = metres <= NEAR_M, overlap(F.col("s.dishes"), F.col("t.dishes"))
    j = j.where(F.coalesce(F.col("s.city") == F.col("t.city"), F.lit(True)))
    j = j.where(near | ((metres <= MENU_M) & F.coalesce(areas_compatible(F.col("s.area"), F.col("t.area")), F.lit(True)) & (share >= LEAST_OVERLAP))).withColumn("overlap", share)
    return j.select("id1", "id2", metres.alias("metres"), (F.floor(F.col("overlap") * 100 + 0.5) / 100).alias("overlap"), F.col("s.grp").alias("grp1"), F.col("s.matched").alias("matched1"), F.col("t.grp").alias("grp2"), F.col("t.matched").alias("matched2"))


def unambiguous(pairs: DataFrame) -> DataFrame:
    """Pairs of which neither side has another partner."""
    single = [pairs.groupBy(side).agg(F.count("*").alias("n")).where("n = 1").select(side) for side in ("id1", "id2")]
    return pairs.join(single[0], "id1").join(single[1], "id2")


def lone_pairs(listings: DataFrame, first: str, second: str) -> DataFrame:
    """`unambiguous` of `candidates`, without a list of all pairs: the partners of each listing are counted where pairs are found, and only
    listings with exactly one are paired once more. A pair of two such listings is the only one of both."""
    ends = candidates(listings, first, second).select(F.explode(F.array("id1", "id2")).alias("restaurant"))
    single = written(ends.groupBy("restaurant").agg(F.count("*").alias("n")).where("n = 1").select("restaurant"))
    return candidates(listings.join(single, "restaurant", "left_semi"), first, second)


def merges(pairs: DataFrame) -> DataFrame:
    """Anchor, moving, the group that is joined, the group that is left, whether that is retired (it has nobody else), and outcome.

    A listing that is matched keeps its group and the other joins; the second platform's anchors if both are. Without a matched
    listing there is no group to join (ANCHOR_NOT_MATCHED). Both in one group already: nothing to do (ALREADY_TOGETHER)."""
    to_second = F.col("matched2")
    pick = lambda a, b: F.when(to_second, F.col(a)).otherwise(F.col(b))
    together = F.col("grp1").eqNullSafe(F.col("grp2")) & F.col("matched1") & F.col("matched2")
    outcome = F.when(~F.col("matched1") & ~F.col("matched2"), "ANCHOR_NOT_MATCHED").when(together, "ALREADY_TOGETHER").otherwise("merged")
    left = F.when(to_second & F.col("matched1"), F.col("grp1"))
    return pairs.select("id1", "id2", "metres", "overlap", pick("id2", "id1").alias("anchor"), pick("id1", "id2").alias("moving"), outcome.alias("outcome"), F.when(outcome == "merged", pick("grp2", "grp1")).alias("joins"), F.when(outcome == "merged", left).alias("retired"))


def applied(mappings: DataFrame, merged: DataFrame) -> DataFrame:
    """The mappings after the merges: a moving listing is matched to the group it joins."""
    moves = merged.where("outcome = 'merged'").select(F.col("moving").alias("restaurant"), "joins")
    return mappings.join(moves, "restaurant", "left").select("restaurant", F.coalesce("joins", "grp").alias("grp"), F.when(F.col("joins").isNotNull(), "MATCHED").otherwise(F.col("status")).alias("status"))
