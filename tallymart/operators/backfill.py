"""What two listings of branches say about each other, and the plan of a run that gives listings their groups, in order.

A run takes listings by time and id. One that fits no group becomes a group itself, so later ones see earlier decisions. Two things
alone depend on order, and both are settled in rounds over all rows at once:

* Which listings become groups: one that fits a stored group, or an earlier listing that became one, does not; one whose earlier
  candidates all did not, does. Each round settles every listing of which one or the other is known.
* Which platforms a group has: a second listing of a platform is no match but goes to review. Of the listings that wait for the same
  (group, platform), each round decides the first.

A group keeps the evidence of the listing that started it, as in a dry run. Pairs that were rejected never come up again. Candidates
are found by pins within FAR_M and a name or brand, or, where a pin is missing, by a name or brand and city. The latter meet all groups of
their block, as classes of listings and classes of groups that say the same; of their weak pairs only the first two at a confidence are
written down, as these tell the best and whether there are several. Listings that fit a stored group start none, so listings meet one
another only where they fit no stored one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.geo import distance_m, near_pairs, valid
from tallymart.functions.item_text import areas_compatible
from tallymart.operators.files import shared_folder

NEAR_M, FAR_M = 75, 500
SAID = ("names", "brands", "city", "area", "address")
SIGNALS = (*SAID, "lat", "lng")
#: The parts that the classes of a key's sources are dealt to.
DEALT = 8
_EDGE = ("id1", "id2", "ord", "ord2", "platform", "strong", "method", "confidence")
_BEFORE = "t.ord2 IS NULL OR t.ord2 < s.ord"


def _is(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def branch_evidence(s: str, t: str) -> dict[str, Column]:
    """E4, of two structs: cities, areas, addresses and pins that agree or contradict. Pins close together overrule labels of areas."""
    a, b = (lambda f: F.nullif(F.col(f"{s}.{f}"), F.lit(""))), (lambda f: F.nullif(F.col(f"{t}.{f}"), F.lit("")))
    both = F.col(f"{s}.lat").isNotNull() & F.col(f"{s}.lng").isNotNull() & F.col(f"{t}.lat").isNotNull() & F.col(f"{t}.lng").isNotNull()
    metres = F.when(both, F.floor(distance_m(F.col(f"{s}.lat"), F.col(f"{s}.lng"), F.col(f"{t}.lat"), F.col(f"{t}.lng")) + 0.5))
    near, areas = _is(metres <= NEAR_M), areas_compatible(a("area"), b("area"))
    return {
        "CITY_EQUAL": _is(a("city") == b("city")), "AREA_COMPATIBLE": _is(areas), "ADDRESS_EXACT": _is(a("address") == b("address")), "LOCATION_NEAR": near,
        "CITY_MISMATCH": _is(a("city") != b("city")), "AREA_MISMATCH": _is(~areas) & ~near, "ADDRESS_MISMATCH": _is(a("address") != b("address")), "LOCATION_FAR": _is(metres > FAR_M),
    }


def judged(pairs: DataFrame, s: str = "s", t: str = "t") -> DataFrame:
    """E5: pairs with strong (a match unless the platform is taken), method and confidence; those that conflict or share no name are left out."""
    e = branch_evidence(s, t)
    name, brand = _is(F.arrays_overlap(f"{s}.names", f"{t}.names")), _is(F.arrays_overlap(f"{s}.brands", f"{t}.brands"))
    fits = (name | brand) & ~(e["CITY_MISMATCH"] | e["AREA_MISMATCH"] | e["LOCATION_FAR"])
    how = F.when(name & e["ADDRESS_EXACT"], F.struct(F.lit("NAME_ADDRESS"), F.lit(0.95))).when(name & e["LOCATION_NEAR"], F.struct(F.lit("NAME_LOCATION"), F.lit(0.9))).when(brand & e["ADDRESS_EXACT"], F.struct(F.lit("BRAND_NAME_ADDRESS"), F.lit(0.85)))
    weak = F.struct(F.when(name, "EXACT_NAME").otherwise("BRAND_NAME_ADDRESS"), F.when(e["AREA_COMPATIBLE"] | e["CITY_EQUAL"], 0.5).otherwise(0.3))
    rows = pairs.withColumn("_fits", fits).withColumn("_how", how).withColumn("_weak", weak).where("_fits")
    told = F.coalesce("_how", "_weak")
    return rows.withColumn("strong", F.col("_how").isNotNull()).withColumn("method", told["col1"]).withColumn("confidence", told["col2"]).drop("_fits", "_how", "_weak")


def _keyed(df: DataFrame) -> DataFrame:
    """With keys of names and brands, whether there is a pin, and look: the same for all rows that say the same but for their pins."""
    tagged = lambda c, kind: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.concat(F.lit(kind), x))
    keys = F.array_distinct(F.array_compact(F.concat(tagged("names", "n:"), tagged("brands", "b:"))))
    df = df.withColumns({"keys": keys, "pinned": valid(F.col("lat"), F.col("lng"))})
    return df.withColumn("look", _digest(*SAID, "pinned"))


def _digest(*columns) -> Column:
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def _near(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs of pins that fit, judged. Targets, which are fewer, visit the cells around."""
    carry = (*SIGNALS, "ord", "platform", "ord2")
    s = sources.withColumn("ord2", F.lit(None).cast(targets.schema["ord2"].dataType))
    t = targets.withColumn("ord", F.lit(None).cast(sources.schema["ord"].dataType)).withColumn("platform", F.lit(None).cast(sources.schema["platform"].dataType))
    found = near_pairs(t.where("pinned"), s.where("pinned"), FAR_M + 1, "keys", carry).select(F.col("id2").alias("id1"), F.col("id1").alias("id2"), F.col("t").alias("s"), F.col("s").alias("t"))
    return judged(found.where(_BEFORE)).select("id1", "id2", "s.ord", "t.ord2", "s.platform", "strong", "method", "confidence")


def _class_pairs(sources: DataFrame, targets: DataFrame, same_address: bool = False) -> DataFrame:
    """(cls1, cls2, strong, method, confidence, first) of the classes that fit where one side has no pin. Rows of a class say the same; they
    meet by a key in a city that does not differ, once, at the first key that both have; of same_address alone all strong pairs are. A
    target that someone rejected is a class of its own. first: the first two rows of cls2. The classes of a key's sources are dealt to DEALT
    parts, each with all targets of the key."""
    no_pin = [F.lit(None).cast("double").alias(c) for c in ("lat", "lng")]
    one = lambda df, n, i, extra: df.groupBy(F.col("cls").alias(f"cls{n}")).agg(F.any_value(F.struct("keys", "pinned", extra, F.struct(*SAID, *no_pin).alias(i))).alias("x")).select(f"cls{n}", F.col("x.keys").alias(f"k{n}"), f"x.{i}", f"x.{extra}", "x.pinned")
    first = targets.withColumn("_n", F.row_number().over(Window.partitionBy("cls").orderBy("ord2", "id"))).where("_n <= 2").groupBy(F.col("cls").alias("cls2")).agg(F.collect_list(F.struct("ord2", F.col("id").alias("id2"))).alias("first"))
    s, t = one(sources, 1, "s", "gone"), one(targets, 2, "t", "only").join(first, "cls2")
    said = lambda i, what: F.nullif(F.col(f"{i}.{what}"), F.lit(""))
    city, every, none = (lambda i: F.concat(F.lit("="), said(i, "city"))), F.lit("every"), F.lit("none")
    # a source without a pin meets all targets, one with a pin those without; one without a city meets all cities, one with a city its own and none
    s_city = F.when(city("s").isNull(), F.array(every)).otherwise(F.array(city("s"), none))
    t_pin = F.when(F.col("pinned"), F.array(F.lit("no pin"))).otherwise(F.array(F.lit("pin"), F.lit("no pin")))
    by = ["key", "city", "pin", "part", *(["address"] if same_address else [])]
    s = s.select("cls1", "k1", "s", "gone", said("s", "address").alias("address"), F.explode(s_city).alias("city"), F.when(F.col("pinned"), "pin").otherwise("no pin").alias("pin"))
    s = s.withColumn("part", F.pmod(F.xxhash64("cls1"), F.lit(DEALT)).cast("int")).withColumn("key", F.explode("k1"))
    t = t.select("cls2", "k2", "t", "only", "first", said("t", "address").alias("address"), F.explode(F.array(F.coalesce(city("t"), none), every)).alias("city"), t_pin.alias("pins"))
    t = t.withColumn("pin", F.explode("pins")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1)))).withColumn("key", F.explode("k2"))
    if same_address:
        s, t = s.where("address IS NOT NULL"), t.where("address IS NOT NULL")
    else:
        s, t = s.drop("address"), t.drop("address")
    n = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = F.get(F.array_intersect("k1", "k2"), F.lit(0)) == F.col("key")
    met = s.repartition(n, *by).join(t.repartition(n, *by), by).where(once & ~F.coalesce(F.array_contains("gone", F.col("only")), F.lit(False)))
    return judged(met).select("cls1", "cls2", "strong", "method", "confidence", "first")


def _members(pairs: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """The pairs of rows behind pairs of classes."""
    s = sources.select(F.col("cls").alias("cls1"), F.col("id").alias("id1"), "ord", "platform")
    t = targets.select(F.col("cls").alias("cls2"), F.col("id").alias("id2"), "ord2")
    return pairs.join(s, "cls1").join(t, "cls2").where("ord2 IS NULL OR ord2 < ord").select(*_EDGE)


def _edges(sources: DataFrame, targets: DataFrame, gone: DataFrame | None = None) -> DataFrame:
    """The pairs that fit, judged (id1, id2, ord, ord2, platform, strong, method, confidence), of sources (id, ord, platform, signals, cls,
    gone) with targets (id, ord2, signals, cls, only) that are stored (no ord2) or come before: all strong ones and, of the others, all
    between two pins and otherwise the first two of a listing at each confidence. No more is asked of them than the best and whether there
    are several, so these are found for whole classes: the first two targets of each class, and of these the first two for each class."""
    near = _near(sources, targets)
    near = near if gone is None else near.join(gone, ["id1", "id2"], "left_anti")
    place = F.row_number().over(Window.partitionBy("cls1", "confidence").orderBy("ord2", "id2"))
    weak = _class_pairs(sources, targets).where("NOT strong").select("cls1", "strong", "method", "confidence", F.inline("first")).withColumn("_n", place).where("_n <= 2")
    s = sources.select(F.col("cls").alias("cls1"), F.col("id").alias("id1"), "ord", "platform")
    weak = s.join(weak, "cls1").where("ord2 IS NULL OR ord2 < ord").select(*_EDGE)
    strong = _members(_class_pairs(sources, targets, same_address=True).where("strong"), sources, targets)
    return near.select(*_EDGE).unionByName(weak).unionByName(strong)


def plan(listings: DataFrame, groups: DataFrame, mappings: DataFrame, rejected: DataFrame, folder: str | None = None) -> DataFrame:
    """Id, outcome, status, method, confidence, group_id (stored) or seed (a listing that becomes a group), conflict, for every listing.

    listings: id (unique), created_at, platform and the signals; groups: group_id and the signals; mappings: id, group_id, status of the
    mapping that holds now (one for each listing at most, also of listings not in this run, with their platform); rejected: id, group_id.
    Listings that are matched or in review stay. Unmatched ones are looked at again and are told UNMATCHED if they stay so. A null
    created_at comes first. Pins out of range are none; empty texts say nothing."""
    spark = listings.sparkSession
    folder = folder or shared_folder(spark)

    def put(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    good = valid(F.col("lat"), F.col("lng"))
    pins = lambda df: df.withColumns({c: F.when(good, F.col(c)) for c in ("lat", "lng")})
    held = mappings.where("status IN ('MATCHED', 'REVIEW')")
    open_ = pins(listings.join(held.select("id"), "id", "left_anti"))
    order = F.struct(F.col("created_at").isNotNull(), F.col("created_at"), F.col("id"))
    bare_groups = groups.select(F.concat(F.lit("g:"), "group_id").alias("id2"))
    gone = put(rejected.select(F.concat(F.lit("r:"), "id").alias("id1"), F.concat(F.lit("g:"), "group_id").alias("id2")).distinct().join(bare_groups, "id2", "left_semi"), "gone")
    # listings that say the same and have the same rejections are one class, stored groups that say the same and were never rejected
    refused = gone.groupBy(F.col("id1").alias("id")).agg(F.sort_array(F.collect_set("id2")).alias("gone"))
    rows = _keyed(open_.select(F.concat(F.lit("r:"), "id").alias("id"), order.alias("ord"), "platform", *SIGNALS)).join(refused, "id", "left")
    rows = put(rows.withColumn("cls", _digest("look", "gone")), "rows")
    only = gone.select(F.col("id2").alias("id")).distinct().withColumn("only", F.col("id"))
    known = _keyed(pins(groups).select(F.concat(F.lit("g:"), "group_id").alias("id"), *SIGNALS)).join(only, "id", "left")
    known = put(known.withColumn("ord2", F.lit(None).cast(rows.schema["ord"].dataType)).withColumn("cls", _digest("look", "only")), "known")
    stored = put(_edges(rows, known, gone), "edges")
    # only listings that fit no stored group can start one, so these alone meet each other; all meet those that do
    plain = rows.withColumn("gone", F.lit(None).cast("array<string>")).withColumn("cls", F.col("look"))
    as_targets = lambda df: df.select("id", F.col("ord").alias("ord2"), *SIGNALS, "keys", "pinned", F.lit(None).cast("string").alias("only"), "cls")
    open_rows = put(plain.where(_located()).join(stored.select(F.col("id1").alias("id")).distinct(), "id", "left_anti"), "open")
    themselves = as_targets(open_rows)
    among = put(_near(open_rows, themselves).select("id1", "id2").unionByName(_members(_class_pairs(open_rows, themselves), open_rows, themselves).select("id1", "id2")), "among")
    starts = put(_starters(open_rows, among, put), "starts")
    fit = stored.unionByName(put(_edges(plain, as_targets(open_rows.join(starts, "id", "left_semi"))), "new"))
    # what starts a group has no fit; its own platform is taken from the beginning
    taken = held.where("status = 'MATCHED'").select(F.concat(F.lit("g:"), "group_id").alias("id2"), "platform").unionByName(starts.join(rows.select("id", "platform"), "id").select(F.col("id").alias("id2"), "platform")).distinct()
    # platforms matter to strong pairs alone
    strong = fit.where("strong").join(taken.withColumn("taken", F.lit(True)), ["id2", "platform"], "left").select(*_EDGE, F.coalesce("taken", F.lit(False)).alias("taken"))
    fit = put(strong.unionByName(fit.where("NOT strong").withColumn("taken", F.lit(False))), "fit")
    matched = _matches(fit, put)
    told = _told(fit, matched)
    place = rows.select(F.col("id").alias("id1"), _located().alias("located")).join(told.select("id1"), "id1", "left_anti")
    if_placed = lambda yes, no=None: F.when(F.col("located"), yes).otherwise(no)
    new = place.select("id1", if_placed("GROUP_CREATED", "UNMATCHED").alias("outcome"), if_placed("MATCHED", "UNMATCHED").alias("status"), if_placed("SEED").alias("method"), if_placed(1.0).alias("confidence"), if_placed(F.col("id1")).alias("target"), F.when(~F.col("located"), "BRANCH_IDENTITY_UNKNOWN").alias("conflict"))
    bare = lambda c, kind: F.when(F.startswith(c, F.lit(kind)), F.substring(c, 3, 1 << 30))
    decided = told.unionByName(new).select(bare(F.col("id1"), "r:").alias("id"), "outcome", "status", "method", "confidence", bare(F.col("target"), "g:").alias("group_id"), bare(F.col("target"), "r:").alias("seed"), "conflict")
    kept = listings.select("id").join(held, "id").select(F.col("id").cast("string").alias("id"), F.lit("ALREADY_MAPPED").alias("outcome"), "status", F.lit(None).cast("string").alias("method"), F.lit(None).cast("double").alias("confidence"), F.col("group_id").cast("string").alias("group_id"), F.lit(None).cast("string").alias("seed"), F.lit(None).cast("string").alias("conflict"))
    return put(decided.unionByName(kept), "plan")


def _located() -> Column:
    """A listing without address, area and pin cannot tell its branch."""
    return F.nullif(F.col("address"), F.lit("")).isNotNull() | F.nullif(F.col("area"), F.lit("")).isNotNull() | F.col("lat").isNotNull()


def _starters(rows: DataFrame, among: DataFrame, put) -> DataFrame:
    """id of the listings that become groups, of those that can; among: id1 fits the earlier id2."""
    state = put(rows.select("id", F.lit(None).cast("boolean").alias("starts")), "state-0")
    step = 0
    while True:
        step += 1
        seen = among.join(state.select(F.col("id").alias("id2"), F.col("starts").alias("other")), "id2").groupBy(F.col("id1").alias("id")).agg(F.max(F.coalesce("other", F.lit(False))).alias("some"), F.max(F.col("other").isNull()).alias("waits"))
        now = F.coalesce("starts", F.when(F.col("some"), False), F.when(~F.coalesce("waits", F.lit(False)), True))
        state = put(state.join(seen, "id", "left").select("id", now.alias("starts")), f"state-{step}")
        if not state.where("starts IS NULL").limit(1).count():
            return state.where("starts").select("id")


def _matches(fit: DataFrame, put) -> DataFrame:
    """id1, id2 of the matches: a listing with exactly one strong group whose platform is free when its turn comes."""
    strong = put(fit.where("strong").select("id1", "id2", "ord", "platform", "taken"), "strong-0")
    none = strong.where("taken").select("id1", "id2").limit(0)
    matches, step = none, 0
    while strong.where("NOT taken").limit(1).count():
        step += 1
        free = strong.where("NOT taken")
        first = free.groupBy("id2", "platform").agg(F.min("ord").alias("first"))
        turn = free.join(first, ["id2", "platform"]).groupBy("id1").agg(F.min(F.col("ord") == F.col("first")).alias("ready"), F.count("*").alias("n"), F.min("id2").alias("id2")).where("ready")
        turn = put(turn.select("id1", "n", "id2"), f"turn-{step}")
        new = turn.where("n = 1").select("id1", "id2")
        matches = put(matches.union(new), f"matches-{step}")
        rest = strong.join(turn.select("id1"), "id1", "left_anti")
        claimed = new.join(fit.select("id1", "id2", "platform"), ["id1", "id2"]).select("id2", "platform").distinct().withColumn("now", F.lit(True))
        strong = put(rest.join(claimed, ["id2", "platform"], "left").select("id1", "id2", "ord", "platform", (F.col("taken") | F.coalesce("now", F.lit(False))).alias("taken")), f"strong-{step}")
    return matches


def _told(fit: DataFrame, matches: DataFrame) -> DataFrame:
    """E6 for every listing that fits a group: its match, or the best to review. Which strong groups were free at its turn follows from the matches of earlier ones."""
    claims = matches.join(fit.select("id1", "id2", "ord", "platform"), ["id1", "id2"]).select("id2", "platform", F.col("ord").alias("since"))
    free = ~F.col("taken") & F.coalesce(F.col("since") >= F.col("ord"), F.lit(True))
    strong = fit.where("strong").join(claims, ["id2", "platform"], "left").withColumn("match", free).drop("since")
    rows = strong.unionByName(fit.where("NOT strong").withColumn("match", F.lit(False)))
    # stored groups are older than those of this run; these are in the order of their listings
    confidence = F.when(F.col("match") | ~F.col("strong"), F.col("confidence")).otherwise(0.5)
    rank = F.struct((-confidence).alias("c"), F.col("ord2").isNotNull().alias("new"), F.col("ord2").alias("ord2"), F.col("id2").alias("id2"))
    value = F.struct("id2", "method", confidence.alias("confidence"), (F.col("strong") & ~F.col("match")).alias("again"))
    per = rows.groupBy("id1").agg(F.count_if("match").alias("n"), F.count("*").alias("every"), F.min_by(value, F.when(F.col("match"), rank)).alias("m"), F.min_by(value, rank).alias("b"))
    one, several = F.col("n") == 1, F.col("n") > 1
    top = F.when(F.col("n") >= 1, F.col("m")).otherwise(F.col("b"))
    conflict = F.when(several | ((F.col("n") == 0) & (F.col("every") > 1)), "MULTIPLE_CANDIDATES").when((F.col("n") == 0) & F.col("b.again"), "SAME_PLATFORM_ALREADY_MAPPED")
    return per.select("id1", F.when(one, "MATCHED_EXISTING_GROUP").otherwise("REVIEW").alias("outcome"), F.when(one, "MATCHED").otherwise("REVIEW").alias("status"), top["method"].alias("method"), F.when(several, 0.5).otherwise(top["confidence"]).alias("confidence"), top["id2"].alias("target"), conflict.alias("conflict"))
