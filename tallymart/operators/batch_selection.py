"""Which candidates of two platforms a batch takes, against quotas that all tiers share.

Taken one by one, most popular first: pairs of one brand and place on both platforms, then control pairs of one brand in different
places (one a brand), then others, a few of each brand. The same choice without that order of work: pairs are a matching in which,
round by round, every pair is taken that is the first one left for both of its ends; of the matching, the first pairs up to the
smaller quota count, as a quota only ends a list, so pairs that must come after these are never made or are left out. Controls are the first of each brand, the rest is a rank within brands; each
is cut where the quota ends. Equally popular candidates go by their id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.operators.files import shared_folder

SELECTED = "id string, platform string, tier string, pair_key string"


def popularity(rating_count: Column, rating: Column) -> Column:
    """O8."""
    return F.coalesce(rating_count, F.lit(0)) * 10 + F.coalesce(rating, F.lit(0.0))


def pairs(first: DataFrame, second: DataFrame) -> DataFrame:
    """id1, id2, ord1, ord2, pair_key of candidates of one brand that share a word of their place."""
    side = lambda df, n: df.select(F.col("id").alias(f"id{n}"), F.col("ord").alias(f"ord{n}"), "brand", F.explode(F.array_distinct("areas")).alias("area"))
    shared = side(first, 1).join(side(second, 2), ["brand", "area"]).groupBy("brand", "id1", "id2").agg(F.min("ord1").alias("ord1"), F.min("ord2").alias("ord2"), F.array_join(F.sort_array(F.collect_set("area")), "+").alias("areas"))
    return shared.select("id1", "id2", "ord1", "ord2", "brand", F.concat_ws(":", "brand", "areas").alias("pair_key"))


def foremost(candidates: DataFrame, most: int) -> DataFrame:
    """Candidates that the first `most` pairs can hold: the first ones of each brand and set of areas. Those behind them have the
    same partners, and a candidate is passed over for good only if all of these are taken, so they come after `most` pairs."""
    alike = Window.partitionBy("brand", F.array_sort(F.array_distinct("areas"))).orderBy("ord")
    return candidates.withColumn("_n", F.row_number().over(alike)).where(F.col("_n") <= most).drop("_n")


def matching(edges: DataFrame, folder: str, most: int | None = None) -> DataFrame:
    """The edges that are taken one after the other by (ord1, ord2), each if neither end is taken yet; with `most` at least the
    first so many of them. Once that many are taken, what comes after them cannot be among the first and is left out."""
    spark = edges.sparkSession
    if most is not None and most <= 0:
        return edges.limit(0)

    def put(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    left, taken, step = put(edges, "edges"), edges.limit(0), 0
    while left.limit(1).count():
        step += 1
        at = F.struct("ord1", "ord2")
        best = {n: left.groupBy(f"id{n}").agg(F.min(at).alias(f"best{n}")) for n in (1, 2)}
        now = put(left.join(best[1], "id1").join(best[2], "id2").where((at == F.col("best1")) & (at == F.col("best2"))).select(*edges.columns), f"taken-{step}")
        taken = taken.unionByName(now)
        rest = left.join(now.select("id1"), "id1", "left_anti").join(now.select("id2"), "id2", "left_anti").select(*edges.columns)
        if most is not None and taken.count() >= most:
            last = taken.select(at.alias("at")).orderBy("at").limit(most).agg(F.max("at").alias("last"))
            rest = rest.crossJoin(F.broadcast(last)).where(at < F.col("last")).drop("last")
        left = put(rest, f"left-{step}")
    return taken


def selected(candidates: DataFrame, quota: dict[str, int], platforms: tuple[str, str], controls: int = 0, per_brand: int = 2, folder: str | None = None) -> DataFrame:
    """id, platform, tier (PAIR, CONTROL, FILL) and pair_key of what the batch takes.

    candidates: id, platform, brand (a key of the name; without one a candidate is left out), areas (words of its place), rating,
    rating_count. The numbers taken are bounded by the quotas, so a list is cut by a top-k, never by one sorted partition."""
    spark = candidates.sparkSession
    folder = folder or shared_folder(spark)
    order = F.struct((-popularity(F.col("rating_count"), F.col("rating"))).alias("p"), F.col("id").alias("i"))
    rows = candidates.where(F.col("brand") != "").select("id", "platform", "brand", F.coalesce("areas", F.array().cast("array<string>")).alias("areas"), order.alias("ord"))
    rows.write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    a, b = (rows.where(F.col("platform") == p) for p in platforms)
    left = {p: max(0, quota.get(p, 0)) for p in platforms}

    def put(df: DataFrame, name: str, *by: str, most: int) -> DataFrame:
        df.orderBy(*by).limit(most).write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def spent(chosen: DataFrame) -> int:
        n = chosen.count()
        for p in platforms:
            left[p] -= n
        return n

    most = min(left.values())
    both = put(matching(pairs(foremost(a, most), foremost(b, most)), folder, most), "pairs", "ord1", "ord2", most=most)
    spent(both)
    tried = both.select("brand").distinct()
    head = lambda df, n: df.join(tried, "brand", "left_anti").groupBy("brand").agg(F.min(F.struct("ord", "id")).alias("x")).select("brand", F.col("x.id").alias(f"id{n}"), F.col("x.ord").alias(f"ord{n}"))
    control = head(a, 1).join(head(b, 2), "brand").withColumn("pair_key", F.concat(F.lit("control:"), "brand"))
    control = put(control, "controls", "ord1", most=min(controls, *left.values()))
    spent(control)
    out = []
    for tier, chosen in (("PAIR", both), ("CONTROL", control)):
        out += [chosen.select(F.col(f"id{n}").alias("id"), F.lit(p).alias("platform"), "brand", F.lit(tier).alias("tier"), "pair_key") for n, p in ((1, platforms[0]), (2, platforms[1]))]
    chosen = out[0]
    for x in out[1:]:
        chosen = chosen.unionByName(x)
    for p, side in zip(platforms, (a, b)):
        mine = chosen.where(F.col("platform") == p)
        had = mine.groupBy("brand").agg(F.count("*").alias("had"))
        rest = side.join(mine.select("id"), "id", "left_anti").join(had, "brand", "left")
        place = F.row_number().over(Window.partitionBy("brand").orderBy("ord"))
        fill = rest.withColumn("place", place).where(F.col("place") <= per_brand - F.coalesce("had", F.lit(0)))
        fill = put(fill, f"fill-{p}", "ord", most=left[p])
        out.append(fill.select("id", F.lit(p).alias("platform"), "brand", F.lit("FILL").alias("tier"), F.lit(None).cast("string").alias("pair_key")))
    every = out[0]
    for x in out[1:]:
        every = every.unionByName(x)
    return every.select("id", "platform", "tier", "pair_key")
