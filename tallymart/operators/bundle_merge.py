"""Bundles of one run that are the same product, by name or by a listing, merged in their order.

Taken one by one, a bundle joins the survivor that the first of its keys (the name, then its listings) points to, and from then
on all its keys point there, also those that pointed elsewhere. So a key always points to the survivor of the last bundle that
had it: a bundle's parent is the bundle before it under the first of its keys that any bundle had before, and its survivor is
where its parents end. No order of work is left in this but the order of the rows: parents come from one pass over the keys,
their ends from pointer doubling, in as many steps as the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.marketplace import offer_key
from tallymart.functions.text import name_key
from tallymart.operators.files import shared_folder

#: Rows of one key that one task puts in order; a key that more bundles have is taken in blocks of the bundles' numbers.
BLOCK = 1 << 16


def bundle_keys(name: Column, retailers: Column) -> Column:
    """The name's key, then each listing's: by the shop's id of it, else by its address. Listings with neither give none."""
    by_id = lambda r: F.when(r["external_id"] != "", F.concat_ws(":", r["retailer"], F.lit("id"), r["external_id"]))
    listings = F.coalesce(F.transform(retailers, lambda r: F.coalesce(by_id(r), offer_key(r["retailer"], r["url"]))), F.array().cast("array<string>"))
    return F.array_distinct(F.array_compact(F.concat(F.array(F.concat(F.lit("name:"), name_key(name))), listings)))


def parents(keys: DataFrame) -> DataFrame:
    """seq and parent from (seq, at, key): the last bundle before it under its first key that has one; itself if no key has."""
    rows = keys.withColumn("block", F.floor(F.col("seq") / BLOCK))
    within = Window.partitionBy("key", "block").orderBy("seq")
    rows = rows.withColumn("before", F.lag("seq").over(within))
    last = rows.groupBy("key", "block").agg(F.max("seq").alias("last"))
    earlier = last.withColumn("carried", F.lag("last").over(Window.partitionBy("key").orderBy("block"))).where("carried IS NOT NULL").select("key", "block", "carried")
    first = rows.where("before IS NULL").join(earlier, ["key", "block"], "left").withColumn("before", F.col("carried")).drop("carried")
    every = rows.where("before IS NOT NULL").unionByName(first)
    return every.groupBy("seq").agg(F.coalesce(F.min_by("before", F.when(F.col("before").isNotNull(), F.col("at"))), F.col("seq")).alias("parent"))


def survivors(keys: DataFrame, folder: str) -> DataFrame:
    """seq and survivor: the end of each bundle's chain of parents."""
    spark = keys.sparkSession
    at = f"{folder}/chain-0"
    parents(keys).write.parquet(at)
    for step in range(1, 64):
        chain = spark.read.parquet(at)
        up = chain.select(F.col("seq").alias("parent"), F.col("parent").alias("above"))
        at = f"{folder}/chain-{step}"
        chain.join(up, "parent").select("seq", F.col("above").alias("parent"), (F.col("above") != F.col("parent")).alias("moved")).write.parquet(at)
        if not spark.read.parquet(at).where("moved").limit(1).count():
            break
    return spark.read.parquet(at).select("seq", F.col("parent").alias("survivor"))


def merged(bundles: DataFrame, folder: str | None = None) -> DataFrame:
    """One row for each survivor of bundles (seq, unique; name, retailers (retailer, external_id, url, price, in_stock, observed_at),
    tags, images, description, rating, review_count, retailer_count, lowest_price, highest_price), named by its first bundle's seq.

    Rows without a name are left out. Of a shop's offers the newest stays, of equally new ones the later, in the place of the
    shop's first; tags are added in order; the first of the longest galleries, the first description and the rating with most
    reviews (the first of these) stay. Prices count offers not known to be out of stock, and only of merged bundles: a bundle
    alone keeps its own. Null lists are empty."""
    spark = bundles.sparkSession
    folder = folder or shared_folder(spark)
    b = bundles.where("name <> ''")
    keys = b.select("seq", F.posexplode(bundle_keys(F.col("name"), F.col("retailers"))).alias("at", "key"))
    rows = b.join(survivors(keys, folder), "seq")
    first = F.col("seq") == F.col("survivor")
    by = lambda c, order: F.max_by(c, order)
    size = F.coalesce(F.size(F.filter("images", lambda _: F.lit(True))), F.lit(0))
    base = rows.groupBy("survivor").agg(
        F.count("*").alias("members"),
        *(F.min_by(c, "seq").alias(c) for c in ("name", "retailer_count", "lowest_price", "highest_price")),
        by("images", F.struct(size, -F.col("seq"))).alias("images"),
        F.min_by("description", F.when(F.col("description").isNotNull(), F.col("seq"))).alias("description"),
        *(by(c, F.struct(F.coalesce("review_count", F.lit(-1)), -F.col("seq"))).alias(c) for c in ("rating", "review_count")),
    )
    offers = rows.select("survivor", "seq", first.alias("own"), F.posexplode("retailers").alias("at", "o"))
    # a first bundle may name a shop twice; what comes later meets the first of these
    again = F.row_number().over(Window.partitionBy("seq", "o.retailer").orderBy("at")) - 1
    offers = offers.withColumn("again", F.when(F.col("own"), again).otherwise(0))
    kept = offers.groupBy("survivor", F.col("o.retailer").alias("retailer"), "again").agg(F.min(F.struct("seq", "at")).alias("place"), by("o", F.struct(F.coalesce(F.col("o.observed_at").cast("string"), F.lit("")), F.col("seq"), F.col("at"))).alias("o"))
    shops = kept.groupBy("survivor").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "o"))), lambda x: x["o"]).alias("retailers"))
    tagged = rows.select("survivor", "seq", F.posexplode("tags").alias("at", "tag")).groupBy("survivor", "tag").agg(F.min(F.struct("seq", "at")).alias("place"))
    tags = tagged.groupBy("survivor").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "tag"))), lambda x: x["tag"]).alias("tags"))
    every = base.join(shops, "survivor", "left").join(tags, "survivor", "left")
    priced = F.transform(F.filter("retailers", lambda o: (o["price"] > 0) & F.coalesce(o["in_stock"], F.lit(True))), lambda o: o["price"])
    many = F.col("members") > 1
    some = lambda c: F.coalesce(c, F.array().cast(bundles.schema[c].dataType)).alias(c)
    return every.select(
        F.col("survivor").alias("seq"), "name", "members", some("retailers"), some("tags"), some("images"), "description", "rating", "review_count",
        F.when(many, F.coalesce(F.size("retailers"), F.lit(0))).otherwise(F.col("retailer_count")).alias("retailer_count"),
        F.when(many, F.array_min(priced)).otherwise(F.col("lowest_price")).alias("lowest_price"),
        F.when(many, F.array_max(priced)).otherwise(F.col("highest_price")).alias("highest_price"),
    )
