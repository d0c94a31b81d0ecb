"""Upsert of observed products: which stored product each belongs to, the fold of its offers, and the fields that change."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.text import name_key


def match_targets(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """For every incoming row (seq, name, match_key, keys array<string>) the stored row (id, name, match_key, keys) that it
    belongs to, and by what: 1 a shared key of a listing, 2 the match key, 3 the name. The lowest id wins within a kind; null
    without a hit. Null names, keys and match keys meet nothing. One equi-join over all kinds; hits are reduced before the
    shuffle to incoming rows."""

    def keyed(df: DataFrame, key: str) -> DataFrame:
        kinds = F.array(
            F.struct(F.lit(1).alias("kind"), F.coalesce("keys", F.array().cast("array<string>")).alias("values")),
            F.struct(F.lit(2).alias("kind"), F.array("match_key").alias("values")),
            F.struct(F.lit(3).alias("kind"), F.array(name_key(F.col("name"))).alias("values")),
        )
        rows = df.select(key, F.explode(kinds).alias("k")).select(key, "k.kind", F.explode("k.values").alias("value"))
        return rows.where("value IS NOT NULL")

    # of the rows that hold a value only the lowest id can win, so a frequent value joins once
    holders = keyed(stored, "id").groupBy("kind", "value").agg(F.min("id").alias("id"))
    hits = keyed(incoming, "seq").join(holders, ["kind", "value"]).groupBy("seq").agg(F.min(F.struct("kind", "id")).alias("best"))
    return incoming.select("seq").join(hits, "seq", "left").select("seq", F.col("best.id").alias("id"), F.col("best.kind").alias("kind"))


def observed_offers(offers: DataFrame) -> DataFrame:
    """M2: a priceless observation says something only if it says that the offer is unavailable."""
    priced = F.when((F.col("price") > 0) & ~F.isnan("price"), F.col("price"))
    return offers.withColumn("price", priced).where("price IS NOT NULL OR in_stock = false")


def folded_offers(stored: DataFrame, incoming: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """M3/M5 for several observations of one offer, taken in order of `seq` (unique within a key, not negative): keys, price, in_stock, observed_at.

    An observation counts unless an earlier one that counts, or the stored row, has a later time; one without a time counts
    only while there is none. A priceless one takes the stock away and keeps the price; before there is an offer it is
    dropped. Each observation depends on those before it, so the observations of one offer are sorted in one task."""
    columns = ["price", "in_stock", "observed_at"]
    old = stored.select(*keys, F.lit(-1).cast("long").alias("at"), *columns, F.lit(True).alias("opens"))
    new = observed_offers(incoming).select(*keys, F.col(seq).cast("long").alias("at"), "price", F.when(F.col("price").isNull(), False).otherwise(F.col("in_stock")).alias("in_stock"), "observed_at", F.col("price").isNotNull().alias("opens"))
    w = Window.partitionBy(*keys).orderBy("at")
    rows = old.union(new).withColumn("open", F.max("opens").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("open")
    rows = rows.withColumn("before", F.max("observed_at").over(w.rowsBetween(Window.unboundedPreceding, -1))).where("before IS NULL OR observed_at >= before")
    return rows.groupBy(*keys).agg(
        F.max_by("price", F.when(F.col("price").isNotNull(), F.col("at"))).alias("price"), F.max_by("in_stock", "at").alias("in_stock"), F.max("observed_at").alias("observed_at")
    )


def written_products(stored: DataFrame, incoming: DataFrame, targets: DataFrame, fill: list[str], refresh: list[str]) -> DataFrame:
    """M5/K1: the next snapshot (id, fields, `status`, `n_incoming`). Several incoming rows of one product are folded in order of
    seq: `fill` takes the first value where none is stored, `refresh` the last value that came in. Rows without a target make new
    products (id null), one for each name, from the first row with a price and an image on; rows before that are skipped."""

    def folded(rows: DataFrame, key: str) -> DataFrame:
        first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in fill]
        last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in refresh]
        return rows.groupBy(key).agg(*first, *last, F.count("*").alias("n_incoming"))

    rows = incoming.join(targets.select("seq", "id"), "seq", "left")
    known = folded(rows.where("id IS NOT NULL"), "id").alias("i")
    s = stored.alias("s")
    kept = [F.coalesce(f"s.{c}", f"i.{c}").alias(c) for c in fill] + [F.coalesce(f"i.{c}", f"s.{c}").alias(c) for c in refresh]
    status = F.when(F.col("i.id").isNull(), "kept").otherwise("updated")
    old = s.join(known, F.col("s.id") == F.col("i.id"), "left").select("s.id", *kept, status.alias("status"), F.coalesce("i.n_incoming", F.lit(0)).alias("n_incoming"))
    fresh = rows.where("id IS NULL AND name IS NOT NULL").withColumn("_key", name_key(F.col("name")))
    opening = fresh.where("insertable").groupBy("_key").agg(F.min("seq").alias("_from"))
    new = folded(fresh.join(opening, "_key").where("seq >= _from"), "_key")
    id_type = stored.schema["id"].dataType
    return old.union(new.select(F.lit(None).cast(id_type).alias("id"), *fill, *refresh, F.lit("created").alias("status"), "n_incoming"))


def unchanged_since(read: DataFrame, current: DataFrame, key: str = "id", version: str = "updated_at") -> DataFrame:
    """M6: rows that were read, with whether their version is still the stored one (two nulls agree); a row that is gone conflicts."""
    now = current.select(F.col(key).alias("_key"), F.col(version).alias("_now"))
    j = read.join(now, read[key] == now["_key"], "left")
    return j.select(*read.columns, (F.col("_key").isNotNull() & F.col(version).eqNullSafe(F.col("_now"))).alias("writable"))


def union_all(*parts: DataFrame) -> DataFrame:
    """The rows of all parts, columns by name."""
    return reduce(DataFrame.unionByName, parts)
