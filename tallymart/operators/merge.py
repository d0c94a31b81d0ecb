"""Merges of snapshots: newer wins, fill only, field diffs, histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first in `order`, which must be total. The limit is applied before the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_at", F.row_number().over(w)).where("_at = 1").drop("_at")


def fill_only(stored: DataFrame, incoming: DataFrame, key: str, fill: list[str], refresh: list[str]) -> DataFrame:
    """M4: stored values of `fill` stay where present, those of `refresh` give way where something came in."""
    s, i = stored.alias("s"), incoming.alias("i")
    pick = [F.coalesce(f"s.{c}", f"i.{c}").alias(c) for c in fill] + [F.coalesce(f"i.{c}", f"s.{c}").alias(c) for c in refresh]
    action = F.when(F.col(f"s.{key}").isNull(), "created").when(F.col(f"i.{key}").isNull(), "kept").otherwise("updated")
    return s.join(i, F.col(f"s.{key}") == F.col(f"i.{key}"), "full_outer").select(F.coalesce(f"s.{key}", f"i.{key}").alias(key), *pick, action.alias("action"))


def newer_wins(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """M3, one row per key on either side: an older observation changes nothing, and one without a time is older than a stored
    one that has a time; a stored one without a time gives way. A priceless observation says that the offer is unavailable:
    it takes the stock of a stored offer alone, and makes no new one."""
    s, i = stored.alias("s"), incoming.alias("i")
    on = [F.col(f"s.{k}") == F.col(f"i.{k}") for k in keys]
    has_s, has_i = F.col(f"s.{keys[0]}").isNotNull(), F.col(f"i.{keys[0]}").isNotNull()
    seen, came = F.col("s.observed_at"), F.col("i.observed_at")
    older = has_s & has_i & seen.isNotNull() & F.coalesce(came < seen, F.lit(True))
    keep = ~has_i | older
    gone = F.col("i.price").isNull()
    price = F.when(keep | gone, F.col("s.price")).otherwise(F.col("i.price")).alias("price")
    stock = F.when(keep, F.col("s.in_stock")).when(gone, False).otherwise(F.col("i.in_stock")).alias("in_stock")
    at = F.when(keep, seen).otherwise(F.coalesce(came, seen)).alias("observed_at")
    return s.join(i, on, "full_outer").where(has_s | ~gone).select(*[F.coalesce(f"s.{k}", f"i.{k}").alias(k) for k in keys], price, stock, at)


def field_diff(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Q9: one row per changed field (key, action, field, before, after); rows that vanished are not reported."""
    b, a = before.alias("b"), after.alias("a")
    made = F.col(f"b.{key}").isNull()
    text = lambda c: F.col(c).cast("string")
    entries = F.array(*[F.struct(F.lit(c).alias("field"), text(f"b.{c}").alias("before"), text(f"a.{c}").alias("after")) for c in fields])
    rows = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "left").select(F.col(f"a.{key}").alias(key), F.when(made, "created").otherwise("updated").alias("action"), F.explode(entries).alias("e"))
    changed = rows.where(~F.col("e.before").eqNullSafe(F.col("e.after")))
    return changed.select(key, "action", "e.field", "e.before", "e.after")


def history(df: DataFrame, item: str, at: str, tie: str) -> DataFrame:
    """Every decision with the one it supersedes, when it was superseded, and whether it is active."""
    w = Window.partitionBy(item).orderBy(at, tie)
    return df.withColumns({"superseded_at": F.lead(at).over(w), "supersedes": F.lag(tie).over(w)}).withColumn("active", F.col("superseded_at").isNull())


def missing_from(stored: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Stored rows whose key was not seen."""
    return stored.join(seen.select(key).distinct(), key, "left_anti")
