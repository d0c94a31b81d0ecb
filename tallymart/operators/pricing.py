"""Offer economics: price ranges, staleness, the cheapest offer with its ties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def price_ranges(offers: DataFrame, key: str = "product_id") -> DataFrame:
    """Q1 over offers with price, in_stock (null: unknown), is_stale and retailer_id. Unavailable offers leave the range; only available ones confirm a price."""
    live = ~F.col("is_stale") & F.col("price").isNotNull()
    comparable = live & F.coalesce(F.col("in_stock"), F.lit(True))
    confirmed = live & F.coalesce(F.col("in_stock"), F.lit(False))
    return offers.groupBy(key).agg(
        F.min(F.when(comparable, F.col("price"))).alias("lowest_price"),
        F.max(F.when(comparable, F.col("price"))).alias("highest_price"),
        F.min(F.when(confirmed, F.col("price"))).alias("best_confirmed"),
        F.count_distinct(F.when(comparable, F.col("retailer_id"))).alias("n_comparable"),
    )


def mark_stale(offers: DataFrame, cutoff: str) -> DataFrame:
    """M7: an offer last seen before the cutoff is stale and its stock unknown; one never seen is left alone."""
    stale = F.coalesce(F.col("observed_at") < F.lit(cutoff).cast("timestamp"), F.lit(False))
    return offers.withColumn("is_stale", stale).withColumn("in_stock", F.when(~stale, F.col("in_stock")))


def cheapest(offers: DataFrame, key: str, currency: str) -> DataFrame:
    """Q7: lowest eligible price per key and currency, all sellers that ask it, and the verdict over currencies."""
    fit = offers.where(F.col("price").isNotNull() & F.coalesce(F.col("in_stock"), F.lit(False)))
    lowest = fit.groupBy(key, currency).agg(F.min("price").alias("price"))
    ties = fit.join(lowest, [key, currency, "price"]).groupBy(key, currency, "price").agg(F.array_join(F.array_sort(F.collect_set("retailer_id")), ",").alias("sellers"))
    spread = ties.groupBy(key).agg(F.count("*").alias("n_currencies"))
    return ties.join(spread, key).withColumn("verdict", F.when(F.col("n_currencies") > 1, "MIXED_CURRENCIES").otherwise("OK"))
