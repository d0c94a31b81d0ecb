"""Which offers of an item may be its cheapest, why others may not, their order, and the cheapest with its ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The order of platforms, and what availability a listing can have.
PLATFORMS = ("deliveroo", "talabat", "careem")
KNOWN = ("available", "unavailable", "unknown")


def availability(status: Column, flag: Column) -> Column:
    """available, unavailable or unknown; a status that contradicts the flag, or is none of the three, makes it unknown."""
    odd = (status == "unknown") | ~status.isin(*KNOWN)
    yes = F.when(F.coalesce(status == "unavailable", F.lit(False)), "unknown").otherwise("available")
    no = F.when(F.coalesce(status == "available", F.lit(False)), "unknown").otherwise("unavailable")
    return F.when(odd, "unknown").when(flag, yes).when(~flag, no).otherwise("unknown")


def judged(offers: DataFrame) -> DataFrame:
    """offers (price, currency, item_active, restaurant_active, status, available) with price and currency or null, price_status, availability,
    reasons (all that keep it from being the cheapest, in order) and eligible. A null flag of activity is inactive; other columns pass through."""
    price = F.col("price").cast("double")
    fine = ~F.isnan(price) & (price >= 0) & (price < float("inf"))
    status = F.when(price.isNull(), "MISSING").when(fine, "OK").otherwise("INVALID")
    code = F.upper(F.trim("currency"))
    rows = offers.withColumns({
        "price_status": status, "currency": F.when(code.rlike("^[A-Z]{3}$"), code), "availability": availability(F.col("status"), F.col("available")),
    }).withColumn("price", F.when(F.col("price_status") == "OK", price))
    off = lambda flag: ~F.coalesce(F.col(flag), F.lit(False))
    checks = {
        "ITEM_INACTIVE": off("item_active"), "ITEM_UNAVAILABLE": F.col("availability") == "unavailable", "ITEM_AVAILABILITY_UNKNOWN": F.col("availability") == "unknown", "RESTAURANT_INACTIVE": off("restaurant_active"),
        "PRICE_MISSING": F.col("price_status") == "MISSING", "PRICE_INVALID": F.col("price_status") == "INVALID", "CURRENCY_INVALID": F.col("currency").isNull(),
    }
    reasons = F.array_compact(F.array(*(F.when(broken, name) for name, broken in checks.items())))
    return rows.withColumn("reasons", reasons).withColumn("eligible", F.size("reasons") == 0)


def _place(platform: Column) -> Column:
    """Unknown platforms come first, as they have no place in the order."""
    return F.coalesce(F.array_position(F.array(*(F.lit(p) for p in PLATFORMS)), platform), F.lit(0))


def ranked(rows: DataFrame, item: str, platform: str = "platform", offer: str = "offer_id") -> DataFrame:
    """Judged offers with `rank` within their item, from 1: eligible ones, then by price (none last), platform and id. An item has the
    confirmed listings of one group of restaurants; Spark spills an item's sort where it has more."""
    order = Window.partitionBy(item).orderBy(F.col("eligible").desc(), F.col("price").asc_nulls_last(), _place(F.col(platform)), F.col(offer))
    return rows.withColumn("rank", F.row_number().over(order))


def cheapest_offers(rows: DataFrame, item: str, platform: str = "platform", offer: str = "offer_id") -> DataFrame:
    """item, currency, price, platform, offer, tied (ids of the others at that price, in order), verdict: a row for each item and currency
    with an eligible offer, a row without currency for an item that has none. Verdicts: OK, MIXED_CURRENCIES, NO_ELIGIBLE_OFFERS.

    Prices are reduced by an aggregate before anything is joined, so only offers at the lowest price meet it."""
    fit = rows.where("eligible").select(item, "currency", "price", F.struct(_place(F.col(platform)).alias("place"), F.col(offer).alias("id"), F.col(platform).alias("name")).alias("_o"))
    lowest = fit.groupBy(item, "currency").agg(F.min("price").alias("price"))
    ties = fit.join(lowest, [item, "currency", "price"]).groupBy(item, "currency", "price").agg(F.array_sort(F.collect_list("_o")).alias("_os"))
    currencies = lowest.groupBy(item).agg(F.count("*").alias("_n"))
    found = rows.select(item).distinct().join(currencies, item, "left").join(ties, item, "left")
    verdict = F.when(F.col("_n").isNull(), "NO_ELIGIBLE_OFFERS").when(F.col("_n") > 1, "MIXED_CURRENCIES").otherwise("OK")
    first, others = F.get("_os", F.lit(0)), F.slice("_os", 2, F.greatest(F.size("_os") - 1, F.lit(0)))
    return found.select(item, "currency", "price", first["name"].alias(platform), first["id"].alias(offer), F.transform(others, lambda o: o["id"]).alias("tied"), verdict.alias("verdict"))
