"""Bundling of one query's listings into products. The outcome depends on the order of the listings, so a query is one group;
it holds what a few shops show for one search, some dozens of rows. Queries are dealt out by Spark."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions import rules, text, variants

#: Similarity that bundles, similarity worth a look, and the price ratio that forbids.
BUNDLED, REVIEWED, RATIO = 0.45, 0.3, variants.MAX_PRICE_RATIO
FEATURES = ("tokens", "role", "type", "brand_word", "qualifiers", "storage_gb", "screen_inch", "models")
PLACED = "query string, seq long, bundle long, reason string, similarity double, candidate long"
SCHEMA = pa.schema([("query", pa.string()), ("seq", pa.int64()), ("bundle", pa.int64()), ("reason", pa.string()), ("similarity", pa.float64()), ("candidate", pa.int64())])


def features(items: DataFrame) -> DataFrame:
    """What two names are compared by, as columns."""
    name = F.col("name")
    s = variants.signature(name)
    return items.withColumns(
        {"tokens": text.name_tokens(name), "role": variants.role(name), "type": rules.product_type(name), "brand_word": rules.brand(name)}
        | {f: s[f] for f in ("qualifiers", "storage_gb", "screen_inch", "models")}
    )


def _conflict(a: dict, b: dict) -> str | None:
    differ = lambda f: a[f] is not None and b[f] is not None and a[f] != b[f]
    if a["role"] != b["role"]:
        return "role_mismatch"
    if differ("type"):
        return "type_mismatch"
    if differ("brand_word"):
        return "brand_mismatch"
    models = len(a["models"]) and len(b["models"]) and not set(a["models"]) & set(b["models"])
    return "variant_mismatch" if a["qualifiers"] != b["qualifiers"] or differ("storage_gb") or differ("screen_inch") or models else None


def _similarity(a: dict, b: dict) -> float:
    x, y = set(a["tokens"]), set(b["tokens"])
    return len(x & y) / len(x | y) if x | y else 0.0


def _placed(items: list[dict]) -> list[tuple]:
    """One query's listings in order: seq, the bundle of each (its first listing; null if the listing was there already), and the near miss that made it open one."""
    bundles: list[dict] = []  # first seq, listing that gives the name, retailers, prices
    seen: set[tuple] = set()
    out = []
    for item in items:
        listing = (item["retailer"], item["external_id"])
        if item["external_id"] is not None and listing in seen:
            out.append((item["seq"], None, None, None, None))
            continue
        seen.add(listing)
        price = item["price"] if item["price"] is not None and item["price"] > 0 else None
        best, miss = (0.0, None), (0.0, None, None)
        for b in bundles:
            if item["retailer"] in b["retailers"]:
                continue
            close = _similarity(item, b["named"])
            if close < REVIEWED:
                continue
            prices = b["prices"] + [price] if price and b["prices"] else []
            conflict = _conflict(item, b["named"]) or ("price_ratio" if prices and max(prices) / min(prices) > RATIO else None) or ("low_similarity" if close < BUNDLED else None)
            if conflict is None:
                best = (close, b) if close > best[0] else best
            elif conflict in ("price_ratio", "low_similarity") or (conflict == "variant_mismatch" and close >= BUNDLED):
                miss = (close, conflict, b["first"]) if close > miss[0] else miss
        b = best[1]
        if b is None:
            b = {"first": item["seq"], "named": item, "retailers": set(), "prices": []}
            bundles.append(b)
            reason = (miss[1], round(miss[0] * 100 + 1e-9) / 100, miss[2]) if miss[1] else (None, None, None)
        else:
            reason = (None, None, None)
            if len(item["name"]) > len(b["named"]["name"]):
                b["named"] = item
        b["retailers"].add(item["retailer"])
        if price and item["available"] is not False:
            b["prices"].append(price)
        out.append((item["seq"], b["first"], *reason))
    return out


def _all_placed(batches):
    """Each row holds a query and its listings."""
    for b in batches:
        rows = [(q, *r) for q, items in zip(b.column("query").to_pylist(), b.column("items").to_pylist()) for r in _placed(items)]
        columns = [list(c) for c in zip(*rows)] or [[] for _ in SCHEMA]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA)], schema=SCHEMA)


def placed(items: DataFrame) -> DataFrame:
    """For every listing (query, seq, retailer, external_id, name, price, available) its bundle, and for one that opened a bundle
    after a near miss the reason, the similarity and the bundle that it nearly joined. `seq` is unique within a query. Listings without a name are left out."""
    rows = items.where("name IS NOT NULL AND name <> ''")
    # searches show the same products, so what a name says is worked out once for each name
    named = rows.join(features(rows.select("name").distinct()), "name")
    listing = F.struct(F.col("seq").cast("long").alias("seq"), "retailer", "external_id", "name", F.col("price").cast("double").alias("price"), "available", *FEATURES)
    queries = named.groupBy(F.col("query").cast("string").alias("query")).agg(F.array_sort(F.collect_list(listing)).alias("items"))
    return queries.mapInArrow(_all_placed, PLACED)


def bundled(items: DataFrame, places: DataFrame) -> DataFrame:
    """The products of bundled listings: longest name, most images, first description, prices of offers that may be had, and
    rating and reviews of the offer with the most reviews, else the first rating. The earlier listing wins ties."""
    rows = items.join(places.where("bundle IS NOT NULL").select("query", "seq", "bundle"), ["query", "seq"])
    price = F.when((F.col("price") > 0) & F.coalesce("available", F.lit(True)), F.col("price"))
    early = -F.col("seq")
    return rows.groupBy("query", "bundle").agg(
        F.max_by("name", F.struct(F.length("name"), early)).alias("name"),
        F.max_by("images", F.struct(F.size("images"), early)).alias("images"),
        F.min_by("description", F.when(F.col("description") != "", F.col("seq"))).alias("description"),
        F.min(price).alias("lowest_price"),
        F.max(price).alias("highest_price"),
        F.count("*").alias("retailer_count"),
        F.coalesce(
            F.when(F.max("review_count").isNotNull(), F.max_by("rating", F.when(F.col("review_count").isNotNull(), F.struct("review_count", early)))).otherwise(F.min_by("rating", F.when(F.col("rating").isNotNull(), F.col("seq"))))
        ).alias("rating"),
        F.max("review_count").alias("review_count"),
    )
