"""Landed feeds and sitemaps as tables: shop feeds, sitemap shards, bundles, category trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.item_text import has_all_words

FEED = (
    "struct<products: array<struct<title: string, handle: string, product_type: string, vendor: string, body_html: string, tags: array<string>, "
    "images: array<struct<src: string>>, variants: array<struct<price: string, available: boolean, compare_at_price: string, sku: string>>>>>"
)
# Words in an address that tell an accessory from the device.
ACCESSORY_SLUGS = (
    "case cover screen-protector glass charger cable adapter film pouch stand sleeve bag backpack holder mount "
    "dock hub headset earphone earpiece skin folio wallet"
).split()


def _number(text: Column) -> Column:
    return F.regexp_extract(text, "^\\s*([+-]?(?:\\d+\\.?\\d*|\\.\\d+))", 1).try_cast("double")


def feed_products(feeds: DataFrame, category: str = "", feed: str = "feed") -> DataFrame:
    """Products of landed feed pages (host, page, feed: JSON text) that fit the category and have a price.

    The variant is the cheapest in stock, else the cheapest; the first of equal ones. A price of zero is none. The price before
    is told if it is higher. A page that is no JSON gives nothing."""
    rows = feeds.select("host", "page", F.posexplode(F.from_json(feed, FEED)["products"]).alias("at", "p")).where("p IS NOT NULL")
    text = F.concat_ws(" ", F.coalesce("p.title", F.lit("")), F.coalesce("p.product_type", F.lit("")), F.coalesce("p.vendor", F.lit("")), F.array_join(F.coalesce("p.tags", F.array().cast("array<string>")), " "))
    variants = F.transform("p.variants", lambda v, i: F.struct(_number(v["price"]).alias("price"), i.alias("at"), v["available"].alias("available"), _number(v["compare_at_price"]).alias("before"), F.trim(v["sku"]).alias("sku")))
    priced = F.filter(variants, lambda v: v["price"].isNotNull())
    ready = F.filter(priced, lambda v: v["available"])
    rows = rows.where(has_all_words(text, category)).withColumn("v", F.array_min(F.when(F.size(ready) > 0, ready).otherwise(priced))).where("v.price <> 0")
    images = F.filter(F.transform("p.images", lambda i: i["src"]), lambda s: s != "")
    about = F.substring(F.trim(F.regexp_replace(F.regexp_replace("p.body_html", "<[^>]+>", " "), "\\s+", " ")), 1, 500)
    return rows.select(
        "host", "page", "at",
        F.nullif(F.col("p.title"), F.lit("")).alias("name"),
        F.concat(F.lit("https://"), "host", F.lit("/products/"), "p.handle").alias("url"),
        images.alias("images"),
        F.col("v.price").alias("price"),
        F.when(F.col("v.before") > F.col("v.price"), F.col("v.before")).alias("price_before"),
        F.nullif(F.col("v.sku"), F.lit("")).alias("sku"),
        F.col("v.available").alias("in_stock"),
        F.nullif(F.col("p.product_type"), F.lit("")).alias("category"),
        F.nullif(about, F.lit("")).alias("description"),
    )


def sitemap_links(shards: DataFrame, keyword: str, most: int | None = None) -> DataFrame:
    """Distinct English addresses of sitemap shards (shard, xml) that hold every word of the keyword, with `accessory` and their
    `place`: devices before accessories, then by shard and place in it. `most` keeps the first ones, as the search does."""
    words = [w for w in keyword.lower().split() if len(w) > 1]
    urls = shards.select("shard", F.posexplode(F.regexp_extract_all("xml", F.lit("<loc>([^<]+)</loc>"), F.lit(1))).alias("at", "url"))
    low = F.lower("url")
    for w in words:
        urls = urls.where(low.contains(w))
    accessory = F.lit(False)
    for s in ACCESSORY_SLUGS:
        accessory = accessory | low.contains(f"/{s}") | low.contains(f"-{s}-") | low.contains(f"-{s}/")
    english = F.regexp_replace("url", "/mafuae/ar/", "/mafuae/en/")
    order = F.struct(accessory.alias("accessory"), "shard", "at")
    found = urls.groupBy(english.alias("url")).agg(F.min(order).alias("place"))
    if most is not None:
        found = found.orderBy("place").limit(most)
    return found.select("url", "place.accessory", "place.shard", "place.at")


def bundles(spark, path: str) -> DataFrame:
    """The rows of `bundles` of a JSON file; none if the file has no such list."""
    raw = spark.read.json(path, multiLine=True)
    if "bundles" not in raw.columns:
        return spark.createDataFrame([], "name string")
    return raw.select(F.explode("bundles").alias("b")).select("b.*")


def subcategories(pages: DataFrame, key: str, state: str) -> DataFrame:
    """X11: categories and subcategories of a store's state (JSON text), with their counts; categories without any are left out."""
    tree = F.from_json(state, "struct<categories: array<struct<slug: string, subCategories: array<struct<slug: string, count: double>>>>>")
    c = pages.select(key, F.posexplode(tree["categories"]).alias("at", "c"))
    s = c.select(key, "at", F.trim("c.slug").alias("category"), F.posexplode("c.subCategories").alias("place", "s"))
    return s.where("category <> '' AND trim(s.slug) <> ''").select(key, "at", "place", "category", F.trim("s.slug").alias("subcategory"), F.coalesce("s.count", F.lit(0.0)).alias("count"))
