"""Queries on listing pages, feeds, tags and source keys: cases written by hand with what is expected of them, and tables joined whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.functions import listings, tags
from tallymart.operators import records
from tallymart.plans.catalog import register
from tallymart.plans.menu_queries import _column, _dealt, _expected
from tallymart.sources import feeds
from tallymart.sources.tables import table

c = F.col

#: site, page, links
LISTINGS = [
    ("amazon", '<a class="x" href="/Phone/dp/B0ABCDEF12/ref=sr_1?x=1&amp;y=2">a</a><a href="https://www.amazon.ae/gp/product/B0ABCDEF13?th=1">b</a><a href="/dp/B0ABCDEF12">again</a>', "https://www.amazon.ae/dp/B0ABCDEF12 https://www.amazon.ae/dp/B0ABCDEF13"),
    ("amazon", '<a href="https://aax-eu.amazon.ae/x/dp/B0ABCDEF14">ad</a><a href="/dp/B0ABCDEF15#customerReviews">r</a><a href="/help">h</a>', ""),
    ("noon", '<a href="/uae-en/phone/N70000001A/p/?o=abc">a</a><a href=\'https://www.noon.com/uae-en/phone/N70000001A/p/\'>b</a><a href="/brands">c</a>', "https://www.noon.com/uae-en/phone/N70000001A/p/"),
    ("sharafdg", '<a href="/product/phone-x/?promo=1">a</a><a href="https://uae.sharafdg.com/product/phone-y/reviews">b</a><a href="/c/product/z">c</a><a href="https://other.com/product/q/">d</a>', "https://uae.sharafdg.com/product/phone-x/ https://uae.sharafdg.com/product/phone-y/"),
    ("jumbo", '<a href="/apple-phone-15-black.html?x=1#a">a</a><a href="/mobile-phones.html">b</a><a href="/computers/apple-laptop-air-m2.html">c</a><a href="/advance-for-apple-phone-16.html">d</a><a href="lg-tv-55-oled.html">e</a><a href="/deal-of-the-day.html">f</a>', "https://www.jumbo.ae/apple-phone-15-black.html https://www.jumbo.ae/lg-tv-55-oled.html"),
    ("mumzworld", '<a href="/en/brand-stroller-travel-system-123?a=1">a</a><a href="/en/feeding">b</a><a href="/en/nursery-bedroom/brand-cot-with-mattress-9">c</a><a href="/ar/brand-stroller-travel-system-123">d</a>', "https://www.mumzworld.com/en/brand-stroller-travel-system-123"),
    ("namshi", '{"url": "https://www.namshi.com/uae-en/buy-shoe/S1/p/","url":"https://www.namshi.com/uae-en/buy-shoe/S1/p/"} https://www.namshi.com/uae-en/buy-another-shoe/S2/p/', "https://www.namshi.com/uae-en/buy-shoe/S1/p/"),
    ("namshi", "see https://www.namshi.com/uae-en/buy-another-shoe/S2/p/ or https://namshi.com/uae-en/x/p/", "https://www.namshi.com/uae-en/buy-another-shoe/S2/p/"),
    ("amazon", None, None),
    ("jumbo", "", ""),
]


@register("listing_links", _expected(site=_column(LISTINGS, 0), links=_column(LISTINGS, 2)))
def listing_links(spark, sf):
    """S7a-S7f."""
    page = c("page")
    by_site = {
        "amazon": listings.amazon(page), "noon": listings.product_paths(page, "https://www.noon.com"), "sharafdg": listings.sharafdg(page),
        "jumbo": listings.jumbo(page), "mumzworld": listings.mumzworld(page), "namshi": listings.namshi(page),
    }
    found = F.coalesce(*[F.when(c("site") == site, links) for site, links in by_site.items()])
    return _dealt(spark, sf, ("site", _column(LISTINGS, 0)), ("page", _column(LISTINGS, 1))).select("id", "site", F.array_join(found, " ").alias("links"))


#: page, listings of a store, stores of an area, highest page, rating, raters
STORES = [
    ('<a href="/uae/grocery/12/shop/food/tea?aid=1">a</a><a href="/uae/grocery/12/shop/food/tea?aid=2">b</a><a href="https://t.com/uae/grocery/12/shop/food/jam">c</a><a href="/uae/grocery/13/other">d</a><a href="/x?page=7">e</a><a href="?a=1&amp;page=12">f</a>',
     "https://t.com/uae/grocery/12/shop/food/tea?aid=1 https://t.com/uae/grocery/12/shop/food/jam", "https://t.com/uae/grocery/12/shop https://t.com/uae/grocery/13/other", "12", 4.4, "65"),
    ("<p>nothing</p>", "", "", "1", None, None),
    (None, None, None, "1", None, None),
]
_WIDGET = '<div data-x="1" class="a loox-rating b" data-rating="4.4" data-raters="65">'


@register("store_links", _expected(listing=_column(STORES, 1), stores=_column(STORES, 2), max_page=_column(STORES, 3), rating=_column(STORES, 4), raters=_column(STORES, 5)))
def store_links(spark, sf):
    """X12, X19."""
    page, stores = c("page"), listings.store_links(c("page"), "https://t.com")
    widget = listings.rating_widget(F.when(page.contains("aid="), F.concat(page, F.lit(_WIDGET))).otherwise(F.concat(page, F.lit('<div class="loox-rating" data-rating="5.5" data-raters="0">'))))
    return _dealt(spark, sf, ("page", _column(STORES, 0))).select(
        "id", F.array_join(listings.subcategory_links(page, "https://t.com"), " ").alias("listing"), F.array_join(stores["stores"], " ").alias("stores"),
        stores["max_page"].cast("string").alias("max_page"), widget["rating"].alias("rating"), widget["raters"].cast("string").alias("raters"),
    )


@register(
    "feed_products",
    """SELECT p_partkey AS page, p_name || ' frames' AS name, 'https://shop.example/products/h' || p_partkey AS url, CASE WHEN p_partkey % 4 = 0 THEN p_size + 5.0::DOUBLE ELSE p_size + 1.5::DOUBLE END AS price,
 CASE WHEN p_partkey % 4 <> 0 THEN p_size + 9.0::DOUBLE END AS price_before, CASE WHEN p_partkey % 4 = 0 THEN 'A' ELSE 'B' END AS sku, p_partkey % 4 <> 0 AS in_stock, 'two words' AS description, 'https://i/1.jpg' AS images
 FROM part WHERE p_partkey % 5 <> 0""",
)
def feed_products(spark, sf):
    """Three variants a product, each fourth product out of stock, each fifth of another kind or at a price of zero; a page that is no JSON for each product."""
    k = c("p_partkey")
    variant = lambda sku, price, there, before: F.struct(price.cast("string").alias("price"), there.alias("available"), before.cast("string").alias("compare_at_price"), F.lit(sku).alias("sku"))
    zero, size, there = k % 10 == 0, c("p_size").cast("double"), k % 4 != 0
    first = variant(" A ", F.when(there, size + 0.5).otherwise(size + 5.0), F.lit(False), size)
    rest = [variant("B", F.when(there, size + 1.5).otherwise(size + 7.0), there, size + 9.0), variant("C", F.lit("n/a"), there, size), variant("D", F.when(there, size + 1.5).otherwise(size + 8), there, size)]
    product = F.struct(
        F.when((k % 5 == 0) & ~zero, F.concat("p_name", F.lit(" framework"))).otherwise(F.concat("p_name", F.lit(" frames"))).alias("title"), F.concat(F.lit("h"), k).alias("handle"), F.lit("").alias("product_type"),
        F.lit("<p>two <b>words</b></p>").alias("body_html"), F.array(F.struct(F.lit("https://i/1.jpg").alias("src"))).alias("images"),
        F.array(*[F.struct(F.when(zero, "0").otherwise(v["price"]).alias("price"), v["available"].alias("available"), v["compare_at_price"].alias("compare_at_price"), v["sku"].alias("sku")) for v in [first, *rest]]).alias("variants"),
    )
    p = table(spark, sf, "part").select(F.lit("shop.example").alias("host"), k.alias("page"), F.to_json(F.struct(F.array(product).alias("products"))).alias("feed"))
    broken = p.select("host", (-c("page")).alias("page"), F.lit("<html>").alias("feed"))
    return feeds.feed_products(p.union(broken), "a frame").select("page", "name", "url", "price", "price_before", "sku", "in_stock", "description", F.array_join("images", " ").alias("images"))


@register(
    "sitemap_links",
    """WITH u AS (SELECT p_partkey % 36 AS shard, p_partkey AS k, replace(p_name, ' ', '-') AS slug FROM part),
 x AS (SELECT 'https://c/mafuae/en/' || slug || CASE WHEN k % 3 = 0 THEN '-case-' ELSE '-' END || k % 700 AS url, k % 3 = 0 AS accessory, shard, row_number() OVER (PARTITION BY shard ORDER BY k) - 1 AS nth FROM u)
 SELECT url, bool_and(accessory) AS accessory, arg_min(shard, [accessory::INT, shard, nth]) AS shard, arg_min(nth, [accessory::INT, shard, nth]) AS nth FROM x WHERE contains(url, 'widget') GROUP BY url""",
)
def sitemap_links(spark, sf):
    """S5 with a shard for each of 36 files; half of the addresses are Arabic ones of the same page."""
    k = c("p_partkey")
    url = F.concat(F.lit("<url><loc>https://c/mafuae/"), F.when(k % 2 == 0, "ar").otherwise("en"), F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.when(k % 3 == 0, "-case-").otherwise("-"), k % 700, F.lit("</loc></url>"))
    lines = table(spark, sf, "part").select((k % 36).alias("shard"), F.struct(k, url.alias("line")).alias("l"))
    shards = lines.groupBy("shard").agg(F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["line"]), "\n").alias("xml"))
    return feeds.sitemap_links(shards, "a Widget").withColumnRenamed("at", "nth")


@register(
    "store_subcategories",
    "SELECT p_partkey AS id, 'food' AS category, s AS subcategory, CASE s WHEN 'tea' THEN p_size::DOUBLE ELSE 0 END AS count FROM part, (VALUES ('tea'), ('jam')) v(s) WHERE p_partkey % 3 <> 0",
)
def store_subcategories(spark, sf):
    """X11."""
    state = F.concat(F.lit('{"categories": [{"slug": " food ", "subCategories": [{"slug": "tea", "count": '), "p_size", F.lit('}, {"slug": "jam"}, {"slug": ""}]}, {"slug": "none", "subCategories": []}, {"subCategories": [{"slug": "x"}]}]}'))
    p = table(spark, sf, "part").select(c("p_partkey").alias("id"), F.when(c("p_partkey") % 3 != 0, state).otherwise("{}").alias("state"))
    return feeds.subcategories(p, "id", "state").select("id", "category", "subcategory", "count")


#: text, price, retailers, rating, reviews, tags, brand
TAGGED = [
    ("Apple iPhone 15 5G", 3999.0, 3, 4.6, 1200, "5g brand-apple electronics mobile popular premium smartphone top-rated widely-available", "Apple"),
    ("LG OLED TV", 5000.0, 2, None, None, "brand-lg electronics luxury multi-retailer premium smart-tv television", "LG"),
    ("Bosch dishwasher", 199.99, 1, 4.4, 999, "appliances brand-bosch budget dishwasher kitchen", "Bosch"),
    ("pineapple hat", None, None, None, None, "", None),
    (None, 500.0, 1, None, None, "mid-range", None),
]
#: A few rules of a shop; the rules are the caller's.
RULES = [
    ("\\bapple\\b", ["brand-apple"]), ("\\blg\\b", ["brand-lg"]), ("\\bbosch\\b", ["brand-bosch"]), ("iphone", ["smartphone", "electronics", "mobile", "brand-apple"]), ("\\b5g\\b", ["5g"]),
    ("\\b(oled|qled|neo qled)\\b", ["television", "electronics", "smart-tv", "premium"]), ("\\b(dishwasher)\\b", ["dishwasher", "appliances", "kitchen"]),
]


@register("bundle_tags", _expected(tags=_column(TAGGED, 5), brand=_column(TAGGED, 6)))
def bundle_tags(spark, sf):
    """T13, T14."""
    t = _dealt(spark, sf, *[(n, _column(TAGGED, i)) for i, n in enumerate(("text", "price", "retailers", "rating", "reviews"))])
    found = tags.all_tags(tags.rule_tags(c("text"), RULES), tags.social_tags(c("price"), c("retailers"), c("rating"), c("reviews")))
    t = t.select("id", found.alias("tags"))
    return t.select("id", F.array_join("tags", " ").alias("tags"), tags.brand_of_tags(c("tags")).alias("brand"))


_TAX = "(VALUES (0, ['food', 'grocery']), (1, ['home']), (2, ['luxury', 'bags']))"


@register(
    "vector_tags",
    f"""WITH a AS (SELECT label, embedding AS v FROM embeddings WHERE vec_id < 5), hits AS (SELECT e.vec_id, 'anchor-' || a.label AS tag FROM embeddings e, a WHERE list_cosine_similarity(e.embedding::DOUBLE[], a.v::DOUBLE[]) >= 0.25),
 t AS (SELECT vec_id, tag FROM hits UNION SELECT vec_id, unnest(tags) FROM embeddings JOIN {_TAX} x(k, tags) ON label = k UNION SELECT vec_id, CASE WHEN vec_id % 6000 < 200 THEN 'budget' WHEN vec_id % 6000 < 500 THEN 'affordable' WHEN vec_id % 6000 < 1500 THEN 'mid-range' WHEN vec_id % 6000 < 5000 THEN 'premium' ELSE 'luxury' END FROM embeddings)
 SELECT vec_id, array_to_string(list_sort(list(tag)), ' ') AS tags FROM t GROUP BY vec_id""",
)
def vector_tags(spark, sf):
    """Tags of the taxonomy, of anchors whose vector is near, and of the price. The anchors are five rows."""
    e = table(spark, sf, "embeddings")
    base = spark.createDataFrame([(0, ["food", "grocery"]), (1, ["home"]), (2, ["luxury", "bags"])], "label int, base array<string>")
    anchors = e.where("vec_id < 5").select(F.concat(F.lit("anchor-"), "label").alias("tag"), c("embedding").alias("v"))
    one = anchors.agg(F.collect_list(F.struct("tag", "v")).alias("anchors"))
    double = lambda v: v.cast("array<double>")
    dot = lambda a, b: F.aggregate(F.zip_with(double(a), double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    near = F.filter("anchors", lambda a: dot(c("embedding"), a["v"]) / F.sqrt(dot(c("embedding"), c("embedding")) * dot(a["v"], a["v"])) >= 0.25)
    rows = e.join(F.broadcast(base), "label", "left").join(F.broadcast(one))  # three rows and one row
    price = (c("vec_id") % 6000).cast("double")
    none = F.lit(None).cast("int")
    found = tags.all_tags(c("base"), F.transform(near, lambda a: a["tag"]), tags.social_tags(price, none, none, none))
    return rows.select("vec_id", F.array_join(found, " ").alias("tags"))


@register("embedding_texts", "SELECT doc_id, md5(left(concat_ws(' ', nullif(source, ''), nullif(left(text, 200), ''), 'a', 'b'), 800)) AS short_md5, md5(left(concat_ws(' ', nullif(source, ''), nullif(text, ''), 'a', 'b', 'c'), 800)) AS long_md5 FROM documents")
def embedding_texts(spark, sf):
    """T19."""
    three = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.md5(tags.embedding_text(c("source"), c("text"), three, 2, 200)).alias("short_md5"), F.md5(tags.embedding_text(c("source"), c("text"), three)).alias("long_md5"))


#: id, anchor, position, restaurant key, category key, item key, entity and value of the item key
KEYS = [
    ("a b", None, "1", None, None, None, None),
    ("12:7", None, None, "talabat:restaurant:id:12%3A7", "talabat:restaurant:id:9:category:id:12%3A7", "talabat:restaurant:id:9:item:id:12%3A7", "item id 12:7"),
    (None, "it's-(x)~!*é", None, "talabat:restaurant:anchor:it's-(x)~!*%C3%A9", "talabat:restaurant:id:9:category:anchor:it's-(x)~!*%C3%A9", "talabat:restaurant:id:9:item:anchor:it's-(x)~!*%C3%A9", "item anchor it's-(x)~!*é"),
    (None, None, "3", None, "talabat:restaurant:id:9:category:pos:3", "talabat:restaurant:id:9:category:id:4:item:pos:3", "item position 3"),
    (None, None, "100001", None, None, None, None),
    (None, "كباب", None, None, None, None, None),
    ("", "x", None, None, None, None, None),
    (None, None, None, None, None, None, None),
]


@register("source_keys", _expected(restaurant=_column(KEYS, 3), category=_column(KEYS, 4), item=_column(KEYS, 5), parsed=_column(KEYS, 6)))
def source_keys(spark, sf):
    """T38."""
    s = _dealt(spark, sf, ("own", _column(KEYS, 0)), ("anchor", _column(KEYS, 1)), ("position", _column(KEYS, 2)))
    part = tags.identity_segment(c("own"), c("anchor"), c("position").cast("int"))
    parent = F.lit("talabat:restaurant:id:9")
    keys = s.select("id", tags.restaurant_key(F.lit("talabat"), part).alias("restaurant"), tags.category_key(parent, part).alias("category"), tags.item_key_of(parent, F.lit("talabat:restaurant:id:9:category:id:4"), part).alias("item"))
    parsed = tags.parsed_key(c("item"))
    return keys.withColumn("parsed", F.concat(parsed["entity"], F.lit(" "), parsed["kind"], F.lit(" "), parsed["value"]))


#: page, slug, sku, address
ITEM_URLS = [
    ("https://t.com/a/b/?x=1", "green tea", "9", "https://t.com/a/b/green%20tea?x=1"),
    ("https://t.com/a/b/green-tea/", "green-tea", None, "https://t.com/a/b/green-tea"),
    ("https://t.com", "", "9", "https://t.com/9"),
    ("https://t.com/a", None, None, "https://t.com/a"),
    ("no address", "x", None, "no address"),
    (None, "x", None, None),
]


@register("item_urls", _expected(url=_column(ITEM_URLS, 3)))
def item_urls(spark, sf):
    """T51."""
    return _dealt(spark, sf, *[(n, _column(ITEM_URLS, i)) for i, n in enumerate(("page", "slug", "sku"))]).select("id", tags.item_url(c("page"), c("slug"), c("sku")).alias("url"))


@register(
    "modifier_digests",
    """SELECT p_partkey AS id, CASE WHEN p_partkey % 3 <> 0 THEN 2 END AS groups, CASE WHEN p_partkey % 3 <> 0 THEN 3 END AS options, p_partkey % 3 <> 0 AS hashed, count(*) OVER (PARTITION BY CASE WHEN p_partkey % 3 <> 0 THEN p_size END) AS alike FROM part""",
)
def modifier_digests(spark, sf):
    """Groups that are alike have one digest; the order of fields as they were written plays no part."""
    p = table(spark, sf, "part")
    option = lambda name, price=None: F.struct(F.lit(name).alias("name"), F.lit(price).cast("double").alias("price"))
    group = lambda most, name, *options: F.struct(most.alias("max"), F.lit(name).alias("name"), F.array(*options).alias("options"))
    groups = F.array(group(c("p_size"), "size", option("small"), option("large", 2.5)), group(F.lit(None).cast("int"), "milk", option("oat")))
    d = p.select(c("p_partkey").alias("id"), tags.modifier_digest(F.when(c("p_partkey") % 3 != 0, groups)).alias("d"))
    alike = d.groupBy(c("d.hash").alias("hash")).agg(F.count("*").alias("alike"))
    return d.join(alike, c("d.hash").eqNullSafe(alike["hash"])).select("id", "d.groups", "d.options", c("d.hash").isNotNull().alias("hashed"), "alike")


@register(
    "filled_records",
    """SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN p_name WHEN p_partkey % 7 <> 0 THEN 'ld' END AS name, CASE WHEN p_partkey % 3 <> 0 THEN p_size::DOUBLE WHEN p_partkey % 7 <> 0 THEN 5 ELSE 0 END AS price,
 CASE WHEN p_partkey % 3 = 0 AND p_partkey % 7 <> 0 THEN 'USD' ELSE 'AED' END AS currency, CASE WHEN p_partkey % 5 = 0 THEN 'a' WHEN p_partkey % 7 <> 0 THEN 'b c' ELSE '' END AS images, CASE WHEN p_partkey % 2 = 0 THEN false WHEN p_partkey % 7 <> 0 THEN true END AS in_stock FROM part""",
)
def filled_records(spark, sf):
    """X3."""
    p, k = table(spark, sf, "part"), c("p_partkey")
    texts = lambda *v: F.array(*map(F.lit, v)).cast("array<string>")
    read = p.select(k.alias("id"), F.when(k % 2 == 0, c("p_name")).when(k % 7 != 0, "").alias("name"), F.when(k % 3 != 0, c("p_size").cast("double")).otherwise(0.0).alias("price"), F.lit("AED").alias("currency"), F.when(k % 5 == 0, texts("a")).otherwise(texts()).alias("images"), F.when(k % 2 == 0, False).alias("in_stock"))
    data = p.where(k % 7 != 0).select(k.alias("id"), F.lit("ld").alias("name"), F.lit(5.0).alias("price"), F.lit("USD").alias("currency"), texts("b", "c").alias("images"), F.lit(True).alias("in_stock"))
    return records.filled(read, data, "id").withColumn("images", F.array_join("images", " "))


@register(
    "merged_records",
    """SELECT p_partkey AS id, CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 2 = 0 THEN p_name WHEN p_partkey % 5 <> 0 THEN 'second' END AS name, CASE WHEN p_partkey % 3 <> 0 THEN CASE WHEN p_size > 20 THEN p_size::DOUBLE END WHEN p_partkey % 5 <> 0 THEN 7 END AS price,
 CASE WHEN p_partkey % 5 <> 0 THEN 'SAR' WHEN p_partkey % 3 <> 0 AND p_size > 20 THEN 'AED' END AS currency, CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 4 = 0 THEN 'a' WHEN p_partkey % 5 <> 0 THEN 'b c' ELSE '' END AS images FROM part WHERE p_partkey % 3 <> 0 OR p_partkey % 5 <> 0""",
)
def merged_records(spark, sf):
    """X18."""
    p, k = table(spark, sf, "part"), c("p_partkey")
    texts = lambda *v: F.array(*map(F.lit, v)).cast("array<string>")
    first = p.where(k % 3 != 0).select(k.alias("id"), F.when(k % 2 == 0, c("p_name")).alias("name"), F.when(c("p_size") > 20, c("p_size").cast("double")).otherwise(0.0).alias("price"), F.lit(None).cast("string").alias("currency"), F.when(k % 4 == 0, texts("a")).otherwise(texts()).alias("images"))
    second = p.where(k % 5 != 0).select(k.alias("id"), F.lit("second").alias("name"), F.lit(7.0).alias("price"), F.lit("SAR").alias("currency"), texts("b", "c").alias("images"))
    return records.merged(first, second, "id").withColumn("images", F.array_join("images", " "))


_MOVED = """pics AS (SELECT l_orderkey AS id, (l_partkey % 300)::VARCHAR AS url, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, (l_partkey % 300)::VARCHAR) AS nth FROM lineitem),
 seen AS (SELECT id, nth, CASE WHEN url::INT % 3 = 0 THEN 'new' || url ELSE url END AS url, url::INT % 3 = 0 AS moved, url::INT % 3 = 1 AS gone FROM pics),
 each AS (SELECT *, bool_and(gone) OVER (PARTITION BY id) AS kept_last FROM seen),
 g AS (SELECT id, count(*) FILTER (WHERE moved) AS n_moved, CASE WHEN kept_last THEN 0 ELSE count(*) FILTER (WHERE gone) END AS n_dropped, kept_last FROM each GROUP BY id, kept_last),
 firsts AS (SELECT id, url, min(nth) AS nth FROM each WHERE kept_last OR NOT gone GROUP BY id, url), galleries AS (SELECT id, list(url ORDER BY nth) AS images FROM firsts GROUP BY id)"""


def _rehosted(spark, sf):
    """A third of the images moved, a third gone."""
    line = table(spark, sf, "lineitem").select(c("l_orderkey").alias("id"), c("l_linenumber").alias("at"), (c("l_partkey") % 300).cast("string").alias("url"))
    documents = line.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "url"))), lambda x: x["url"]).alias("images"))
    offers = line.select("id", c("at").alias("retailer"), c("url").alias("image"))
    urls = spark.range(300).select("id", c("id").cast("string").alias("url"))
    return records.rehosted(documents, offers, urls.where("id % 3 = 0").select("url", F.concat(F.lit("new"), "url").alias("new")), urls.where("id % 3 = 1").select("url"))


@register("rehosted_galleries", f"WITH {_MOVED} SELECT id, array_to_string(images, ' ') AS images, n_moved, n_dropped, kept_last FROM g JOIN galleries USING (id)")
def rehosted_galleries(spark, sf):
    """M19."""
    return _rehosted(spark, sf)[0].withColumn("images", F.array_join("images", " ")).withColumns({n: c(n).cast("long") for n in ("n_moved", "n_dropped")})


@register("rehosted_offers", f"WITH {_MOVED} SELECT l_orderkey AS id, l_linenumber AS retailer, CASE WHEN l_partkey % 300 % 3 = 0 THEN 'new' || l_partkey % 300 WHEN l_partkey % 300 % 3 = 1 AND NOT list_contains(images, (l_partkey % 300)::VARCHAR) THEN images[1] ELSE (l_partkey % 300)::VARCHAR END AS image, l_partkey % 300 % 3 = 0 AS moved FROM lineitem JOIN galleries ON id = l_orderkey")
def rehosted_offers(spark, sf):
    return _rehosted(spark, sf)[1]
