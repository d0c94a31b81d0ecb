"""X6a-X6e: product pages of five more shops: what pages say in structured blocks, in embedded states and in their tags.

Tags are read by the stream and the rule tables of `product_pages`; blocks of structured data are VARIANT expressions on the page's
own row, so nothing but a page's rows of tags is joined, by the page's key. Every function takes pages (key, html, some also url)
and returns key, name, price, currency, in_stock, image_url, image_urls, rating, review_count, description; other columns play no part.
A page that is null or empty has nulls, no pictures and, where a shop's pages have one, the currency that is meant without one.
Numbers in texts are read as far as they are numbers. Lengths are code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.sources.menu_pages import STATE
from tallymart.sources.product_pages import Rule, beside, by_attribute, by_class, class_has, folded, trimmed, values

# Where pages hold what, and words about stock and of texts that describe no product.
BLOCK = '(?is)<script[^>]*\\btype=["\']?application/ld\\+json["\']?[^>]*>(.*?)</script>'
OUT, MEANT = "out of stock", "AED"
NO_DESCRIPTION = "cookie|privacy policy|by clicking"
LONG_PARAGRAPH, PARAGRAPHS, MOST_DESCRIPTION, LEAST_DESCRIPTION = 80, 3, 500, 20
OWN_PRICE = "[\\s\\S]{0,1500}?finalPrice\\\\*\":\\\\*\"([\\d.]+)"
RATED, REVIEWED = "averageRating\\\\*\":\\\\*\"([\\d.]+)", "totalReviewsText\\\\*\":\\\\*\"[^\"\\\\]*\\(+__?(\\d+)"
GALLERY = '"(?:imageUrl|image_url|src)"\\s*:\\s*"(https?://f\\.nooncdn\\.com/p[^"]+)"'
_META = "(?i)^meta(?=.*\\s{}=[\"']?{}(?=[\"'\\s>]|$))"
_ANY = "(?i)^(?![/!])"


def meta(attribute: str, value: str) -> str:
    return _META.format(attribute, value)


def some(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def leading_number(text: Column) -> Column:
    return F.regexp_extract(text, "^\\s*([+-]?(?:\\d+\\.?\\d*|\\.\\d+)(?:[eE][+-]?\\d+)?)", 1).try_cast("double")


def digits_number(text: Column) -> Column:
    """The number that digits and points make once all else is gone; null if it is not above zero."""
    n = leading_number(F.regexp_replace(text, "[^\\d.]", ""))
    return F.when(n > 0, n)


def first_amount(text: Column) -> Column:
    return leading_number(F.replace(F.regexp_extract(text, "([\\d,]+\\.?\\d*)", 1), F.lit(","), F.lit("")))


def told(block: Column, path: str) -> Column:
    """Text of a text or number; null for nothing, an empty text, zero or anything else."""
    kind = F.regexp_extract(F.schema_of_variant(F.try_variant_get(block, path, "variant")), "^[A-Z]+", 0)
    text = F.try_variant_get(block, path, "string")
    number = F.when(kind != "STRING", text.try_cast("double"))
    return F.when(kind.isin("STRING", "BIGINT", "DECIMAL", "DOUBLE", "FLOAT") & (text != "") & F.coalesce(number != 0, F.lit(True)), text)


def blocks(html: Column) -> Column:
    """Structured blocks of a page that are JSON, in order."""
    return F.array_compact(F.transform(F.regexp_extract_all(html, F.lit(BLOCK), F.lit(1)), lambda b: F.try_parse_json(b)))


def _is_product(block: Column) -> Column:
    return F.coalesce(F.try_variant_get(block, "$['@type']", "string") == "Product", F.lit(False))


def products(html: Column, lists: bool = True) -> Column:
    """Blocks that are products; of a list its first one, or none without `lists`."""

    def product(block: Column) -> Column:
        listed = F.get(F.filter(F.try_variant_get(block, "$", "array<variant>"), _is_product), F.lit(0))
        return F.when(_is_product(block), block).otherwise(listed if lists else F.lit(None))

    return F.array_compact(F.transform(blocks(html), product))


def pictures(block: Column, path: str = "$.image") -> Column:
    listed = F.transform(F.try_variant_get(block, path, "array<variant>"), lambda x: told(x, "$"))
    return F.coalesce(F.array_compact(listed), F.array_compact(F.array(told(block, path))))


def _firsts(found: DataFrame, key: str, *fields: str) -> DataFrame:
    """Of each field the first element of each rule, and of these the first that says something."""
    first = found.groupBy(key, "field", "precedence").agg(F.min_by("value", "at").alias("value")).where("value IS NOT NULL AND value <> ''")
    return first.groupBy(key).agg(*(F.min_by("value", F.when(F.col("field") == f, F.col("precedence"))).alias(f) for f in fields))


def _in_order(found: DataFrame, key: str, field: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.when((F.col("field") == field) & F.col("value").isNotNull(), F.struct("at", "value")))), lambda x: x["value"])


def _record(rows: DataFrame, key: str, **columns: Column) -> DataFrame:
    kinds = {"name": "string", "price": "double", "currency": "string", "in_stock": "boolean", "image_url": "string", "image_urls": "array<string>", "rating": "double", "review_count": "long", "description": "string"}
    columns["image_urls"] = F.coalesce(columns["image_urls"], F.array().cast("array<string>"))
    columns.setdefault("image_url", F.get(columns["image_urls"], F.lit(0)))
    return rows.select(key, *(columns[c].cast(t).alias(c) for c, t in kinds.items()))


def carrefour(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """The first structured product; a price that it lacks is the first one close behind the page's own id. Stock that is not told is
    taken for granted unless the page says otherwise anywhere. Up to three long paragraphs describe the product."""
    found = values(pages, [Rule("h1", 0, "(?i)^h1(?:\\s|$)"), Rule("p", 0, "(?i)^p(?:\\s|$)")], key, html)
    text = trimmed(F.col("value"))
    fine = (F.col("field") == "p") & (F.length(text) > LONG_PARAGRAPH) & ~F.lower(text).rlike(NO_DESCRIPTION)
    told_by = found.withColumn("value", F.when(F.col("field") == "h1", text).when(fine, text))
    tags = told_by.groupBy(key).agg(F.min_by("value", F.when(F.col("field") == "h1", F.col("at"))).alias("h1"), F.slice(_in_order(told_by, key, "p"), 1, PARAGRAPHS).alias("ps"))
    rows = beside(pages.select(key, F.col(html).alias("_html"), F.col(url).alias("_url"), F.get(products(F.col(html), lists=False), F.lit(0)).alias("_v")), tags, key)
    v, page = F.col("_v"), F.col("_html")
    offer = F.coalesce(F.get(F.try_variant_get(v, "$.offers", "array<variant>"), F.lit(0)), F.try_variant_get(v, "$.offers", "variant"))
    asked = leading_number(F.coalesce(F.try_variant_get(offer, "$.price", "string"), F.try_variant_get(offer, "$.lowPrice", "string")))
    own = F.concat(some(F.regexp_extract("_url", "/p/([A-Za-z0-9]+)", 1)), F.lit(OWN_PRICE))
    behind = leading_number(F.get(F.regexp_extract_all(page, own, F.lit(1)), F.lit(0)))
    stock = F.when(told(v, "$.offers.availability").isNotNull(), F.contains(told(v, "$.offers.availability"), F.lit("InStock"))).otherwise(~F.contains(F.lower(page), F.lit(OUT)))
    return _record(
        rows, key, name=F.coalesce(told(v, "$.name"), some(F.col("h1"))), price=F.coalesce(F.when(asked > 0, asked), F.when(behind > 0, behind)), currency=F.coalesce(told(v, "$.offers.priceCurrency"), F.lit(MEANT)), in_stock=stock, image_urls=pictures(v),
        rating=leading_number(F.regexp_extract(page, RATED, 1)), review_count=F.regexp_extract(page, REVIEWED, 1).try_cast("long"), description=some(F.array_join("ps", " | ")),
    )


SHARAF = [
    Rule("name", 0, "(?i)^h1(?:\\s|$)"), Rule("price", 0, meta("itemprop", "price"), take="content"), Rule("currency", 0, meta("itemprop", "priceCurrency"), take="content"), Rule("image", 0, "(?i)^img(?=.*\\ssrc=[\"']?[^\"'\\s>]*pimcdn\\.sharafdg\\.com)", take="src"),
    Rule("about", 0, "(?i)^ul(?:\\s|$)", (by_class("product-summary"),)), Rule("rating", 0, by_attribute("itemprop", "ratingValue")), Rule("reviews", 0, by_attribute("itemprop", "reviewCount")), Rule("stock", 0, by_attribute("itemprop", "availability"), take="href"),
]


def sharaf(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Attributes of tags tell price, rating and stock; stock as in `carrefour` where they do not."""
    found = values(pages, SHARAF, key, html)
    first = found.groupBy(key).agg(*(F.min_by("value", F.when(F.col("field") == f, F.col("at"))).alias(f) for f in ("name", "price", "currency", "about", "rating", "reviews", "stock")), F.array_distinct(_in_order(found, key, "image")).alias("images"))
    rows = beside(pages.select(key, F.col(html).alias("_html")), first, key)
    stock = F.coalesce(F.col("stock"), F.lit(""))
    said = F.when(F.contains(stock, F.lit("InStock")), True).when(F.contains(stock, F.lit("OutOfStock")), False).otherwise(~F.contains(F.lower("_html"), F.lit(OUT)))
    return _record(
        rows, key, name=some(trimmed(F.col("name"))), price=leading_number(F.col("price")), currency=F.when(F.col("currency") != "", trimmed(F.col("currency"))), in_stock=said, image_urls=F.filter("images", lambda u: u != ""),
        rating=leading_number(trimmed(F.col("rating"))), review_count=F.regexp_extract("reviews", "^\\s*([+-]?\\d+)", 1).try_cast("long"), description=some(folded(F.col("about"))),
    )


JUMBO = [
    Rule("title", 0, meta("property", "og:title"), take="content"), Rule("h1", 0, "(?i)^h1(?:\\s|$)"), Rule("price", 0, class_has("price")), Rule("price", 1, meta("property", "product:price:amount"), take="content"),
    Rule("image", 0, meta("property", "og:image"), take="content"), Rule("image", 1, "(?i)^img(?=.*\\ssrc=[\"']?[^\"'\\s>]*catalog/product)", take="src"), Rule("about", 0, meta("property", "og:description"), take="content"),
]


def jumbo(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """The last structured product, if it has a name and a price above zero; else all fields by tags, with nothing known about stock."""
    first = _firsts(values(pages, JUMBO, key, html), key, "title", "h1", "price", "image", "about")
    rows = beside(pages.select(key, F.try_element_at(products(F.col(html)), F.lit(-1)).alias("_v")), first, key)
    v = F.col("_v")
    price = leading_number(F.try_variant_get(v, "$.offers.price", "string"))
    whole = told(v, "$.name").isNotNull() & (price > 0)
    either = lambda structured, tags: F.when(whole, structured).otherwise(tags)
    title = trimmed(F.regexp_replace(F.regexp_replace("title", "(?i)^Buy\\s+", ""), "(?i)\\s+Online in UAE.*$", ""))
    above = lambda n: F.when(n > 0, n)
    cut = lambda text: some(F.substring(text, 1, MOST_DESCRIPTION))
    stars = leading_number(told(v, "$.aggregateRating.ratingValue"))
    count = F.regexp_extract(told(v, "$.aggregateRating.reviewCount"), "^\\s*(\\d+)", 1).try_cast("long")
    return _record(
        rows, key, name=either(told(v, "$.name"), F.coalesce(some(title), some(trimmed(F.col("h1"))))), price=either(price, above(first_amount(F.col("price")))), currency=either(F.coalesce(told(v, "$.offers.priceCurrency"), F.lit(MEANT)), F.lit(MEANT)),
        in_stock=either(told(v, "$.offers.availability").rlike("(?i)InStock"), F.lit(None)), image_urls=either(pictures(v), F.array_compact(F.array("image"))), rating=either(above(stars), F.lit(None)), review_count=either(above(count), F.lit(None)),
        description=either(cut(told(v, "$.description")), cut(F.col("about"))),
    )


NAMSHI = [
    *(Rule("name", i, s) for i, s in enumerate(("(?i)^h1(?=\\s).*\\sclass=[\"']?[^\"'>]*product", class_has("(?-i:ProductName)"), by_attribute("data-testid", "product-name"), "(?i)^h1(?:\\s|$)"))),
    *(Rule("price", i, s) for i, s in enumerate((class_has("(?-i:product-price)"), class_has("(?-i:ProductPrice)"), by_attribute("data-testid", "product-price"), class_has("(?-i:price)")))),
    Rule("image", 0, "(?i)^img(?=\\s).*\\sclass=[\"']?[^\"'>]*(?-i:product)", take="src"), Rule("image", 1, "(?i)^img(?:\\s|$)", (class_has("(?-i:ProductImage)"),), take="src"), Rule("image", 2, meta("property", "og:image"), take="content"),
    Rule("about", 0, class_has("description")),
]


def namshi(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """X6d: the product of the embedded state if it has a name and a price, else the last structured product, else tags, field by field. A
    name ends at the first bar; pictures are those of the shop's image server anywhere in the page."""
    first = _firsts(values(pages, NAMSHI, key, html).withColumn("value", F.when(F.col("field") == "name", trimmed(F.col("value"))).otherwise(F.col("value"))), key, "name", "price", "image", "about")
    state = F.try_parse_json(F.regexp_extract(html, STATE, 1))
    an_object = lambda path: F.when(F.schema_of_variant(F.try_variant_get(state, path, "variant")).startswith("OBJECT"), F.try_variant_get(state, path, "variant"))
    own = F.coalesce(*(an_object(f"$.props.pageProps.{p}") for p in ("product", "productDetails", "data.product")))
    rows = beside(pages.select(key, F.array_distinct(F.regexp_extract_all(html, F.lit(GALLERY), F.lit(1))).alias("_shown"), own.alias("_s"), F.try_element_at(products(F.col(html)), F.lit(-1)).alias("_v")), first, key)
    s, v = F.col("_s"), F.col("_v")
    any_of = lambda block, *paths: F.coalesce(*(told(block, f"$.{p}") for p in paths))
    cut = lambda text: some(F.substring(text, 1, MOST_DESCRIPTION))
    price = digits_number(any_of(s, "price", "salePrice", "currentPrice"))
    whole = any_of(s, "name", "productName").isNotNull() & price.isNotNull()
    either = lambda embedded, other: F.when(whole, embedded).otherwise(other)
    full = F.coalesce(told(v, "$.name"), F.col("name"))
    name = F.coalesce(some(trimmed(F.regexp_replace(full, "\\s*\\|.*$", ""))), full)
    listed = F.array_compact(F.transform(F.try_variant_get(s, "$.images", "array<variant>"), lambda x: told(x, "$")))
    main = F.coalesce(any_of(s, "image", "imageUrl"), F.get(listed, F.lit(0)))
    image = F.coalesce(F.get(pictures(v), F.lit(0)), F.col("image"))
    seen = F.when(F.size("_shown") > 0, F.col("_shown")).otherwise(F.array_compact(F.array(image)))
    truth = lambda path: F.try_variant_get(s, path, "boolean")
    asked = digits_number(any_of(v, "offers.price", "offers.lowPrice"))
    whole_number = lambda text: F.regexp_extract(text, "^\\s*(\\d+)", 1).try_cast("long")
    return _record(
        rows, key, name=either(any_of(s, "name", "productName"), name), price=either(price, F.coalesce(asked, digits_number(F.col("price")))), currency=F.lit(MEANT), in_stock=either(F.coalesce(truth("$.inStock"), truth("$.available")), told(v, "$.offers.availability").rlike("(?i)InStock")),
        image_url=either(main, image), image_urls=either(F.coalesce(listed, F.array_compact(F.array(main))), seen), rating=either(leading_number(told(s, "$.rating")), F.nullif(leading_number(told(v, "$.aggregateRating.ratingValue")), F.lit(0.0))),
        review_count=either(whole_number(told(s, "$.reviewCount")), F.nullif(whole_number(told(v, "$.aggregateRating.reviewCount")), F.lit(0))), description=either(cut(any_of(s, "description", "shortDescription")), F.coalesce(cut(told(v, "$.description")), cut(trimmed(F.col("about"))))),
    )


_VALUE = by_class("value")
MUMZWORLD = [
    *(Rule("name", i, s, w) for i, (s, w) in enumerate((("(?i)^span(?=.*\\sitemprop=[\"']?name(?=[\"'\\s>]|$))", ()), (by_class("base"), (by_class("page-title"),)), (by_class("product-name", "h1"), ()), ("(?i)^h1(?:\\s|$)", ())))),
    Rule("meta_price", 0, meta("itemprop", "price"), take="content"), Rule("currency", 0, meta("itemprop", "priceCurrency"), take="content"),
    *(Rule("price", i, by_class("price"), (w,)) for i, w in enumerate((by_attribute("data-price-type", "finalPrice"), by_class("product-info-price"), by_class("price-box")))), Rule("price", 3, class_has("(?-i:product-price)")),
    Rule("image", 0, "(?i)^img(?:\\s|$)", take="src"), Rule("rating", 0, by_attribute("itemprop", "ratingValue"), take="content"), Rule("rating_text", 0, by_attribute("itemprop", "ratingValue")), Rule("stars", 0, by_class("rating-result"), take="title"),
    Rule("reviews", 0, by_attribute("itemprop", "reviewCount"), take="content"), Rule("reviews_text", 0, by_attribute("itemprop", "reviewCount")), Rule("stock", 0, by_attribute("itemprop", "availability"), take="href"), Rule("stock_content", 0, by_attribute("itemprop", "availability"), take="content"),
    Rule("there", 0, "(?i)^(?=[a-z0-9]+\\s.*class=[\"']?(?:[^\"'>]*\\s)?stock[\"'\\s>])(?=.*class=[\"'](?:[^\"']*\\s)?available[\"'\\s])"), Rule("gone", 0, "(?i)^(?=[a-z0-9]+\\s.*class=[\"']?(?:[^\"'>]*\\s)?stock[\"'\\s>])(?=.*class=[\"'](?:[^\"']*\\s)?unavailable[\"'\\s])"),
    Rule("about", 0, _VALUE, ("(?i)^[a-z0-9]+\\s(?=.*class=[\"'](?:[^\"']*\\s)?product[\"'\\s])(?=.*class=[\"'](?:[^\"']*\\s)?attribute[\"'\\s])(?=.*class=[\"'](?:[^\"']*\\s)?description[\"'\\s])",)), Rule("about", 1, _VALUE, (by_class("product-info-description"),)), Rule("about", 2, by_attribute("itemprop", "description")),
]


def mumzworld(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """X6e: attributes of tags, then boxes, then structured blocks. A rating in percent is one of five stars; stock by what a link says, by
    the class of a box, by the first block that tells."""
    found = values(pages, MUMZWORLD, key, html)
    one = _firsts(found.withColumn("value", F.when(F.col("field") == "name", trimmed(F.col("value"))).otherwise(F.col("value"))), key, "name", "meta_price", "currency", "price", "rating", "stars", "reviews", "stock", "stock_content")
    every = found.where("field IN ('about', 'rating_text', 'reviews_text')").groupBy(key, "field", "precedence").agg(trimmed(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]), "")).alias("value")).where("value <> ''")
    texts = every.groupBy(key).agg(*(F.min_by("value", F.when(F.col("field") == f, F.col("precedence"))).alias(f) for f in ("about", "rating_text", "reviews_text")))
    seen = found.groupBy(key).agg(F.array_distinct(_in_order(found, key, "image")).alias("images"), F.bool_or(F.col("field") == "there").alias("there"), F.bool_or(F.col("field") == "gone").alias("gone"))
    rows = pages.select(key, products(F.col(html)).alias("_vs"))
    for part in (one, texts, seen):
        rows = beside(rows, part, key)
    first_of = lambda f: F.get(F.array_compact(F.transform("_vs", f)), F.lit(0))
    offer = lambda v: F.coalesce(F.get(F.try_variant_get(v, "$.offers", "array<variant>"), F.lit(0)), F.try_variant_get(v, "$.offers", "variant"))
    price = F.when(F.col("meta_price").isNotNull(), leading_number(F.col("meta_price"))).when(F.col("price").rlike("[\\d,]"), first_amount(F.col("price"))).otherwise(leading_number(first_of(lambda v: told(v, "$.offers.price"))))
    rating = F.coalesce("rating", "rating_text")
    stars = F.floor(leading_number(F.regexp_extract("stars", "([\\d.]+)%", 1)) / 100 * 5 * 10 + 0.5) / 10
    said = F.coalesce("stock", "stock_content")
    stock = F.when(said.isNotNull(), said.rlike("(?i)InStock")).when(F.col("there"), True).when(F.col("gone"), False).otherwise(first_of(lambda v: told(offer(v), "$.availability")).rlike("(?i)InStock"))
    fine = lambda u: u.rlike("mumzworld|media/catalog/product|s3-pwa-prod") & ~u.rlike("placeholder|logo")
    about = F.coalesce(F.when(F.length("about") > LEAST_DESCRIPTION, F.col("about")), first_of(lambda v: told(v, "$.description")))
    return _record(
        rows, key, name=F.col("name"), price=F.nullif(price, F.lit(0.0)), currency=F.coalesce("currency", F.lit(MEANT)), in_stock=stock, image_urls=F.filter("images", fine), rating=F.when(rating.isNotNull(), leading_number(rating)).otherwise(stars),
        review_count=F.regexp_extract(F.coalesce("reviews", "reviews_text"), "(\\d+)", 1).try_cast("long"), description=F.substring(about, 1, MOST_DESCRIPTION),
    )
