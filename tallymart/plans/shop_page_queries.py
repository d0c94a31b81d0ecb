"""Queries on product pages of five more shops; the pages are made of parts, of changing make by key."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.plans.catalog import register
from tallymart.plans.product_page_queries import _page
from tallymart.sources import shop_pages
from tallymart.sources.tables import table

c, lit = F.col, F.lit
_ABOUT = "This text says what the product is for and goes on until it is long enough to count: "


def _read(spark, sf, shop, html, url=None):
    k = c("p_partkey")
    pages = table(spark, sf, "part").select(k.alias("page_id"), (lit("") if url is None else url).alias("url"), html.alias("html"))
    return shop(pages).select("page_id", "name", "price", "currency", "in_stock", F.array_join("image_urls", ",").alias("images"), "rating", "review_count", "description")


def _block(*fields):
    """A structured block of a product."""
    return _page('<script type="application/ld+json">', F.to_json(F.struct(lit("Product").alias("@type"), *fields)), "</script>")


def _offers(price, availability):
    return F.struct(price.cast("string").alias("price"), availability.alias("availability")).alias("offers")


@register(
    "carrefour_pages",
    f"""SELECT p_partkey AS page_id, p_name AS name, CASE WHEN p_partkey % 3 <> 2 THEN p_retailprice END AS price, 'AED' AS currency, CASE WHEN p_partkey % 3 = 0 THEN p_partkey % 2 = 0 ELSE p_partkey % 4 <> 1 END AS in_stock,
 CASE WHEN p_partkey % 3 = 0 THEN p_brand || ',' || p_type ELSE '' END AS images, CASE WHEN p_partkey % 3 = 1 THEN p_size % 5 + 0.5 END::DOUBLE AS rating, CASE WHEN p_partkey % 3 = 1 THEN CAST(p_size AS BIGINT) END AS review_count, '{_ABOUT}' || p_type AS description FROM part""",
)
def carrefour_pages(spark, sf):
    """A structured price, one behind the page's own id, or another product's alone."""
    k = c("p_partkey")
    own = F.concat(lit("AB"), k, lit("Z"))
    price = c("p_retailprice").cast("string")
    html = _page(
        (k % 3 == 0, _block(c("p_name").alias("name"), F.array("p_brand", "p_type").alias("image"), _offers(c("p_retailprice"), F.when(k % 2 == 0, "https://schema.org/InStock").otherwise("https://schema.org/OutOfStock")))),
        "<h1> ", c("p_name"), '</h1><i>{\\"finalPrice\\":\\"208\\"}</i>', (k % 3 == 1, _page('<i>{\\"id\\":\\"', own, '\\",\\"finalPrice\\":\\"', price, '\\",\\"averageRating\\":\\"', (c("p_size") % 5 + 0.5).cast("string"), '\\",\\"totalReviewsText\\":\\"(_', c("p_size").cast("string"), ' reviews)\\"}</i>')),
        "<p>short</p><p>We set a cookie. ", _ABOUT, "</p><p>", _ABOUT, c("p_type"), "</p>", (k % 4 == 1, "<b>OUT OF STOCK</b>"),
    )
    return _read(spark, sf, shop_pages.carrefour, html, F.concat(lit("https://shop.example/en/p/"), own))


@register(
    "sharaf_pages",
    """SELECT p_partkey AS page_id, p_name AS name, CASE WHEN p_size % 7 > 0 THEN p_retailprice END AS price, CASE WHEN p_size % 7 > 0 THEN 'AED' END AS currency, p_partkey % 3 = 0 OR (p_partkey % 3 = 2 AND p_partkey % 4 <> 0) AS in_stock,
 'https://pimcdn.sharafdg.com/' || p_partkey || ',https://pimcdn.sharafdg.com/b' AS images, p_size % 5 + 0.5::DOUBLE AS rating, CAST(p_size AS BIGINT) AS review_count, p_brand || ' ' || p_type AS description FROM part""",
)
def sharaf_pages(spark, sf):
    """What attributes say, and stock that only the page's text tells."""
    k, size = c("p_partkey"), c("p_size")
    img = _page('<img src="https://pimcdn.sharafdg.com/', k.cast("string"), '">')
    html = _page(
        "<h1>", c("p_name"), "</h1>", img, '<img src="https://pimcdn.sharafdg.com/b">', img, '<img src="https://elsewhere.example/x">', (size % 7 > 0, _page('<meta itemprop="price" content="', c("p_retailprice").cast("string"), '"><meta itemprop="priceCurrency" content="AED ">')),
        '<div class="product-summary"><ul><li>', c("p_brand"), "</li>\n  <li>", c("p_type"), '</li></ul></div><ul><li>no</li></ul><b itemprop="ratingValue">', (size % 5 + 0.5).cast("string"), '</b><b itemprop="reviewCount">', size.cast("string"), " reviews</b>",
        (k % 3 == 0, '<link itemprop="availability" href="https://schema.org/InStock">'), (k % 3 == 1, '<link itemprop="availability" href="https://schema.org/OutOfStock">'), (k % 4 == 0, "<p>Out of stock</p>"),
    )
    return _read(spark, sf, shop_pages.sharaf, html)


@register(
    "jumbo_pages",
    """SELECT p_partkey AS page_id, p_name AS name, CASE WHEN p_partkey % 3 = 2 AND p_size % 2 = 0 THEN NULL ELSE p_retailprice END AS price, 'AED' AS currency, CASE WHEN p_partkey % 3 = 0 THEN p_partkey % 2 = 0 END AS in_stock,
 CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE 'https://x/catalog/product/' || p_partkey || '.jpg' END AS images, CASE WHEN p_partkey % 3 = 0 THEN 4.5::DOUBLE END AS rating, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS BIGINT) END AS review_count,
 CASE WHEN p_partkey % 3 = 1 THEN NULL ELSE p_type END AS description FROM part""",
)
def jumbo_pages(spark, sf):
    """The last structured product that is whole, else tags."""
    k, size = c("p_partkey"), c("p_size")
    whole = _block(c("p_name").alias("name"), c("p_brand").alias("image"), c("p_type").alias("description"), _offers(c("p_retailprice"), F.when(k % 2 == 0, "InStock").otherwise("OutOfStock")), F.struct(lit("4.5").alias("ratingValue"), size.alias("reviewCount")).alias("aggregateRating"))
    html = _page(
        _block(lit("an accessory").alias("name"), _offers(lit(1), lit("InStock"))), (k % 3 == 0, whole), (k % 3 != 0, _block(c("p_name").alias("name"))), (k % 3 == 2, _page('<meta property="og:title" content="Buy ', c("p_name"), ' Online in UAE at best price"><meta property="og:description" content="', c("p_type"), '">')),
        (k % 3 == 1, _page("<h1>", c("p_name"), "</h1>")), ((k % 3 == 2) & (size % 2 == 0), '<span class="price">ask</span>'), (~((k % 3 == 2) & (size % 2 == 0)), _page('<span class="special-price">AED ', F.format_number("p_retailprice", 2), "</span>")),
        '<img src="https://x/catalog/product/', k.cast("string"), '.jpg">',
    )
    return _read(spark, sf, shop_pages.jumbo, html)


@register(
    "namshi_pages",
    """SELECT p_partkey AS page_id, CASE WHEN p_partkey % 3 = 0 THEN p_name || ' | new' ELSE p_name END AS name, p_retailprice AS price, 'AED' AS currency, CASE WHEN p_partkey % 3 = 0 THEN p_size > 25 WHEN p_partkey % 3 = 1 THEN true END AS in_stock,
 CASE WHEN p_partkey % 3 = 0 THEN p_brand || ',' || p_type WHEN p_partkey % 3 = 1 THEN 'https://f.nooncdn.com/p/' || p_partkey || '.jpg,https://f.nooncdn.com/p/b.jpg' ELSE 'in.jpg' END AS images, CASE WHEN p_partkey % 3 = 0 THEN 4.5::DOUBLE END AS rating,
 CASE WHEN p_partkey % 3 = 1 THEN CAST(p_size AS BIGINT) END AS review_count, CASE WHEN p_partkey % 3 <> 1 THEN p_type END AS description FROM part""",
)
def namshi_pages(spark, sf):
    """X6d: the embedded state, a structured block, or tags."""
    k, size = c("p_partkey"), c("p_size")
    product = F.struct(F.concat("p_name", lit(" | new")).alias("name"), F.concat(lit("AED "), F.format_number("p_retailprice", 2)).alias("salePrice"), F.array("p_brand", "p_type").alias("images"), (size > 25).alias("inStock"), lit("4.5").alias("rating"), c("p_type").alias("shortDescription"))
    state = F.to_json(F.struct(F.struct(F.struct(product.alias("productDetails")).alias("pageProps")).alias("props")))
    picture = lambda name: _page('<i>{"src": "https://f.nooncdn.com/p/', name, '.jpg"}</i>')
    structured = _page(
        _block(F.concat("p_name", lit(" | Best Price")).alias("name"), lit("l.jpg").alias("image"), F.struct(c("p_retailprice").alias("lowPrice"), lit("InStock").alias("availability")).alias("offers"), F.struct(size.alias("reviewCount")).alias("aggregateRating")),
        picture(k.cast("string")), picture("b"), picture(k.cast("string")),
    )
    html = _page(
        (k % 3 == 0, _page('<script id="__NEXT_DATA__">', state, "</script>")), (k % 3 == 1, structured),
        (k % 3 == 2, _page("<h1>other</h1><div data-testid='x' class=\"a-ProductName\">", c("p_name"), ' | Namshi</div><b class="product-price">AED ', F.format_number("p_retailprice", 2), '</b><div class="ProductImage"><img src="in.jpg"></div><p class="description">', c("p_type"), "</p>")),
    )
    return _read(spark, sf, shop_pages.namshi, html)


@register(
    "mumzworld_pages",
    """SELECT p_partkey AS page_id, p_name AS name, p_retailprice AS price, CASE WHEN p_partkey % 3 = 0 THEN 'USD' ELSE 'AED' END AS currency, CASE p_partkey % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN p_size > 25 END AS in_stock,
 'https://x/media/catalog/product/' || p_partkey || '.jpg' AS images, CASE WHEN p_partkey % 5 = 0 THEN 4.5 ELSE floor(p_size % 50 * 2 / 100.0 * 5 * 10 + 0.5) / 10 END::DOUBLE AS rating, CAST(p_size AS BIGINT) AS review_count,
 CASE WHEN p_partkey % 2 = 0 THEN 'More than twenty characters: ' || p_type WHEN p_partkey % 4 = 3 THEN p_brand END AS description FROM part""",
)
def mumzworld_pages(spark, sf):
    """X6e: attributes, boxes, then structured blocks; stock by a link, a box's class or a block."""
    k, size = c("p_partkey"), c("p_size")
    price = F.format_number("p_retailprice", 2)
    html = _page(
        (k % 2 == 0, _page('<span itemprop="name"> ', c("p_name"), "</span>")), (k % 2 == 1, _page('<div class="page-title"><b class="base">', c("p_name"), "</b></div>")), "<h1>no</h1>",
        (k % 3 == 0, _page('<meta itemprop="price" content="', c("p_retailprice").cast("string"), '"><meta itemprop="priceCurrency" content="USD">')), (k % 3 == 1, _page('<div class="price-box"><span class="price">AED ', price, "</span></div>")),
        (k % 3 == 2, _block(lit("x").alias("name"), F.struct(c("p_retailprice").alias("price")).alias("offers"))), (k % 4 == 0, '<link itemprop="availability" href="https://schema.org/InStock">'), (k % 4 == 1, '<div class="stock unavailable">no</div>'),
        (k % 4 == 2, _block(F.array(F.struct(F.when(size > 25, "InStock").otherwise("OutOfStock").alias("availability"))).alias("offers"))), (k % 4 == 3, _block(c("p_brand").alias("description"))),
        '<img src="https://x/media/catalog/product/', k.cast("string"), '.jpg"><img src="https://x/media/catalog/product/placeholder.jpg">', (k % 5 == 0, '<i itemprop="ratingValue" content="4.5"></i>'), '<div class="rating-result" title="', (size % 50 * 2).cast("string"), '%"></div><i itemprop="reviewCount">', size.cast("string"), " in all</i>",
        (k % 2 == 0, _page('<div class="product attribute description"><div class="value">More than twenty characters: ', c("p_type"), "</div></div>")),
    )
    return _read(spark, sf, shop_pages.mumzworld, html)
