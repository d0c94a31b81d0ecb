"""Queries on product pages: pages of two shops made of parts, and the tag stream of the given pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.plans.catalog import register
from tallymart.sources import product_pages
from tallymart.sources.tables import table

c = F.col


def _page(*parts):
    """Pieces of HTML by part: texts, columns or (condition, text) for pieces that only some pages have."""
    return F.concat(*(F.when(p[0], p[1] if hasattr(p[1], "alias") else F.lit(p[1])).otherwise("") if isinstance(p, tuple) else p if hasattr(p, "alias") else F.lit(p) for p in parts))


@register(
    "first_shop_pages",
    """SELECT p_partkey AS page_id, p_name AS name, CASE WHEN p_size % 5 = 4 THEN NULL WHEN p_size % 5 = 3 THEN floor(p_retailprice) + 0.05 ELSE p_retailprice END AS price, CASE WHEN p_size % 5 <> 4 THEN 'AED' END AS currency,
 CASE WHEN p_partkey % 4 = 0 THEN false WHEN p_partkey % 4 = 1 OR p_partkey % 8 = 2 THEN true END AS in_stock, CASE WHEN p_partkey % 3 = 0 THEN 'https://i/' || p_partkey || 'a.jpg,https://i/' || p_partkey || 'b.jpg' ELSE 'https://i/' || p_partkey || '.jpg' END AS images,
 p_size % 50 / 10 AS rating, p_partkey * 1000 + 7 AS review_count, p_brand || ' | ' || p_type AS description FROM part""",
)
def first_shop_pages(spark, sf):
    """Prices for screen readers, split ones, struck through ones before them, ones in another currency; other products around."""
    k, size = c("p_partkey"), c("p_size")
    price = F.format_number("p_retailprice", 2)
    html = _page(
        '<html><div class="carousel"><span class="a-price"><span class="a-offscreen">AED 1.00</span></span></div><span id="productTitle"> ', c("p_name"), "\n</span>",
        (size % 5 <= 1, _page('<div id="corePrice_desktop"><p><span class="a-price a-text-price"><span class="a-offscreen">AED 99,999.00</span></span><span class="a-price"><span class="a-offscreen">AED&nbsp;', price, "</span></span></div>")),
        (size % 5 == 2, _page('<div id="apex_desktop"><div class="x priceToPay"><span class="a-offscreen">', price, "</span></div></div>")),
        (size % 5 == 3, _page('<div id="newBuyBoxPrice"><span class="b a-price"><span class="a-price-symbol">AED</span><span class="a-price-whole">', F.format_number(F.floor("p_retailprice"), 0), '<span>.</span></span><span class="a-price-fraction">05</span></span></div>')),
        (size % 5 == 4, _page('<div id="corePrice_feature_div"><span class="a-price"><span class="a-offscreen">USD ', price, "</span></span></div>")),
        (k % 4 == 0, '<div id="availability"><span>Currently  unavailable.</span></div><button id="add-to-cart-button">'), (k % 4 == 1, '<div id="availability">In stock</div>'), (k % 8 == 2, '<button id="buy-now-button">Buy</button>'), (k % 8 == 6, '<button id="buy-now-button" disabled>Buy</button>'),
        '<img id="landingImage" src="https://i/', k.cast("string"), '.jpg"', (k % 3 == 0, _page(' data-a-dynamic-image="{&quot;https://i/', k.cast("string"), "a.jpg&quot;:[1,2],&quot;https://i/", k.cast("string"), 'b.jpg&quot;:[1,2]}"')), ">",
        '<div id="acrPopover" title="', (size % 50 / 10).cast("string"), ' out of 5"></div><span id="acrCustomerReviewText">', F.format_number(k * 1000 + 7, 0), ' ratings</span><div id="feature-bullets"><ul><li>', c("p_brand"), '</li><li class="aplus-module">x</li><li>', c("p_type"), "</li></ul></div></html>",
    )
    pages = table(spark, sf, "part").select(k.alias("page_id"), html.alias("html"))
    return product_pages.amazon(pages).select("page_id", "name", "price", "currency", "in_stock", F.array_join("image_urls", ",").alias("images"), "rating", "review_count", "description")


@register(
    "second_shop_pages",
    """SELECT p_partkey AS page_id, p_name AS name, CASE WHEN p_size % 9 > 0 THEN p_retailprice END AS price, CASE WHEN p_partkey % 4 = 0 THEN false WHEN p_partkey % 4 = 1 THEN true END AS in_stock,
 CASE WHEN p_partkey % 3 = 0 THEN 'https://f.nooncdn.com/p/pnsku/N' || (p_partkey + 1000000) || 'A/1.jpg' WHEN p_partkey % 3 = 1 THEN 'https://f.nooncdn.com/p/og.jpg' ELSE 'https://f.nooncdn.com/p/own.jpg' END AS images,
 4.5::DOUBLE AS rating, CAST(p_size AS BIGINT) AS review_count, p_type AS description FROM part""",
)
def second_shop_pages(spark, sf):
    """Pictures by the page's own id, by what the page declares, or the first outside of other products."""
    k = c("p_partkey")
    sku = F.concat(F.lit("N"), (k + 1000000).cast("string"), F.lit("A"))
    html = _page(
        (k % 3 == 1, '<meta property="og:image" content="https://f.nooncdn.com/p/og.jpg">'), "<h1>", c("p_name"), '</h1><div class="recommended"><img src="https://f.nooncdn.com/p/pnsku/N777777A/1.jpg"></div>',
        (k % 3 == 0, _page('<img src="https://f.nooncdn.com/p/pnsku/', sku, '/1.jpg">')), '<img src="https://f.nooncdn.com/p/own.jpg">', '<div data-qa="div-price-now">', F.when(c("p_size") % 9 > 0, F.format_number("p_retailprice", 2)).otherwise("none"), "</div>",
        '<div class="a ratingCtr">4.5', c("p_size").cast("string"), ' Ratings</div><div class="highlightsCtr">Highlights ', c("p_type"), "</div>", (k % 4 == 0, "<main><b>Sold out</b></main>"), (k % 4 == 1, '<button data-qa="pdp-add-to-cart">Add to cart</button>'), (k % 4 == 2, '<button data-qa="pdp-add-to-cart" disabled>Add to cart</button>'),
    )
    pages = table(spark, sf, "part").select(k.alias("page_id"), F.concat(F.lit("https://www.noon.com/x/"), F.when(k % 3 == 0, sku).otherwise("abc"), F.lit("/p/")).alias("url"), html.alias("html"))
    return product_pages.noon(pages).select("page_id", "name", "price", "in_stock", F.array_join("image_urls", ",").alias("images"), "rating", "review_count", "description")


@register(
    "page_parts",
    r"""WITH p AS (SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->|<(?:script|style|noscript)\b[^>]*>.*?</(?:script|style|noscript)\s*>', '', 'g') AS body FROM pages),
h AS (SELECT page_id, list_transform(regexp_extract_all(body, '(?is)<h1[^>]*>(.*?)</h1>', 1), lambda x: regexp_replace(x, '<[^>]*>', '', 'g')) AS titles, regexp_extract_all(body, '(?is)<nav[^>]*>.*?</nav>') AS navs FROM p)
SELECT page_id, CASE WHEN len(titles) > 0 THEN trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(titles[1], '&quot;', '"'), '&#39;', ''''), '&#x27;', ''''), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) END AS title,
 CAST(coalesce(list_sum(list_transform(navs, lambda x: len(regexp_extract_all(x, '(?is)<a\s[^>]*href=')))), 0) AS BIGINT) AS links FROM h""",
)
def page_parts(spark, sf):
    """X4's stream over the given pages: the first title, and the links inside navigation."""
    rules = [product_pages.Rule("title", 0, "(?i)^h1(?:\\s|$)"), product_pages.Rule("link", 0, "(?i)^a\\s.*href=", ("(?i)^nav(?:\\s|$)",), take="href")]
    pages = table(spark, sf, "pages").select("page_id", "html")
    found = product_pages.values(pages, rules)
    told = found.groupBy("page_id").agg(F.min_by("value", F.when(c("field") == "title", c("at"))).alias("title"), F.count_if(c("field") == "link").alias("links"))
    return product_pages.beside(pages.select("page_id"), told, "page_id").select("page_id", product_pages.folded(c("title")).alias("title"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))
