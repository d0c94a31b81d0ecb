"""Product pages of five shops of different make, worked out by hand."""

import json

import pytest

from tallymart.sources import shop_pages

EMPTY = {"name": None, "price": None, "currency": None, "in_stock": None, "image_url": None, "image_urls": [], "rating": None, "review_count": None, "description": None}


def ld(*blocks):
    return "".join(f'<script type="application/ld+json">{b if isinstance(b, str) else json.dumps(b)}</script>' for b in blocks)


def read(spark, shop, pages):
    rows = spark.createDataFrame([(k, u, h, "x", 0) for k, (u, h) in pages.items()], "page_id long, url string, html string, name string, at int")
    return {r.page_id: {k: v for k, v in r.asDict().items() if k != "page_id" and v != EMPTY[k]} for r in shop(rows).collect()}


LONG = "A long text about this product that says all there is to say and then still goes on for a while."


def test_carrefour(spark):
    assert read(spark, shop_pages.carrefour, {
        1: ("https://c/p/55", ld([{"@type": "Product", "name": "list"}], "{bad", {"@type": "Product", "name": "TV", "image": ["a", "", "b"], "offers": {"price": "12.5", "priceCurrency": "USD", "availability": "http://s/OutOfStock"}}, {"@type": "Product", "name": "second"}) + "<h1>no</h1>"),
        2: ("https://c/p/55X?a", f'<h1> Fan </h1>{{\\"id\\":\\"9\\",\\"finalPrice\\":\\"208\\"}} 55X ,\\"finalPrice\\":\\"33.10\\" averageRating\\":\\"4.4\\" totalReviewsText\\":\\"(_12 reviews\\"<p>short</p><p>{LONG}</p><p>{LONG} cookie</p><p>{LONG}2</p><p>{LONG}3</p><p>{LONG}4</p>'),
        3: ("none", ld({"@type": "Product", "image": "one", "offers": [{"lowPrice": 7}]}) + "Out of Stock"), 4: (None, None), 5: ("https://c/p/1", ""),
    }) == {
        1: {"name": "TV", "price": 12.5, "currency": "USD", "in_stock": False, "image_url": "a", "image_urls": ["a", "b"]},
        2: {"name": "Fan", "price": 33.1, "currency": "AED", "in_stock": True, "rating": 4.4, "review_count": 12, "description": f"{LONG} | {LONG}2 | {LONG}3"},
        3: {"price": 7.0, "currency": "AED", "in_stock": False, "image_url": "one", "image_urls": ["one"]}, 4: {"currency": "AED"}, 5: {"currency": "AED", "in_stock": True},
    }


def test_sharaf(spark):
    img = '<img src="https://pimcdn.sharafdg.com/{}">'
    assert read(spark, shop_pages.sharaf, {
        1: (None, f'<h1>Kettle</h1><meta itemprop="price" content="99.5 x"><meta content=" AED " itemprop="priceCurrency">{img.format(1)}{img.format(2)}{img.format(1)}<img src="https://x/3"><div class="a product-summary"><ul><li>One </li>\n<li>Two</li></ul><ul>no</ul></div>'
            '<span itemprop="ratingValue">4.5</span><span itemprop="reviewCount">17 reviews</span><link itemprop="availability" href="http://s/OutOfStock">'),
        2: (None, "<h1></h1> Out Of stock"), 3: (None, '<link itemprop="availability" href="http://s/InStock"> out of stock'), 4: (None, None),
    }) == {
        1: {"name": "Kettle", "price": 99.5, "currency": "AED", "in_stock": False, "image_url": "https://pimcdn.sharafdg.com/1", "image_urls": ["https://pimcdn.sharafdg.com/1", "https://pimcdn.sharafdg.com/2"], "rating": 4.5, "review_count": 17, "description": "One Two"},
        2: {"in_stock": False}, 3: {"in_stock": True}, 4: {},
    }


def test_jumbo(spark):
    assert read(spark, shop_pages.jumbo, {
        1: (None, ld({"@type": "Product", "name": "first", "offers": {"price": 1}}, [{"@type": "Other"}, {"@type": "Product", "name": "TV", "description": "d" * 600, "image": "i", "offers": {"price": "5.5", "availability": "instock"}, "aggregateRating": {"ratingValue": "4.1", "reviewCount": 3}}])),
        2: (None, ld({"@type": "Product", "name": "TV", "offers": {"price": 0}}) + '<meta property="og:title" content="Buy  LG TV Online in UAE | Shop"><span class="old-price">AED 1,299.00</span><meta property="og:image" content="o.jpg"><meta property="og:description" content="about">'),
        3: (None, '<h1> Fan </h1><meta property="product:price:amount" content="20"><img src="https://x/catalog/product/1.jpg">'), 4: (None, None),
    }) == {
        1: {"name": "TV", "price": 5.5, "currency": "AED", "in_stock": True, "image_url": "i", "image_urls": ["i"], "rating": 4.1, "review_count": 3, "description": "d" * 500},
        2: {"name": "LG TV", "price": 1299.0, "currency": "AED", "image_url": "o.jpg", "image_urls": ["o.jpg"], "description": "about"},
        3: {"name": "Fan", "price": 20.0, "currency": "AED", "image_url": "https://x/catalog/product/1.jpg", "image_urls": ["https://x/catalog/product/1.jpg"]}, 4: {"currency": "AED"},
    }


def test_namshi(spark):
    state = lambda d: f'<script id="__NEXT_DATA__" type="application/json">{json.dumps({"props": {"pageProps": d}})}</script>'
    assert read(spark, shop_pages.namshi, {
        1: (None, state({"data": {"product": {"productName": "Shoe | x", "price": 0, "salePrice": "AED 49.5", "images": ["a", None, "b"], "available": False, "rating": "4.5", "reviewCount": "8", "shortDescription": "s"}}})),
        2: (None, state({"product": {"name": "no price"}}) + ld({"@type": "Product", "name": "Bag | Best Price", "image": ["l"], "offers": {"lowPrice": 70, "availability": "InStock"}, "aggregateRating": {"ratingValue": 0}}) + '{"src": "https://f.nooncdn.com/p/1.jpg"}{"imageUrl":"https://f.nooncdn.com/p/2.jpg"}{"src":"https://f.nooncdn.com/p/1.jpg"}'),
        3: (None, '<h1>plain</h1><div class="xProductName"> Hat | y</div><b class="price">none</b><i data-testid="product-price">AED 9</i><div class="ProductImage"><img src="in.jpg"></div><p class="description"> text </p>'), 4: (None, None),
    }) == {
        1: {"name": "Shoe | x", "price": 49.5, "currency": "AED", "in_stock": False, "image_url": "a", "image_urls": ["a", "b"], "rating": 4.5, "review_count": 8, "description": "s"},
        2: {"name": "Bag", "price": 70.0, "currency": "AED", "in_stock": True, "image_url": "l", "image_urls": ["https://f.nooncdn.com/p/1.jpg", "https://f.nooncdn.com/p/2.jpg"]},
        3: {"name": "Hat", "price": 9.0, "currency": "AED", "image_url": "in.jpg", "image_urls": ["in.jpg"], "description": "text"}, 4: {"currency": "AED"},
    }


def test_mumzworld(spark):
    assert read(spark, shop_pages.mumzworld, {
        1: (None, '<h1>no</h1><span itemprop="name"> </span><div class="page-title"><span class="base">Cot</span></div><meta itemprop="price" content="150"><meta itemprop="priceCurrency" content="USD"><img src="https://mumzworld/a.jpg"><img src="https://mumzworld/logo.jpg"><img src="https://z/b.jpg">'
            '<div class="rating-result" title="87%"></div><a itemprop="reviewCount" content="12 in all"></a><link itemprop="availability" href="x/instock"><div class="product attribute description"><div class="value">More than twenty characters here.</div></div>'),
        2: (None, '<h1 class="product-name">Pram</h1><div class="price-box"><span class="price">AED 1,020.50</span></div><div class="stock unavailable">x</div><i itemprop="ratingValue">4.2</i><b itemprop="description">too short</b>' + ld([{"@type": "Product", "description": "of the block", "offers": {"price": 3}}])),
        3: (None, ld("{", {"@type": "Product"}, {"@type": "Product", "offers": [{"availability": "OutOfStock"}]}, {"@type": "Product", "offers": {"price": "8.5", "availability": "InStock"}})), 4: (None, None), 5: (None, '<p class="stock available">'),
    }) == {
        1: {"name": "Cot", "price": 150.0, "currency": "USD", "in_stock": True, "image_url": "https://mumzworld/a.jpg", "image_urls": ["https://mumzworld/a.jpg"], "rating": 4.4, "review_count": 12, "description": "More than twenty characters here."},
        2: {"name": "Pram", "price": 1020.5, "currency": "AED", "in_stock": False, "rating": 4.2, "description": "of the block"},
        3: {"price": 8.5, "currency": "AED", "in_stock": False}, 4: {"currency": "AED"}, 5: {"currency": "AED", "in_stock": True},
    }


@pytest.mark.parametrize("shop", [shop_pages.carrefour, shop_pages.sharaf, shop_pages.jumbo, shop_pages.namshi, shop_pages.mumzworld])
def test_no_pages(spark, shop):
    assert shop(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
