"""Links of listing pages as column expressions: distinct product links of a page, in order of appearance.

All take the page as text. A null page gives null, a page without links an empty array. An href is read from anchors, with
`&amp;` decoded; an address without a scheme belongs to the site.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pages of a shop that look like products, and the least length of a product's slug.
JUMBO_CATEGORIES = (
    "mobile-phones television-home-theaters headphones-speakers cameras wearables gaming home-appliances health-and-personal-care "
    "personal-computers accessories smart-home deals offers brands new-arrivals clearance"
).split()
JUMBO_OTHERS = "^(deal-of-the-day|best-sellers?|new-arrivals?|top-deals|clearance-sale)$|^advance-for-"
JUMBO_WORDS = 4
MUMZWORLD_CATEGORIES = (
    "sign-in collections nursery-bedroom feeding-and-nursing toys-learning bath-and-skin-care health-safety baby-clothing-shoes "
    "back-to-school household-supplies party-supplies wishlist privacy-policy terms contact about faq help shipping return yalla app"
).split()
MUMZWORLD_SLUG = 20
ADDRESS = "^(?i)(https?)://([^/?#:]+)(?::[0-9]+)?([^?#]*)"


def hrefs(html: Column) -> Column:
    """Targets of a page's anchors."""
    raw = F.regexp_extract_all(html, F.lit("(?i)<a\\s(?:[^>]*?\\s)?href\\s*=\\s*(\"[^\"]*\"|'[^']*')"), F.lit(1))
    return F.transform(raw, lambda h: F.replace(F.substr(h, F.lit(2), F.length(h) - 2), F.lit("&amp;"), F.lit("&")))


def _links(found: Column, clean) -> Column:
    return F.array_distinct(F.array_compact(F.transform(found, clean)))


def _at(h: Column, origin: str) -> Column:
    """The address of an href on a site."""
    return F.when(h.startswith("//"), F.concat(F.lit("https:"), h)).when(h.startswith("/"), F.concat(F.lit(origin), h)).otherwise(h)


def amazon(html: Column, origin: str = "https://www.amazon.ae") -> Column:
    """`/dp/<id>` of the shop's own pages; links to reviews and redirects are no products."""

    def clean(h: Column) -> Column:
        url = _at(h, origin)
        host, path = F.lower(F.regexp_extract(url, ADDRESS, 2)), F.regexp_extract(url, ADDRESS, 3)
        item = lambda p: F.concat(F.lit("/dp/"), F.regexp_extract(path, p, 1))
        short = F.when(path.rlike("/dp/"), item("/dp/([^/]*)")).when(path.rlike("/product/"), item("/product/([^/]*)")).otherwise(path)
        wanted = (h.contains("/dp/") | h.contains("/gp/product/")) & ~h.rlike("customer-reviews|#customerReviews|/slredirect/")
        own = F.when(host.isin("www.amazon.ae", "amazon.ae"), F.concat(F.lit("https://www.amazon.ae"), short))
        return F.when(wanted, F.when(host == "", h).otherwise(own))

    return _links(hrefs(html), clean)


def product_paths(html: Column, origin: str) -> Column:
    """Addresses with `/p/`, without query and fragment."""

    def clean(h: Column) -> Column:
        url = _at(h, origin)
        host = F.lower(F.regexp_extract(url, ADDRESS, 2))
        bare = F.concat(F.lower(F.regexp_extract(url, ADDRESS, 1)), F.lit("://"), host, F.regexp_extract(url, ADDRESS, 3))
        return F.when(h.contains("/p/"), F.when(host == "", h).otherwise(bare))

    return _links(hrefs(html), clean)


def sharafdg(html: Column, origin: str = "https://uae.sharafdg.com") -> Column:
    """`/product/<slug>/`."""

    def clean(h: Column) -> Column:
        url = _at(h, origin)
        slug = F.regexp_extract(F.regexp_extract(url, ADDRESS, 3), "^/+product/+([^/]+)", 1)
        host = F.lower(F.regexp_extract(url, ADDRESS, 2))
        whole = F.concat(F.lower(F.regexp_extract(url, ADDRESS, 1)), F.lit("://"), host, F.lit("/product/"), slug, F.lit("/"))
        return F.when(h.contains("/product/") & host.contains("sharafdg.com") & (slug != ""), whole)

    return _links(hrefs(html), clean)


def _full(h: Column, origin: str) -> Column:
    return F.when(h.startswith("http"), h).when(h.startswith("/"), F.concat(F.lit(origin), h)).otherwise(F.concat(F.lit(f"{origin}/"), h))


def jumbo(html: Column, origin: str = "https://www.jumbo.ae") -> Column:
    """S7d: pages of one path segment whose slug has at least JUMBO_WORDS words and names no category."""

    def clean(h: Column) -> Column:
        full = _full(h, origin)
        bare = F.split(full, "[?#]")[0]
        slug = F.regexp_extract(bare, "(?i)^https?://[^/]+/+([^/]+)\\.html$", 1)
        words = F.size(F.filter(F.split(slug, "-"), lambda w: w != ""))
        return F.when(full.contains("jumbo.ae") & (slug != "") & ~slug.isin(JUMBO_CATEGORIES) & ~slug.rlike(JUMBO_OTHERS) & (words >= JUMBO_WORDS), bare)

    return _links(hrefs(html), clean)


def mumzworld(html: Column, origin: str = "https://www.mumzworld.com") -> Column:
    """S7e: a last segment after `/en/` of at least MUMZWORLD_SLUG characters."""

    def clean(h: Column) -> Column:
        full = _full(h, origin)
        bare = F.split(full, "[?]")[0]
        slug = F.regexp_extract(bare, "/en/([^/]+)/?$", 1)
        good = h.contains("/en/") & full.contains("mumzworld.com") & (F.length(slug) >= MUMZWORLD_SLUG) & ~slug.isin(MUMZWORLD_CATEGORIES)
        return F.when(good, bare)

    return _links(hrefs(html), clean)


def namshi(html: Column) -> Column:
    """S7f: `url` fields of embedded JSON; addresses anywhere in the page only if there are none."""
    fields = F.array_distinct(F.regexp_extract_all(html, F.lit('"url"\\s*:\\s*"(https?://(?:www\\.)?namshi\\.com/uae-en/[^"]+/p/)"'), F.lit(1)))
    loose = F.regexp_extract_all(html, F.lit("https?://(?:www\\.)?namshi\\.com/uae-en/[^\"'\\s]{10,}/p/"), F.lit(0))
    return F.when(F.size(fields) > 0, fields).otherwise(F.array_distinct(F.transform(loose, lambda u: F.split(u, "[?]")[0])))


def _first_of_each(pairs: Column) -> Column:
    """The first value of each key among (key, value) pairs, in order."""
    keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    return F.transform(keys, lambda k: F.filter(pairs, lambda p: p["key"] == k)[0]["value"])


def subcategory_links(html: Column, origin: str) -> Column:
    """Listings of a store, `/<country>/grocery/<id>/<slug>/<category>/<sub>`, the first link of each path with its query."""
    path = lambda h: F.when(h.startswith("http"), F.regexp_extract(h, ADDRESS, 3)).otherwise(F.split(h, "[?#]")[0])
    found = F.filter(hrefs(html), lambda h: path(h).rlike("(?i)^/[a-z-]+/grocery/\\d+/[^/?#]+/[^/?#]+/[^/?#]+$"))
    return _first_of_each(F.transform(found, lambda h: F.struct(path(h).alias("key"), F.when(h.startswith("http"), h).otherwise(F.concat(F.lit(origin), h)).alias("value"))))


def store_links(html: Column, origin: str) -> Column:
    """Stores of an area page, the first link of each branch; and the highest page that it links to, 1 if to none (`stores`, `max_page`)."""
    found = F.filter(hrefs(html), lambda h: h.rlike("(?i)/[a-z-]+/grocery/\\d+/[^/?#]+"))
    piece = lambda h, g: F.regexp_extract(h, "(?i)/[a-z-]+/grocery/(\\d+)/[^/?#]+", g)
    stores = _first_of_each(F.transform(found, lambda h: F.struct(piece(h, 1).alias("key"), F.concat(F.lit(origin), piece(h, 0)).alias("value"))))
    pages = F.transform(hrefs(html), lambda h: F.regexp_extract(h, "[?&]page=(\\d+)\\b", 1).try_cast("int"))
    return F.struct(stores.alias("stores"), F.greatest(F.lit(1), F.array_max(pages)).alias("max_page"))


def rating_widget(html: Column) -> Column:
    """Rating (over 0, at most 5) and number of raters of a loox-rating element."""
    tag = F.regexp_extract(html, '(?i)<[^>]*class="[^"]*\\bloox-rating\\b[^"]*"[^>]*>', 0)
    rating = F.regexp_extract(F.regexp_extract(tag, 'data-rating="([\\d.]*)"', 1), "^(\\d+\\.?\\d*|\\.\\d+)", 1).try_cast("double")
    raters = F.regexp_extract(tag, 'data-raters="(\\d*)"', 1).try_cast("long")
    return F.struct(F.when((rating > 0) & (rating <= 5), rating).alias("rating"), F.when(raters > 0, raters).alias("raters"))
