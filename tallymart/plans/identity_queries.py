"""Queries on the identity of listings and titles: marketplace ids, URLs, variants, conflicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.functions import marketplace, variants
from tallymart.plans.catalog import register
from tallymart.sources.tables import table

#: Addresses and titles that stand for those of parts, by key.
ADDRESSES = [
    ("amazon", "https://www.Amazon.ae/Some-Slug/dp/b0abcdef12?tag=x-21&th=1"),
    ("amazon", "http://amazon.ae/gp/product/B0ABCDEF12/ref=sr_1"),
    ("noon", "https://www.noon.com/uae-en/Galaxy-S24/N53432547A/p/?o=1"),
    ("namshi", "https://www.namshi.com/uae-en/buy-shoe/ZABC12345/p"),
    ("carrefour", "https://www.carrefouruae.com/mafuae/en/milk/p/1234567?x=1"),
    ("noon", "https://s.noon.com/AbC"),
    ("jumbo", "https://www.jumbo.ae/Phones/Item.html/"),
    ("amazon", "ftp://amazon.ae/dp/B0ABCDEF12"),
    ("noon", "https://user:secret@shop.example.com:8443/a/b?token=1#x"),
    ("jumbo", "no url"),
]
TITLES = [
    "Samsung Galaxy S24 Ultra 256GB 12GB RAM",
    "Samsung Galaxy S25 Ultra 256GB",
    "Apple iPhone 16 Clear Case",
    "Apple iPhone 16 128GB with Charging Case",
    "LG 55 inch OLED TV C4",
    'LG 65" OLED TV C4',
    "Sony WH-1000XM5 Headphones",
    "Screen Protector for Galaxy S24",
    "WD Drive 1.5TB 12gbps",
    "Redmi Note 13 Pro+ 5G 256GB",
]


def _sql_list(xs: list[str]) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


_URLS = f"WITH u AS (SELECT p_partkey AS id, {_sql_list([a for a, _ in ADDRESSES])}[p_partkey % 10 + 1] AS r, {_sql_list([b for _, b in ADDRESSES])}[p_partkey % 10 + 1] AS url FROM part), "
_PARTS = r"""h AS (SELECT *, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)', 1)), ':[0-9]+$', '') AS host, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+([^?#]*)', 1) AS path, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*)://[^/?#]+', 1) AS scheme FROM u),
 k AS (SELECT *, CASE WHEN regexp_matches(host, '(^|\.)amazon\.') THEN nullif(upper(regexp_extract(path, '(?i)/(?:dp|gp/product|gp/aw/d|product)/([A-Z0-9]{10})(?:[/?#]|$)', 1)), '') END AS asin, regexp_replace(host, '^www\.', '') AS bare FROM h),
 m AS (SELECT *, CASE WHEN r = 'amazon' THEN asin WHEN r IN ('noon', 'namshi') AND regexp_matches(host, '(^|\.)(noon|namshi)\.com$') THEN nullif(upper(regexp_extract(path, '(?i)/([A-Z0-9]{6,})/p/?(?:[?#]|$)', 1)), '')
   WHEN r = 'carrefour' AND host <> '' THEN nullif(regexp_extract(path, '/p/([0-9]{5,})(?:[/?#]|$)', 1), '') END AS mid,
   CASE WHEN lower(scheme) IN ('http', 'https') THEN 'https://' || bare || CASE WHEN asin IS NOT NULL THEN '/dp/' || asin WHEN regexp_replace(path, '/+$', '') = '' THEN '/' ELSE lower(regexp_replace(path, '/+$', '')) END END AS canonical FROM k) """


def _addressed(spark, sf):
    at = (F.col("p_partkey") % 10 + 1).cast("int")
    pick = lambda xs: F.element_at(F.array(*map(F.lit, xs)), at)
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), pick([a for a, _ in ADDRESSES]).alias("r"), pick([b for _, b in ADDRESSES]).alias("url"))


@register("listing_identities", _URLS + _PARTS + "SELECT id, mid AS marketplace_id, canonical, coalesce(r || ':id:' || mid, r || ':url:' || canonical) AS offer_key FROM m")
def listing_identities(spark, sf):
    """T20/T21/T22."""
    r, url = F.col("r"), F.col("url")
    return _addressed(spark, sf).select("id", marketplace.marketplace_id(r, url).alias("marketplace_id"), marketplace.canonical_product_url(url).alias("canonical"), marketplace.offer_key(r, url).alias("offer_key"))


@register(
    "link_kinds",
    _URLS + _PARTS + r"""SELECT id, host IN ('s.noon.com', 'amzn.to', 'amzn.eu') OR regexp_matches(url, '[?&](tag|linkCode|linkId|affiliate_id|aff_id)(=|&|#|$)') AS affiliate,
 CASE WHEN scheme <> '' THEN scheme || '://' || regexp_replace(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)', 1), '^[^@]*@', '') || path END AS safe FROM m""",
)
def link_kinds(spark, sf):
    """Affiliate links, and addresses without secrets."""
    return _addressed(spark, sf).select("id", marketplace.is_affiliate(F.col("url")).alias("affiliate"), marketplace.redacted(F.col("url")).alias("safe"))


_TITLES = f"WITH t AS (SELECT p_partkey AS id, {_sql_list(TITLES)}[p_partkey % 10 + 1] AS a, {_sql_list(TITLES)}[p_size % 10 + 1] AS b FROM part)"


def _titled(spark, sf):
    pick = lambda k: F.element_at(F.array(*map(F.lit, TITLES)), (F.col(k) % 10 + 1).cast("int"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), pick("p_partkey").alias("a"), pick("p_size").alias("b"))


@register(
    "variant_signatures",
    _TITLES + r""", s AS (SELECT id, replace(lower(a), '+', ' plus ') AS s FROM t),
 w AS (SELECT *, regexp_extract_all(s, '(\d+(?:\.\d+)?)\s*(gb|tb)\b', 1) AS n, regexp_extract_all(s, '(\d+(?:\.\d+)?)\s*(gb|tb)\b', 2) AS u, regexp_replace(s, '(\d+(?:\.\d+)?)\s*(gb|tb)\b', ' ', 'g') AS rest FROM s)
 SELECT id, list_max(list_transform(range(len(n)), lambda i: n[i + 1]::DOUBLE * CASE WHEN u[i + 1] = 'tb' THEN 1024 ELSE 1 END)) AS storage_gb,
 nullif(regexp_extract(rest, '(\d{2,3}(?:\.\d)?)\s*(?:"|-?\s*inch(?:es)?\b|in\b)', 1), '')::DOUBLE AS screen_inch,
 coalesce(array_to_string(list_sort(list_distinct(list_filter(regexp_split_to_array(regexp_replace(rest, '[^a-z0-9_\s.]', ' ', 'g'), '\s+'), lambda x: x IN ('pro', 'max', 'ultra', 'plus', 'mini', 'lite', 'fe', 'air', 'fold', 'flip')))), ' '), '') AS qualifiers FROM w""",
)
def variant_signatures(spark, sf):
    """T4."""
    s = _titled(spark, sf).select("id", variants.signature(F.col("a")).alias("s"))
    return s.select("id", "s.storage_gb", "s.screen_inch", "s.qualifiers")


@register(
    "product_roles",
    _TITLES + f""" SELECT id, CASE WHEN regexp_matches(h, '(?i){variants.ACCESSORY}') OR regexp_matches(h, '(?i){variants.FOR_DEVICE}') THEN 'accessory' ELSE 'main_product' END AS role
 FROM (SELECT id, regexp_split_to_array(a, '(?i)\\b(?:with|including|includes|bundle|plus)\\b|[+&]')[1] AS h FROM t)""",
)
def product_roles(spark, sf):
    """T6."""
    return _titled(spark, sf).select("id", variants.role(F.col("a")).alias("role"))


#: The first conflict of each pair of titles, by their places, read off the rules; pairs that are not here have none.
ROLE_MISMATCH = [(i, j) for i in (2, 7) for j in range(10) if j not in (2, 7)] + [(j, i) for i in (2, 7) for j in range(10) if j not in (2, 7)]
TYPE_MISMATCH = [(i, j) for i, j in [(0, 4), (0, 5), (0, 6), (1, 4), (1, 5), (1, 6), (3, 4), (3, 5), (3, 6), (4, 6), (5, 6)]]
BRAND_MISMATCH = [(0, 3), (0, 9), (1, 3), (1, 9), (3, 9), (4, 9), (5, 9), (6, 9)]
VARIANT_MISMATCH = [(0, 1), (4, 5), (0, 8), (1, 8), (3, 8), (4, 8), (5, 8), (6, 8), (8, 9), (2, 7)]
_KNOWN = {**{p: "role_mismatch" for p in ROLE_MISMATCH}, **{q: kind for kind, ps in (("type_mismatch", TYPE_MISMATCH), ("brand_mismatch", BRAND_MISMATCH), ("variant_mismatch", VARIANT_MISMATCH)) for p in ps for q in (p, p[::-1])}}
_PAIRS = ", ".join(f"({i}, {j}, '{k}')" for (i, j), k in sorted(_KNOWN.items()))


@register("title_conflicts", f"WITH k(i, j, conflict) AS (VALUES {_PAIRS}) SELECT p_partkey AS id, conflict FROM part LEFT JOIN k ON i = p_partkey % 10 AND j = p_size % 10")
def title_conflicts(spark, sf):
    """The first reason that the titles of a pair cannot be one product."""
    return _titled(spark, sf).select("id", variants.conflict(F.col("a"), F.col("b")).alias("conflict"))
