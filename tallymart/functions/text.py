"""Scalar text functions as column expressions: names, tokens, keys, URLs, hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that say nothing about a product.
NAME_STOPWORDS = (
    "the a an and or for in of to at by with from on is it its this that new buy online "
    "version edition series model international middle east"
).split()
GROCERY_STOPWORDS = (
    "the and of with for in a an to plus pack size fresh value offer new original premium "
    "assorted each approx approximately piece pieces pcs pc"
).split()

MULTIPACK = "(?i)([0-9]+)[ ]*[x×][ ]*([0-9]+(?:\\.[0-9]+)?)[ ]*(ml|l|cl|g|kg|mg)\\b"
SIZE = "(?i)([0-9]+(?:\\.[0-9]+)?)[ ]*(ml|l|cl|g|kg|mg)\\b"
COUNT = "(?i)([0-9]+)[ ]*(pcs?|pieces?)\\b"


def normalize_name(c: Column) -> Column:
    """Lower case, anything but ASCII word characters to a blank, blanks folded."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9_]+", " "))


def name_key(c: Column) -> Column:
    """T11."""
    return F.trim(F.regexp_replace(F.lower(c), "[ \\t\\n\\r]+", " "))


def name_tokens(c: Column) -> Column:
    """Distinct tokens of two or more characters that are no stop words."""
    return F.array_distinct(F.filter(F.split(normalize_name(c), " "), lambda t: (F.length(t) > 1) & ~t.isin(*NAME_STOPWORDS)))


def jaccard(a: Column, b: Column) -> Column:
    """T3."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def dice(a: Column, b: Column) -> Column:
    """T31."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(0.0)).otherwise(2 * F.size(F.array_intersect(a, b)) / total)


def grocery_match_key(c: Column) -> Column:
    """Sorted words '#' sorted sizes, multipacks before sizes before counts; null without either part."""
    blank = lambda x, p: F.regexp_replace(x, p, " ")
    found = lambda x, p: F.regexp_extract_all(x, F.lit(p), F.lit(0))
    tidy = lambda xs, p, out: F.transform(xs, lambda s: F.lower(F.regexp_replace(s, p, out)))
    after_multi, after_size = blank(c, MULTIPACK), blank(blank(c, MULTIPACK), SIZE)
    sizes = F.array_sort(
        F.array_distinct(
            F.concat(
                tidy(found(c, MULTIPACK), MULTIPACK, "$1x$2$3"),
                tidy(found(after_multi, SIZE), SIZE, "$1$2"),
                tidy(found(after_size, COUNT), COUNT, "$1pc"),
            )
        )
    )
    rest = F.regexp_replace(F.lower(blank(after_size, COUNT)), "[^a-z0-9. ]", " ")
    bag = F.array_sort(F.array_distinct(F.filter(F.split(rest, " +"), lambda t: (F.length(t) > 1) & ~t.isin(*GROCERY_STOPWORDS) & ~t.rlike("^[0-9]+$"))))
    return F.when((F.size(sizes) > 0) & (F.size(bag) > 0), F.concat(F.array_join(bag, " "), F.lit("#"), F.array_join(sizes, ",")))


def price_tier(price: Column) -> Column:
    """T15."""
    return F.when(price < 200, "budget").when(price < 500, "affordable").when(price < 1500, "mid-range").when(price < 5000, "premium").when(price.isNotNull(), "luxury")


def canonical_url(c: Column) -> Column:
    """Of a page: host without www and lower-case path, without query, fragment and trailing slash. Listings go by marketplace.canonical_product_url."""
    bare = F.regexp_replace(F.regexp_replace(c, "[?#].*$", ""), "/+$", "")
    return F.lower(F.regexp_replace(bare, "^(https?://)(www\\.)?", "https://"))


def storage_gb(c: Column) -> Column:
    """The largest whole capacity named, in GB; variants.signature (T4) takes decimals and ends at a word's end."""
    amounts = F.transform(F.regexp_extract_all(F.lower(c), F.lit("([0-9]+) ?gb"), F.lit(1)), lambda x: x.cast("long"))
    tera = F.transform(F.regexp_extract_all(F.lower(c), F.lit("([0-9]+) ?tb"), F.lit(1)), lambda x: x.cast("long") * 1024)
    return F.array_max(F.concat(amounts, tera))


def rounded(c: Column, k: int) -> Column:
    return F.floor(c * k + F.lit(0.5)) / F.lit(k)
