"""Identities of listings: marketplace ids, canonical and affiliate URLs, offer keys, image keys, redaction.

Null in, null out, unless a docstring says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where marketplaces write their ids, and what marks a link as an affiliate's.
ASIN = "(?i)/(?:dp|gp/product|gp/aw/d|product)/([A-Z0-9]{10})(?:[/?#]|$)"
NOON_SKU = "(?i)/([A-Z0-9]{6,})/p/?(?:[?#]|$)"
CARREFOUR_ID = "/p/([0-9]{5,})(?:[/?#]|$)"
AMAZON_HOST, NOON_HOST = "(?i)(^|\\.)amazon\\.", "(?i)(^|\\.)(noon|namshi)\\.com$"
AFFILIATE_HOSTS = ("s.noon.com", "amzn.to", "amzn.eu")
AFFILIATE_PARAMETERS = ("tag", "linkCode", "linkId", "affiliate_id", "aff_id")

_URL = "^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]+)([^?#]*)(\\?[^#]*)?"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _URL, group)


def host(url: Column) -> Column:
    """Lower-case host without port; empty if there is none."""
    return F.regexp_replace(F.lower(_part(url, 2)), ":[0-9]+$", "")


def bare_host(url: Column) -> Column:
    return F.regexp_replace(host(url), "^www\\.", "")


def _found(where: Column, path: Column, pattern: str) -> Column:
    return F.when(where, F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")))


def marketplace_id(retailer: Column, url: Column) -> Column:
    """The id that the retailer's URLs carry in their paths, null without one."""
    path = _part(url, 3)
    return (
        F.when(retailer == "amazon", F.upper(_found(host(url).rlike(AMAZON_HOST), path, ASIN)))
        .when(retailer.isin("noon", "namshi"), F.upper(_found(host(url).rlike(NOON_HOST), path, NOON_SKU)))
        .when(retailer == "carrefour", _found(host(url) != "", path, CARREFOUR_ID))
    )


def canonical_product_url(url: Column) -> Column:
    """Https, host without www, lower-case path without trailing slash, query and fragment; Amazon's is /dp/ and the id; null if not http(s)."""
    asin = F.upper(_found(host(url).rlike(AMAZON_HOST), _part(url, 3), ASIN))
    path = F.regexp_replace(_part(url, 3), "/+$", "")
    plain = F.concat(F.lit("https://"), bare_host(url), F.when(path == "", "/").otherwise(F.lower(path)))
    return F.when(F.lower(_part(url, 1)).isin("http", "https"), F.coalesce(F.concat(F.lit("https://"), bare_host(url), F.lit("/dp/"), asin), plain))


def offer_key(retailer: Column, url: Column) -> Column:
    """By marketplace id where there is one, else by canonical URL."""
    return F.coalesce(F.concat(retailer, F.lit(":id:"), marketplace_id(retailer, url)), F.concat(retailer, F.lit(":url:"), canonical_product_url(url)))


def is_affiliate(url: Column) -> Column:
    """False for null and for what is no URL."""
    names = F.transform(F.split(F.regexp_replace(_part(url, 4), "^\\?", ""), "&"), lambda p: F.split(p, "=")[0])
    return F.coalesce(host(url).isin(*AFFILIATE_HOSTS) | F.arrays_overlap(names, F.array(*map(F.lit, AFFILIATE_PARAMETERS))), F.lit(False))


def image_key(url: Column) -> Column:
    """Host and path, by which two image URLs are one."""
    return F.when(host(url) != "", F.concat(host(url), _part(url, 3)))


def redacted(url: Column) -> Column:
    """Without user, query and fragment; secrets travel there."""
    return F.when(_part(url, 1) != "", F.concat(_part(url, 1), F.lit("://"), F.regexp_replace(_part(url, 2), "^[^@]*@", ""), _part(url, 3)))


def slug(text: Column) -> Column:
    """Lower case, runs of other characters than letters and digits to one hyphen."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def humanized(text: Column) -> Column:
    """A slug as words, each with a capital."""
    return F.initcap(F.regexp_replace(text, "-+", " "))
