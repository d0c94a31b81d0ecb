"""Landed pages to rows: JSON-LD products, embedded script state, links and robots rules, with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JSON_LD = "(?s)<script[^>]*application/ld\\+json[^>]*>(.*?)</script>"
STATE = "(?s)<script[^>]*id=\"__NEXT_DATA__\"[^>]*>(.*?)</script>"


def json_ld_nodes(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per node (key, node as VARIANT), with @graph and top-level lists opened; malformed blocks are skipped."""
    blocks = pages.select(key, F.explode(F.regexp_extract_all(html, F.lit(JSON_LD), F.lit(1))).alias("raw"))
    node = blocks.select(key, F.try_parse_json("raw").alias("v")).where("v IS NOT NULL")
    inner = lambda path: F.try_variant_get("v", path, "array<variant>")
    listed = node.select(key, F.explode(F.coalesce(inner("$"), inner("$['@graph']"), F.array("v"))).alias("node"))
    return listed


def products(nodes: DataFrame, key: str = "page_id") -> DataFrame:
    """Name, price, currency, stock (true, false, null: no evidence) and rating scaled to 0-5 of Product nodes."""
    at = lambda path, kind: F.try_variant_get("node", path, kind)
    offer = lambda f, kind: F.coalesce(at(f"$.offers.{f}", kind), at(f"$.offers[0].{f}", kind))
    rows = nodes.where(at("$['@type']", "string") == "Product")
    best = F.coalesce(at("$.aggregateRating.bestRating", "double"), F.lit(5.0))
    return rows.select(
        key,
        at("$.name", "string").alias("name"),
        price(offer("price", "string")).alias("price"),
        F.upper(offer("priceCurrency", "string")).alias("currency"),
        stock(offer("availability", "string")).alias("in_stock"),
        F.when(best > 0, at("$.aggregateRating.ratingValue", "double") * 5 / best).alias("rating"),
    )


def price(text: Column) -> Column:
    """A positive amount below a million, to two places; anything else is null."""
    x = F.regexp_replace(text, ",", "").try_cast("double")
    return F.when((x > 0) & (x < 1_000_000), F.round(x, 2))


def stock(availability: Column) -> Column:
    """In stock, out of stock, or no evidence."""
    low = F.lower(availability)
    return F.when(low.rlike("outofstock|soldout|discontinued"), False).when(low.rlike("instock|limitedavailability|onlineonly"), True)


def state(pages: DataFrame, path: str, key: str = "page_id", html: str = "html") -> DataFrame:
    """Rows of the list at `path` in the page's embedded state (key, position, row as VARIANT); the first of equal ids is up to the caller."""
    raw = pages.select(key, F.try_parse_json(F.regexp_extract(html, STATE, 1)).alias("v"))
    return raw.select(key, F.posexplode(F.try_variant_get("v", path, "array<variant>")).alias("position", "row"))


def robots_pattern(rule: Column) -> Column:
    """A rule as a regular expression: it matches from the start, * stands for anything, a last $ for the end."""
    ends = F.endswith(rule, F.lit("$"))
    body = F.regexp_replace(F.when(ends, F.regexp_replace(rule, "\\$$", "")).otherwise(rule), "([.+?^${}()|\\[\\]\\\\])", "\\\\$1")
    return F.concat(F.lit("^"), F.replace(body, F.lit("*"), F.lit(".*")), F.when(ends, "$").otherwise(""))


def robots_allow(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Rules (host, allow, prefix), urls (host, path): the longest matching rule decides, allow wins ties, no rule allows.

    A host's rules are few, so each of its addresses meets them all."""
    some = urls.select("host", "path").distinct()
    j = some.join(rules.where(F.col("prefix") != "").select("host", "allow", "prefix"), "host").where(F.regexp(F.col("path"), robots_pattern(F.col("prefix"))))
    decided = j.groupBy("host", "path").agg(F.max(F.struct(F.length("prefix").alias("n"), F.col("allow"))).alias("top"))
    return urls.join(decided, ["host", "path"], "left").select("host", "path", F.coalesce("top.allow", F.lit(True)).alias("allowed"))
