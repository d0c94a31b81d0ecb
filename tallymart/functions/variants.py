"""What keeps two product titles apart: variants, roles, and the first conflict between two names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymart.functions import rules

# Words and patterns of the variant and role guards.
QUALIFIERS = ("pro", "max", "ultra", "plus", "mini", "lite", "fe", "air", "fold", "flip")
STORAGE = "(\\d+(?:\\.\\d+)?)\\s*(gb|tb)\\b"
SCREEN = "(\\d{2,3}(?:\\.\\d)?)\\s*(?:\"|''|-?\\s*inch(?:es)?\\b|in\\b)"
UNIT_TOKEN = "^\\d+(?:\\.\\d+)?(?:g|k|hz|mah|w|mp|l|ml|kg|cm|mm|m|v|nm|th|nd|rd|st|x)$"
ACCESSORY = (
    "\\b(cases?|covers?|screen protectors?|tempered glass|protectors?|chargers?|charging (?:cable|pad|stand|dock)|cables?|adapters?|stylus|sleeves?|"
    "pouch(?:es)?|skins?|holders?|mounts?|lens protectors?|replacement (?:bands?|straps?|tips|pads)|ear ?tips|ear ?pads|straps?|watch bands?|"
    "power banks?|refills?|cartridges?)\\b"
)
FOR_DEVICE = "\\b(?:for|compatible with|designed for|fits)\\s+(?:apple\\s+|samsung\\s+|google\\s+)?(?:iphone|galaxy|ipad|macbook|airpods|pixel|apple watch|watch)\\b"
MAX_PRICE_RATIO = 2


def signature(name: Column) -> Column:
    """T4: qualifiers (sorted, joined), storage_gb (largest, a TB is 1024), screen_inch (first), model tokens (distinct, in order)."""
    s = F.regexp_replace(F.lower(name), "\\+", " plus ")
    amounts = F.zip_with(F.regexp_extract_all(s, F.lit(STORAGE), F.lit(1)), F.regexp_extract_all(s, F.lit(STORAGE), F.lit(2)), lambda n, u: n.cast("double") * F.when(u == "tb", 1024.0).otherwise(1.0))
    without = F.regexp_replace(s, STORAGE, " ")
    # the first screen size alone is taken out, as a rest of the title could hold another number of that form
    whole = F.regexp_extract(without, SCREEN, 0)
    at = F.instr(without, whole)
    rest = F.when(whole == "", without).otherwise(F.concat(F.substr(without, F.lit(1), at - 1), F.lit(" "), F.substr(without, at + F.length(whole))))
    tokens = F.filter(F.transform(F.split(F.regexp_replace(rest, "[^a-z0-9_\\s.]", " "), "\\s+"), lambda t: F.regexp_replace(t, "^\\.+|\\.+$", "")), lambda t: t != "")
    models = F.array_distinct(F.filter(tokens, lambda t: t.rlike("[0-9]") & ~t.rlike(UNIT_TOKEN) & (F.length(t) <= 12)))
    return F.struct(
        F.array_join(F.array_sort(F.array_distinct(F.filter(tokens, lambda t: t.isin(*QUALIFIERS)))), " ").alias("qualifiers"),
        F.array_max(amounts).alias("storage_gb"),
        F.nullif(F.regexp_extract(without, SCREEN, 1), F.lit("")).cast("double").alias("screen_inch"),
        models.alias("models"),
    )


def compatible(a: Column, b: Column) -> Column:
    """T5 on two signatures: equal qualifiers; storage and screen equal where both are named; a model token shared where both have some."""
    same = lambda f: F.coalesce(a[f] == b[f], F.lit(True))
    shared = (F.size(a["models"]) == 0) | (F.size(b["models"]) == 0) | F.arrays_overlap(a["models"], b["models"])
    return (a["qualifiers"] == b["qualifiers"]) & same("storage_gb") & same("screen_inch") & shared


def role(name: Column) -> Column:
    """Accessory or main_product, by what stands before words such as `with`."""
    head = F.split(name, rules.INCLUDED)[0]
    return F.when(head.rlike(f"(?i){ACCESSORY}") | head.rlike(f"(?i){FOR_DEVICE}"), "accessory").otherwise("main_product")


def conflict(a: Column, b: Column) -> Column:
    """The first reason that two titles cannot be one product: role, type, brand, variant; null if there is none."""
    return (
        F.when(role(a) != role(b), "role_mismatch")
        .when(rules.product_type(a) != rules.product_type(b), "type_mismatch")
        .when(rules.brand(a) != rules.brand(b), "brand_mismatch")
        .when(~compatible(signature(a), signature(b)), "variant_mismatch")
    )


def price_conflict(price: Column, others: Column) -> Column:
    """Whether the largest of a price and an array of prices is over MAX_PRICE_RATIO times the smallest; false without a price on either side."""
    some = F.filter(others, lambda x: x > 0)
    high, low = F.greatest(F.array_max(some), price), F.least(F.array_min(some), price)
    return F.coalesce((price > 0) & (F.size(some) > 0) & (high / low > MAX_PRICE_RATIO), F.lit(False))
