"""Tags of products: by rule, price, spread, rating and taxonomy; brands that tags name; texts to embed; keys of menu sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymart.functions.text import price_tier

# Brands by tag.
BRAND_TAGS = {
    "brand-apple": "Apple", "brand-samsung": "Samsung", "brand-lg": "LG", "brand-sony": "Sony", "brand-dyson": "Dyson", "brand-philips": "Philips",
    "brand-xiaomi": "Xiaomi", "brand-huawei": "Huawei", "brand-dell": "Dell", "brand-hp": "HP", "brand-lenovo": "Lenovo", "brand-nespresso": "Nespresso",
    "brand-bosch": "Bosch", "brand-anker": "Anker", "brand-google": "Google", "brand-jbl": "JBL", "brand-bose": "Bose",
}
#: Characters of the Arabic blocks.
ARABIC = "[\\u0600-\\u06FF\\u0750-\\u077F\\u08A0-\\u08FF\\uFB50-\\uFDFF\\uFE70-\\uFEFF]"


def brand_of_tags(tags: Column) -> Column:
    """The brand of the first tag that names one."""
    brands = F.create_map(*[F.lit(x) for pair in BRAND_TAGS.items() for x in pair])
    return F.get(F.array_compact(F.transform(tags, lambda t: F.try_element_at(brands, t))), F.lit(0))


def search_text(*parts: Column) -> Column:
    """The parts that are neither null nor empty, joined by blanks."""
    return F.array_join(F.filter(F.array(*parts), lambda p: p != ""), " ")


def rule_tags(text: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """The tags of every (pattern, tags) whose pattern is found in the text, letter case aside; one expression over all rules."""
    found = [F.when(text.rlike(f"(?i){p}"), F.array(*map(F.lit, tags))) for p, tags in rules]
    return F.array_distinct(F.flatten(F.array_compact(F.array(*found)))) if rules else F.array().cast("array<string>")


def social_tags(price: Column, retailers: Column, rating: Column, reviews: Column) -> Column:
    """Price tier, spread over retailers, rating and number of reviews."""
    spread = F.when(retailers >= 3, "widely-available").when(retailers >= 2, "multi-retailer")
    return F.array_compact(F.array(price_tier(price), spread, F.when(rating >= 4.5, "top-rated"), F.when(reviews >= 1000, "popular")))


def all_tags(*tags: Column) -> Column:
    """Distinct tags of several arrays, sorted; a null array counts as empty."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.flatten(F.array(*[F.coalesce(t, empty) for t in tags]))))


def embedding_text(name: Column, description: Column, tags: Column, most_tags: int = 20, most_description: int | None = None, most: int = 800) -> Column:
    """Name, description and the first tags, cut to the length that the embedding takes."""
    about = description if most_description is None else F.substring(description, 1, most_description)
    first = F.slice(F.coalesce(tags, F.array().cast("array<string>")), 1, most_tags)
    return F.substring(F.array_join(F.filter(F.concat(F.array(name, about), first), lambda p: p != ""), " "), 1, most)


def _encoded(value: Column) -> Column:
    """Percent encoding that leaves letters, digits and - _ . ! ~ * ' ( ) alone."""
    out = F.url_encode(value)
    for code, plain in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(code), F.lit(plain))
    return out


def identity_problem(value: Column) -> Column:
    """Why a token cannot be an identity, null if it can."""
    return (
        F.when(value.isNull() | (value == ""), "EMPTY")
        .when(F.length(value) > 256, "TOO_LONG")
        .when(value.rlike("[\\s\\x{00a0}]"), "WHITESPACE")
        .when(value.rlike(ARABIC), "ARABIC")
    )


def identity_segment(id: Column, anchor: Column, position: Column) -> Column:
    """Kind and encoded value by precedence id, anchor, position; null if the first of them that is there cannot be an identity."""
    token = lambda kind, v: F.when(identity_problem(v).isNull(), F.concat(F.lit(f"{kind}:"), _encoded(v)))
    at = F.when(position.between(0, 100000), F.concat(F.lit("pos:"), position.cast("string")))
    return F.when(id.isNotNull(), token("id", id)).when(anchor.isNotNull(), token("anchor", anchor)).otherwise(at)


def restaurant_key(platform: Column, segment: Column) -> Column:
    """Null for a position, which identifies no restaurant."""
    return F.when(~segment.startswith("pos:"), F.concat(platform, F.lit(":restaurant:"), segment))


def category_key(restaurant: Column, segment: Column) -> Column:
    return F.concat(restaurant, F.lit(":category:"), segment)


def item_key_of(restaurant: Column, category: Column, segment: Column) -> Column:
    """An item with a position is known within its category alone."""
    own = category.startswith(F.concat(restaurant, F.lit(":category:")))
    parent = F.when(~segment.startswith("pos:"), restaurant).when(own, category)
    return F.concat(parent, F.lit(":item:"), segment)


def parsed_key(key: Column, platforms: tuple[str, ...] = ("talabat", "deliveroo")) -> Column:
    """Platform, entity, kind and decoded value of a source key, null if it is none."""
    names = "|".join(platforms)
    good = key.rlike(f"^({names}):restaurant:(id|anchor):[^:]+(:(category|item):(id|anchor|pos):[^:]+)*$")
    parts = F.split(key, ":")
    last = lambda i: F.element_at(parts, -i)
    kind = F.when(last(2) == "pos", "position").otherwise(last(2))
    value = F.try_url_decode(F.replace(last(1), F.lit("+"), F.lit("%2B")))
    return F.when(good & value.isNotNull(), F.struct(parts[0].alias("platform"), last(3).alias("entity"), kind.alias("kind"), value.alias("value")))


def modifier_digest(groups: Column) -> Column:
    """Groups, options and the first 12 digits of a SHA-1 over the groups, in which the fields stand by name and nulls are left out;
    null without groups. `groups` is array<struct<..., options array<...>>> whose fields are declared in alphabetical order."""
    options = F.aggregate(groups, F.lit(0), lambda n, g: n + F.coalesce(F.size(g["options"]), F.lit(0)))
    digest = F.substring(F.sha1(F.to_json(groups, {"ignoreNullFields": "true"})), 1, 12)
    return F.when(F.size(groups) > 0, F.struct(F.size(groups).alias("groups"), options.alias("options"), digest.alias("hash")))


def item_url(page: Column, slug: Column, sku: Column) -> Column:
    """The page's address with the item's slug (else sku) as last segment, once; the page itself without either or if it is no address."""
    token = F.coalesce(F.nullif(slug, F.lit("")), F.nullif(sku, F.lit("")))
    piece = lambda g: F.regexp_extract(page, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)([^?#]*)(.*)$", g)
    path = F.regexp_replace(piece(2), "/+$", "")
    there = path.endswith(F.concat(F.lit("/"), _encoded(token))) | path.endswith(F.concat(F.lit("/"), token))
    url = F.concat(piece(1), F.when(there, path).otherwise(F.concat(path, F.lit("/"), _encoded(token))), piece(3))
    return F.when(token.isNull() | (piece(1) == ""), page).otherwise(url)
