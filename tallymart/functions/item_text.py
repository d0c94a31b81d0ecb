"""Texts of menus and listings: keys, keywords, portions, brands, areas, amounts, titles, labels of promotions.

Null in, null out, unless a docstring says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymart.functions.identity_text import identity_text

# Digits, stop words, units and size words of menu items.
EASTERN_DIGITS, WESTERN_DIGITS = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "01234567890123456789"
STOPWORDS = ("and", "with", "or", "the", "of", "a", "an", "in", "on", "for", "to", "و", "مع", "او", "في", "من", "على")
UNITS = [
    ("pcs", "pcs|pc|pieces|piece|nos|no|قطع|قطعة|قطعه|حبات|حبة|حبه"),
    ("inch", 'inches|inch|"|″|بوصة|بوصه|انش|إنش'),
    ("cm", "cm|سم"),
    ("ml", "ml|مل"),
    ("l", "litres|liters|litre|liter|ltr|l|لتر"),
    ("kg", "kg|كجم|كغ|كيلو"),
    ("g", "grams|gram|gms|gm|g|جرام|غرام|جم|غ"),
    ("oz", "oz"),
]
COUNT_UNIT = "pcs"
SIZE_WORDS = {
    "small": "small",
    "medium": "medium",
    "regular": "regular",
    "large": "large",
    "family": "family",
    "jumbo": "jumbo",
    "mini": "mini",
    "xl": "xl",
    "xxl": "xxl",
    "صغير": "small",
    "وسط": "medium",
    "متوسط": "medium",
    "كبير": "large",
    "عائلي": "family",
}
MAX_KEYWORDS = 150
# One place written in two ways, and places inside others.
AREA_SPELLINGS = {"ibn batutta": "ibn battuta"}
AREA_WITHIN = [("city walk", "al wasl")]
# Amounts in texts.
BIDI = "[\\u200E\\u200F\\u202A-\\u202E\\u2066-\\u2069]"
MONEY = "([A-Z]{3})\\s*([0-9\\u0660-\\u0669][0-9\\u0660-\\u0669.,\\u066B]*)|([0-9\\u0660-\\u0669][0-9\\u0660-\\u0669.,\\u066B]*)\\s*([A-Z]{3})"
THREE_PLACES = ("KWD", "BHD", "OMR", "JOD")
# Fixed value: title segments that say nothing about the product.
MARKETING = (
    "(?i)^(best price.*|free\\b.*|(\\d+\\s*(year|yr|month)s?\\s*)?warranty.*|buy\\b.*online.*|.*\\b(uae|dubai)\\b.*|namshi|mumzworld|jumbo( electronics)?|letstango|lets tango|"
    "official.*|genuine.*|original.*|cash on delivery.*|same day delivery.*|express delivery.*)$"
)
# Wordings of promotions.
AED = "(?:AED|د\\.إ)"
SPEND_PERCENT = f"(?i)^spend {AED}\\s?([\\d,.]+),? (?:get|unlock) (\\d+)% off(?: up to {AED}\\s?([\\d,.]+))?"
SPEND_DELIVERY = f"(?i)^spend {AED}\\s?([\\d,.]+),? (?:to )?get free delivery"
PERCENT_OFF = f"(?i)^(\\d+)% off (selected items|entire menu)(?: on {AED}\\s?([\\d,.]+)\\+?)?"
BUY_GET = "(?i)^buy \\d+,? get \\d+ free"

_UNIT = "|".join(p for _, p in UNITS)
_QUANTITY = f"(?iu)(\\d+(?:[.,]\\d+)?)\\s*({_UNIT})(?![\\p{{L}}\\p{{N}}])"
_SIZE = f"(?iu)(?<![\\p{{L}}\\p{{N}}])({'|'.join(SIZE_WORDS)})(?![\\p{{L}}\\p{{N}}])"


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, "^\\s+|\\s+$", "")


def western_digits(c: Column) -> Column:
    return F.translate(c, EASTERN_DIGITS, WESTERN_DIGITS)


def item_key(c: Column) -> Column:
    """Folded as names are, eastern digits as ASCII ones; null if nothing is left."""
    return identity_text(western_digits(c))


def keyword_tokens(key: Column) -> Column:
    """T26, of an item key: tokens that begin with a digit, and others of two or more characters that are no stop words; empty for null."""
    return F.coalesce(F.filter(F.split(key, " "), lambda t: t.rlike("^[0-9]") | ((F.length(t) >= 2) & ~t.isin(*STOPWORDS))), F.array().cast("array<string>"))


def search_keywords(*keys: Column) -> Column:
    """The first MAX_KEYWORDS distinct tokens of names, aliases, categories and descriptions, in this order."""
    return F.slice(F.array_distinct(F.flatten(F.array(*map(keyword_tokens, keys)))), 1, MAX_KEYWORDS)


def signals(*keys: Column) -> Column:
    """Distinct keys that are there."""
    return F.array_distinct(F.array_compact(F.array(*keys)))


def portion(name: Column) -> Column:
    """Label, quantity, unit and size. A number counts with a unit beside it, else a size word is looked for; counts have no size; null without either."""
    text = western_digits(name)
    whole, number, raw = (F.regexp_extract(text, _QUANTITY, i) for i in range(3))
    quantity = F.regexp_replace(number, ",", ".").try_cast("double")
    unit, size = F.lit(None).cast("string"), F.lit(None).cast("string")
    for u, p in reversed(UNITS):
        unit = F.when(raw.rlike(f"(?iu)^(?:{p})$"), u).otherwise(unit)
    word = F.regexp_extract(text, _SIZE, 1)
    for w, s in reversed(SIZE_WORDS.items()):
        size = F.when(F.lower(word) == w, s).otherwise(size)
    shown = F.when(quantity == F.floor(quantity), F.floor(quantity).cast("string")).otherwise(quantity.cast("string"))
    measured = F.struct(
        F.trim(whole).alias("label"), quantity.alias("quantity"), unit.alias("unit"), F.when(unit != COUNT_UNIT, F.concat(shown, F.lit(" "), unit)).alias("size")
    )
    worded = F.struct(word.alias("label"), F.lit(None).cast("double").alias("quantity"), F.lit(None).cast("string").alias("unit"), size.alias("size"))
    return F.when((quantity > 0) & unit.isNotNull(), measured).when(word != "", worded)


def core_name(name: Column) -> Column:
    """The item key without portions and size words."""
    return item_key(F.regexp_replace(F.regexp_replace(western_digits(name), _QUANTITY, " "), _SIZE, " "))


def brand_from_name(name: Column) -> Column:
    """What stands before a spaced dash, if it has three characters or more."""
    parts = F.split(name, "\\s[-–—]\\s")
    key = identity_text(parts[0])
    return F.when((F.size(parts) >= 2) & (F.length(key) >= 3), key)


def _area(key: Column) -> Column:
    spaced = F.concat(F.lit(" "), F.regexp_replace(key, "(?<=(?:^| )\\p{L}) (?=\\p{L}(?: |$))", ""), F.lit(" "))
    for a, b in AREA_SPELLINGS.items():
        spaced = F.replace(spaced, F.lit(f" {a} "), F.lit(f" {b} "))
    return spaced


def areas_compatible(a: Column, b: Column) -> Column:
    """T34, of folded names: equal, one holding the other as whole words, or one known to lie in the other; initials count as one word."""
    x, y = _area(a), _area(b)
    out = (a == b) | F.contains(x, y) | F.contains(y, x)
    for inner, outer in AREA_WITHIN:
        i, o = F.lit(f" {inner} "), F.lit(f" {outer} ")
        out = out | (F.contains(x, i) & F.contains(y, o)) | (F.contains(y, i) & F.contains(x, o))
    return out


def number_text(text: Column) -> Column:
    """A number with separators for thousands and a point or comma before decimals; null if it is none."""
    plain = F.regexp_replace(western_digits(text), "\\u066B", ".")
    return F.regexp_replace(F.regexp_replace(plain, ",(?=\\d{3}(\\D|$))", ""), "^([^,]*),", "$1.").try_cast("double")


def money(text: Column) -> Column:
    """Amount and currency of the first amount beside a currency code; null without one."""
    found = [_some(F.regexp_extract(F.regexp_replace(text, BIDI, ""), MONEY, i)) for i in range(1, 5)]
    amount, currency = number_text(F.coalesce(found[1], found[2])), F.coalesce(found[0], found[3])
    return F.when(amount >= 0, F.struct(amount.alias("amount"), currency.alias("currency")))


def money_of_minor_units(fractional: Column, code: Column) -> Column:
    """An amount that is given in the smallest units of its currency."""
    fine = (fractional >= 0) & (fractional == F.floor(fractional)) & code.rlike("^[A-Z]{3}$")
    return F.when(fine, fractional / F.when(code.isin(*THREE_PLACES), 1000.0).otherwise(100.0))


def plain_number(text: Column) -> Column:
    """Digits of either script and one decimal separator; null for anything else."""
    x = F.regexp_replace(western_digits(_stripped(F.regexp_replace(text, BIDI, ""))), "\\u066B", ".")
    x = F.regexp_replace(x, "\\u066C", "")
    return F.when(x.rlike("^-?\\d+(\\.\\d+)?$"), x.try_cast("double"))


def clean_name(name: Column) -> Column:
    """A title without what shops add to it; other segments stay, as they may name a variant; null if nothing is left."""
    decoded = F.replace(name, F.lit("&amp;"), F.lit("&"))
    decoded = F.regexp_replace(F.regexp_replace(decoded, "&#x27;|&#39;", "'"), "&quot;", '"')
    parts = F.transform(F.split(decoded, "\\|"), _stripped)
    kept = F.array_join(F.filter(parts, lambda p, i: (i == 0) | ((p != "") & ~p.rlike(MARKETING))), " | ")
    bare = F.regexp_replace(F.regexp_replace(kept, "(?i)^\\s*buy\\s+", ""), "(?i)\\s+(online\\s+)?in\\s+(the\\s+)?uae\\b.*$", "")
    return _some(_stripped(F.regexp_replace(bare, "\\s+", " ")))


def clean_text(text: Column, most: int = 500) -> Column:
    """Without tags, blanks folded, at most `most` characters (a description's limit, as the reference sets it)."""
    bare = F.replace(F.regexp_replace(text, "<[^>]+>", " "), F.lit("&nbsp;"), F.lit(" "))
    return _some(F.substr(_stripped(F.regexp_replace(bare, "\\s+", " ")), F.lit(1), F.lit(most)))


def promotion(label: Column) -> Column:
    """Type, percentage, minimum, maximum and title of a promotion's label; OTHER for unknown wordings."""
    s = _stripped(F.regexp_replace(F.regexp_replace(label, "[\\u200E\\u200F\\u202A-\\u202E]", ""), "[\\s\\u00A0]+", " "))
    at = lambda p, i: F.regexp_replace(F.regexp_extract(s, p, i), ",", "").try_cast("double")
    none = F.lit(None).cast("double")

    def made(kind, percentage=none, minimum=none, maximum=none):
        return F.struct(F.lit(kind).alias("type") if isinstance(kind, str) else kind.alias("type"), percentage.alias("percentage"), minimum.alias("minimum"), maximum.alias("maximum"), s.alias("title"))

    scope = F.when(F.lower(F.regexp_extract(s, PERCENT_OFF, 2)) == "entire menu", "PERCENT_OFF_MENU").otherwise("PERCENT_OFF_ITEMS")
    return (
        F.when(s.rlike(SPEND_PERCENT), made("PERCENT_OFF_MENU", at(SPEND_PERCENT, 2), at(SPEND_PERCENT, 1), at(SPEND_PERCENT, 3)))
        .when(s.rlike(SPEND_DELIVERY), made("FREE_DELIVERY", none, at(SPEND_DELIVERY, 1)))
        .when(s.rlike(PERCENT_OFF), made(scope, at(PERCENT_OFF, 1), at(PERCENT_OFF, 3)))
        .when(s.rlike(BUY_GET), made("BUY_ONE_GET_ONE"))
        .when(s.isNotNull(), made("OTHER"))
    )


# Names of shops that are no restaurants, and titles and marks of pages that block.
NO_RESTAURANT = (
    "(?i)\\b(supermarket|hypermarket|minimart|mini ?market|grocer(?:y|ies)|pharmacy|hop|carrefour|choithrams|spinneys|lulu|viva|waitrose|union co-?op|nesto|best mart|"
    "grandiose|fresh ?market|flowers?|florist|pet shop|electronics)\\b"
)
BLOCK_TITLE = "(?i)^\\s*(access denied|attention required|just a moment|are you a robot|pardon our interruption|request blocked|captcha)"
BLOCK_MARK = "(?i)errors\\.edgesuite\\.net|cf-chl-|captcha-delivery"
SHORT_PAGE = 3000


def likely_restaurant(name: Column) -> Column:
    """P9."""
    return ~name.rlike(NO_RESTAURANT)


def block_page(html: Column) -> Column:
    """A title that refuses, or a short page with the mark of a protection service."""
    title = F.regexp_extract(html, "(?i)<title[^>]*>([^<]*)", 1)
    return title.rlike(BLOCK_TITLE) | ((F.length(html) < SHORT_PAGE) & html.rlike(BLOCK_MARK))


def has_all_words(text: Column, category: str) -> Column:
    """P10: every word of the category (three characters or more) as a whole word, plurals too; an empty category fits all."""
    out = F.lit(True)
    for w in (w for w in category.lower().split() if len(w) > 2):
        out = out & F.lower(text).rlike(f"\\b\\Q{w}\\E(?:s|es)?\\b")
    return out


def cleaned_images(images: Column, drop: str, own: tuple[str, str] | None = None) -> Column:
    """Without images that match `drop`, and, if one matches own[0], without those that match own[1]; null if nothing changes or nothing is left."""
    kept = F.filter(images, lambda u: ~u.rlike(drop))
    if own is not None:
        kept = F.when(F.exists(kept, lambda u: u.rlike(own[0])), F.filter(kept, lambda u: ~u.rlike(own[1]))).otherwise(kept)
    return F.when((F.size(kept) < F.size(images)) & (F.size(kept) > 0), kept)
