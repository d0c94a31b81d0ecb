"""What is wrong with documents, as rows of path and message, by rule tables for nine kinds of documents.

Documents are VARIANT. A rule says what a field has to be (`Field`), what the elements of a list have to be (`Each`), what is inside an
object (`Inside`) or when fields contradict one another (`Given`). All rules of a kind make one column of issues: no shuffle and
no join, one pass over the documents whatever their number.

Dates are timestamps, or texts in ISO form with a time; object ids are 24 hexadecimal digits. A missing field differs from a JSON
null, which is of no type. Lengths count code points. Issues come in the order of the rules and of the lists; unknown keys in
alphabetical order, as VARIANT keeps no other. A document that is null or no object has one issue, at `$`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions import tags

ISSUES = "array<struct<path:string,message:string>>"
Check = Callable[[Column, Column], Column]  # of a value and its path

# Limits and forms of fields, names of what a field may be.
MOST_TEXT, MOST_PRICE, MOST_ERRORS, MOST_MESSAGE, MOST_KEYWORDS = 5000, 100000, 200, 2000, 150
CURRENCY, RUN_ID, SECRET = "^[A-Z]{3}$", "^[A-Za-z0-9._:-]{8,128}$", "(?i)[?&](token|api_?key|access_?token)="
REQUEST_HOST = "(?i)^\\s*https?:[/\\\\]*(?:[^/?#\\\\]*@)?(?:[^/?#\\\\:]*\\.)?scrape\\.do(?=[:/?#\\\\]|\\s*$)"
PLATFORMS = ("deliveroo", "talabat", "careem")
LOCALES = ("en", "ar")
AVAILABILITY = ("available", "unavailable", "unknown")
RUN_STATUSES, TRIGGERS, TARGETS = ("running", "succeeded", "partial", "failed"), ("manual", "cron", "queue"), ("restaurant", "listing")
COUNTS = (
    "restaurantsCreated", "restaurantsUpdated", "restaurantsUnchanged", "categoriesCreated", "categoriesUpdated", "categoriesUnchanged", "categoriesRejected",
    "categoriesMarkedInactive", "itemsSeen", "itemsCreated", "itemsUpdated", "itemsUnchanged", "itemsRejected", "itemsMarkedInactive",
)
GROUP_STATUSES, IDENTITY_STATUSES = ("active", "inactive"), ("verified", "auto", "review")
CANONICAL_STATUSES, CANONICAL_IDENTITY = ("active", "inactive"), ("auto", "verified", "review")
MATCH_STATUSES = ("MATCHED", "REVIEW", "UNMATCHED", "REJECTED")
MATCH_METHODS = ("SEED", "MANUAL", "EXACT_NAME", "NAME_ADDRESS", "NAME_LOCATION", "BRAND_NAME_ADDRESS", "SEMANTIC", "IMPORT")
SIGNALS = ("NAME_EXACT", "BRAND_EXACT", "CITY_EQUAL", "AREA_COMPATIBLE", "ADDRESS_EXACT", "LOCATION_NEAR")
CONFLICTS = ("CITY_MISMATCH", "AREA_MISMATCH", "ADDRESS_MISMATCH", "LOCATION_FAR", "SAME_PLATFORM_ALREADY_MAPPED", "MULTIPLE_CANDIDATES")
DECIDERS = ("backfill", "manual")
ITEM_METHODS = ("IMPORT", "EXACT_NORMALIZED", "NAME_CATEGORY", "NAME_DESCRIPTION", "VARIANT", "MODIFIER", "SEMANTIC", "MANUAL")
ITEM_DECIDERS = ("import", "matcher", "manual")
SCORES = ("nameScore", "descriptionScore", "categoryScore", "variantScore", "modifierScore", "imageScore")
NOT_OF_GROUPS = ("url", "rating", "ratingCount", "deliveryFee", "minimumOrder", "price", "isOpen", "currency")
NOT_OF_CANONICALS = ("price", "originalPrice", "currency", "imageUrl", "sourceUrl", "url", "platformItemId", "sourceKey", "isAvailable", "availabilityStatus", "isActive", "modifiers", "hasModifiers")
NOT_OF_MAPPINGS = ("price", "originalPrice", "currency", "imageUrl", "sourceUrl", "name", "description", "isAvailable", "availabilityStatus")
TOKEN_PROBLEMS = {
    "EMPTY": "must be a non-empty string", "TOO_LONG": "must be at most 256 characters", "WHITESPACE": "must not contain whitespace (display names are not identities)",
    "ARABIC": "must not contain Arabic text (translated names are not identities)",
}


# values


class Facts:
    """What rules ask of a document column, as columns in stages that build on one another: each is worked out once for a document, outside
    of lambdas, which Spark interprets. What is inside lists is not here, but worked out where a list's elements are."""

    def __init__(self, documents: DataFrame, doc: str):
        self.doc, self._taken, self.stages, self._names = F.col(doc), set(documents.columns), [{}, {}, {}, {}], {}

    def put(self, stage: int, what: str, column: Callable[[], Column]) -> Column:
        name = self._names.get(what)
        if name is None:
            n = len(self._names)
            while f"_fact_{n}" in self._taken:
                n += len(self._names) + 1
            name = self._names[what] = f"_fact_{n}"
            self._taken.add(name)
            self.stages[stage][name] = column()
        found = F.col(name)
        found.is_fact = True
        return found

    def on(self, documents: DataFrame, out: str, found: Column) -> DataFrame:
        # a lambda in each stage: else Spark fuses the stages into one method that is larger than the JVM compiles (8,000 bytes)
        for stage in self.stages:
            first = next(iter(stage), None)
            documents = documents.withColumns(stage | {first: bound(stage[first], lambda x: x)}) if stage else documents
        return documents.withColumn(out, found).drop(*self._names.values())


class Fact:
    """The value at a path of the documents; in place of a VARIANT column in the functions below."""

    def __init__(self, facts: Facts, path: str = ""):
        self.facts, self.path = facts, path

    def at(self, path: str) -> Fact:
        return Fact(self.facts, f"{self.path}.{path}" if self.path else path)

    def _put(self, stage: int, what: str, column: Callable[[], Column]) -> Column:
        return self.facts.put(stage, f"{what} {self.path}", column)

    def variant(self) -> Column:
        return self._put(0, "variant", lambda: F.try_variant_get(self.facts.doc, f"$.{self.path}", "variant")) if self.path else self.facts.doc

    def kind(self) -> Column:
        return self._put(1, "kind", lambda: F.schema_of_variant(self.variant()))

    def cast(self, kind: str) -> Column:
        return self._put(1, kind, lambda: F.try_variant_get(self.variant(), "$", kind))

    def derived(self, stage: int, what: str, column: Callable[[Fact], Column]) -> Column:
        return self._put(stage, what, lambda: column(self))


def bound(value: Column | Fact, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of the value, which is computed once, however often it is used."""
    if isinstance(value, Fact) or "is_fact" in vars(value):
        return use(value)
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def variant(value: Column | Fact) -> Column:
    return value.variant() if isinstance(value, Fact) else value


def get(doc: Column | Fact, path: str) -> Column | Fact:
    return doc.at(path) if isinstance(doc, Fact) else F.try_variant_get(doc, f"$.{path}", "variant")


def missing(value: Column | Fact) -> Column:
    return variant(value).isNull()


def _is(value: Column | Fact, *kinds: str) -> Column:
    """Whether the value is an ARRAY, STRING, ...; a JSON null is VOID. Never null."""
    if isinstance(value, Fact):
        return F.coalesce(reduce(Column.__or__, (F.startswith(value.kind(), F.lit(k)) for k in kinds)), F.lit(False))
    return F.coalesce(F.schema_of_variant(value).rlike(f"^(?:{'|'.join(kinds)})"), F.lit(False))


def is_text(value: Column | Fact) -> Column:
    return _is(value, "STRING")


def is_number(value: Column | Fact) -> Column:
    return _is(value, "BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def is_object(value: Column | Fact) -> Column:
    """Without its type in full, which names all its fields."""
    return (value.cast("struct<>") if isinstance(value, Fact) else F.try_variant_get(value, "$", "struct<>")).isNotNull()


def is_list(value: Column | Fact) -> Column:
    return value.cast("array<variant>").isNotNull() if isinstance(value, Fact) else _is(value, "ARRAY")


def _derived(stage: int, what: str):
    """Decorator: of a Fact, the function's column is one of the stage."""

    def put(fn):
        return lambda value: value.derived(stage, what, fn) if isinstance(value, Fact) else fn(value)

    return put


@_derived(2, "text")
def text(value: Column | Fact) -> Column:
    """The text of a value that is one, else null."""
    return F.when(is_text(value), F.try_variant_get(variant(value), "$", "string"))


@_derived(2, "number")
def number(value: Column | Fact) -> Column:
    return F.when(is_number(value), F.try_variant_get(variant(value), "$", "double"))


@_derived(2, "flag")
def flag(value: Column | Fact) -> Column:
    return F.when(_is(value, "BOOLEAN"), F.try_variant_get(variant(value), "$", "boolean"))


@_derived(3, "moment")
def moment(value: Column | Fact) -> Column:
    iso = bound(text(value), lambda t: F.when(t.rlike("^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}"), t.try_cast("timestamp")))
    return F.when(_is(value, "TIMESTAMP", "DATE"), F.try_variant_get(variant(value), "$", "timestamp")).otherwise(iso)


@_derived(3, "object id")
def object_id(value: Column | Fact) -> Column:
    return bound(text(value), lambda t: F.when(t.rlike("(?i)^[0-9a-f]{24}$"), F.lower(t)))


def says(value: Column, *words: str) -> Column:
    """Whether the value is one of these texts; never null."""
    return F.coalesce(text(value).isin(*words), F.lit(False))


# issues


def issue(when: Column, path: Column, message: Column | str) -> Column:
    told = F.lit(message) if isinstance(message, str) else message
    return F.when(F.coalesce(when, F.lit(False)), F.array(F.struct(path.alias("path"), told.alias("message")))).otherwise(F.array().cast(ISSUES)).cast(ISSUES)


def several(*parts: Column) -> Column:
    return F.flatten(F.array(*parts)) if len(parts) > 1 else parts[0]


def under(path: Column | None, name: str) -> Column:
    """Path of a field; what is in the document itself (no path) has its bare name."""
    return F.lit(name) if path is None else F.concat(path, F.lit(f".{name}"))


def elements(value: Column) -> Column:
    return F.coalesce(value.cast("array<variant>") if isinstance(value, Fact) else F.try_variant_get(value, "$", "array<variant>"), F.array().cast("array<variant>"))


def keys(value: Column) -> Column:
    return F.coalesce(F.array_sort(F.json_object_keys(F.to_json(variant(value)))), F.array().cast("array<string>"))


def must(test: Callable[[Column], Column], message: str) -> Check:
    """A value that has to be there and pass the test."""
    return lambda x, p: issue(~F.coalesce(test(x), F.lit(False)), p, message)


def optional(check: Check) -> Check:
    return lambda x, p: F.when(missing(x), F.array().cast(ISSUES)).otherwise(check(x, p))


def required(check: Check) -> Check:
    return lambda x, p: F.when(missing(x), issue(F.lit(True), p, "is required")).otherwise(check(x, p))


def one_of(words: Sequence[str], message: str | None = None) -> Check:
    return must(lambda x: text(x).isin(*words), message or f"must be one of: {', '.join(words)}")


platform = one_of(PLATFORMS, "must be a supported dining platform")
date = must(lambda x: moment(x).isNotNull(), "must be a valid Date")
identifier = must(lambda x: object_id(x).isNotNull(), "must be an ObjectId")
boolean = must(lambda x: flag(x).isNotNull(), "must be a boolean")
currency = must(lambda x: text(x).rlike(CURRENCY), "must be an ISO 4217 code (e.g. AED)")
share = must(lambda x: number(x).between(0, 1), "must be between 0 and 1")
_TRIM = "^[\\s\\x{00a0}\\x{feff}]+|[\\s\\x{00a0}\\x{feff}]+$"


def plain(most: int = MOST_TEXT) -> Check:
    def told(t: Column, p: Column) -> Column:
        odd = lambda bare: several(issue(bare == "", p, "must not be empty"), issue(t != bare, p, "must not have leading/trailing whitespace"), issue(F.length(t) > most, p, f"must be at most {most} characters"))
        return F.when(t.isNull(), issue(F.lit(True), p, "must be a string")).otherwise(bound(F.regexp_replace(t, _TRIM, ""), odd))

    return lambda x, p: bound(text(x), lambda t: told(t, p))


def short_text(most: int) -> Check:
    return optional(must(lambda x: bound(text(x), lambda t: (F.regexp_replace(t, _TRIM, "") != "") & (F.length(t) <= most)), f"must be a non-empty string of at most {most} characters"))


def amount(least: int | None = None, most: int | None = None, whole: bool = False) -> Check:
    def told(n: Column, p: Column) -> Column:
        parts = [issue(n != F.floor(n), p, "must be an integer")] if whole else []
        parts += [issue(n < least, p, f"must be >= {least}")] if least is not None else []
        parts += [issue(n > most, p, f"must be <= {most}")] if most is not None else []
        return F.when(n.isNull(), issue(F.lit(True), p, "must be a finite number")).otherwise(several(*parts))

    return lambda x, p: bound(number(x), lambda n: told(n, p))


def _why(problem: Column) -> Column:
    return F.create_map(*(F.lit(s) for pair in TOKEN_PROBLEMS.items() for s in pair))[problem]


def token(x: Column, p: Column) -> Column:
    problem = bound(text(x), lambda t: F.when(t.isNull(), "EMPTY").otherwise(tags.identity_problem(t)))
    return bound(problem, lambda w: issue(w.isNotNull(), p, _why(w)))


def url(x: Column, p: Column) -> Column:
    return bound(text(x), lambda t: _url(t, p))


def _url(t: Column, p: Column) -> Column:
    web = t.rlike("(?i)^\\s*https?:")
    absolute = F.when(web, t.rlike("(?i)^\\s*https?:[/\\\\]*[^\\s/?#\\\\]+")).otherwise(t.rlike("(?i)^\\s*[a-z][a-z0-9+.-]*:"))
    owner = t.rlike("(?i)^\\s*[a-z][a-z0-9+.-]*:[/\\\\]*(?!:?@)[^/?#\\\\]*@")
    wrong = several(issue(~web, p, "must use http or https"), issue(owner, p, "must not contain credentials"), issue(t.rlike(SECRET), p, "must not contain secret query parameters"))
    return F.when(t.isNull(), issue(F.lit(True), p, "must be a URL string")).when(~absolute, issue(F.lit(True), p, "must be an absolute URL")).otherwise(wrong)


def platform_url(x: Column, p: Column) -> Column:
    return several(url(x, p), issue(text(x).rlike(REQUEST_HOST), p, "must be the platform URL, not a Scrape.do request URL"))


def _strange(x: Column, p: Column) -> Column:
    """An issue for each key that is no locale."""
    other = F.filter(keys(x), lambda k: ~k.isin(*LOCALES))
    return F.transform(other, lambda k: F.struct(F.concat(p, F.lit("."), k).alias("path"), F.lit("is not a supported locale (en, ar)").alias("message"))).cast(ISSUES)


def _spoken_in(at: str, check: Check, x: Column, p: Column) -> Column:
    return bound(get(x, at), lambda y: optional(check)(y, under(p, at)))


def localized(check: Check = plain()) -> Check:
    def inside(x: Column, p: Column) -> Column:
        there = [_spoken_in(at, check, x, p) for at in LOCALES]
        none = issue(missing(get(x, "en")) & missing(get(x, "ar")), p, "must contain at least one locale")
        return F.when(~is_object(x), issue(F.lit(True), p, "must be a LocalizedText object { en?, ar? }")).otherwise(several(_strange(x, p), none, *there))

    return inside


def per_locale(check: Check) -> Check:
    def inside(x: Column, p: Column) -> Column:
        there = [_spoken_in(at, check, x, p) for at in LOCALES]
        return F.when(~is_object(x), issue(F.lit(True), p, "must be an object { en?, ar? }")).otherwise(several(_strange(x, p), *there))

    return inside


def texts(x: Column, p: Column) -> Column:
    each = F.flatten(F.transform(elements(x), lambda e, i: plain(200)(e, F.concat(p, F.lit("["), i, F.lit("]")))))
    return F.when(is_list(x), each).otherwise(issue(F.lit(True), p, "must be an array of strings"))


def list_of(test: Callable[[Column], Column], message: str) -> Check:
    """One issue for the list, whatever the number of elements that fail."""
    return must(lambda x: is_list(x) & F.forall(elements(x), lambda e: F.coalesce(test(e), F.lit(False))), message)


words = list_of(lambda e: text(e) != "", "must be an array of non-empty strings")
spoken = list_of(lambda e: F.regexp_replace(text(e), _TRIM, "") != "", "must be an array of non-empty strings")
codes = list_of(lambda e: text(e).rlike("^[A-Z0-9_]{2,64}$"), "must be an array of UPPER_SNAKE codes")


# rules


class Field(NamedTuple):
    path: str
    check: Check

    def issues(self, doc: Column, at: Column | None) -> Column:
        return bound(get(doc, self.path), lambda x: self.check(x, under(at, self.path)))


class Given(NamedTuple):
    """An issue at the path if the condition holds in the document."""

    path: str
    message: str | Callable[[Column], Column]
    when: Callable[[Column], Column]

    def issues(self, doc: Column, at: Column | None) -> Column:
        return issue(self.when(doc), under(at, self.path), self.message if isinstance(self.message, str) else self.message(doc))


class Inside(NamedTuple):
    path: str
    rules: tuple
    may_miss: bool = False

    def issues(self, doc: Column, at: Column | None) -> Column:
        return bound(get(doc, self.path), lambda x: self._issues(x, under(at, self.path)))

    def _issues(self, x: Column, p: Column) -> Column:
        found = F.when(is_object(x), issues_of(x, self.rules, p)).otherwise(issue(F.lit(True), p, "must be an object"))
        return F.when(missing(x), F.array().cast(ISSUES)).otherwise(found) if self.may_miss else found


class Each(NamedTuple):
    path: str
    rules: tuple
    wrong: str = "must be an array"
    may_miss: bool = False
    may_be_empty: bool = True

    def issues(self, doc: Column, at: Column | None) -> Column:
        return bound(get(doc, self.path), lambda x: self._issues(x, under(at, self.path)))

    def _issues(self, x: Column, p: Column) -> Column:
        def one(e: Column, i: Column) -> Column:
            q = F.concat(p, F.lit("["), i, F.lit("]"))
            return F.when(is_object(e), issues_of(e, self.rules, q)).otherwise(issue(F.lit(True), q, "must be an object"))

        bad = ~is_list(x) if self.may_be_empty else ~is_list(x) | (F.size(elements(x)) == 0)
        found = F.when(bad, issue(F.lit(True), p, self.wrong)).otherwise(F.flatten(F.transform(elements(x), one)))
        return F.when(missing(x), F.array().cast(ISSUES)).otherwise(found) if self.may_miss else found


class When(NamedTuple):
    """Rules that hold only for documents of which the condition is true."""

    when: Callable[[Column], Column]
    rules: tuple

    def issues(self, doc: Column, at: Column | None) -> Column:
        return F.when(F.coalesce(self.when(doc), F.lit(False)), issues_of(doc, self.rules, at)).otherwise(F.array().cast(ISSUES))


def issues_of(doc: Column, rules: tuple, at: Column | None) -> Column:
    return several(*(r.issues(doc, at) for r in rules))


def there(path: str) -> Callable[[Column], Column]:
    return lambda d: ~missing(get(d, path))


def absent(*paths: str, message: str) -> tuple:
    return tuple(Given(p, message, there(p)) for p in paths)


def times(*paths: str) -> tuple:
    """Dates that have to be there, and no update before the creation."""
    return (*(Field(p, required(date)) for p in paths), Given("updatedAt", "must not be earlier than createdAt", lambda d: moment(get(d, "updatedAt")) < moment(get(d, "createdAt"))))


# keys of sources


def _segment(d: Column, kind_of: str, path: str) -> Column:
    if kind_of == "position":
        return _at_place(number(get(d, path)))
    return tags.identity_segment(text(get(d, path)), F.lit(None).cast("string"), F.lit(None).cast("int")) if kind_of == "id" else _at_anchor(text(get(d, path)))


def _expected(entity: str, kind_of: str, path: str, built: Callable[[Column, Column], Column]) -> tuple:
    """The key has to be the one built of the identity; where that can be none, the issue says why."""
    key = lambda d: built(d, _segment(d, kind_of, path))
    value = lambda d: F.when(text(get(d, path)).isNull(), "EMPTY").otherwise(tags.identity_problem(text(get(d, path))))
    why = (lambda d: F.lit(f"{entity} position must be an integer between 0 and 100000")) if kind_of == "position" else (lambda d: F.concat(F.lit(f"{entity} {kind_of} "), _why(value(d))))
    differs = lambda d: ~F.coalesce(text(get(d, "sourceKey")) == key(d), F.lit(False))
    message = lambda d: F.coalesce(F.concat(F.lit("does not match the identity fields (expected "), key(d), F.lit(")")), why(d))
    return (
        When(lambda d: says(get(d, "sourceKeyKind"), kind_of) & missing(get(d, path)), (Given(path, f'is required when sourceKeyKind is "{kind_of}"', lambda d: F.lit(True)),)),
        When(lambda d: says(get(d, "sourceKeyKind"), kind_of) & there(path)(d), (Given("sourceKey", message, differs),)),
    )


def _id_wins(path: str) -> Given:
    return Given("sourceKeyKind", f'must be "id" when {path} is present', lambda d: there(path)(d) & ~says(get(d, "sourceKeyKind"), "id"))


def _parsed(d: Column, path: str) -> Column:
    return bound(text(get(d, path)), lambda t: tags.parsed_key(t, PLATFORMS))


def _parent(d: Column) -> Column:
    """The parsed key of the restaurant; null if it is none."""
    return bound(_parsed(d, "restaurantSourceKey"), lambda k: F.when(k["entity"] == "restaurant", k))


def _own(d: Column) -> Column:
    return _parsed(d, "sourceKey")


def _restaurant_text(d: Column) -> Column:
    return text(get(d, "restaurantSourceKey"))


_OF_RESTAURANT = (
    Field("restaurantId", required(identifier)),
    Field("platformRestaurantId", optional(token)),
    Given("restaurantSourceKey", "must be a valid restaurant sourceKey", lambda d: _parent(d).isNull()),
    Given("restaurantSourceKey", "must belong to the same platform", lambda d: _parent(d).isNotNull() & ~F.coalesce(_parent(d)["platform"] == text(get(d, "platform")), F.lit(False))),
    Given("platformRestaurantId", "does not match restaurantSourceKey", lambda d: there("platformRestaurantId")(d) & (_parent(d)["kind"] == "id") & ~F.coalesce(_parent(d)["value"] == text(get(d, "platformRestaurantId")), F.lit(False))),
)
_NAME, _LOCALIZED = required(localized()), optional(localized())
_ADDRESS = required(localized(platform_url))


def _seen(*dates: str, at: str) -> tuple:
    return (Field(at, per_locale(date)), Field("lastRunIdByLocale", per_locale(plain(128))), *times(*dates))


RESTAURANT = (
    Field("_id", optional(identifier)), Field("platform", platform), Field("platformRestaurantId", optional(token)), Field("slug", optional(token)), Field("sourceKeyKind", one_of(("id", "anchor"))),
    When(lambda d: says(get(d, "platform"), *PLATFORMS), (
        _id_wins("platformRestaurantId"),
        *_expected("restaurant", "id", "platformRestaurantId", lambda d, s: tags.restaurant_key(text(get(d, "platform")), s)),
        *_expected("restaurant", "anchor", "slug", lambda d, s: tags.restaurant_key(text(get(d, "platform")), s)),
    )),
    Field("name", _NAME), Field("brandName", _LOCALIZED), Field("description", _LOCALIZED), Field("url", _ADDRESS), *(Field(f, texts) for f in ("cuisines", "tags", "offers")),
    Field("rating", optional(amount(0, 5))), Field("ratingCount", optional(amount(0, whole=True))), Field("ratingCountText", optional(plain(50))), Field("currency", required(currency)),
    Field("deliveryFee", optional(amount(0, MOST_PRICE))), Field("minimumOrder", optional(amount(0, MOST_PRICE))), Field("deliveryTimeMin", optional(amount(0, whole=True))), Field("deliveryTimeMax", optional(amount(0, whole=True))),
    Given("deliveryTimeMin", "must not exceed deliveryTimeMax", lambda d: number(get(d, "deliveryTimeMin")) > number(get(d, "deliveryTimeMax"))),
    Field("isOpen", optional(boolean)), Field("isActive", required(boolean)), Field("imageUrl", optional(url)),
    Inside("location", (*(Field(f, optional(plain(500))) for f in ("city", "area", "address")), Field("lat", optional(amount(-90, 90))), Field("lng", optional(amount(-180, 180))))),
    *_seen("firstSeenAt", "createdAt", "updatedAt", at="lastScrapedAtByLocale"),
)

CATEGORY = (
    Field("_id", optional(identifier)), Field("platform", platform), *_OF_RESTAURANT, Field("platformCategoryId", optional(token)), Field("sourceKeyKind", one_of(("id", "anchor", "position"))), Field("sortOrder", optional(amount(0, whole=True))),
    When(lambda d: _parent(d).isNotNull(), (
        _id_wins("platformCategoryId"),
        *_expected("category", "id", "platformCategoryId", lambda d, s: tags.category_key(_restaurant_text(d), s)),
        *_expected("category", "position", "sortOrder", lambda d, s: tags.category_key(_restaurant_text(d), s)),
        Given("sourceKey", "must be an anchor category key under restaurantSourceKey", lambda d: says(get(d, "sourceKeyKind"), "anchor") & ~F.coalesce((_own(d)["kind"] == "anchor") & (
            text(get(d, "sourceKey")) == tags.category_key(_restaurant_text(d), _at_anchor(_own(d)["value"]))), F.lit(False))),
    )),
    Field("name", _NAME), Field("isActive", required(boolean)), *_seen("firstSeenAt", "createdAt", "updatedAt", at="lastScrapedAtByLocale"),
)

OPTION = (
    Field("optionId", optional(token)), Field("name", _NAME), Field("description", _LOCALIZED), Field("priceDelta", optional(amount(-MOST_PRICE, MOST_PRICE))), Field("currency", optional(currency)), Field("isAvailable", optional(boolean)),
)
MODIFIERS = (
    Field("groupId", optional(token)), Field("name", _NAME), Field("description", _LOCALIZED), Field("required", optional(boolean)), Field("minSelections", optional(amount(0, whole=True))), Field("maxSelections", optional(amount(1, whole=True))),
    Given("minSelections", "must not exceed maxSelections", lambda d: number(get(d, "minSelections")) > number(get(d, "maxSelections"))),
    Given("minSelections", "must be >= 1 when the group is required", lambda d: flag(get(d, "required")) & (number(get(d, "minSelections")) == 0)),
    Each("options", OPTION, "must be a non-empty array", may_be_empty=False),
)


def _category_of(d: Column) -> Column:
    """The category's part of an item's key."""
    return F.regexp_extract(text(get(d, "sourceKey")), "^(.*):item:.*$", 1)


def _unlike(status: str, value: bool) -> Given:
    return Given("isAvailable", f'must be {str(value).lower()} when availabilityStatus is "{status}"', lambda d: says(get(d, "availabilityStatus"), status) & ~F.coalesce(flag(get(d, "isAvailable")) == value, F.lit(False)))


def _item_key(d: Column, category: Column, segment: Column) -> Column:
    return tags.item_key_of(_restaurant_text(d), category, segment)


def _at_anchor(value: Column) -> Column:
    return tags.identity_segment(F.lit(None).cast("string"), value, F.lit(None).cast("int"))


def _at_place(place: Column) -> Column:
    none = F.lit(None).cast("string")
    return tags.identity_segment(none, none, F.when(place == F.floor(place), place).cast("int"))


ITEM = (
    Field("_id", optional(identifier)), Field("platform", platform), *_OF_RESTAURANT, Field("platformItemId", optional(token)), Field("sourceKeyKind", one_of(("id", "anchor", "position"))), Field("categoryId", optional(identifier)),
    When(lambda d: _parent(d).isNotNull(), (
        _id_wins("platformItemId"),
        *_expected("item", "id", "platformItemId", lambda d, s: _item_key(d, F.lit(""), s)),
        Given("sourceKey", "must be an anchor item key under restaurantSourceKey", lambda d: says(get(d, "sourceKeyKind"), "anchor") & ~F.coalesce((_own(d)["entity"] == "item") & (_own(d)["kind"] == "anchor") & (
            text(get(d, "sourceKey")) == _item_key(d, F.lit(""), _at_anchor(_own(d)["value"]))), F.lit(False))),
        When(lambda d: says(get(d, "sourceKeyKind"), "position"), (
            Given("categoryId", 'is required when sourceKeyKind is "position"', lambda d: missing(get(d, "categoryId"))),
            Given("sourceKey", "must be a position item key under a category of restaurantSourceKey", lambda d: ~_placed(d)),
            Given("sourceKey", lambda d: F.coalesce(F.concat(F.lit("does not match the identity fields (expected "), _place_key(d), F.lit(")")), F.lit("item position must be an integer between 0 and 100000")),
                  lambda d: _placed(d) & ~F.coalesce(text(get(d, "sourceKey")) == _place_key(d), F.lit(False))),
        )),
    )),
    Field("name", _NAME), Field("description", _LOCALIZED), Field("categoryName", _LOCALIZED), Field("sourceUrl", _ADDRESS), Field("price", required(amount(0, MOST_PRICE))), Field("originalPrice", optional(amount(0, MOST_PRICE))),
    Given("originalPrice", "must not be lower than price", lambda d: number(get(d, "originalPrice")) < number(get(d, "price"))), Field("currency", required(currency)), Field("imageUrl", optional(url)),
    When(lambda d: missing(get(d, "availabilityStatus")), (Field("isAvailable", required(boolean)),)), Field("availabilityStatus", optional(one_of(AVAILABILITY))),
    Given("isAvailable", 'must be absent when availabilityStatus is "unknown"', lambda d: says(get(d, "availabilityStatus"), "unknown") & there("isAvailable")(d)), _unlike("available", True), _unlike("unavailable", False),
    Field("isActive", required(boolean)), Field("isPopular", optional(boolean)), Field("dietaryTags", texts), Field("calories", optional(amount(0, whole=True))), Field("hasModifiers", optional(boolean)), Each("modifiers", MODIFIERS, may_miss=True),
    *_seen("firstSeenAt", "lastSeenAt", "createdAt", "updatedAt", at="lastSeenAtByLocale"),
)


def _placed(d: Column) -> Column:
    own = _own(d)
    within = F.startswith(text(get(d, "sourceKey")), F.concat(_restaurant_text(d), F.lit(":category:")))
    return F.coalesce((own["entity"] == "item") & (own["kind"] == "position") & within, F.lit(False))


def _place_key(d: Column) -> Column:
    return _item_key(d, _category_of(d), _at_place(_own(d)["value"].try_cast("double")))


_STATUS = amount(100, 599, whole=True)
RUN = (
    Field("_id", optional(identifier)), Field("runId", must(lambda x: text(x).rlike(RUN_ID), "must be 8–128 characters of [A-Za-z0-9._:-]")), Field("platform", platform), Field("locale", one_of(LOCALES)), Field("targetType", one_of(TARGETS)),
    Field("trigger", one_of(TRIGGERS)), Field("status", one_of(RUN_STATUSES)), Field("targetUrl", platform_url), Field("dryRun", required(boolean)), Field("startedAt", required(date)),
    Given("finishedAt", "must be absent while the run is running", lambda d: says(get(d, "status"), "running") & there("finishedAt")(d)),
    When(lambda d: ~says(get(d, "status"), "running"), (Field("finishedAt", required(date)), Given("finishedAt", "must not be earlier than startedAt", lambda d: moment(get(d, "finishedAt")) < moment(get(d, "startedAt"))))),
    Field("durationMs", optional(amount(0, whole=True))), Inside("counts", tuple(Field(f, required(amount(0, whole=True))) for f in COUNTS)),
    Given("errors", f"must contain at most {MOST_ERRORS} entries", lambda d: F.size(elements(get(d, "errors"))) > MOST_ERRORS),
    Given("errors", "must contain at least one entry for a failed run", lambda d: says(get(d, "status"), "failed") & is_list(get(d, "errors")) & (F.size(elements(get(d, "errors"))) == 0)),
    Each("errors", (Field("stage", plain(100)), Field("code", plain(100)), Field("message", plain(MOST_MESSAGE)), Given("message", "must not contain secret query parameters", lambda d: text(get(d, "message")).rlike(SECRET)))),
    Inside("fetch", (
        Field("statusCode", optional(_STATUS)), Field("initialStatusCode", optional(_STATUS)), Field("finalUrl", optional(platform_url)), Field("requestCost", optional(amount(0))), Field("remainingCredits", optional(amount(0))),
        Field("attempts", optional(amount(1, whole=True))), Field("durationMs", optional(amount(0, whole=True))),
    ), may_miss=True),
    *times("createdAt", "updatedAt"),
)


def _degrees(most: int, message: str) -> Check:
    return optional(must(lambda x: F.abs(number(x)) <= most, message))


GROUP = (
    Field("canonicalName", _NAME), Field("brandName", _LOCALIZED), Field("city", short_text(100)), Field("area", short_text(200)), Field("address", short_text(500)),
    Inside("location", (Field("lat", _degrees(90, "must be a latitude")), Field("lng", _degrees(180, "must be a longitude"))), may_miss=True),
    Field("status", one_of(GROUP_STATUSES)), Field("identityStatus", one_of(IDENTITY_STATUSES)), Field("seedRestaurantId", optional(identifier)), Inside("signals", (Field("names", words), Field("brands", words))),
    *absent(*NOT_OF_GROUPS, message="platform-specific data does not belong on a canonical group"), Field("createdAt", date), Field("updatedAt", date),
)


def _needed(path: str, status: str = "matchStatus") -> Given:
    """An id that only an unmatched mapping goes without."""
    told = lambda d: F.concat(F.lit("is required when "), F.coalesce(F.try_variant_get(variant(get(d, status)), "$", "string"), F.when(missing(get(d, status)), "undefined").otherwise("null")))
    return Given(path, told, lambda d: ~says(get(d, status), "UNMATCHED") & object_id(get(d, path)).isNull())


def _unmatched(d: Column) -> Column:
    return says(get(d, "matchStatus"), "UNMATCHED")


def _known(among: Sequence[str], message: str) -> Check:
    return list_of(lambda e: text(e).isin(*among), message)


MAPPING = (
    Field("restaurantId", identifier), Field("platform", one_of(PLATFORMS)), Field("platformRestaurantId", short_text(200)), Field("restaurantSourceKey", must(lambda x: text(x) != "", "is required")), Field("matchStatus", one_of(MATCH_STATUSES)),
    When(lambda d: ~(_unmatched(d) & missing(get(d, "matchMethod"))), (Field("matchMethod", one_of(MATCH_METHODS)),)), Field("decidedBy", one_of(DECIDERS)), Field("canonicalRestaurantGroupId", optional(identifier)),
    Given("canonicalRestaurantGroupId", "must be absent while UNMATCHED", lambda d: _unmatched(d) & there("canonicalRestaurantGroupId")(d)), _needed("canonicalRestaurantGroupId"), Field("isActive", boolean),
    Given("isActive", "must be false exactly when REJECTED", lambda d: flag(get(d, "isActive")) == says(get(d, "matchStatus"), "REJECTED")), Field("confidence", share),
    Inside("evidence", (Field("signals", _known(SIGNALS, "contains an unknown signal")), Field("conflicts", _known(CONFLICTS, "contains an unknown conflict")), Field("reason", short_text(100)), Field("note", short_text(500)))),
    Field("createdAt", date), Field("updatedAt", date),
)

CANONICAL = (
    *(Field(f, identifier) for f in ("restaurantGroupId", "seedMenuItemId", "seedRestaurantId")),
    Given("identityKey", "does not match restaurantGroupId + seedMenuItemId", lambda d: object_id(get(d, "restaurantGroupId")).isNotNull() & object_id(get(d, "seedMenuItemId")).isNotNull() & ~F.coalesce(
        text(get(d, "identityKey")) == F.concat(F.lit("seed:"), object_id(get(d, "restaurantGroupId")), F.lit(":"), object_id(get(d, "seedMenuItemId"))), F.lit(False))),
    Field("seedPlatform", platform), Field("canonicalName", _NAME), Field("canonicalDescription", _LOCALIZED), Field("category", _LOCALIZED), Field("aliases", spoken), Field("searchKeywords", spoken),
    Given("searchKeywords", f"must have at most {MOST_KEYWORDS} entries", lambda d: F.size(elements(get(d, "searchKeywords"))) > MOST_KEYWORDS),
    Inside("variant", (
        Field("quantity", optional(must(lambda x: number(x) > 0, "must be a positive number"))), *(Field(f, optional(must(lambda x: F.regexp_replace(text(x), _TRIM, "") != "", "must be a non-empty string"))) for f in ("size", "unit")), Field("label", _LOCALIZED),
    ), may_miss=True),
    Field("status", one_of(CANONICAL_STATUSES)), Field("identityStatus", one_of(CANONICAL_IDENTITY)), Inside("signals", tuple(Field(f, words) for f in ("normalizedNames", "normalizedDescriptions", "normalizedCategories"))),
    *absent(*NOT_OF_CANONICALS, message="platform-specific data does not belong on a canonical item"), Field("createdAt", date), Field("updatedAt", date),
)

ITEM_MAPPING = (
    *(Field(f, identifier) for f in ("restaurantGroupId", "menuItemId", "restaurantId")), Field("platform", platform), Field("platformItemId", optional(must(lambda x: text(x) != "", "must be a non-empty string"))),
    Field("matchStatus", one_of(MATCH_STATUSES)), Field("decidedBy", one_of(ITEM_DECIDERS)), When(_unmatched, absent("canonicalItemId", "matchMethod", message="must be absent while UNMATCHED")), _needed("canonicalItemId"),
    When(lambda d: ~_unmatched(d), (Field("matchMethod", one_of(ITEM_METHODS)),)), Field("isActive", boolean),
    Given("isActive", "must be false when REJECTED", lambda d: says(get(d, "matchStatus"), "REJECTED") & flag(get(d, "isActive"))),
    Given("supersededAt", "must be absent on an active mapping", lambda d: flag(get(d, "isActive")) & there("supersededAt")(d)),
    Given("supersededAt", "is required on an inactive (superseded) mapping", lambda d: ~flag(get(d, "isActive")) & ~says(get(d, "matchStatus"), "REJECTED") & moment(get(d, "supersededAt")).isNull()),
    Field("supersedesMappingId", optional(identifier)), Field("confidence", share), Given("confidence", "must be 1 for IMPORT", lambda d: says(get(d, "matchMethod"), "IMPORT") & ~F.coalesce(number(get(d, "confidence")) == 1, F.lit(False))),
    Inside("evidence", (
        *(Field(f, optional(share)) for f in SCORES), Field("reasons", codes), Field("conflicts", codes), Field("candidateCanonicalItemIds", optional(list_of(lambda e: object_id(e).isNotNull(), "must be an array of ObjectIds"))),
    )),
    Field("note", short_text(500)), *absent(*NOT_OF_MAPPINGS, message="platform data does not belong on an item mapping"), *(Field(f, date) for f in ("decidedAt", "createdAt", "updatedAt")),
)

KINDS = {
    "restaurant": RESTAURANT, "category": CATEGORY, "item": ITEM, "modifiers": MODIFIERS, "run": RUN, "group": GROUP, "mapping": MAPPING, "canonical": CANONICAL, "item_mapping": ITEM_MAPPING,
}


def _told(doc: Column | Fact, rules: tuple) -> Column:
    return F.when(is_object(doc), issues_of(doc, rules, None)).otherwise(issue(F.lit(True), F.lit("$"), "must be an object"))


def issues(doc: Column, rules: tuple) -> Column:
    """array<struct<path, message>> of a VARIANT document, empty if nothing is wrong."""
    return bound(doc, lambda d: _told(d, rules))


def validated(documents: DataFrame, rules: tuple, doc: str = "doc", out: str = "issues") -> DataFrame:
    """The rows with their issues; other columns pass through, one of the name `out` is replaced."""
    facts = Facts(documents, doc)
    return facts.on(documents, out, _told(Fact(facts), rules))


def issue_rows(documents: DataFrame, rules: tuple, key: str, doc: str = "doc") -> DataFrame:
    """key, at (place among the document's issues), path, message: a row for each issue, none for a document without."""
    # outer: a filter that Spark infers for the explode would be pushed below the facts and repeat all of them
    rows = validated(documents.select(key, doc), rules, doc, "_issues").select(F.col(key), F.posexplode_outer("_issues").alias("at", "_issue"))
    return rows.where("_issue IS NOT NULL").select(key, "at", "_issue.path", "_issue.message")
