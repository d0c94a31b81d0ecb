"""Menu pages that embed one tree of related lists, as tables: restaurants, categories, items, modifier groups, options and warnings.

Each level of the tree is one explode of VARIANT lists. What refers to something by its id within the page (an item to its
category and its modifier groups, an item that is only an option of a group) is joined by (page, id). Values are taken only
where they have the expected type: a number given as text is no number, an id with white space is none. A page without such a
state gives a warning and no rows; the rendered page is not read instead.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.item_text import BIDI, THREE_PLACES, money, number_text
from tallymart.operators.files import written

STATE_TAG = '(?is)<script[^>]*\\bid="__NEXT_DATA__"[^>]*>'
STATE = f"{STATE_TAG}(.*?)</script>"
#: Texts that are not clean: marks of direction, white space at an end, in a row or other than a blank.
ODD = f"{BIDI}|[\\t\\n\\x0B\\f\\r]|  |^ | $"
#: Where the state has what, the separator of header texts and what they look like, by language.
MENU, ROOT = "$.props.initialState.menuPage.menu", "$.metas.root"
MAP_LAYOUT = "layout-list-map"
SEPARATOR = "·"
RATING_COUNT, RATING = "^\\((\\d[\\d,]*)(\\+)?\\)$", "^(\\d(?:[.,]\\d+)?)(?:\\s|$)"
HEADER = {
    "en": {"minimum": "(?i)\\bminimum\\b", "delivery": "(?i)\\bdelivery\\b", "opening": "(?i)\\b(closes|opens) at\\b"},
    "ar": {"minimum": "الحد الأدنى", "delivery": "رسوم التوصيل", "opening": "(يغلق|يفتح)"},
}
LIST, TEXTS = "array<variant>", "array<string>"


NUMBERS = ("BIGINT", "DOUBLE", "FLOAT")


def kind(v: Column, path: str) -> Column:
    """Type of what stands at the path, in full; null if nothing does. For values, not for large objects, whose types are long."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _is_number(of: Column) -> Column:
    return of.isin(*NUMBERS) | F.startswith(of, F.lit("DECIMAL"))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of the value, which is worked out once, however often it is used. It also keeps Spark from fusing all columns of a
    row into one method, which could be larger than the JVM compiles."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def clean(text: Column) -> Column:
    """Without marks of direction, white space folded; null if nothing is left."""
    folded = lambda t: F.trim(F.regexp_replace(F.regexp_replace(t, BIDI, ""), "\\s+", " "))
    return bound(text, lambda t: F.when(t.rlike(ODD), bound(folded(t), lambda s: F.nullif(s, F.lit("")))).otherwise(F.nullif(t, F.lit(""))))


def state_text(html: Column) -> Column:
    """What STATE finds in a page, or an empty text, at the speed of a search for plain text where no other end tag is inside."""

    def after(rest: Column) -> Column:
        return bound(F.substring_index(rest, "</script>", 1), lambda t: F.when(F.contains(rest, F.lit("</script>")) & ~F.contains(t, F.lit("</")), t).otherwise(F.regexp_extract(html, STATE, 1)))

    found = lambda tag: F.when(tag == "", "").otherwise(bound(F.substr(html, F.instr(html, tag) + F.length(tag)), after))
    return bound(F.regexp_extract(html, STATE_TAG, 0), found)


def text_at(v: Column, path: str) -> Column:
    return F.when(kind(v, path) == "STRING", clean(F.try_variant_get(v, path, "string")))


def number_at(v: Column, path: str) -> Column:
    return F.when(_is_number(kind(v, path)), F.try_variant_get(v, path, "double"))


def whole_at(v: Column, path: str) -> Column:
    x = number_at(v, path)
    return F.when(x == F.floor(x), x.cast("long"))


def flag_at(v: Column, path: str) -> Column:
    return F.when(kind(v, path) == "BOOLEAN", F.try_variant_get(v, path, "boolean"))


def id_at(v: Column, path: str) -> Column:
    """A number, or a text without white space inside; of a page's numbers only whole ones are expected."""
    of, text = kind(v, path), F.try_variant_get(v, path, "string")
    bare = F.regexp_replace(text, "^\\s+|\\s+$", "")
    return F.when(_is_number(of) | ((of == "STRING") & text.rlike("^\\S+\\z")), text).when((of == "STRING") & ~bare.rlike("^$|\\s"), bare)


def ids_at(v: Column, path: str) -> Column:
    listed = F.coalesce(F.try_variant_get(v, path, LIST), F.array().cast(LIST))
    return F.array_compact(F.transform(listed, lambda x: id_at(x, "$")))


def money_parts(v: Column, path: str) -> tuple[Column, Column]:
    """Number and code of an amount in the smallest units, where they have the expected types."""
    return number_at(v, f"{path}.fractional"), F.when(kind(v, f"{path}.code") == "STRING", F.try_variant_get(v, f"{path}.code", "string"))


def money_of(number: Column, code: Column) -> Column:
    """amount and currency of an amount in the smallest units; null if it is none."""
    cents = F.when(number == F.floor(number), number.cast("long"))
    return F.when((cents >= 0) & code.rlike("^[A-Z]{3}$"), F.struct((cents / F.when(code.isin(*THREE_PLACES), 1000.0).otherwise(100.0)).alias("amount"), code.alias("currency")))


def money_at(v: Column, path: str) -> Column:
    return money_of(*money_parts(v, path))


def image_url(template: Column) -> Column:
    """An address without its query; null if it is not of the web."""
    return bound(F.substring_index(template, "?", 1), lambda base: F.when(base.rlike("(?i)^https?://[^/\\s]+"), base))


def image_anchor(url: Column) -> Column:
    """The address's path: the same picture in every language."""
    return bound(F.regexp_extract(url, "^(?i)https?://[^/]+/+(.*)$", 1), lambda path: F.when((path != "") & ~path.rlike("\\s"), path))


def _warning(scope: str, code: str, field, at=None, message=None) -> Column:
    put = lambda x, t: (F.lit(x) if x is None or isinstance(x, str) else x).cast(t)
    return F.struct(F.lit(scope).alias("scope"), F.lit(code).alias("code"), put(field, "string").alias("field"), put(at, "int").alias("at"), put(message, "string").alias("value"))


class MenuPages:
    """Tables of pages (key, html, locale: en or ar). The menus of the pages are written to the shared folder as VARIANT, so a page is
    made, searched and parsed once, and a table that is asked for takes from them what its columns need and no more. Tables meet by
    sorted joins: their files are small next to their rows. Items meet categories and options in the rows of their page, which are
    dealt once."""

    def __init__(self, pages: DataFrame, key: str = "page_id", html: str = "html", locale: str = "locale"):
        self.key = key
        lang = F.lower(F.regexp_extract(html, "(?is)<html[^>]*\\blang=[\"']?([A-Za-z]+)", 1))
        link = F.regexp_extract(html, "(?is)<link(?=[^>]*rel=[\"']?canonical)[^>]*href=[\"']([^\"']*)", 1)
        state = F.try_parse_json(state_text(F.col(html)))
        rows = pages.select(key, F.col(locale).alias("locale"), F.nullif(lang, F.lit("")).alias("lang"), F.nullif(link, F.lit("")).alias("url"), F.nullif(clean(F.regexp_replace(F.regexp_extract(html, "(?is)<h1[^>]*>(.*?)</h1>", 1), "<[^>]*>", "")), F.lit("")).alias("h1"), F.try_variant_get(state, MENU, "variant").alias("v"))
        items = lambda at: F.try_variant_get("v", f"{ROOT}.items{at}", "variant")
        listed = items("[0]").isNotNull() | F.startswith(F.schema_of_variant(items("")), F.lit("ARRAY"))  # an empty list has no first item
        self.pages = written(rows.withColumn("has_menu", F.coalesce(listed, F.lit(False))), shredded=False)
        self.menus = self.pages.where("has_menu")

    def _beside(self, rows: DataFrame, other: DataFrame, *by: str) -> DataFrame:
        return rows.join(other.hint("merge"), [self.key, *by], "left")

    def _level(self, rows: DataFrame, source: str, path: str, *keep: str, at: str = "at", out: str = "v") -> DataFrame:
        return rows.select(self.key, *keep, F.posexplode(F.try_variant_get(source, path, LIST)).alias(at, out))

    @cached_property
    def _header(self) -> DataFrame:
        """cuisines, rating and the like, from lines of texts: a line with an amount or a count of ratings informs, others name cuisines."""
        spans = lambda line: F.coalesce(F.try_variant_get(line, "$.spans", LIST), F.array().cast(LIST))
        shown = lambda line: F.filter(F.array_compact(F.transform(spans(line), lambda s: F.when(F.try_variant_get(s, "$.typeName", "string") == "UISpanText", text_at(s, "$.text")))), lambda t: t != SEPARATOR)
        lines = self.menus.select(self.key, "locale", F.transform(F.try_variant_get("v", "$.header.headerTags.lines", LIST), shown).alias("lines"))
        informs = lambda ts: F.exists(ts, lambda t: t.rlike(RATING_COUNT) | money(t).isNotNull())
        paired = lambda ts: F.transform(ts, lambda t, i: F.struct(t.alias("text"), F.when(i > 0, F.get(ts, i - 1)).alias("before"), money(t).amount.alias("amount"), t.rlike(RATING_COUNT).alias("count")))
        split = lines.select(self.key, "locale", F.flatten(F.filter("lines", lambda ts: ~informs(ts))).alias("cuisines"), F.flatten(F.transform(F.filter("lines", informs), paired)).alias("told"))
        stars = lambda x: number_text(F.regexp_extract(x["before"], RATING, 1))
        rated = F.get(F.filter("told", lambda x: x["count"] & (stars(x) >= 0) & (stars(x) <= 5)), F.lit(0))
        like = lambda x, what: F.when(F.col("locale") == "ar", x["text"].rlike(HEADER["ar"][what])).otherwise(x["text"].rlike(HEADER["en"][what]))
        counted = lambda x: x["count"] & x["before"].isNotNull()
        lowest = F.get(F.filter("told", lambda x: ~counted(x) & x["amount"].isNotNull() & like(x, "minimum")), F.lit(0))
        fee = F.get(F.filter("told", lambda x: ~counted(x) & x["amount"].isNotNull() & like(x, "delivery") & ~F.coalesce(x["text"] == lowest["text"], F.lit(False))), F.lit(0))
        opening = F.get(F.filter("told", lambda x: ~counted(x) & like(x, "opening") & ~(x["amount"].isNotNull() & (like(x, "minimum") | like(x, "delivery")))), F.lit(0))
        return split.select(self.key, "cuisines", stars(rated).alias("rating"), rated["before"].alias("rating_text"), rated["text"].alias("rating_count_text"), lowest["amount"].alias("minimum_order"), fee["amount"].alias("delivery_fee"), opening["text"].alias("opening_status"))

    @cached_property
    def _pins(self) -> DataFrame:
        """n_pins, n_bad, places (distinct good ones) of the map in the page's information; the customer's own place is no source."""
        groups = self._level(self.menus, "v", "$.layoutGroups", out="g")
        layouts = self._level(groups, "g", "$.layouts", out="l").where(F.try_variant_get("l", "$.actionId", "string") == MAP_LAYOUT)
        pins = self._level(self._level(layouts, "l", "$.blocks", out="b"), "b", "$.map.pins", out="p")
        lat, lng = number_at(F.col("p"), "$.lat"), number_at(F.col("p"), "$.lon")
        good = (lat != 0) & (F.abs(lat) <= 90) & (lng != 0) & (F.abs(lng) <= 180)
        place = F.when(good, F.struct(lat.alias("lat"), lng.alias("lng")))
        return pins.groupBy(self.key).agg(F.count("*").alias("n_pins"), F.sum(F.when(place.isNull(), 1).otherwise(0)).alias("n_bad"), F.collect_set(place).alias("places"))

    @cached_property
    def _placed(self) -> DataFrame:
        """The restaurant's own place and what is wrong with it."""
        rows = self.menus.select(self.key, number_at(F.col("v"), f"{ROOT}.customerLocation.lat").alias("c_lat"), number_at(F.col("v"), f"{ROOT}.customerLocation.lon").alias("c_lng"))
        rows = self._beside(rows, self._pins)
        one = F.get("places", F.lit(0))
        n = F.coalesce(F.size("places"), F.lit(0))
        customer = F.coalesce((one["lat"] == F.col("c_lat")) & (one["lng"] == F.col("c_lng")), F.lit(False))
        problem = F.when(n > 1, "AMBIGUOUS_COORDINATES").when((n == 1) & customer, "COORDINATES_MATCH_CUSTOMER_LOCATION")
        fine = (n == 1) & ~customer
        return written(rows.select(self.key, F.when(fine, one["lat"]).alias("lat"), F.when(fine, one["lng"]).alias("lng"), problem.alias("pin_problem"), F.coalesce("n_bad", F.lit(0)).alias("n_bad")))

    @cached_property
    def _named(self) -> DataFrame:
        """What the state says about the restaurant itself."""
        r = F.col("v")
        at = lambda path: f"{ROOT}.restaurant.{path}"
        code = F.try_variant_get(r, at("currencyCode"), "string")
        image = image_url(text_at(r, "$.header.image.url"))
        return self.menus.select(
            self.key, id_at(r, at("id")).alias("restaurant_id"), id_at(r, at("drnId")).alias("drn_id"), id_at(r, at("uname")).alias("slug"), F.coalesce(text_at(r, at("name")), "h1").alias("name"), "url",
            F.when(code.rlike("^[A-Z]{3}$"), code).alias("currency"), image.alias("image_url"), image_anchor(image).alias("image_anchor"),
            *(text_at(r, at(f"location.address.{a}")).alias(b) for a, b in (("address1", "address"), ("neighborhood", "area"), ("city", "city"), ("country", "country"))),
            whole_at(r, at("location.cityId")).alias("city_id"), whole_at(r, at("location.zoneId")).alias("zone_id"), flag_at(r, at("menuDisabled")).alias("menu_disabled"),
        )

    @cached_property
    def restaurants(self) -> DataFrame:
        return self._beside(self._beside(self._named, self._header), self._placed.select(self.key, "lat", "lng"))

    @cached_property
    def _categories(self) -> DataFrame:
        rows = self._level(self.menus, "v", f"{ROOT}.categories")
        return rows.select(self.key, "at", id_at(F.col("v"), "$.id").alias("category_id"), text_at(F.col("v"), "$.name").alias("name"))

    @cached_property
    def categories(self) -> DataFrame:
        """Those with an id and a name, counted from 0 in the page's order."""
        good = self._categories.where("category_id IS NOT NULL AND name IS NOT NULL")
        return good.select(self.key, (F.row_number().over(Window.partitionBy(self.key).orderBy("at")) - 1).alias("sort_order"), "category_id", "name")

    @cached_property
    def _groups(self) -> DataFrame:
        rows = self._level(self.menus, "v", f"{ROOT}.modifierGroups")
        v = F.col("v")
        return rows.select(self.key, "at", id_at(v, "$.id").alias("group_id"), id_at(v, "$.drnId").alias("drn_id"), text_at(v, "$.name").alias("name"), whole_at(v, "$.minSelection").alias("min_selections"), whole_at(v, "$.maxSelection").alias("max_selections"), flag_at(v, "$.multiselect").alias("multiselect"), "v")

    @cached_property
    def _last_groups(self) -> DataFrame:
        good = self._groups.where("group_id IS NOT NULL AND name IS NOT NULL")
        return good.groupBy(self.key, "group_id").agg(F.max_by(F.struct(*(c for c in good.columns if c not in (self.key, "group_id"))), "at").alias("g")).select(self.key, "group_id", "g.*")

    @cached_property
    def modifier_groups(self) -> DataFrame:
        """Those with an id and a name; the last of equal ids."""
        return self._last_groups.drop("at", "v")

    def _options(self, groups: DataFrame) -> DataFrame:
        rows = self._level(groups, "v", "$.modifierOptions", "group_id", at="position", out="o")
        o, price = F.col("o"), money_at(F.col("o"), "$.price")
        return rows.select(
            self.key, "group_id", "position", id_at(o, "$.id").alias("option_id"), id_at(o, "$.drnId").alias("drn_id"), text_at(o, "$.name").alias("name"), text_at(o, "$.description").alias("description"),
            price.amount.alias("price_delta"), price.currency.alias("currency"), flag_at(o, "$.available").alias("available"), ids_at(o, "$.modifierGroupIds").alias("nested_group_ids"),
        )

    @cached_property
    def options(self) -> DataFrame:
        """Options with a name, of the groups that count."""
        return self._options(self._last_groups).where("name IS NOT NULL")

    @cached_property
    def _items(self) -> DataFrame:
        """All items with what they refer to: category_index, and hidden if an item stands for an option alone."""
        rows = self._level(self.menus, "v", f"{ROOT}.items", at="source_index")
        v, c = F.col("v"), F.col
        cut = F.try_variant_get(v, "$.priceDiscounted", "variant")
        rows = rows.select(
            self.key, "source_index", F.try_variant_get(v, "$", "struct<>").isNotNull().alias("is_object"), id_at(v, "$.id").alias("item_id"), id_at(v, "$.drnId").alias("drn_id"), id_at(v, "$.categoryId").alias("category_id"), text_at(v, "$.name").alias("name"), text_at(v, "$.description").alias("description"),
            *(x.alias(f"_{name}_{part}") for name, path in (("listed", "$.price"), ("cut", "$.priceDiscounted")) for part, x in zip(("number", "code"), money_parts(v, path), strict=True)), (cut.isNotNull() & ~F.is_variant_null(cut)).alias("has_cut"), image_url(text_at(v, "$.image.url")).alias("image_url"),
            flag_at(v, "$.available").alias("available"), flag_at(v, "$.popular").alias("popular"), ids_at(v, "$.modifierGroupIds").alias("modifier_group_ids"),
        )
        # what several columns are made of is taken from the value once
        rows = rows.withColumns({"image_anchor": image_anchor(c("image_url")), **{name: money_of(c(f"_{name}_number"), c(f"_{name}_code")) for name in ("listed", "cut")}})
        rows = rows.drop(*(f"_{name}_{part}" for name in ("listed", "cut") for part in ("number", "code")))
        # a page's items, categories and options stand together: of categories with equal ids the last counts
        known = self.categories.select(self.key, "category_id", F.struct("sort_order", "name").alias("_category"))
        chosen = self.options.where("option_id IS NOT NULL").select(self.key, c("option_id").alias("item_id"), F.lit(True).alias("_option"))
        every = rows.unionByName(known, allowMissingColumns=True).unionByName(chosen, allowMissingColumns=True).repartition(self.key)
        of = lambda x, by: F.max(x).over(Window.partitionBy(self.key, by))
        every = every.withColumn("_category", of("_category", "category_id")).withColumn("_option", of("_option", "item_id")).where("source_index IS NOT NULL")
        rows = every.select("*", c("_category.sort_order").alias("category_index"), c("_category.name").alias("category_name"))
        hidden = c("category_index").isNull() & F.coalesce("_option", F.lit(False))
        problem = F.when(~c("is_object"), "INVALID_ITEM").when(hidden, "HIDDEN_OPTION").when(c("name").isNull(), "MISSING_NAME").when(c("listed").isNull(), "INVALID_PRICE")
        return rows.withColumn("problem", problem).drop("_category", "_option")

    @cached_property
    def items(self) -> DataFrame:
        """Items with a name and a price that are not options of others. A lower discounted price counts, the listed one is then the original."""
        lower = F.coalesce((F.col("cut.currency") == F.col("listed.currency")) & (F.col("cut.amount") < F.col("listed.amount")), F.lit(False))
        place = F.row_number().over(Window.partitionBy(self.key, "category_index").orderBy("source_index")) - 1
        return self._items.where("problem IS NULL").select(
            self.key, "source_index", "item_id", "drn_id", "category_index", "category_id", "category_name", F.when(F.col("category_index").isNotNull(), place).alias("position"), "name", "description",
            F.when(lower, F.col("cut.amount")).otherwise(F.col("listed.amount")).alias("price"), F.when(lower, F.col("listed.amount")).alias("original_price"), F.col("listed.currency").alias("currency"),
            "image_url", "image_anchor", "available", "popular", "modifier_group_ids",
        )

    @cached_property
    def item_modifiers(self) -> DataFrame:
        """Items and the groups that they name, in order; known is false where the page has no such group."""
        named = self.items.select(self.key, "source_index", F.posexplode("modifier_group_ids").alias("at", "group_id"))
        return self._beside(named, self.modifier_groups.select(self.key, "group_id", F.lit(True).alias("known")), "group_id").select(self.key, "source_index", "at", "group_id", F.coalesce("known", F.lit(False)).alias("known"))

    @cached_property
    def stats(self) -> DataFrame:
        """items_seen, items_parsed, items_rejected, hidden_options and modifier_groups of each page with a menu."""
        n = lambda test: F.sum(F.when(test, 1).otherwise(0))
        counted = self._items.groupBy(self.key).agg(F.count("*").alias("items_seen"), n(F.col("problem").isNull()).alias("items_parsed"), n(F.col("problem").isNotNull() & (F.col("problem") != "HIDDEN_OPTION")).alias("items_rejected"), n(F.col("problem") == "HIDDEN_OPTION").alias("hidden_options"))
        groups = self.modifier_groups.groupBy(self.key).agg(F.count("*").alias("modifier_groups"))
        names = ("items_seen", "items_parsed", "items_rejected", "hidden_options", "modifier_groups")
        return self._beside(self._beside(self.pages.where("has_menu").select(self.key), counted), groups).select(self.key, *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names))

    @cached_property
    def warnings(self) -> DataFrame:
        """scope, code, field, at (place in its list) and value (what was referred to) of everything that was odd."""
        def told(rows: DataFrame, what: Column) -> DataFrame:
            return rows.select(self.key, what.alias("w")).where("w IS NOT NULL")

        w, c = _warning, F.col
        code = lambda test, *what: F.when(test, w(*what))
        every = self._beside(self.pages.select(self.key, "has_menu", "lang", "locale"), self._named.select(self.key, "restaurant_id", "name"))
        price = c("has_cut") & ~F.coalesce(c("cut.currency") == c("listed.currency"), F.lit(False))
        # what the warnings need of the items, whose tables are long
        items = written(self._items.select(
            self.key, "source_index", "problem", F.when(c("problem").isNull(), price).alias("odd_cut"), F.when(c("problem").isNull() & c("category_index").isNull(), c("category_id")).alias("unknown"), F.when(c("problem").isNull(), c("modifier_group_ids")).alias("named"),
        ))
        parsed = items.groupBy(self.key).agg(F.count_if(c("problem").isNull()).alias("items_parsed"))
        at = c("source_index")
        of_item = [
            code(c("problem") == "INVALID_ITEM", "item", "INVALID_ITEM", "item", at), code(c("problem") == "MISSING_NAME", "item", "MISSING_NAME", "name", at), code(c("problem") == "INVALID_PRICE", "item", "INVALID_PRICE", "price", at),
            code(c("odd_cut"), "item", "INVALID_DISCOUNT_PRICE", "priceDiscounted", at), code(c("unknown").isNotNull(), "item", "UNKNOWN_CATEGORY", "categoryId", at, c("unknown")),
        ]
        named = items.select(self.key, "source_index", F.explode("named").alias("group_id"))
        missing = named.join(self.modifier_groups.select(self.key, "group_id").hint("merge"), [self.key, "group_id"], "left_anti")
        parts = [
            told(every, code(~c("has_menu"), "page", "NEXT_DATA_UNAVAILABLE", None)),
            told(every, code(c("lang").isin(*HEADER) & (c("lang") != c("locale")), "page", "LOCALE_MISMATCH", "html[lang]", None, c("lang"))),
            told(every, code(c("has_menu") & c("restaurant_id").isNull(), "restaurant", "MISSING_RESTAURANT_ID", "restaurant.id")),
            told(every, code(c("name").isNull(), "restaurant", "MISSING_RESTAURANT_NAME", "name")),
            told(self._beside(self.pages.select(self.key), parsed), code(F.coalesce("items_parsed", F.lit(0)) == 0, "page", "NO_ITEMS", None)),
            told(self._placed, code(c("pin_problem") == "AMBIGUOUS_COORDINATES", "restaurant", "AMBIGUOUS_COORDINATES", "map.pins")),
            told(self._placed, code(c("pin_problem") == "COORDINATES_MATCH_CUSTOMER_LOCATION", "restaurant", "COORDINATES_MATCH_CUSTOMER_LOCATION", "map.pins")),
            told(self._placed.where("n_bad > 0").select(self.key, F.explode(F.sequence(F.lit(1), c("n_bad").cast("int"))).alias("i")), w("restaurant", "INVALID_COORDINATES", "map.pins")),
            told(self._categories, code(c("category_id").isNull() | c("name").isNull(), "category", "INVALID_CATEGORY", F.when(c("category_id").isNull(), "id").otherwise("name"), c("at"))),
            told(self._groups, code(c("group_id").isNull() | c("name").isNull(), "page", "INVALID_MODIFIER_GROUP", "modifierGroups", c("at"))),
            told(self._options(self._groups.where("group_id IS NOT NULL AND name IS NOT NULL")), code(c("name").isNull(), "page", "INVALID_MODIFIER_OPTION", F.concat(F.lit("modifierGroups."), "group_id"), c("position"))),
            told(items.select("*", F.explode(F.array_compact(F.array(*of_item))).alias("_w")), c("_w")),
            told(missing, w("item", "MISSING_MODIFIER_GROUP", "modifierGroupIds", at, c("group_id"))),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.select(self.key, "w.*")
