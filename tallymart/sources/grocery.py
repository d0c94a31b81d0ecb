"""Items of grocery pages, read from the state that the pages embed; and prices before a discount that a page mentions near its product."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.rules import first_rule

STATE = '(?is)<script[^>]*\\bid="__NEXT_DATA__"[^>]*>(.*?)</script>'
ITEM = "id: string, title: string, name: string, slug: string, uid: string, sku: string, description: string, images: array<string>, image: string"
LISTED = f"struct<itemsData: struct<pageCount: double, currentPage: double, items: array<struct<{ITEM}, price: string, originalPrice: string, stockAmount: double, inStock: boolean>>>>"
MENU = (
    "struct<items: array<struct<id: string, name: string, uid: string, description: string, image: struct<url: string>, price: struct<fractional: double>, "
    "priceDiscounted: struct<fractional: double>, stockCount: double, available: boolean>>>"
)


def _text(c) -> Column:
    """Trimmed with white space folded, null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(c, "\\s+", " ")), F.lit(""))


def _state(pages: DataFrame, key: str, html: str, path: str, schema: str) -> DataFrame:
    state = F.get_json_object(F.regexp_extract(html, STATE, 1), path)
    return pages.select(key, F.from_json(state, schema).alias("state"))


def _marked(rows: DataFrame) -> DataFrame:
    problem = F.when(F.col("title").isNull(), "NO_TITLE").when(F.col("price").isNull(), "NO_PRICE")
    return rows.withColumn("problem", problem)


def listed_items(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Items of a page whose state lists them (key, at, id, sku, title, slug, price, original_price, images, stock, current_page, page_count), with
    the `problem` of those without title or price. A page without such a state gives nothing. Stock is a count, else 1 or 0, else null."""
    rows = _state(pages, key, html, "$.props.pageProps.initialState", LISTED)
    page = lambda n: F.when(F.col(f"state.itemsData.{n}") > 0, F.col(f"state.itemsData.{n}").cast("int")).otherwise(1)
    rows = rows.select(key, page("currentPage").alias("current_page"), page("pageCount").alias("page_count"), F.posexplode("state.itemsData.items").alias("at", "i")).where("i IS NOT NULL")
    price = lambda n: F.when(F.col(f"i.{n}").try_cast("double") > 0, F.col(f"i.{n}").try_cast("double"))
    listed = F.filter("i.images", lambda u: u != "")
    one = F.array_compact(F.array(_text("i.image")))
    stock = F.coalesce(F.when(F.col("i.stockAmount") >= 0, F.col("i.stockAmount")), F.col("i.inStock").cast("int").cast("double"))
    return _marked(
        rows.select(
            key, "at", _text("i.id").alias("id"), _text("i.sku").alias("sku"), _text("i.title").alias("title"), _text("i.slug").alias("slug"), price("price").alias("price"), price("originalPrice").alias("original_price"),
            F.when(F.size(listed) > 0, listed).otherwise(one).alias("images"), stock.alias("stock"), "current_page", "page_count",
        )
    )


def menu_items(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Items of a page whose state is a menu, in the columns of `listed_items` but the page numbers. Prices are in minor units; the
    discounted one counts where there is one, the other is the original price."""
    rows = _state(pages, key, html, "$.props.initialState.menuPage.menu.metas.root", MENU).select(key, F.posexplode("state.items").alias("at", "i")).where("i IS NOT NULL")
    major = lambda n: F.when(F.col(f"i.{n}.fractional") >= 0, F.floor(F.col(f"i.{n}.fractional") + 0.5) / 100)
    stock = F.coalesce("i.stockCount", F.col("i.available").cast("int").cast("double"))
    return _marked(
        rows.select(
            key, "at", "i.id", F.col("i.id").alias("sku"), _text("i.name").alias("title"), F.coalesce(_text("i.uid"), "i.id").alias("slug"), F.coalesce(major("priceDiscounted"), major("price")).alias("price"),
            major("price").alias("original_price"), F.array_compact(F.array(_text("i.image.url"))).alias("images"), stock.alias("stock"),
        )
    )


#: Kinds of promotions by the platform's name of them, the first that fits.
PROMOTIONS = [("PERCENT_OFF_ITEMS", "^ItemSpecificPercentOff"), ("PERCENT_OFF_MENU", "^FullMenuPercentOff"), ("FREE_DELIVERY", "^FreeDelivery"), ("BUY_ONE_GET_ONE", "(buyoneget|bogo|multibuy)")]
_MONEY = "struct<fractional: double, currency_code: string>"
_OFFER = f"struct<typeName: string, percentageDiscount: double, minimumOrderValue: {_MONEY}, maxDiscount: {_MONEY}, itemIds: array<string>>"


def menu_promotions(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Promotions of a menu page: the shown one, the listed ones, then the one of the progress bar; the first of those of one rule (kind,
    name, percentage, least order, largest discount). Amounts are in minor units; a zero means that there is no such limit."""
    schema = f"struct<offer: struct<offer: {_OFFER}, offers: array<{_OFFER}>, progressBar: struct<offer: {_OFFER}>>>"
    s = _state(pages, key, html, "$.props.initialState.menuPage.menu.metas.root", schema).select(key, "state.offer.*")
    every = F.array_compact(F.concat(F.array("offer"), F.coalesce("offers", F.array().cast(f"array<{_OFFER}>")), F.array("progressBar.offer")))
    o = s.select(key, F.posexplode(every).alias("at", "o")).where("o.typeName IS NOT NULL")
    amount = lambda n: F.when(F.col(f"o.{n}.fractional") > 0, F.floor(F.col(f"o.{n}.fractional") + 0.5) / 100)
    kind = first_rule(F.col("o.typeName"), PROMOTIONS, "OTHER")
    rules = o.select(key, "at", kind.alias("kind"), F.col("o.typeName").alias("name"), F.col("o.percentageDiscount").alias("percentage"), amount("minimumOrderValue").alias("least_order"), amount("maxDiscount").alias("most_off"), F.col("o.itemIds").alias("items"))
    return rules.groupBy(key, "kind", "name", "percentage", "least_order", "most_off").agg(F.min("at").alias("at"), F.min_by("items", "at").alias("items"))


#: How far a product's own pair of prices may be from a mention of the product, in characters.
REACH = 2500


def original_price(regular: str, final: str, gap: int = 1500):
    """A UDF of (text, price, anchor): the regular price that stands nearest to the product's own final price.

    Values of the keys `regular` and `final` at most `gap` characters apart make a pair; of the pairs whose final price is the given one,
    the nearest to each mention of the anchor counts, or all if the anchor is null. All must agree and exceed the price, else null."""
    number = "([0-9]+(?:\\.[0-9]+)?)"
    found = {k: re.compile(f'(?<![A-Za-z0-9_]){re.escape(k)}\\\\?"?\\s*:\\s*(?:\\{{[^{{}}]{{0,80}}?value\\\\?"?\\s*:\\s*)?{number}') for k in (regular, final)}

    def nearest(values: list[tuple[int, float]], at: int, reach: int):
        return min((v for v in values if abs(v[0] - at) <= reach), key=lambda v: abs(v[0] - at), default=None)

    def one(text, price, anchor) -> float | None:
        if not text or pd.isna(price):
            return None
        all_of = {k: [(m.start(), float(m[1])) for m in p.finditer(text)] for k, p in found.items()}
        own = [f for f in all_of[final] if abs(f[1] - price) < 0.02]
        if anchor:
            own = [f for f in (nearest(own, m.start(), REACH) for m in re.finditer(re.escape(anchor), text)) if f]
        pairs = [p for p in (nearest(all_of[regular], f[0], gap) for f in own) if p]
        prices = {round(p[1], 2) for p in pairs}
        return prices.pop() if len(prices) == 1 and min(prices) > price + 0.009 else None

    @F.pandas_udf("double")
    def prices(text: pd.Series, price: pd.Series, anchor: pd.Series) -> pd.Series:
        return pd.Series([one(*row) for row in zip(text, price, anchor)], dtype="float64").astype(object).where(lambda s: s.notna(), None)

    return prices


def write_bundles(bundles: DataFrame, path: str) -> None:
    """K6: JSON lines, one file a task, without vectors."""
    bundles.drop("embedding").write.json(path)
