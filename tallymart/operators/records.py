"""Records of one product from several readings of its page, and images that moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _blank(column: Column, kind: str) -> Column:
    if kind.startswith("array"):
        return column.isNull() | (F.size(column) == 0)
    return column.isNull() | (column == "") if kind == "string" else column.isNull()


def filled(read: DataFrame, structured: DataFrame, key: str, unset: tuple[str, ...] = ("in_stock",)) -> DataFrame:
    """What a page's reader left empty (null, empty text, no image, a price of zero or less) from the page's structured data.

    A price brings its currency along. Fields in `unset` are taken only where the reader has null. A key without structured
    data keeps its row; `structured` has one row a key."""
    s = structured.select(F.col(key), *[F.col(c).alias(f"_{c}") for c in structured.columns if c != key])
    kinds = dict(read.dtypes)
    no_price = (F.col("price").isNull() | (F.col("price") <= 0)) & F.col("_price").isNotNull()

    def column(c: str) -> Column:
        if c == key or f"_{c}" not in s.columns:
            return F.col(c)
        if c in ("price", "currency"):
            return F.when(no_price, F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
        empty = F.col(c).isNull() if c in unset else _blank(F.col(c), kinds[c])
        return F.when(empty & ~_blank(F.col(f"_{c}"), kinds[c]), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)

    return read.join(s, key, "left").select(*[column(c) for c in read.columns])


def merged(first: DataFrame, second: DataFrame, key: str, images: str = "images") -> DataFrame:
    """Field by field the first reading, else the second; images from one of them alone, and a currency for every price.
    Keys of either side; a null key meets nothing."""
    one, two = first.alias("a"), second.alias("b")
    pick = lambda c: F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}"))
    own = F.when(F.size(f"a.{images}") > 0, F.col(f"a.{images}")).otherwise(F.col(f"b.{images}"))
    price = F.when(pick("price") > 0, pick("price"))
    special = {images: F.coalesce(own, F.array().cast("array<string>")), "price": price, "currency": F.coalesce(pick("currency"), F.when(price.isNotNull(), "AED"))}
    return one.join(two, F.col(f"a.{key}") == F.col(f"b.{key}"), "full").select(*[special.get(c, pick(c)).alias(c) for c in first.columns])


def rehosted(documents: DataFrame, offers: DataFrame, mapping: DataFrame, dropped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Galleries (id, images, n_moved, n_dropped, kept_last) and offers (id, retailer, image, moved) after images moved.

    documents (id, images), offers (id, retailer, image), mapping (url, new) and dropped (url); urls are unique in the last two.
    Moved images take their new address, dropped ones go, unless no image would be left; equal ones stay once, in order. An offer's
    dropped image gives way to the gallery's first, null without one. The sides are joined by address, whatever their size."""
    gone = dropped.select("url", F.lit(True).alias("_gone"))
    urls = documents.select("id", F.posexplode("images").alias("at", "url")).join(mapping, "url", "left")
    urls = urls.select("id", "at", F.coalesce("new", "url").alias("url"), F.col("new").isNotNull().alias("moved")).join(gone, "url", "left")
    image = F.struct("at", "url", "moved", F.coalesce("_gone", F.lit(False)).alias("gone"))
    found = urls.groupBy("id").agg(F.array_sort(F.collect_list(image)).alias("all"))  # a document's own images
    kept = F.filter("all", lambda i: ~i["gone"])
    last = F.size(kept) == 0
    galleries = found.select(
        "id",
        F.array_distinct(F.transform(F.when(last, F.col("all")).otherwise(kept), lambda i: i["url"])).alias("images"),
        F.size(F.filter("all", lambda i: i["moved"])).alias("n_moved"),
        F.when(last, 0).otherwise(F.size("all") - F.size(kept)).alias("n_dropped"),
        last.alias("kept_last"),
    )
    shown = offers.join(mapping.withColumnRenamed("url", "image"), "image", "left").join(gone.withColumnRenamed("url", "image"), "image", "left").join(galleries.select("id", "images"), "id", "left")
    goes = F.col("_gone") & ~F.coalesce(F.array_contains("images", F.col("image")), F.lit(False))
    now = F.when(F.col("new").isNotNull(), F.col("new")).when(goes, F.get("images", F.lit(0))).otherwise(F.col("image"))
    return galleries, shown.select("id", "retailer", now.alias("image"), F.col("new").isNotNull().alias("moved"))
