"""Scoring a listed item against canonical items: names, category, variant; a shortlist, a margin, and a decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.text import dice

#: Weights of the parts that are present; confidence from which a clear winner is matched, a floor for review, and the margin below which two are ambiguous.
NAME, CATEGORY, DESCRIPTION = 0.5, 0.1, 0.2
MATCH, REVIEW, MARGIN = 0.75, 0.5, 0.1
SHORTLIST = 10


def variants(a: Column, b: Column) -> Column:
    """E14 on sizes: equal or both absent 1, one-sided 0.5, different 0."""
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.5).when(a == b, 1.0).otherwise(0.0)


def _met(items: DataFrame, canon: DataFrame, *more: str) -> DataFrame:
    """Pairs of one group that share any token, each once: at the first token of the item that both have. `more` columns go along as structs a and b."""
    own = F.array_distinct(F.array_compact("tokens"))
    side = lambda df, i, n, s: df.select(F.col("id").alias(i), "grp", own.alias(n), *([F.struct(*more).alias(s)] if more else [])).withColumn("t", F.explode(n))
    met = side(items, "item", "t1", "a").join(side(canon, "canonical", "t2", "b"), ["grp", "t"])
    return met.where(F.get(F.array_intersect("t1", "t2"), F.lit(0)) == F.col("t"))


def candidates(items: DataFrame, canon: DataFrame) -> DataFrame:
    """Pairs of one group that share any token."""
    return _met(items, canon).select("item", "canonical")


def scores(items: DataFrame, canon: DataFrame) -> DataFrame:
    """Item, canonical, confidence to three places, conflict; n of a canonical row goes along."""
    n = [F.col("b.n")] if "n" in canon.columns else []
    j = _met(items if not n else items.withColumn("n", F.lit(1)), canon, "tokens", "category", "size", *(["n"] if n else []))
    variant = variants(F.col("a.size"), F.col("b.size"))
    raw = (NAME * dice(F.col("a.tokens"), F.col("b.tokens")) + CATEGORY * (F.col("a.category") == F.col("b.category")).cast("double") + DESCRIPTION * variant) / (NAME + CATEGORY + DESCRIPTION)
    return j.select("item", "canonical", (F.floor(raw * 1000 + 0.5) / 1000).alias("confidence"), F.when(variant == 0, "SIZE_MISMATCH").alias("conflict"), *n)


ALIKE = ("grp", "tokens", "category", "size")


def matched(items: DataFrame, canon: DataFrame) -> DataFrame:
    """E16-E18 of many items (unique ids): `decide` on `scores`. Rows that agree in all that is compared are one class, on both sides, and
    of an item's candidates only the number and the smallest id at each confidence (of three places) are kept, so no pair is shuffled."""
    a = items.groupBy(*ALIKE).agg(F.min("id").alias("id"))
    b = canon.groupBy(*ALIKE).agg(F.min("id").alias("id"), F.count("*").alias("n"))
    clear, held = F.col("conflict").isNull(), F.col("conflict").isNotNull()
    at = scores(a, b).groupBy("item", "confidence").agg(F.sum("n").alias("n"), F.min(F.when(clear, F.col("canonical"))).alias("clear"), F.min(F.when(held, F.col("canonical"))).alias("held"))
    best = Window.partitionBy("item").orderBy(F.desc_nulls_last("confidence"))
    top = at.withColumn("_n", F.row_number().over(best)).where("_n <= 2")
    per = top.groupBy("item").agg(*[F.max(F.when(F.col("_n") == 1, F.col(c))).alias(c) for c in ("confidence", "n", "clear", "held")], F.max(F.when(F.col("_n") == 2, F.col("confidence"))).alias("next"))
    against = F.col("held").isNotNull() & (F.col("clear").isNull() | (F.col("held") < F.col("clear")))
    first = per.select("item", F.coalesce(F.least("clear", "held"), "clear", "held").alias("canonical"), "confidence", F.when(against, "SIZE_MISMATCH").alias("conflict"), F.when(F.col("n") > 1, F.col("confidence")).otherwise(F.col("next")).alias("next"))
    told = _decided(a.select(F.col("id").alias("item"), *[F.col(c).alias(f"_{c}") for c in ALIKE]).join(first, "item", "left")).drop("item")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ALIKE]
    return items.join(told, same).select(F.col("id").alias("item"), "canonical", "confidence", "status")


def _decided(j: DataFrame) -> DataFrame:
    """Rows with the best candidate's canonical, confidence and conflict and the next one's confidence, with `status`."""
    clear = F.col("next").isNull() | (F.col("confidence") - F.col("next") >= MARGIN)
    return j.withColumn("status", F.when((F.col("confidence") >= MATCH) & F.col("conflict").isNull() & clear, "MATCHED").when(F.col("confidence") >= REVIEW, "REVIEW").otherwise("UNMATCHED"))


def decide(items: DataFrame, scored: DataFrame) -> DataFrame:
    """The best of a shortlist is matched if it is good, free of conflicts and ahead by the margin; else it is for review or unmatched."""
    order = Window.partitionBy("item").orderBy(F.desc("confidence"), "canonical")
    top = scored.withColumn("at", F.row_number().over(order)).where(F.col("at") <= SHORTLIST)
    first = top.where("at = 1").select("item", "canonical", "confidence", "conflict")
    second = top.where("at = 2").select("item", F.col("confidence").alias("next"))
    j = items.select(F.col("id").alias("item")).join(first, "item", "left").join(second, "item", "left")
    return _decided(j).select("item", "canonical", "confidence", "status")
