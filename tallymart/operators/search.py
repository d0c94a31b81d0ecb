"""Lexical search in tiers, keyword indexes, similarity pairs, and vector search with filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_tier(name: Column, tokens: Column, query: str) -> Column:
    """Q4: 1 exact name, 2 all words, 3 some word begins so, null no match."""
    words = query.split()
    whole = [F.array_contains(tokens, w) for w in words]
    begins = lambda w: F.exists(tokens, lambda t: t.startswith(w))
    begun = [begins(w) for w in words]
    every = whole[0]
    some = begun[0]
    for a, b in zip(whole[1:], begun[1:]):
        every, some = every & a, some | b
    return F.when(name == query, 1).when(every, 2).when(some, 3)


def token_pairs(left: DataFrame, right: DataFrame, score, least: float) -> DataFrame:
    """Pairs (id1, id2, score) of rows (id, tokens) that share a token and reach `least` > 0.

    Only tokens up to an exact prefix are joined: a pair with Jaccard of at least `least` shares one of the first
    n - ceil(least * n) + 1 tokens of either side in order of rarity, so frequent tokens seldom open a block."""
    exploded = lambda df, i: df.select(F.col("id").alias(i), F.explode("tokens").alias("t"), F.size("tokens").alias("n"))
    counts = exploded(left, "id").unionByName(exploded(right, "id")).groupBy("t").agg(F.count("*").alias("f"))

    def prefix(df, i):
        w = Window.partitionBy(i).orderBy("f", "t")
        rows = exploded(df, i).join(counts, "t").withColumn("at", F.row_number().over(w))
        return rows.where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * least) + 1).select(i, "t")

    pairs = prefix(left, "id1").join(prefix(right, "id2"), "t").where("id1 < id2").select("id1", "id2").distinct()
    a = left.select(F.col("id").alias("id1"), F.col("tokens").alias("t1"))
    b = right.select(F.col("id").alias("id2"), F.col("tokens").alias("t2"))
    scored = pairs.join(a, "id1").join(b, "id2").select("id1", "id2", score(F.col("t1"), F.col("t2")).alias("score"))
    return scored.where(F.col("score") >= least)


def cosine(a: Column, b: Column) -> Column:
    """Zero where a norm is zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, p: s + p)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms == 0, F.lit(0.0)).otherwise(dot(a, b) / norms)
