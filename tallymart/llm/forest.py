"""Approximate nearest neighbours: a forest of random-projection trees, one shared priority queue, exact reranking.

Every tree splits by one random direction per level at the median of the rows in a node, until a leaf holds about LEAF rows,
so depth grows with the table (up to MAX_DEPTH, from where leaves grow). Medians of the upper levels come from one bounded
sample; where that grows thin, samples inside each leaf so far place the splits below it, fitted by Spark tasks. All rows are
indexed: a row's leaf in each tree. A query walks all trees from one priority queue, ordered by the sum of its squared
distances to the splits it has crossed, and visits as many leaves as the forest is tuned to: PROBES stated rows are compared
with all rows, in blocks, and the forest takes the number of trees (at least two) and of leaves at which they find
RECALL of their true neighbours while visiting the fewest rows. On clustered vectors these are few leaves; on noise the
method can but visit much of the table. The candidates are all rows of the leaves visited; their cosines are computed in
double precision on the original vectors, block against block.

Equal vectors are one point with its smallest ids, as many as a result can show, so groups of copies stay small; equal
query vectors are searched once. Vectors that are null, zero, of another length than most, or that hold null or non-finite
components take no part, nor do rows with a null id. Of rows with one id each vector counts. Cosines are of vectors scaled
by their largest component, so that very small and very large ones have norms too. An empty table yields no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.common import shared_dir, written

K, TREES, LEAF, MAX_DEPTH = 5, 8, 256, 16
#: Sample that places the upper splits, and the rows of it that a node needs for another split.
SAMPLE, SPLIT_ROWS = 20_000, 20
#: Rows that tune the forest, and the share of their true neighbours that it must find.
PROBES, RECALL = 100, 0.95
#: Points, and queries, of a leaf that one task multiplies; larger leaves are split by salt.
BLOCK = 20_000


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; none of them is zero."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _split(p: np.ndarray, node: np.ndarray, nodes: int) -> np.ndarray:
    """Median of the projections in each node, 0 where it is empty."""
    order = np.lexsort((p, node))
    ends = np.searchsorted(node[order], np.arange(nodes + 1))
    middle = (ends[:-1] + ends[1:]) // 2
    return np.where(ends[:-1] < ends[1:], p[order][np.minimum(middle, len(p) - 1)], 0.0) if len(p) else np.zeros(nodes)


class Forest:
    """directions[t, level]; thresholds[level][t, node] splits the node of that level."""

    def __init__(self, dim: int, trees: int = TREES, seed: int = 7):
        self.trees, self.depth = trees, 0
        self.directions = np.random.default_rng(seed).standard_normal((trees, MAX_DEPTH, dim))
        self.thresholds: list[np.ndarray] = []

    def grow(self, rows: np.ndarray, depth: int) -> None:
        """Splits down to `depth` at the medians of these unit vectors."""
        node = self.leaves(rows)
        for level in range(self.depth, depth):
            cuts = np.zeros((self.trees, 1 << level))
            for t in range(self.trees):
                p = rows @ self.directions[t, level]
                cuts[t] = _split(p, node[:, t], 1 << level)
                node[:, t] = 2 * node[:, t] + (p >= cuts[t][node[:, t]])
            self.thresholds.append(cuts)
        self.depth = max(depth, self.depth)

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of each row in each tree."""
        out = np.zeros((len(rows), self.trees), dtype=np.int64)
        for t in range(self.trees):
            for level in range(self.depth):
                out[:, t] = 2 * out[:, t] + (rows @ self.directions[t, level] >= self.thresholds[level][t][out[:, t]])
        return out

    def walk(self, q: np.ndarray, trees: int) -> Iterator[tuple[int, int]]:
        """(tree, leaf) pairs of the first `trees` trees, in order of one queue over all of them."""
        p = np.einsum("tld,d->tl", self.directions[:trees, : self.depth], q)
        queue = [(0.0, t, 0, 0) for t in range(trees)]
        while queue:
            far, t, level, node = heapq.heappop(queue)
            while level < self.depth:
                gap = p[t, level] - self.thresholds[level][t][node]
                heapq.heappush(queue, (far + gap * gap, t, level + 1, 2 * node + int(gap < 0)))
                node, level = 2 * node + int(gap >= 0), level + 1
            yield t, node

    def needed(self, q: np.ndarray, targets: np.ndarray, trees: int) -> list[int]:
        """For each row of target leaves, how many leaves the walk has visited when it first meets one of them."""
        at = np.zeros(len(targets), dtype=np.int64)
        for n, (t, leaf) in enumerate(self.walk(q, trees), 1):
            at[(at == 0) & (targets[:, t] == leaf)] = n
            if at.all():
                break
        return at.tolist()


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 1))


def usable(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """id and v (doubles) of the rows that take part, and the length of their vectors."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & fine)
    most = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    dim = most[0]["dim"] if most else 0
    return rows.where(F.size("v") == dim), dim


def _placed(held):
    """Rows once for each tree, with the leaf so far."""

    def rows(batches):
        for b in batches:
            x = _matrix(b.column("v"))
            if len(x):
                at = held.value.leaves(unit(x))
                for t in range(at.shape[1]):
                    yield pa.RecordBatch.from_arrays([pa.array([t] * len(x), pa.int32()), pa.array(at[:, t]), b.column("v")], ["t", "cell", "v"])

    return rows


def _below(begin: int, end: int, directions: np.ndarray):
    """The splits of levels begin to end below one leaf, level after level, from its sampled rows."""

    def splits(key, rows):
        t, cell = key[0].as_py(), key[1].as_py()
        x = unit(_matrix(rows.column("v")))
        node, cuts = np.zeros(len(x), dtype=np.int64), []
        for level in range(begin, end):
            p = x @ directions[t, level]
            cuts.append(_split(p, node, 1 << (level - begin)))
            node = 2 * node + (p >= cuts[-1][node])
        return pa.table({"t": pa.array([t], pa.int32()), "cell": pa.array([cell], pa.int64()), "cuts": pa.array([np.concatenate(cuts).tolist()], pa.list_(pa.float64()))})

    return splits


def fit(points: DataFrame, n: int, dim: int, sample: int = SAMPLE, trees: int = TREES, leaf: int = LEAF) -> Forest:
    """points: v. A forest whose leaves hold about `leaf` of the n rows."""
    spark = points.sparkSession
    forest = Forest(dim, trees)
    depth = min(MAX_DEPTH, max(0, int(math.log2(max(1.0, n / leaf)))))
    taken = points.orderBy(F.xxhash64("v")).limit(sample).select("v").toArrow()
    upper = min(depth, max(0, int(math.log2(max(1.0, taken.num_rows / SPLIT_ROWS)))))
    forest.grow(unit(_matrix(taken.column("v"))), upper)
    while forest.depth < depth:
        # more levels: in each leaf so far, of each tree, about `sample` / 8 rows place the splits of its next levels
        begin, want = forest.depth, max(SPLIT_ROWS * 2, sample // 8)
        end = min(depth, begin + max(1, int(math.log2(want / SPLIT_ROWS))))
        share = min(1.0, want * (1 << begin) / n)
        placed, below = _placed(spark.sparkContext.broadcast(forest)), _below(begin, end, forest.directions)
        some = points.where(F.pmod(F.xxhash64("v", F.lit(1)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("v")
        made = some.mapInArrow(placed, "t int, cell long, v array<double>").groupBy("t", "cell").applyInArrow(below, "t int, cell long, cuts array<double>").collect()
        grown = [np.zeros((trees, 1 << level)) for level in range(begin, end)]
        for r in made:
            cuts, at = np.array(r["cuts"]), 0
            for level in range(begin, end):
                width = 1 << (level - begin)
                grown[level - begin][r["t"], r["cell"] * width : (r["cell"] + 1) * width] = cuts[at : at + width]
                at += width
        forest.thresholds += grown
        forest.depth = end
    return forest


def _top(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of the k largest of each row, ties with the last of them included."""
    m = min(k, scores.shape[1])
    cut = np.partition(scores, scores.shape[1] - m, axis=1)[:, scores.shape[1] - m]
    return np.nonzero(scores >= cut[:, None] - 1e-12)


def tuned(points: DataFrame, forest: Forest, n: int, k: int = K, probes: int = PROBES, recall: float = RECALL) -> tuple[int, int]:
    """Trees, and leaves to visit, at which the probes find `recall` of their k nearest points while they visit the fewest rows."""
    if not forest.depth:
        return 1, 1
    spark = points.sparkSession
    asked = unit(_matrix(points.orderBy(F.xxhash64("v", F.lit(2))).limit(probes).select("v").toArrow().column("v")))

    def nearest_of(batches):
        for b in batches:
            x = _matrix(b.column("v"))
            if len(x):
                x = unit(x)
                s = asked @ x.T
                s[s > 1 - 1e-12] = -2.0  # the probe itself
                i, j = _top(s, k)
                at = forest.leaves(x[j])
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(s[i, j]), pa.array(at.tolist(), pa.list_(pa.int64()))], ["q", "s", "leaves"])

    best = Window.partitionBy("q").orderBy(F.desc("s"), "leaves")
    found = points.select("v").mapInArrow(nearest_of, "q long, s double, leaves array<long>").withColumn("at", F.row_number().over(best)).where(F.col("at") <= k)
    targets: dict[int, list] = {}
    for r in found.collect():  # k rows for each probe
        targets.setdefault(r["q"], []).append(r["leaves"])
    options = []
    for trees in sorted({min(2, forest.trees), min(4, forest.trees), forest.trees}):
        visits = np.sort([v for q, t in targets.items() for v in forest.needed(asked[q], np.array(t), trees)])
        leaves = int(visits[min(len(visits) - 1, math.ceil(recall * len(visits)))]) if len(visits) else 1
        options.append((leaves, trees))
    leaves, trees = min(options)
    return trees, leaves


def nearest(df: DataFrame, is_query: Callable[[Column], Column], k: int = K, key: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is_query picks; candidates are all rows but the query's own."""
    spark, folder = df.sparkSession, shared_dir(df.sparkSession)
    rows, dim = usable(df, key, vector)
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # the smallest ids of each vector: a limit inside a window is applied before the shuffle too
    order = Window.partitionBy("v").orderBy("id")
    few = rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    points = written(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), f"{folder}/points")
    n = points.count()
    wanted = rows.where(is_query(F.col("id")))
    asked = written(wanted.groupBy("v").agg(F.min("id").alias("q")), f"{folder}/queries")
    forest = fit(points, n, dim, sample, TREES, leaf)
    trees, visits = tuned(points, forest, n, k)
    held = spark.sparkContext.broadcast(forest)  # at most TREES times 2**MAX_DEPTH numbers
    leaves = 1 << forest.depth
    salts = max(1, math.ceil(n / leaves / BLOCK))

    def places(batches):
        for b in batches:
            x = _matrix(b.column("v"))
            if len(x):
                at = held.value.leaves(unit(x))[:, :trees] + np.arange(trees) * leaves
                yield pa.RecordBatch.from_arrays([b.column("v"), b.column("ids"), pa.array(at.tolist(), pa.list_(pa.int64()))], ["v", "ids", "cells"])

    def walks(visits: int):
        def rows(batches):
            for b in batches:
                x = _matrix(b.column("v"))
                if len(x):
                    found = [[t * leaves + f for (t, f), _ in zip(held.value.walk(u, trees), range(visits))] for u in unit(x)]
                    yield pa.RecordBatch.from_arrays([b.column("q"), b.column("v"), pa.array(found, pa.list_(pa.int64()))], ["q", "v", "cells"])

        return rows

    def product(left: pa.Table, right: pa.Table) -> pa.Table:
        x, y = _matrix(left.column("v")), _matrix(right.column("v"))
        q, ids = left.column("q").to_pylist(), right.column("ids").to_pylist()
        out = []
        if len(x) and len(y):
            x, y = unit(x), unit(y)
            for at in range(0, len(x), 256):
                # rows that tie with the last stay, so that equal scores are settled by id
                for i, j in zip(*_top(x[at : at + 256] @ y.T, k + 5)):
                    score = float((x[at + i] * y[j]).sum())
                    out += [(q[at + i], c, score) for c in ids[j]]
        cols = list(zip(*out)) if out else [[], [], []]
        return pa.table({"q": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    salt = F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int")
    cells = points.mapInArrow(places, "v array<double>, ids array<long>, cells array<long>").select("v", "ids", F.explode("cells").alias("cell"), salt.alias("s"))

    def search(asked: DataFrame, visits: int, name: str) -> DataFrame:
        """v, vec_id and score of the nearest that the leaves visited first hold."""
        salts_q = max(1, math.ceil(asked.count() * visits / (trees * leaves) / BLOCK))
        index = cells.select("v", "ids", "cell", "s", F.explode(F.sequence(F.lit(0), F.lit(salts_q - 1))).alias("sq"))
        visited = asked.mapInArrow(walks(visits), "q long, v array<double>, cells array<long>").select("q", "v", F.explode("cells").alias("cell"))
        visited = visited.select("q", "v", "cell", F.pmod(F.xxhash64("q"), F.lit(salts_q)).cast("int").alias("sq"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("s"))
        by = ("cell", "s", "sq")
        scored = visited.groupBy(*by).cogroup(index.groupBy(*by)).applyInArrow(product, "q long, vec_id long, score double")
        best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        once = scored.groupBy("q", "vec_id").agg(F.max("score").alias("score"))
        top = once.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1)
        return written(top.join(asked, "q").select("q", "v", "vec_id", "score"), f"{folder}/{name}")

    top = search(asked, visits, "top")
    most = min(k + 1, points.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0])
    while visits < trees * leaves:  # leaves can be empty: who found too few goes on
        found = top.groupBy("q").agg(F.count("*").alias("n"))
        short = asked.join(found, "q", "left").where(F.coalesce("n", F.lit(0)) < most).select("q", "v")
        if not short.limit(1).count():
            break
        visits = min(trees * leaves, visits * 4)
        again = written(short, f"{folder}/queries-{visits}")
        top = top.join(again.select("q"), "q", "left_anti").unionByName(search(again, visits, f"top-{visits}"))
    top = top.drop("q")
    each = wanted.select(F.col("id").alias("query_id"), "v").join(top, "v").where("vec_id != query_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.select("query_id", F.row_number().over(final).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def query(embeddings: DataFrame) -> DataFrame:
    return nearest(embeddings, lambda i: i % 50 == 0)
