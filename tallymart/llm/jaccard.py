"""Jaccard join on word n-grams by a blocked sparse product of the document by n-gram incidence matrix.

1. Each text becomes a row of the incidence matrix: the sorted 64-bit hashes of its distinct shingles. Rows are written
   once. Equal rows fall into one class, found by grouping on a 128-bit fingerprint; one row of each class goes on, the
   class's node. Classes that share a doc_id are linked, as rows of one doc_id are one document.
2. Two linked rows of sizes a <= b share at least PERCENT % of b's columns, so they share one of the first
   b - ceil(PERCENT % of b) + 1 columns of either, in any order of the columns that is the same for all rows: the
   size-derived bound that discards all other pairs. Columns go in order of how often they occur, by a histogram of hashed
   columns of fixed size, so columns that many documents share are hardly ever among the first.
3. Of each column and range of sizes one row is the pivot. A row first meets the pivot that most of its columns have, then,
   where a column's rows still lie in several components, that column's pivot. Pairs whose sizes, or whose numbers of
   columns by bucket, differ by more than linked rows can are discarded; the overlap counts of the others come from
   sparse products over batches of pairs.
4. Links give components. Where a column's rows still lie in several, the other pairs between components are met too. In a
   column of few rows they are listed. In a larger one rows are written as differences from the pivot: two rows that link
   share an element of them, by the same bound on the differences (the few pairs so close to the pivot that they need not
   are listed apart). These groups are met by pivots again; only what is then still apart is counted pair by pair, and of
   these pairs only those that places of the shared element, sizes and parities of the differences allow. So no link
   between components is lost, while pairs inside one component are never listed.

A large group of copies costs one class. A hot column is aggregated before it is shuffled and its join is split by the
adaptive planner. Documents without words (null, empty or blank text) have the empty set and link with nothing. A row with
a null doc_id links like any other and takes the component of its class; null if no member of the component has an id.
Repeated rows each get the component of their doc_id. Columns of df other than key and text play no part. An empty table
yields no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.common import drop, shared_dir, small_batches, text_steps, written

SHINGLE, PERCENT = 3, 90
#: Ids that may be broadcast to pick out rows (8 MB as numbers); more are joined by shuffle.
BROADCAST_IDS = 500_000
#: Cells of the histogram that orders columns (4 MB), dealt out in slices; it need only tell frequent ones from rare ones.
CELLS, SLICES = 1 << 22, 64
#: Rows of a column, besides its pivot, whose pairs are listed: at most so many for each row; larger groups go by differences.
LISTED = 8
#: 64-bit words of a difference's parities, which tell most pairs that differ too much before they are made.
PARITIES = [f"p{i}" for i in range(4)]
_P = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5), np.uint64(0x85EBCA77C2B2AE63)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingle_rows(texts: list[str], k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct shingles; of all its words as one, if there are fewer than k."""
    split = [t.encode().lower().split() for t in texts]
    codes: dict[bytes, int] = {}
    for ws in split:
        for w in ws:
            if w not in codes:
                codes[w] = xxhash.xxh3_64_intdigest(w)
    out = []
    for ws in split:
        h = np.fromiter(map(codes.__getitem__, ws), dtype=np.uint64, count=len(ws))
        n = len(h)
        m = min(k, n)
        if not n:
            out.append(h)
            continue
        s = np.zeros(n - m + 1, dtype=np.uint64)
        for i in range(m):
            s = s * _P[4] + _mix(h[i : n - m + 1 + i] + _P[i % 4])
        s = np.sort(_mix(s + np.uint64(m)))
        out.append(s[np.r_[True, s[1:] != s[:-1]]])
    return out


def bound(size, percent: int = PERCENT):
    """Columns in which two linked rows can differ at most, the smaller of which has `size`."""
    return size * (100 - percent) // percent


def first_columns(row: np.ndarray, cells: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The columns of which any linked row shares one: the rarest, one more than a linked row can lack."""
    n = len(row) - -(-percent * len(row) // 100) + 1 if len(row) else 0
    if n >= len(row):
        return row
    often = cells[(row % np.uint64(CELLS)).astype(np.int64)]
    if n < len(row) // 2:  # a row of its own rank apart: ties by the column itself
        least = np.partition(often, n - 1)[n - 1]
        some = np.flatnonzero(often <= least)
        row, often = row[some], often[some]
    return row[np.lexsort((row, often))[:n]]


def ranges_of(size: int, percent: int = PERCENT) -> list[int]:
    """Ranges of sizes, each half as wide again as the one below, in which a row meets others: its own, and those below where linked rows can be (one at most from 67 % on)."""
    if bound(size, percent) == 0 and bound(size - 1, percent) == 0:
        return []  # links with equal rows alone
    at, top = 0, 1
    tops = []
    while top < size:
        tops.append(top)
        at, top = at + 1, top * 3 // 2 + 1
    return [at] + [r for r in range(at - 1, -1, -1) if size * percent <= 100 * tops[r]]


def products(pairs: list[tuple[int, int]], rows: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of the pairs (i, j) of a block of incidence rows: for each i one sparse row times the rows of all its j."""
    columns, flat = np.unique(np.concatenate(rows) if rows else np.zeros(0, np.uint64), return_inverse=True)
    ends = np.cumsum([len(r) for r in rows])
    col = [flat[e - len(r) : e] for e, r in zip(ends, rows)]
    count = np.zeros(len(pairs), dtype=np.int64)
    by_row: dict[int, list[int]] = {}
    for k, (i, _) in enumerate(pairs):
        by_row.setdefault(i, []).append(k)
    dense = np.zeros(len(columns), dtype=np.int32)
    for i, ks in by_row.items():
        dense[col[i]] = 1
        parts = [col[pairs[k][1]] for k in ks]
        lengths = np.array([len(p) for p in parts])
        acc = np.concatenate([[0], np.cumsum(dense[np.concatenate(parts)])])
        stops = np.cumsum(lengths)
        count[ks] = acc[stops] - acc[stops - lengths]
        dense[col[i]] = 0
    return count


def _block(left, right) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
    """Pairs of places and the distinct rows at them, of two columns of packed rows."""
    index: dict[bytes, int] = {}
    held: list[np.ndarray] = []

    def at(raw: bytes) -> int:
        if raw not in index:
            index[raw] = len(held)
            held.append(np.frombuffer(raw, dtype=np.uint64))
        return index[raw]

    return [(at(a), at(b)) for a, b in zip(left.to_pylist(), right.to_pylist())], held


def sketch(row: np.ndarray) -> bytes:
    """Numbers of columns by bucket, about eight to a bucket, at most 255."""
    buckets = 1 << max(3, len(row).bit_length() - 3)
    return np.minimum(np.bincount(((row >> np.uint64(40)) & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets), 255).astype(np.uint8).tobytes()


def apart(a: bytes, b: bytes) -> int:
    """A lower bound, from their sketches, of the number of columns in which two rows differ."""
    x, y = (np.frombuffer(s, np.uint8).astype(np.int64) for s in sorted((a, b), key=len))
    if len(y) > len(x):  # buckets of the finer one fall together
        y = np.minimum(y.reshape(-1, len(x)).sum(axis=0), 255)
    return int(np.abs(x - y).sum())


def _may_link(percent: int):
    def rows(batches):
        for b in batches:
            room = bound(np.minimum(b.column("na").to_numpy(), b.column("nb").to_numpy()), percent).tolist()
            good = [i for i, (x, y, r) in enumerate(zip(b.column("ka").to_pylist(), b.column("kb").to_pylist(), room)) if apart(x, y) <= r]
            yield pa.RecordBatch.from_arrays([b.column(c).take(pa.array(good, pa.int64())) for c in ("a", "b")], ["a", "b"])

    return rows


def _products(percent: int):
    """Pairs with both rows to those that link."""

    def rows(batches):
        for b in batches:
            pairs, held = _block(b.column("sa"), b.column("sb"))
            both = products(pairs, held) if pairs else np.zeros(0, np.int64)
            good = [m for m, (n, (i, j)) in enumerate(zip(both.tolist(), pairs)) if n and 100 * n >= percent * (len(held[i]) + len(held[j]) - n)]
            yield pa.RecordBatch.from_arrays([b.column(c).take(pa.array(good, pa.int64())) for c in ("a", "b")], ["a", "b"])

    return rows


def parities(diff: np.ndarray) -> np.ndarray:
    """Of the elements by bucket whether they are odd in number. Two differences have at least as many elements apart as their parities have bits."""
    bits = np.bincount((diff & np.uint64(64 * len(PARITIES) - 1)).astype(np.int64), minlength=64 * len(PARITIES)) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _differences(batches):
    """The columns in which a row and its pivot's row differ, and their parities."""
    for b in batches:
        diffs = [np.setxor1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True) for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist())]
        odd = np.array([parities(d) for d in diffs], dtype=np.int64).reshape(-1, len(PARITIES)).T
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), b.column("n"), pa.array([len(d) for d in diffs], pa.int64()), pa.array([d.tobytes() for d in diffs], pa.binary()), *(pa.array(x, pa.int64()) for x in odd)], ["a", "b", "n", "far", "diff", *PARITIES])


def may_be_near(element: bool) -> Column:
    """Whether two members of a pivot's group, the second's columns marked by a 2, can differ in as few columns as linked rows do.

    At the first element that both have, those before it are in one difference alone, and of those after it at least as many as
    one side has more."""
    c, room = F.col, F.least("room", "room2")
    near = sum((F.bit_count(c(p).bitwiseXOR(c(f"{p}2"))) for p in PARITIES), F.lit(0)) <= room
    if element:
        near = near & (c("at") + c("at2") + F.abs((c("far") - c("at")) - (c("far2") - c("at2"))) <= room)
    return near


def _difference_products(percent: int):
    """Pairs with their differences from one pivot: columns in which the two rows differ are those in one difference alone."""

    def rows(batches):
        for b in batches:
            pairs, held = _block(b.column("da"), b.column("db"))
            shared = products(pairs, held) if pairs else np.zeros(0, np.int64)
            size = np.array([len(h) for h in held] or [0])
            apart = np.array([size[i] + size[j] for i, j in pairs], dtype=np.int64) - 2 * shared
            total = b.column("na").to_numpy() + b.column("nb").to_numpy()
            both, union = total - apart, total + apart  # twice the sizes of the intersection and the union
            good = np.flatnonzero((100 * both >= percent * union) & (both > 0))
            yield pa.RecordBatch.from_arrays([b.column("a").take(pa.array(good)), b.column("b").take(pa.array(good))], ["a", "b"])

    return rows


def _histogram(batches):
    import zstandard

    cells = np.zeros(CELLS, dtype=np.uint32)
    for b in batches:
        flat = np.frombuffer(b"".join(b.column("s").to_pylist()), dtype=np.uint64)
        at, n = np.unique((flat % np.uint64(CELLS)).astype(np.uint32), return_counts=True)
        cells[at] += n.astype(np.uint32)
    if cells.any():
        small = cells.astype(np.uint8) if cells.max() < 256 else cells
        raw = [zstandard.ZstdCompressor(level=1).compress(x.tobytes()) for x in np.split(small, SLICES)]
        yield pa.RecordBatch.from_pydict({"slice": pa.array(range(SLICES), pa.int32()), "width": pa.array([small.itemsize] * SLICES, pa.int32()), "cells": pa.array(raw, pa.binary())})


def _slice_sum(key, rows):
    import zstandard

    total = np.zeros(CELLS // SLICES, dtype=np.int64)
    for raw, width in zip(rows.column("cells").to_pylist(), rows.column("width").to_pylist()):
        total += np.frombuffer(zstandard.ZstdDecompressor().decompress(raw, max_output_size=width * len(total)), dtype=f"<u{width}").astype(np.int64)
    steps = np.minimum(255, np.log2(total + 1) * 8).astype(np.uint8)
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "steps": pa.array([steps.tobytes()], pa.binary())})


def histogram(rows: DataFrame, column: str) -> np.ndarray:
    """How often the columns of each cell occur in packed rows, in steps of an eighth of a doubling: CELLS bytes, whatever the size of the table."""
    counts = rows.select(F.col(column).alias("s")).mapInArrow(_histogram, "slice int, width int, cells binary")
    cells = np.zeros((SLICES, CELLS // SLICES), dtype=np.uint8)
    for r in counts.groupBy("slice").applyInArrow(_slice_sum, "slice int, steps binary").collect():
        cells[r["slice"]] = np.frombuffer(r["steps"], np.uint8)
    return cells.ravel()


def components(links: DataFrame, folder: str) -> DataFrame:
    """id, label: the smallest id reachable, for every id in links (a, b). Labels spread to neighbours, then jump to their label's label."""
    spark = links.sparkSession
    edges = written(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), f"{folder}/edges")
    labels = written(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label")), f"{folder}/labels-0")
    step = 0
    while True:
        step += 1
        around = edges.join(labels, edges["b"] == labels["id"]).groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        spread = labels.join(around, "id").select("id", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        spread = written(spread, f"{folder}/spread-{step}")
        target = spread.select(F.col("id").alias("label"), F.col("label").alias("next"))
        jumped = written(spread.join(target, "label").select("id", "was", F.least("label", "next").alias("label")), f"{folder}/labels-{step}")
        drop(spark, f"{folder}/spread-{step}")
        drop(spark, f"{folder}/labels-{step - 1}")
        labels = jumped.select("id", "label")
        if not jumped.where(F.col("label") != F.col("was")).limit(1).count():
            return labels


class _Work:
    """One run of the join: its rows (doc_id, h: hash of the text, n, cls, row) and for each class its component."""

    def __init__(self, df: DataFrame, key: str, text: str, k: int, percent: int, by_id: bool):
        self.spark, self.folder, self.percent = df.sparkSession, shared_dir(df.sparkSession), percent
        docs = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))

        def incidence(batches):
            for ids, hs, texts in text_steps(batches, "doc_id", "h"):
                with np.errstate(over="ignore"):
                    sets = [s.tobytes() for s in shingle_rows(texts, k)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(ids, pa.int64()),
                        "h": pa.array(hs, pa.int64()),
                        "n": pa.array([len(s) // 8 for s in sets], pa.int64()),
                        "cls": pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()),
                        "s": pa.array(sets, pa.binary()),
                    }
                )

        rows = docs.mapInArrow(incidence, "doc_id long, h long, n long, cls binary, s binary").withColumn("row", F.monotonically_increasing_id())
        # tasks keep whole rows of several documents at once, so they take them in small batches
        with small_batches(self.spark, "6m"):
            self.work(rows, by_id)

    def work(self, rows: DataFrame, by_id: bool) -> None:
        self.rows = self.put(rows, "rows")
        classes = self.rows.where("n > 0").groupBy("cls").agg(F.min("row").alias("node"))
        self.classes = self.put(classes, "classes")
        members, links = self.stars()
        if by_id:
            links = links.union(self.put(self.ties(), "ties"))
        self.components = self.named(self.settled(members, links))

    def put(self, df: DataFrame, name: str) -> DataFrame:
        return written(df, f"{self.folder}/{name}")

    def few(self, ids: DataFrame) -> DataFrame:
        """A written table of ids, to be broadcast if it is small."""
        return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    def drop(self, *names: str) -> None:
        for name in names:
            drop(self.spark, f"{self.folder}/{name}")

    def ties(self) -> DataFrame:
        """Classes that share an id: each of its classes with the first of them."""
        of_class = self.rows.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "cls").join(self.few(self.classes), "cls").select("doc_id", "node")
        shared = of_class.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z").select("doc_id", "a")
        return of_class.join(shared, "doc_id").where("a < node").select("a", F.col("node").alias("b")).distinct()

    def stars(self) -> tuple[DataFrame, DataFrame]:
        """Columns that rows share, with their pivots (column, range, a, na, b, n; no row for the pivot itself), and the links (a, b) of rows with pivots."""
        percent = self.percent
        nodes = self.rows.join(self.few(self.classes.select(F.col("node").alias("row"))), "row", "left_semi").select(F.col("row").alias("node"), "n", "s")
        cells = self.spark.sparkContext.broadcast(histogram(nodes, "s"))

        def first(batches):
            for b in batches:
                sets = [np.frombuffer(s, np.uint64) for s in b.column("s").to_pylist()]
                held = [first_columns(s, cells.value, percent).view(np.int64) for s in sets]
                ranges = [ranges_of(n, percent) for n in b.column("n").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("node"), b.column("n"), pa.array(ranges, pa.list_(pa.int32())), pa.array(held, pa.list_(pa.int64())), pa.array([sketch(s) for s in sets], pa.binary())], ["node", "n", "ranges", "columns", "sketch"])

        heads = self.put(nodes.mapInArrow(first, "node long, n long, ranges array<int>, columns array<long>, sketch binary").where(F.size("ranges") > 0), "first")
        self.sketches = heads.select("node", "n", "sketch")
        column = heads.select("node", "n", "columns", F.explode("ranges").alias("range")).select("node", "n", "range", F.explode("columns").alias("column"))
        # the pivot of a column is its longest row, ties by a hash, so that a group's columns choose alike
        order = F.col("n") + F.pmod(F.xxhash64("node"), F.lit(1 << 20)) / (1 << 20)
        pivots = column.groupBy("column", "range").agg(F.max_by("node", order).alias("a"), F.max("n").alias("na"), F.count("*").alias("members")).where("members > 1")
        pivots = self.put(pivots.drop("members"), "pivots")
        # joined by shuffle at every size; a hot column is split by the planner
        members = column.join(pivots.hint("merge"), ["column", "range"]).where("node <> a").select("column", "range", "a", "na", F.col("node").alias("b"), "n")
        members = self.put(members, "members")
        self.drop("pivots")
        # a row meets first the pivot that most of its columns have
        fits = members.where(F.col("n") * 100 >= F.col("na") * percent)
        often = fits.groupBy("b", "a").agg(F.count("*").alias("times"))
        star = self.put(often.groupBy("b").agg(F.max_by("a", F.struct("times", "a")).alias("a")).select("a", "b"), "star")
        links = self.linked(star, "star")
        wide = self.spanning(members, components(links, f"{self.folder}/star-components"), "wide")
        pairs = self.put(fits.join(self.few(wide), ["column", "range"]).select("a", "b").distinct(), "pairs")
        return members, links.union(self.linked(pairs.join(self.few(star), ["a", "b"], "left_anti"), "new"))

    def linked(self, pairs: DataFrame, name: str) -> DataFrame:
        """Those of the pairs (a, b) that link. Sketches go around first; of what may link, each row goes once to each partner."""
        one = self.sketches.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka"))
        two = self.sketches.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb"))
        sized = pairs.join(one, "a").join(two, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent)
        may = self.put(sized.select("a", "b", "na", "nb", "ka", "kb").mapInArrow(_may_link(self.percent), "a long, b long"), f"{name}-may")
        return self.put(self.with_rows(may, name).select("a", "b", "sa", "sb").mapInArrow(_products(self.percent), "a long, b long"), f"{name}-links")

    def with_rows(self, pairs: DataFrame, name: str) -> DataFrame:
        """Pairs (a, b, ...), a written table, with their rows sa and sb, and n, the columns of b."""
        side = self.rows.select(F.col("row").alias("b"), "n", F.col("s").alias("sb")).join(self.few(pairs), "b")
        centers = self.put(pairs.select(F.col("a").alias("row")).distinct(), f"{name}-centers")
        center = self.rows.join(self.few(centers), "row", "left_semi").select(F.col("row").alias("a"), F.col("s").alias("sa"))
        return side.join(center, "a")

    def label_of(self, rows: DataFrame, key: str, name: str, labels: DataFrame) -> DataFrame:
        found = rows.join(self.few(labels).select(F.col("id").alias(key), F.col("label").alias("_label")), key, "left")
        return found.withColumn(name, F.coalesce("_label", key)).drop("_label")

    def spanning(self, members: DataFrame, labels: DataFrame, name: str) -> DataFrame:
        """Columns whose rows lie in several components, and how many rows they have besides their pivots."""
        ends = self.label_of(self.label_of(members, "a", "of_a", labels), "b", "label", labels)
        wide = ends.groupBy("column", "range").agg(F.min(F.least("label", "of_a")).alias("x"), F.max(F.greatest("label", "of_a")).alias("y"), F.count("*").alias("others"))
        return self.put(wide.where("x < y").select("column", "range", "others"), name)

    def counted(self, diffs: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
        """Links among pairs (a: pivot, x, y) of rows of one group."""
        one = diffs.select("a", F.col("b").alias("x"), F.col("n").alias("na"), F.col("diff").alias("da"))
        two = diffs.select("a", F.col("b").alias("y"), F.col("n").alias("nb"), F.col("diff").alias("db"))
        pairs = self.put(pairs.distinct(), f"{name}-pairs")
        full = one.join(self.few(pairs), ["a", "x"]).join(two, ["a", "y"]).where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent)
        made = full.select(F.col("x").alias("a"), F.col("y").alias("b"), "na", "nb", "da", "db").mapInArrow(_difference_products(self.percent), "a long, b long")
        return self.put(made.distinct(), f"{name}-links")

    def settled(self, members: DataFrame, links: DataFrame) -> DataFrame:
        """id, label: components of all links, those between two members of a pivot's group included."""
        percent = self.percent
        labels = components(links, f"{self.folder}/first-components")
        wide = self.spanning(members, labels, "first-wide")
        small = self.put(members.join(self.few(wide.where(F.col("others").between(2, LISTED))), ["column", "range"]).select("column", "range", "b", "n"), "small")
        small = self.put(self.label_of(small, "b", "label", labels), "small-labels")
        two = small.select("column", "range", F.col("b").alias("b2"), F.col("n").alias("n2"), F.col("label").alias("label2"))
        fits = F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent
        listed = small.join(two, ["column", "range"]).where((F.col("b") < F.col("b2")) & (F.col("label") != F.col("label2")) & fits)
        more = self.linked(self.put(listed.select(F.col("b").alias("a"), F.col("b2").alias("b")).distinct(), "listed"), "listed")
        if more.limit(1).count():
            links = links.union(more)
            labels = components(links, f"{self.folder}/listed-components")
        wide = self.spanning(members, labels, "second-wide").where(F.col("others") > LISTED)
        large = self.put(members.join(self.few(wide), ["column", "range"]).select("a", "b").distinct(), "large")
        if not large.limit(1).count():
            return labels

        def placed(labels: DataFrame, name: str) -> DataFrame:
            """a, b, of_a, label: the pairs of large groups with the components of pivot and member."""
            return self.put(self.label_of(self.label_of(large, "a", "of_a", labels), "b", "label", labels), name)

        rest = placed(labels, "rest")
        diffs = self.put(self.with_rows(large, "large").select("a", "b", "n", "sa", "sb").mapInArrow(_differences, "a long, b long, n long, far long, diff binary, " + ", ".join(f"{p} long" for p in PARITIES)).join(self.few(rest), ["a", "b"]), "diffs")
        held = self.spark.sparkContext.broadcast(histogram(diffs, "diff"))

        def first(batches):
            """The rarest elements of a difference. Of two linked rows, one element is shared by the first half bound of the shorter difference and the first bound of the longer."""
            cells = held.value
            for b in batches:
                out = []
                for raw, n in zip(b.column("diff").to_pylist(), b.column("n").to_pylist()):
                    d = np.frombuffer(raw, np.uint64)
                    often = cells[(d % np.uint64(CELLS)).astype(np.int64)]
                    out.append(d[np.lexsort((d, often))[: bound(n, percent) + 1]].view(np.int64))
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("a", "b", "n", "far", "label", *PARITIES)), pa.array(out, pa.list_(pa.int64()))], ["a", "b", "n", "far", "label", *PARITIES, "elements"])

        room = F.floor(F.col("n") * (100 - percent) / percent)
        heads = diffs.mapInArrow(first, "a long, b long, n long, far long, label long, " + ", ".join(f"{p} long" for p in PARITIES) + ", elements array<long>")
        element = heads.select("a", "b", "far", "label", room.alias("room"), *PARITIES, F.posexplode("elements").alias("at", "e"))
        element = self.put(element, "elements")
        # elements that only one component has join nothing
        top = F.min(F.struct("far", "b", "label"))
        group = element.groupBy("a", "e").agg(F.min("label").alias("x"), F.max("label").alias("y"), top.alias("top")).where("x < y")
        group = self.put(group.select("a", "e", F.col("top.b").alias("x"), F.col("top.label").alias("label_x")), "groups")
        element = self.put(element.join(self.few(group), ["a", "e"]), "apart")
        pairs = element.where("b <> x AND label <> label_x").select("a", "x", F.col("b").alias("y"))
        again = self.counted(diffs, pairs, "again")
        element = element.drop("x", "label_x")
        if again.limit(1).count():
            links = links.union(again)
            labels = components(links, f"{self.folder}/second-components")
            element = self.put(self.label_of(element.drop("label"), "b", "label", labels), "still")
            rest = placed(labels, "still-rest")
        # a group's main component need not be joined with itself: of each pair one row is outside it
        sizes = element.groupBy("a", "e", "label").agg(F.count("*").alias("members"))
        main = sizes.groupBy("a", "e").agg(F.max_by("label", F.struct("members", "label")).alias("main"), F.count("*").alias("labels")).where("labels > 1").drop("labels")
        element = self.put(element.join(main, ["a", "e"]), "open")
        second = [F.col(c).alias(f"{c}2") for c in ("far", "label", "room", *PARITIES)]
        x = element.where(F.col("at") <= F.floor(F.col("room") / 2)).select("a", "e", F.col("b").alias("x"), "at", "far", "label", "room", *PARITIES, "main")
        y = element.select("a", "e", F.col("b").alias("y"), F.col("at").alias("at2"), *second, (F.col("label") == F.col("main")).alias("in_main"))
        pair = ("a", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        outside = x.where("label <> main").join(y, ["a", "e"]).where(F.expr("label <> label2 AND far <= far2") & may_be_near(True)).select(*pair)
        inside = x.where("label = main").join(y.where("NOT in_main"), ["a", "e"]).where((F.col("far") <= F.col("far2")) & may_be_near(True)).select(*pair)
        # pairs so close to the pivot that their differences need share nothing
        with_labels = diffs.select("a", "b", "far", room.alias("room"), *PARITIES).join(self.few(rest), ["a", "b"])
        near = with_labels.where("label <> of_a AND far <= room").select("a", F.col("b").alias("x"), "label", "room", (F.col("room") - F.col("far")).alias("left"), *PARITIES)
        most = near.groupBy("a").agg(F.max("left").alias("most"))
        around = with_labels.join(most, "a").where("far <= most").select("a", F.col("b").alias("y"), *second)
        close = near.join(around, "a").where(F.expr("label <> label2 AND far2 <= left") & may_be_near(False)).select(*pair)
        across = self.counted(diffs, outside.union(inside).union(close), "across")
        if across.limit(1).count():
            labels = components(links.union(across), f"{self.folder}/last-components")
        self.drop("rest", "diffs", "elements", "groups", "apart", "still", "still-rest", "open")
        return labels

    def named(self, labels: DataFrame) -> DataFrame:
        """cls, label."""
        return self.put(self.label_of(self.classes, "node", "label", labels).select("cls", "label"), "components")

    def labelled(self) -> DataFrame:
        """doc_id, h, n, row and label (null without words) of every row."""
        return self.rows.select("doc_id", "h", "n", "row", "cls").join(self.few(self.components), "cls", "left").drop("cls")


def joined(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of df. Rows of one doc_id are one document."""
    work = _Work(df, key, text, k, percent, True)
    rows = work.put(work.labelled(), "labelled")
    work.drop("rows")
    least = work.put(rows.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id")), "least")
    named = rows.join(work.few(least), "label", "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def representatives(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of df without near copies: of each component the row of the smallest key, a null key last. Each row is a
    document of its own here, whatever its key, so a text that is nobody's copy stays. Rows without words stay too."""
    work = _Work(df, key, text, k, percent, False)
    rows = work.put(work.labelled().where("label IS NOT NULL"), "labelled")
    work.drop("rows")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    best = work.put(rows.groupBy("label").agg(F.min(order).alias("best"), F.count("*").alias("members")).select("label", F.col("best.row").alias("row"), "members"), "best")
    of_many = rows.join(work.few(work.put(best.where("members > 1").select("label", F.col("row").alias("best")), "many")), "label")
    # a text is told by its key and hash; one that stands in several equal rows is thinned to one row
    marked = of_many.groupBy("doc_id", "h").agg(F.max((F.col("row") == F.col("best")).cast("int")).alias("stays"), F.count("*").alias("n"))
    marked = work.put(marked.where("stays = 0 OR n > 1"), "marked")
    held = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("r"), F.col(key).cast("long").alias("k"), F.xxhash64(text).alias("h"))

    def at(keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select(F.col("doc_id").alias("marked_k"), F.col("h").alias("marked_h"))
        return held.join(F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys, F.col("k").eqNullSafe(F.col("marked_k")) & (F.col("h") == F.col("marked_h")), how)

    out = at(marked, "left_anti")
    repeated = marked.where("stays = 1")
    if repeated.limit(1).count():
        out = out.unionByName(at(repeated, "left_semi").dropDuplicates(["k", "h"]))
    return out.select("r.*")
