"""Repeated byte strings by a sparse enhanced suffix array and its interval tree.

A byte goes if a string of WINDOW bytes that covers it starts anywhere else too, in the same document or another.

1. Suffixes are sampled: a position is an anchor if the GRAM bytes from it hash lowest among the grams of some WINDOW bytes.
   Equal strings of WINDOW bytes hold the same anchors, so a repeat can be found from the suffixes at anchors alone; these
   are about one in a hundred. The texts are written to files in the shared folder meanwhile, a file for each task.
2. Anchors whose gram occurs once are done with. The others are read back with their context, all that any string of WINDOW
   bytes around the gram can reach. Equal contexts are repeats as a whole. Of each different context one row goes on, if
   its gram has several.
3. Rows of one gram are one range of the suffix array: sorted by what follows, with the lengths of common prefixes. A stack
   scan gives the tree of its intervals. At each interval the contexts to the left, sorted backwards, are merged, the
   smaller set into the larger. Where members of two intervals below agree to the left, no longer string to the right holds
   them all, and where their left extensions differ, none to the left does: such a group is a maximal repeat, given with all
   its occurrences, not only neighbours (`groups=True`). For the spans alone each occurrence is given where it finds a
   neighbour that reaches farther to the left than any did below. Both are maximal within their contexts of up to
   WINDOW + (WINDOW - GRAM) bytes; longer repeats are runs of spans.
4. A gram with more than LOCAL different contexts is divided first: the strings around it start in one of WAYS ranges of the
   possible places, so it goes on as so many longer cores, what all strings of a range share. A core that occurs once is
   dropped; a hull, all that the strings of a range cover, that occurs again repeats as a whole, and one of its rows goes on
   as a partner for others; ranges of the suffix array that got small are sorted. A row has about one open range at a level,
   at each end of a repeat, and carries the bytes between core and hull alone, ever fewer. Each level is an aggregate that
   combines before the shuffle.
5. Spans go back to the text files; what is left is hashed there. No text is shuffled, only contexts at the ends of repeats.

Hashes of contexts and cores have 128 bits. Null texts are empty; texts under WINDOW bytes keep everything. Each row is a
document of its own, so repeated rows repeat each other, whatever their doc_id; a null doc_id is kept. Columns other than
doc_id and text play no part, whatever their names. An empty table yields no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.common import drop, looked_up, shared_dir, small_batches, text_steps, written
from tallymart.llm.tokenfile import file_system

WINDOW, GRAM = 400, 200
AROUND = WINDOW - GRAM
#: Different contexts of one core that one task sorts.
LOCAL = 2048
#: Ranges into which a larger core is divided at a level.
WAYS = 4
#: Bytes of text that one vectorised step hashes.
BLOCK = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_LETTERS = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ROW = 32  # bits of a row number below the part


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as were ever asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * BLOCK)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def gram_hashes(raw: np.ndarray, k: int = GRAM) -> np.ndarray:
    """A 64-bit hash of each k bytes in a row, from differences of prefix sums."""
    up, down = _POWERS.get(len(raw))
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_LETTERS[raw] * down, out=sums[1:])
    x = (sums[k:] - sums[:-k]) * up[: len(raw) - k + 1]
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def sliding(a: np.ndarray, width: int, op) -> np.ndarray:
    """op over each `width` elements in a row, by doubling."""
    size, cur, n = 1, a, len(a) - width + 1
    while size * 2 <= width:
        cur = op(cur[:-size], cur[size:])
        size *= 2
    return op(cur[:n], cur[width - size : width - size + n])


def anchors(pieces: list[bytes], window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece, position in it and gram hash of each anchor: least of the grams of some `window` bytes of its piece."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    none = np.zeros(0, dtype=np.int64)
    if len(raw) < window:
        return none, none, none.astype(np.uint64)
    ends, width = np.cumsum(sizes), window - gram + 1
    grams = gram_hashes(raw, gram)
    rank = (grams >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = sliding(rank, width, np.minimum)
    least[np.arange(len(least)) + window > np.repeat(ends, sizes)[: len(least)]] = 0  # windows across two pieces
    edge = np.zeros(width - 1, dtype=np.uint32)
    at = np.flatnonzero(sliding(np.concatenate([edge, least, edge]), width, np.maximum) == rank)
    piece = np.searchsorted(ends, at, side="right")
    return piece, at - (ends - sizes)[piece], grams[at]


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text, offset, bytes) in steps of about BLOCK bytes; a longer text comes in pieces that overlap by all but one byte of a window."""
    held, size = [], 0
    for i, raw in enumerate(texts):
        for start in range(0, max(1, len(raw) - WINDOW + 1), BLOCK):
            part = raw[start : start + BLOCK + WINDOW - 1]
            if held and size + len(part) > BLOCK:
                yield held
                held, size = [], 0
            held.append((i, start, part))
            size += len(part)
    if held:
        yield held


def _anchored(folder: str):
    """Writes each task's texts to a file and gives the anchors, and the file's name with its first anchor's row 0."""

    def rows(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        store, root = file_system(folder)
        store.create_dir(root, recursive=True)
        name = f"{part:06d}-{uuid.uuid4().hex}"
        kinds = pa.schema([("doc_id", pa.int64()), ("raw", pa.binary())])
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        row = 0
        with store.open_output_stream(f"{root}/{name}") as out, pa.ipc.new_stream(out, kinds, options=options) as writer:
            for ids, texts in text_steps(batches, "doc_id", step=BLOCK):
                raws = [t.encode() for t in texts]
                writer.write_batch(pa.record_batch([pa.array(ids, pa.int64()), pa.array(raws, pa.binary())], schema=kinds))
                found: list[tuple] = []
                for step in _pieces(raws):
                    piece, at, grams = anchors([p for _, _, p in step])
                    text, offset = np.array([i for i, _, _ in step]), np.array([o for _, o, _ in step])
                    found.append((text[piece], offset[piece] + at, grams))
                text, at, grams = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
                order = np.lexsort((at, text))
                text, at, grams = text[order], at[order], grams[order]
                once = np.r_[True, (text[1:] != text[:-1]) | (at[1:] != at[:-1])][: len(text)]  # overlapping pieces find the same anchor
                text, at, grams = text[once], at[once], grams[once]
                yield pa.RecordBatch.from_pydict({"gram": pa.array(grams.view(np.int64)), "row": pa.array((part << _ROW) + row + 1 + text, pa.int64()), "pos": pa.array(at.astype(np.int32)), "name": pa.nulls(len(at), pa.string())})
                row += len(raws)
        yield pa.RecordBatch.from_pydict({"gram": pa.nulls(1, pa.int64()), "row": pa.array([part << _ROW], pa.int64()), "pos": pa.nulls(1, pa.int32()), "name": pa.array([name])})

    return rows


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """The rows of each value of a sorted key, across batches."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        col, n = batch.column(key), batch.num_rows
        cuts = [0, *(np.flatnonzero(pc.not_equal(col.slice(1), col.slice(0, n - 1)).to_numpy(zero_copy_only=False)) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
        held = batch.slice(cuts[-1])
    if held is not None:
        yield held


def _texts(store, path: str, part: int) -> Iterator[tuple[int, int | None, bytes]]:
    row = part << _ROW
    with store.open_input_stream(path) as source, pa.ipc.open_stream(source) as reader:
        for batch in reader:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                row += 1
                yield row, doc_id, raw.as_py()


def _visited(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[tuple[int, int | None, bytes, pa.RecordBatch | None]]:
    """row, doc_id, bytes and items of every document of the files that the batches name, in order."""
    store, root = file_system(folder)
    texts: Iterator = iter(())
    for items in runs(batches, "row"):
        row = items.column("row")[0].as_py()
        if row % (1 << _ROW) == 0:
            yield from ((*x, None) for x in texts)
            texts = _texts(store, f"{root}/{items.column('name')[0].as_py()}", row >> _ROW)
            continue
        for x in texts:
            yield (*x, items if x[0] == row else None)
            if x[0] == row:
                break
    yield from ((*x, None) for x in texts)


def _context(raw: bytes, pos: int) -> tuple[int, bytes]:
    """Bytes before the gram and all bytes that strings of WINDOW bytes around it reach."""
    start = max(0, pos - AROUND)
    return pos - start, raw[start : pos + WINDOW]


def _digested(folder: str):
    def rows(batches):
        held: list[tuple] = []

        def given():
            cols = list(zip(*held)) if held else [[]] * 5
            held.clear()
            return pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(("ctx", "gram", "row", "pos", "len"), cols, (pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32()))})

        for row, _, raw, items in _visited(batches, folder):
            if items is not None:
                for pos in items.column("pos").to_pylist():
                    before, ctx = _context(raw, pos)
                    held.append((xxhash.xxh3_128_digest(bytes((before,)) + ctx), xxhash.xxh3_128_digest(raw[pos : pos + GRAM]), row, pos, len(ctx)))
                if len(held) > 5000:
                    yield given()
        yield given()

    return rows


_ITEM = "core binary, hull binary, row long, pos int, alone boolean, lo int, hi int, before binary, after binary"


def _batch(held: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*held)) if held else [[]] * 9
    kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_pydict({n.split()[0]: pa.array(c, t) for n, c, t in zip(_ITEM.split(", "), cols, kinds)})


def _with_bytes(folder: str):
    """Items with the bytes before and after their gram; the gram is the core, and no hull repeats."""

    def rows(batches):
        held: list[tuple] = []
        for row, _, raw, items in _visited(batches, folder):
            if items is None:
                continue
            for core, pos, alone in zip(*(items.column(c).to_pylist() for c in ("gram", "pos", "alone"))):
                before, ctx = _context(raw, pos)
                held.append((core, None, row, pos, alone, 0, 0, ctx[:before], ctx[before + GRAM :]))
            if len(held) > 1000:
                yield _batch(held)
                held = []
        yield _batch(held)

    return rows


def _divided(batches):
    """Each item as WAYS: ranges of how far before the gram its strings can start.

    A core is `lo` bytes, the gram and `hi` bytes; before and after are what else the item's strings can reach."""
    for batch in batches:
        held = []
        for core, _, row, pos, alone, lo, hi, before, after in zip(*(batch.column(n.split()[0]).to_pylist() for n in _ITEM.split(", "))):
            size = AROUND - hi - lo + 1
            edges = [lo + size * i // min(WAYS, size) for i in range(min(WAYS, size) + 1)]
            for a, b in zip(edges, (AROUND - e + 1 for e in edges[1:])):
                left, right = a - lo, b - hi  # bytes that the core gains
                if left > len(before) or right > len(after):
                    continue
                inner = xxhash.xxh3_128_digest(core + bytes((a, b)) + before[len(before) - left :] + b"|" + after[:right])
                outer, beyond = before[max(0, len(before) - (AROUND - b - lo)) : len(before) - left], after[right : AROUND - a - hi]
                if a + len(outer) + b + len(beyond) >= AROUND:
                    held.append((inner, xxhash.xxh3_128_digest(inner + bytes((len(outer),)) + outer + beyond), row, pos, alone, a, b, outer, beyond))
        yield _batch(held)


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    hi = min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    lo = 0
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def maximal_repeats(before: list[bytes], after: list[bytes], least: int = WINDOW - GRAM, whole: bool = True) -> list[tuple[int, int, list[int]]]:
    """(left, right, members): contexts that agree on `left` bytes before and `right` bytes after their common core, with
    left + right >= least. A stack scan over the sorted suffixes builds the intervals bottom up.

    whole: every maximal repeat with all its occurrences: members of one interval, not all of one interval below it, that
    agree on `left` bytes and not all on more. Otherwise only what coverage needs: each member, alone, where it finds a
    neighbour that reaches farther to the left than any did in the intervals below."""
    n = len(after)
    back = [b[::-1] for b in before]
    by_left = sorted(range(n), key=back.__getitem__)
    rank = [0] * n
    for r, i in enumerate(by_left):
        rank[i] = r
    best, owner = [-1] * n, [0] * n  # by rank
    known: dict[tuple[int, int], int] = {}

    def left(a: int, b: int) -> int:
        if (a, b) not in known:
            known[a, b] = common(back[by_left[a]], back[by_left[b]])
        return known[a, b]

    def merged(node: list, more: list[int]) -> None:
        if whole:
            node[3] += 1
            for r in more:
                owner[r] = node[3]
        small, large = sorted((node[1], more), key=len)
        for r in small:
            at = bisect_left(large, r)
            for y in large[max(0, at - 1) : at + 1]:
                x = left(min(r, y), max(r, y))
                for z in (r, y):
                    if x > best[z]:
                        best[z] = x
                        node[2].add(z)
            large.insert(at, r)
        node[1] = large

    groups: list[tuple[int, int, list[int]]] = []

    def finished(node: list) -> None:
        right, members, raised, _ = node
        if not whole:
            groups.extend((best[r], right, [by_left[r]]) for r in raised if best[r] + right >= least)
            return
        agree = [left(a, b) for a, b in zip(members, members[1:])]
        seen = set()
        for at in range(len(members)):
            a = b = at
            while True:
                x = max(agree[a - 1] if a else -1, agree[b] if b < len(agree) else -1)
                if x < 0 or x + right < least:
                    break
                while a and agree[a - 1] >= x:
                    a -= 1
                while b < len(agree) and agree[b] >= x:
                    b += 1
                if (a, b) in seen:
                    break
                seen.add((a, b))
                if len({owner[m] for m in members[a : b + 1]}) > 1:
                    groups.append((x, right, [by_left[m] for m in members[a : b + 1]]))

    order = sorted(range(n), key=after.__getitem__)
    stack: list[list] = []  # common right bytes, ranks to the left in order, ranks that reach farther than below, intervals merged
    current = [rank[order[0]]]
    for k in range(1, n + 1):
        height = common(after[order[k - 1]], after[order[k]]) if k < n else -1
        while stack and stack[-1][0] > height:
            node = stack.pop()
            merged(node, current)
            finished(node)
            current = node[1]
        if k < n:
            if stack and stack[-1][0] == height:
                merged(stack[-1], current)
            else:
                for r in current:
                    owner[r] = 0
                stack.append([height, current, set(), 0])
            current = [rank[order[k]]]
    return groups


def _grouped(whole: bool):
    def rows(batches):
        held: list[tuple] = []

        def given():
            cols = list(zip(*held)) if held else [[]] * 4
            held.clear()
            return pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(("grp", "row", "start", "len"), cols, (pa.binary(), pa.int64(), pa.int32(), pa.int32()))})

        for items in runs(batches, "core"):
            if items.num_rows < 2:
                continue
            before, after, row, pos, alone = (items.column(c).to_pylist() for c in ("before", "after", "row", "pos", "alone"))
            core, lo, hi = (items.column(c)[0].as_py() for c in ("core", "lo", "hi"))
            for left, right, members in maximal_repeats(before, after, AROUND - lo - hi, whole):
                some = members[0]
                grp = xxhash.xxh3_128_digest(core + bytes((left, right)) + before[some][len(before[some]) - left :] + b"|" + after[some][:right])
                held += [(grp, row[m], pos[m] - lo - left, lo + left + GRAM + right + hi) for m in members if whole or alone[m]]
            if len(held) > 5000:
                yield given()
        yield given()

    return rows


def _open(rows: DataFrame, key: str, alone) -> DataFrame:
    """Keys of more than one row, some of them still to be decided; n and d are the number of rows."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.max(alone).alias("some")).where("n > 1 AND some").select(key, "n", F.col("n").alias("d"))


def _dealt(items: DataFrame, files: DataFrame, n: int) -> DataFrame:
    """items by the file of their row, in order, each file's name first."""
    both = files.unionByName(items, allowMissingColumns=True)
    return both.repartition(n, F.shiftright("row", _ROW)).sortWithinPartitions("row", "pos")


class Repeats:
    """spans: grp, row, start, len of repeats, all that cover a byte or (groups) all occurrences of every maximal repeat;
    rows number the documents. cut(): what is left of each document."""

    def __init__(self, documents: DataFrame, groups: bool = False):
        spark = documents.sparkSession
        self.spark, self.folder, self.whole = spark, shared_dir(spark), groups
        at = f"{self.folder}/texts"
        with small_batches(spark):
            found = written(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_anchored(at), "gram long, row long, pos int, name string"), f"{self.folder}/anchors")
            self.files = found.where("name IS NOT NULL").select("row", "pos", "name")
            self.n_files = max(1, self.files.count())
            marked = found.where("name IS NULL").drop("name")
            often = written(marked.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), f"{self.folder}/grams")
            again = looked_up(marked, "gram", often).select("row", "pos")
            ctxs = written(_dealt(again, self.files, self.n_files).mapInArrow(_digested(at), "ctx binary, gram binary, row long, pos int, len int"), f"{self.folder}/contexts")
            one = F.min(F.struct("row", "pos"))
            kinds = written(ctxs.groupBy("ctx").agg(F.count("*").alias("copies"), one.alias("at"), F.min("gram").alias("gram")).select("copies", "at.*", "gram", "ctx"), f"{self.folder}/kinds")
            several = written(_open(kinds, "gram", F.col("copies") == 1), f"{self.folder}/several")
            start = F.greatest(F.lit(0), F.col("pos") - AROUND)
            whole = looked_up(ctxs, "ctx", kinds.where("copies > 1").select("ctx", F.col("copies").alias("n")))
            parts = [whole.select(F.col("ctx").alias("grp"), "row", start.alias("start"), "len")]
            opened = looked_up(kinds, "gram", several).select("gram", "row", "pos", (F.col("copies") == 1).alias("alone"), "d")
            wide = opened.where(F.col("d") > LOCAL)
            near = _dealt(opened.where(F.col("d") <= LOCAL).drop("d"), self.files, self.n_files).mapInArrow(_with_bytes(at), _ITEM)
            parts.append(self._local(near))
            if wide.limit(1).count():
                parts += self._divisions(_dealt(wide.drop("d"), self.files, self.n_files).mapInArrow(_with_bytes(at), _ITEM))
            spans = parts[0]
            for p in parts[1:]:
                spans = spans.unionByName(p)
            self.spans = written(spans, f"{self.folder}/spans")
        for name in ("grams", "contexts", "kinds", "several"):
            drop(spark, f"{self.folder}/{name}")

    def _divisions(self, items: DataFrame) -> list[DataFrame]:
        parts, level = [], 0
        while True:
            level += 1
            put = lambda df, name: written(df, f"{self.folder}/{name}-{level}")  # noqa: B023, E731
            halves = put(items.mapInArrow(_divided, _ITEM), "halves")
            if level > 1:
                drop(self.spark, f"{self.folder}/items-{level - 1}")
            met = put(looked_up(halves, "core", put(_open(halves, "core", F.col("alone")), "cores")), "met")
            drop(self.spark, f"{self.folder}/halves-{level}")
            one = F.min(F.struct("row", "pos")).alias("one")
            again = met.groupBy("hull").agg(F.count("*").alias("n"), one, F.max(F.col("lo") + F.col("hi") == AROUND).alias("last")).where("n > 1")
            # for all occurrences of every group a row meets all partners down to single strings
            again = put(again.where(F.col("last") | F.lit(not self.whole)).select("hull", "n", "one"), "hulls")
            told = put(looked_up(met, "hull", again, "left"), "told")
            drop(self.spark, f"{self.folder}/met-{level}")
            size = F.col("lo") + F.length("before") + GRAM + F.length("after") + F.col("hi")
            over = told.where("one IS NOT NULL")
            parts.append(over.where(F.col("alone") | F.lit(self.whole)).select(F.col("hull").alias("grp"), "row", (F.col("pos") - F.col("lo") - F.length("before")).alias("start"), size.cast("int").alias("len")))
            partners = over.where("row = one.row AND pos = one.pos").withColumn("alone", F.lit(False))
            rest = told.where("one IS NULL").unionByName(partners).where(F.col("lo") + F.col("hi") < AROUND).drop("one")
            parts.append(self._local(rest.where(F.col("d") <= LOCAL).drop("d")))
            items = put(rest.where(F.col("d") > LOCAL).drop("d"), "items")
            if not items.limit(1).count():
                return parts

    def _local(self, items: DataFrame) -> DataFrame:
        return items.repartition("core").sortWithinPartitions("core", "row", "pos").mapInArrow(_grouped(self.whole), "grp binary, row long, start int, len int")

    def cut(self, with_text: bool = False) -> DataFrame:
        """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, and the kept bytes if wanted."""
        at, kinds = f"{self.folder}/texts", "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text

        def rows(batches):
            held: list[tuple] = []
            size = 0

            def given():
                cols = list(zip(*held)) if held else [[]] * (5 + with_text)
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                held.clear()
                return pa.RecordBatch.from_pydict({n.split()[0]: pa.array(c, t) for n, c, t in zip(kinds.split(", "), cols, types)})

            for _, doc_id, raw, items in _visited(batches, at):
                spans = merged_spans(items) if items is not None else []
                kept, end = [], 0
                for a, b in spans:
                    kept.append(raw[end:a])
                    end = b
                left = b"".join([*kept, raw[end:]])
                held.append((doc_id, len(raw), len(raw) - len(left), len(spans), hashlib.sha256(left).hexdigest(), left))
                size += len(left) * with_text + 100
                if size > BLOCK:
                    size = 0
                    yield given()
            yield given()

        spans = self.spans.select("row", F.col("start").alias("pos"), "len")
        with small_batches(self.spark):
            return written(_dealt(spans, self.files, self.n_files).mapInArrow(rows, kinds), f"{self.folder}/cut")


def merged_spans(items: pa.RecordBatch) -> list[tuple[int, int]]:
    """Maximal runs of the covered bytes; items come by start."""
    start, end = items.column("pos").to_numpy().astype(np.int64), items.column("pos").to_numpy().astype(np.int64) + items.column("len").to_numpy()
    reach = np.maximum.accumulate(end)
    first = np.r_[True, start[1:] > reach[:-1]]
    return list(zip(start[first].tolist(), reach[np.r_[first[1:], True]].tolist()))


def query(documents: DataFrame) -> DataFrame:
    found = Repeats(documents)
    out = found.cut()
    for name in ("texts", "anchors", "spans"):
        drop(documents.sparkSession, f"{found.folder}/{name}")
    return out
