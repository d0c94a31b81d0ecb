"""Best-fit packing of documents into sequences, after a Martello-Toth reduction.

Pieces are at most CAPACITY tokens long, so an instance of any size is a histogram of CAPACITY counts, and that alone
reaches the driver. The reduction fixes sets that provably dominate every alternative for a piece: a piece that nothing
fits beside, a pair that fills a sequence, the largest partner where at most one fits, or where no two others add up to
more. Best-fit decreasing packs the rest. Both work on whole counts at once and yield runs: the pieces of one length from
one rank to another go into consecutive sequences. Pieces then find their place by their rank among pieces of equal
length, which is a prefix sum over (task, length) counts; no group of pieces meets in one task.

A null text is empty and holds the end id alone. Repeated rows are packed each. An empty table yields no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.common import shared_dir, small_batches, text_steps, written
from tallymart.llm.tokens import END_ID, coder

CAPACITY = 4096


class Plan:
    """Runs (length, first rank, pieces, first sequence, pieces in each, first offset), all from counts by length."""

    def __init__(self, counts, capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = [0] * (capacity + 1)
        for n, c in enumerate(counts):
            if c and not 1 <= n <= capacity:
                raise ValueError("a piece is longer than a sequence")
            self.left[n] = int(c)
        self.taken = [0] * (capacity + 1)
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.bins = 0
        self.fixed = 0
        self.reduce()
        self.fixed = self.bins
        self.best_fit()

    def _run(self, length: int, pieces: int, first_bin: int, each: int, offset: int) -> None:
        self.runs.append((length, self.taken[length], pieces, first_bin, each, offset))
        self.taken[length] += pieces
        self.left[length] -= pieces

    def _fix(self, members: tuple[int, ...], times: int) -> None:
        if len(members) == 2 and members[0] == members[1]:
            self._run(members[0], 2 * times, self.bins, 2, 0)
        else:
            offset = 0
            for m in members:
                self._run(m, times, self.bins, 1, offset)
                offset += m
        self.bins += times

    def _smallest(self, without: int, k: int) -> list[int]:
        """The k smallest lengths left, with repetition, one piece of `without` set aside."""
        out: list[int] = []
        for n in self.present:
            out += [n] * min(k - len(out), self.left[n] - (n == without))
            if len(out) >= k:
                break
        return out

    def reduce(self) -> None:
        while True:
            before = self.bins
            self.present = [n for n, c in enumerate(self.left) if c]
            for s in reversed(list(self.present)):
                while self.left[s] and self._dominating(s):
                    if not self.left[s]:
                        break
                self.present = [n for n in self.present if self.left[n]]
            if self.bins == before:
                return

    def _dominating(self, s: int) -> bool:
        """Fixes as many equal sets around a piece of length s as one rule allows; False if none applies."""
        room = self.capacity - s
        self.present = [n for n in self.present if self.left[n]]
        low = self._smallest(s, 3)
        if not low or low[0] > room:
            self._fix((s,), self.left[s] if not low or low[0] > room and (s > room or self.left[s] == 1) else 1)
            return True
        at = bisect_left(self.present, room + 1) - 1
        while at >= 0 and self.left[self.present[at]] - (self.present[at] == s) <= 0:
            at -= 1
        partner = self.present[at]
        single = partner == room or len(low) < 2 or low[0] + low[1] > room
        if not single and (len(low) < 3 or sum(low) > room):
            single = partner >= self._best_pair(s, room)
        if not single:
            return False
        self._fix((s, partner), self.left[s] // 2 if partner == s else min(self.left[s], self.left[partner]))
        return True

    def _best_pair(self, s: int, room: int) -> int:
        """The largest sum of two further pieces that fits."""
        best, ps = 0, self.present
        i, j = 0, bisect_left(ps, room) - 1
        free = lambda n: self.left[n] - (n == s)
        while i <= j:
            total = ps[i] + ps[j]
            if total > room or free(ps[j]) <= 0:
                j -= 1
            elif free(ps[i]) <= 0 or (i == j and free(ps[i]) < 2):
                i += 1
            else:
                best = max(best, total)
                i += 1
        return best

    def best_fit(self) -> None:
        groups: dict[int, list[tuple[int, int]]] = {}
        rooms: list[int] = []

        def put(room: int, first: int, n: int) -> None:
            if n and room:
                if room not in groups:
                    groups[room] = []
                    insort(rooms, room)
                groups[room].append((first, n))

        for s in range(self.capacity, 0, -1):
            while self.left[s]:
                c, at = self.left[s], bisect_left(rooms, s)
                if at == len(rooms):
                    room, first, n = self.capacity, self.bins, c
                    opened = True
                else:
                    room = rooms[at]
                    (first, n), opened = groups[room].pop(), False
                    if not groups[room]:
                        del groups[room]
                        rooms.pop(at)
                each = min(room // s, c)
                used = min(n, c // each)
                self._run(s, used * each, first, each, self.capacity - room)
                if opened:
                    self.bins += used
                else:
                    put(room, first + used, n - used)
                put(room - each * s, first, used)

    def arrays(self) -> dict[str, np.ndarray]:
        runs = np.array(sorted(self.runs), dtype=np.int64).reshape(-1, 6)
        return dict(zip(("length", "rank", "pieces", "bin", "each", "offset"), runs.T))


def place(runs: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece."""
    big = np.int64(1) << 45
    at = np.searchsorted(runs["length"] * big + runs["rank"], length * big + rank, side="right") - 1
    i = rank - runs["rank"][at]
    return runs["bin"][at] + i // runs["each"][at], runs["offset"][at] + i % runs["each"][at] * length


def pieces(documents: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32; bucket is the task that cut it, local its rank there among equal lengths."""

    def rows(batches):
        from pyspark import TaskContext

        bucket, c = TaskContext.get().partitionId(), coder(path)
        seen = np.zeros(capacity + 1, dtype=np.int64)
        tail = int(END_ID).to_bytes(4, "little")
        for docs, texts in text_steps(batches, "doc_id"):
            out = []
            for d, raw in zip(docs, c.encode(texts)):
                raw += tail
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    n = len(part) // 4
                    out.append((d, k, at // 4, n, zlib.crc32(part), bucket, int(seen[n])))
                    seen[n] += 1
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "bucket", "local")
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_pydict({n: pa.array(x, t) for n, t, x in zip(names, kinds, zip(*out))})
        c.trim()

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, bucket long, local long")


def packed(documents: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of each document."""
    spark = documents.sparkSession
    with small_batches(spark):
        cut = written(pieces(documents, path, capacity), shared_dir(spark))
    by_task = cut.groupBy("bucket", "length").agg(F.count("*").alias("n"))
    by_length = by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()  # one row for each length: at most `capacity`
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in by_length:
        counts[r["length"]] = r["n"]
    runs = Plan(counts, capacity).arrays()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select("bucket", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def rows(batches):
        for b in batches:
            length, rank = (b.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            seq, off = place(runs, length, rank)
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(seq), pa.array(off)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = cut.join(base, ["bucket", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("local")).alias("rank"))
    return ranked.mapInArrow(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
