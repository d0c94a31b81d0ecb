"""How filters interact, from a packed bitmap index.

1. Every text gets a mask of the filters that it fails; the copy filter compares whole texts by a 128-bit hash with the
   smallest id that holds the same text, table-wide.
2. Each task lays its documents out in bitsets of 64-bit words: one for each filter and each label, and one run of words for
   each part, so that the bitset of a part is zero outside its run and is not stored there.
3. For each subset of the filters, what passes all of them is the AND-NOT of the subset less its last filter with that
   filter's bitset; popcounts by run give the counts of each part. Counts of all tasks are summed.
4. An order of filters is a chain of subsets, so every step of every order is read off these sums: 2^n of them for each part,
   whatever the number of documents.

Null texts are empty; a null lang is the part ''. A row with a null doc_id has no smaller id and is nobody's smaller id, so it
never fails the copy filter, and no label is its own. Repeated rows count once each; rows of the same id are no copies of each
other. Of several labels of an id, any 1 counts. Columns other than doc_id, text and lang play no part, whatever their names.
Of an empty table there are no parts and so no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.common import drop, looked_up, shared_dir, small_batches, text_steps, written

#: The filters, each a letter; a text fails a filter if its condition holds.
NAMES = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITALS_PERCENT, SYMBOLS = 100, 80, 10, "#$%&*|"
#: Parts whose counts a task holds before it passes them on.
HELD_PARTS = 4096
_CAPITALS = bytes(range(65, 91))


def text_mask(text: str) -> int:
    """Bit i: the text fails filter i of A to D."""
    raw = text.encode()
    words = raw.split()
    short = len(words) < MIN_WORDS
    repeats = 100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)
    loud = 100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > MAX_CAPITALS_PERCENT * len(text)
    odd = len(raw.translate(None, SYMBOLS.encode())) < len(raw)
    return short | repeats << 1 | loud << 2 | odd << 3


def _masked(batches):
    for ids, parts, texts in text_steps(batches, "doc_id", "part"):
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids, pa.int64()),
            "part": pa.array(parts, pa.string()),
            "h": pa.array([xxhash.xxh3_128_digest(t.encode()) for t in texts], pa.binary()),
            "mask": pa.array([text_mask(t) for t in texts], pa.int32()),
        })


def marks(documents: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """part, mask (bit i: fails filter i of NAMES), good and toxic of every row of documents."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), "text")
    is_one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    with small_batches(documents.sparkSession):
        rows = written(texts.mapInArrow(_masked, "doc_id long, part string, h binary, mask int").join(known, "doc_id", "left"), f"{folder}/rows")
    copies = written(rows.groupBy("h").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1"), f"{folder}/copies")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int") * (1 << NAMES.index("E"))
    return looked_up(rows, "h", copies, "left").select("part", (F.col("mask") + later).alias("mask"), *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))


def bitsets(part_codes: np.ndarray, flags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """First word of each part's run, the bitset of all documents, and one bitset for each list of flags.

    Parts are coded 0, 1, ... without gaps; a part's documents fill a run of whole words, so words of two parts never mix."""
    order = np.argsort(part_codes, kind="stable")
    sizes = np.bincount(part_codes)
    words = -(-sizes // 64)
    first = np.cumsum(words) - words
    at = np.repeat(first * 64 - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(order))

    def packed(bits: np.ndarray) -> np.ndarray:
        spread = np.zeros(int(words.sum()) * 64, dtype=np.uint8)
        spread[at] = bits[order]
        return np.packbits(spread, bitorder="little").view(np.uint64)

    return first, packed(np.ones(len(order), dtype=bool)), [packed(f) for f in flags]


def prefix_counts(first: np.ndarray, present: np.ndarray, filters: list[np.ndarray], labels: list[np.ndarray]) -> np.ndarray:
    """[part, subset of filters, 0: kept, 1...: kept with each label] for documents that fail no filter of the subset."""
    out = np.zeros((len(first), 1 << len(filters), 1 + len(labels)), dtype=np.int64)
    kept: dict[int, np.ndarray] = {0: present}
    for subset in range(1 << len(filters)):
        if subset:
            last = subset.bit_length() - 1
            kept[subset] = kept[subset ^ 1 << last] & ~filters[last]
        for i, bits in enumerate((kept[subset], *(kept[subset] & x for x in labels))):
            out[:, subset, i] = np.add.reduceat(np.bitwise_count(bits).astype(np.int64), first)
    return out


def _counted(n_filters: int):
    def rows(batches):
        held: dict[str, np.ndarray] = {}

        def given():
            yield pa.RecordBatch.from_pydict({"part": pa.array(held, pa.string()), "counts": pa.array([x.ravel().tolist() for x in held.values()], pa.list_(pa.int64()))})
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column("part").dictionary_encode()
            mask = batch.column("mask").to_numpy()
            flags = [(mask >> i & 1).astype(bool) for i in range(n_filters)] + [batch.column(c).to_numpy(zero_copy_only=False) for c in ("good", "toxic")]
            first, present, bits = bitsets(parts.indices.to_numpy(), flags)
            counts = prefix_counts(first, present, bits[:n_filters], bits[n_filters:])
            for part, x in zip(parts.dictionary.to_pylist(), counts):
                held[part] = held[part] + x if part in held else x
            if len(held) >= HELD_PARTS:
                yield from given()
        yield from given()

    return rows


def subset_sums(marked: DataFrame, n_filters: int) -> DataFrame:
    """part and, by subset of the filters, arrays kept, good and toxic of 2^n_filters counts each."""
    counted = marked.mapInArrow(_counted(n_filters), "part string, counts array<long>")
    summed = counted.select("part", F.posexplode("counts").alias("at", "count")).groupBy("part", "at").agg(F.sum("count").alias("count"))
    flat = summed.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("at", "count"))).alias("flat"))  # 3 * 2^n_filters counts
    return flat.select("part", *(F.expr(f"transform(filter(flat, x -> x.at % 3 = {i}), x -> x.count)").alias(c) for i, c in enumerate(("kept", "good", "toxic"))))


def steps(names: str) -> list[tuple]:
    """filter_order, step, filter, subset applied before, subset applied after."""
    out = []
    for order in permutations(range(len(names))):
        before = 0
        for k, f in enumerate(order):
            out.append(("".join(names[i] for i in order), k + 1, f, before, before | 1 << f))
            before |= 1 << f
    return out


def _shapley(kept: str, f: int, n: int) -> Column:
    """Documents that filter f removes, summed over all orders: each subset of the others stands before it in so many."""
    total: Column = F.lit(0).cast("long")
    for before in range(1 << n):
        if not before >> f & 1:
            b = before.bit_count()
            total = total + (F.get(kept, F.lit(before)) - F.get(kept, F.lit(before | 1 << f))) * (factorial(b) * factorial(n - 1 - b))
    return total


def audit(spark: SparkSession, sums: DataFrame, names: str = NAMES) -> DataFrame:
    """One row for each part, order of the filters and step, from the sums of all subsets."""
    n, every = len(names), (1 << len(names)) - 1
    at = F.get
    chain = spark.createDataFrame(steps(names), "filter_order string, step int, f int, before int, after int")  # n * n! rows
    by_part = sums.select("*", F.array(*(_shapley("kept", f, n) for f in range(n))).alias("shares"), F.explode(F.sequence(F.lit(0), F.lit(every))).alias("before"))
    alone = F.expr("shiftleft(1, f)")
    return by_part.join(F.broadcast(chain), "before").select(
        "part",
        "filter_order",
        "step",
        at("kept", F.col("after")).alias("kept"),
        (at("kept", F.col("before")) - at("kept", F.col("after"))).alias("removed"),
        (at("kept", F.lit(0)) - at("kept", alone) - at("kept", F.col("before")) + at("kept", F.col("after"))).alias("redundant"),
        (at("kept", every - alone) - at("kept", F.lit(every))).alias("unique_fails"),
        (at("good", F.col("before")) - at("good", F.col("after"))).alias("good_lost"),
        (at("toxic", F.col("before")) - at("toxic", F.col("after"))).alias("toxic_lost"),
        F.get("shares", F.col("f")).alias("shapley"),
    )


def query(documents: DataFrame, labels: DataFrame) -> DataFrame:
    spark = documents.sparkSession
    folder = shared_dir(spark)
    sums = written(subset_sums(marks(documents, labels, folder), len(NAMES)), f"{folder}/sums")
    drop(spark, f"{folder}/rows")
    drop(spark, f"{folder}/copies")
    return audit(spark, sums)


SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM texts),
known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part,
    CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN words.doc_id > first THEN 'E' ELSE '' END AS fails,
    coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM words LEFT JOIN known ON words.doc_id = known.doc_id),
counted AS (SELECT part, fails, sum(good) AS good, sum(toxic) AS toxic, count(*) AS n FROM judged GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x) JOIN letters d ON d.x NOT IN (a.x, b.x, c.x)
    JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (SELECT filter_order, CAST(s AS INTEGER) AS step, filter_order[s] AS x, left(filter_order, CAST(s AS INTEGER) - 1) AS earlier FROM orders, (SELECT unnest(range(1, 6)) AS s)),
met AS (
  SELECT part, filter_order, step, x, n, good, toxic, fails = x AS only_this, contains(fails, x) AS failing,
    length(translate(fails, earlier, '')) < length(fails) AS gone
  FROM counted, steps),
summed AS (
  SELECT part, filter_order, step, x,
    sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND failing THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN only_this THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND failing THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT gone AND failing THEN toxic ELSE 0 END) AS toxic_lost
  FROM met GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM summed
"""
