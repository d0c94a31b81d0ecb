"""The prefix trie of conversations, by most-significant-digit radix partitioning over dictionary-encoded turns.

1. Turns are ordered by (conversation, turn) with a range partitioning, so a long conversation may lie in several partitions;
   the position of a turn is its place there plus what earlier partitions hold, which is one number for each partition.
2. Distinct turns (role, text) get dense ids; a conversation is a sequence of ids, in pages of PAGE turns.
3. Equal sequences are one sequence with a weight, so a large group of copies is one digit string. The hash of a group's ids is
   taken from chunks of them in order, as a stream.
4. A digit is a turn id. Level d deals each bucket of sequences, which share d turns, out by the turn at d: an aggregate of
   (bucket, id) that combines before the shuffle, then a join that leaves hot children where they are. Every child is a node.
   A child of one sequence is a chain, written down from its pages where they lie. A child with at most LOCAL turns left is
   local: one task sorts it by multikey quicksort, and each part equal to a pivot is a node. Larger ones go on to level d+1,
   so there are as many levels as turns that different sequences with more than LOCAL turns in all share.
5. Totals of subtrees go up from the deepest level: sums by parent.

Ties of a turn number are ordered by role and text, each by its first 64 characters, then by a hash of both; equal rows are
separate turns. Rows without a conv_id take no part. A null role or text is empty. `%` truncates, so the base of -5 is 0.
Columns other than conv_id, turn, role and text play no part, whatever their names. An empty table has no root and no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.common import drop, looked_up, shared_dir, text_steps, written
from tallymart.llm.repeats import runs

PAGE = 64
#: Turns left in a bucket that one task sorts.
LOCAL = 1024
#: Characters of ids that one row carries to the hash of a group.
CHUNK = 1 << 16
_NOBODY = hashlib.sha256(b"").hexdigest()
_NODE = "top boolean, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
COLUMNS = [x.split()[0] for x in _NODE.split(", ")[1:]]


def _keyed(batches):
    for c, turn, role, texts in text_steps(batches, "c", "turn", "role"):
        raws = [t.encode() for t in texts]
        yield pa.RecordBatch.from_pydict({
            "c": pa.array(c, pa.int64()),
            "turn": pa.array(turn, pa.int64()),
            "r64": pa.array([r[:64] for r in role]),
            "t64": pa.array([t[:64] for t in texts]),
            "h": pa.array([xxhash.xxh3_128_digest(b"%d:%s%s" % (len(x := r.encode()), x, t)) for r, t in zip(role, raws)], pa.binary()),
            "words": pa.array([len(t.split()) for t in raws], pa.int64()),
        })


def _placed(batches):
    """The place of each turn among its conversation's turns in this partition."""
    from pyspark import TaskContext

    part, last, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        c = batch.column("c").to_numpy()
        if not len(c):
            continue
        starts = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        at = np.arange(len(c)) - np.repeat(starts, np.diff(np.r_[starts, len(c)]))
        if c[0] == last:
            at[: starts[1] if len(starts) > 1 else len(c)] += n
        last, n = c[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), part, dtype=np.int32)), *(batch.column(x) for x in ("base", "c", "h", "words")), pa.array(at.astype(np.int64))], names=["part", "base", "c", "h", "words", "at"])


def positions(turns: DataFrame, folder: str) -> DataFrame:
    """base, c, pos, h and words of every turn; no partition holds more than its share, however long a conversation is."""
    spark = turns.sparkSession
    order = ["base", F.col("c") != F.col("base"), "c", F.col("turn").asc_nulls_first(), "r64", "t64", F.hex("h")]
    sized = turns.withColumn("base", F.col("c") - F.col("c") % 20).withColumn("salt", F.rand(7))
    placed = written(sized.repartitionByRange(*order, "salt").sortWithinPartitions(*order, "salt").mapInArrow(_placed, "part int, base long, c long, h binary, words long, at long"), f"{folder}/placed")
    key = [F.col("base"), F.col("c") != F.col("base"), F.col("c")]
    ends = placed.groupBy("part").agg(F.min(F.struct(*key)).alias("first"), F.max(F.struct(*key, "at")).alias("last")).select("part", "first.c", F.col("last.c").alias("last"), (F.col("last.at") + 1).alias("n"))
    before, offsets, last = 0, [], None
    for r in sorted(ends.collect()):  # a row for each partition
        offset = before if r.c == last else 0
        offsets.append((r.part, r.c, offset))
        before, last = r.n + (offset if r["last"] == r.c else 0), r["last"]
    shifts = spark.createDataFrame([x for x in offsets if x[2]], "part int, c long, offset long")
    return placed.join(F.broadcast(shifts), ["part", "c"], "left").select("base", "c", (F.col("at") + F.coalesce("offset", F.lit(0))).alias("pos"), "h", "words")


def turns_of(conversations: DataFrame) -> DataFrame:
    some = conversations.where("conv_id IS NOT NULL")
    return some.select(F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), "text").mapInArrow(_keyed, "c long, turn long, r64 string, t64 string, h binary, words long")


def rebuilt(conversations: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Turns (c, pos, h, words) and conversations (c, len): each starts with the first crc32(c) % 4 turns of its base instead of its own."""
    at = written(positions(written(turns_of(conversations), f"{folder}/turns"), folder), f"{folder}/positions")
    sizes = at.groupBy("base", "c").agg(F.count("*").alias("n")).withColumn("h", (F.crc32(F.col("c").cast("string")) % 4).cast("int"))
    heads = at.where("c = base AND pos < 3").select("base", "pos", F.col("h").alias("head"), "words")
    known = heads.groupBy("base").agg(F.count("*").alias("b"))
    convs = written(sizes.join(known, "base", "left").withColumn("b", F.least("h", F.coalesce("b", F.lit(0)))), f"{folder}/convs")
    given = convs.join(heads, "base").where("pos < h").select("c", "pos", F.col("head").alias("h"), "words")
    short = convs.where("b < h AND n > h").select("c", "n", (F.col("h") - F.col("b")).alias("shift"))
    own = at.where(F.col("pos") >= F.crc32(F.col("c").cast("string")) % 4)
    own = looked_up(own, "c", short, "left").select("c", (F.col("pos") - F.coalesce("shift", F.lit(0))).alias("pos"), "h", "words")
    return written(given.unionByName(own), f"{folder}/rebuilt"), convs.select("c", (F.col("b") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("len"))


def paged(turns: DataFrame, folder: str) -> DataFrame:
    """c, page, ids, words: the turns of a conversation by their dictionary ids, PAGE in a row."""
    dictionary = written(turns.groupBy("h").agg(F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id()), f"{folder}/dictionary")
    page = F.floor(F.col("pos") / PAGE).cast("long").alias("page")
    rows = looked_up(turns, "h", dictionary).groupBy("c", page).agg(F.array_sort(F.collect_list(F.struct("pos", "id", "words"))).alias("x"))
    return written(rows.select("c", "page", F.col("x.id").alias("ids"), F.col("x.words").alias("words")), f"{folder}/pages")


def _chunked(batches):
    """The ids of each group in order, joined by commas, CHUNK characters in a row."""
    from pyspark import TaskContext

    part, seq, out = TaskContext.get().partitionId(), 0, []
    for run in runs(batches, "rep"):
        rep, held, size = run.column("rep")[0].as_py(), [], 0
        for c in [*run.column("c").to_pylist(), None]:
            if c is None or size > CHUNK:
                out.append((rep, part, seq, ",".join(held)))
                held, size, seq = [], 0, seq + 1
            if c is not None:
                held.append(str(c))
                size += len(held[-1]) + 1
    cols = list(zip(*out)) if out else [[]] * 4
    yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(("rep", "part", "seq", "ids"), cols, (pa.int64(), pa.int32(), pa.int64(), pa.string()))})


def _hashed(batches):
    """SHA-256 of each group's chunks, read one after the other."""
    rep, state, out = None, None, []
    for batch in batches:
        for r, ids in zip(batch.column("rep").to_pylist(), batch.column("ids").to_pylist()):
            if r != rep:
                if state:
                    out.append((rep, state.hexdigest()))
                rep, state = r, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if state:
        out.append((rep, state.hexdigest()))
    cols = list(zip(*out)) if out else [[]] * 2
    yield pa.RecordBatch.from_pydict({"rep": pa.array(cols[0], pa.int64()), "sha": pa.array(cols[1], pa.string())})


def distinct(convs: DataFrame, pages: DataFrame, folder: str) -> DataFrame:
    """c, w, len, ends: the smallest conversation of each sequence, how many have it and the hash of their ids."""
    prints = pages.groupBy("c").agg(*(F.bit_xor(F.xxhash64(F.lit(i), "page", "ids")).alias(f"f{i}") for i in range(2)))
    named = written(convs.join(prints, "c", "left").select("c", "len", F.concat_ws(":", "f0", "f1", "len").alias("key")), f"{folder}/named")
    classes = written(named.groupBy("key").agg(F.min("c").alias("rep"), F.count("*").alias("n"), F.first("len").alias("len")), f"{folder}/classes")
    copies = classes.where("n > 1")
    sha = F.sha2(F.col("rep").cast("string"), 256)
    if copies.limit(1).count():
        members = written(looked_up(named.select("key", "c"), "key", copies.select("key", "rep", "n")).select("rep", "c"), f"{folder}/members")
        chunks = members.repartitionByRange("rep", "c").sortWithinPartitions("rep", "c").mapInArrow(_chunked, "rep long, part int, seq long, ids string")
        hashes = chunks.repartition("rep").sortWithinPartitions("rep", "part", "seq").mapInArrow(_hashed, "rep long, sha string")
        classes, sha = classes.join(hashes, "rep", "left"), F.coalesce("sha", sha)
    return written(classes.select(F.col("rep").alias("c"), F.col("n").alias("w"), "len", sha.alias("ends")), f"{folder}/sequences")


def _chains(alone: DataFrame, pages: DataFrame) -> DataFrame:
    """Nodes of sequences that share no more turns with others: from depth d + 1 on, row by row."""
    rows = alone.join(pages, "c").where(F.col("page") >= F.floor(F.col("d") / PAGE))
    here = F.expr("aggregate(words, 0L, (a, x) -> a + x)")
    # sums of later pages are needed only where copies save tokens
    later = rows.where("w > 1").select("c", "page", here.alias("sum")).selectExpr("c", "page", "coalesce(sum(sum) OVER (PARTITION BY c ORDER BY page DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS later")
    once = rows.where("w = 1").withColumn("later", F.lit(0).cast("long"))
    each = once.unionByName(rows.where("w > 1").join(later, ["c", "page"])).select("*", F.posexplode("ids").alias("i", "id")).withColumn("pos", F.col("page") * PAGE + F.col("i")).where("pos >= d")
    saved = F.when(F.col("w") > 1, (F.col("w") - 1) * (F.col("later") + F.expr(f"aggregate(slice(words, i + 1, {PAGE}), 0L, (a, x) -> a + x)"))).otherwise(0)
    end = F.col("pos") + 1 == F.col("len")
    return each.select(
        (F.col("pos") == F.col("d")).alias("top"),
        F.col("c").alias("conv_id"),
        (F.col("pos") + 1).alias("depth"),
        F.when(F.col("pos") == F.col("d"), F.col("parent")).otherwise(F.col("c")).alias("parent_conv_id"),
        F.col("w").alias("n_convs"),
        F.when(end, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        saved.cast("long").alias("saved_tokens"),
        F.when(end, F.col("ends")).otherwise(F.lit(_NOBODY)).alias("ends_sha256"),
    )


def sorted_nodes(ids: list[list[int]], words: list[list[int]], convs: list[int], weights: list[int], ends: list[str], parent: int) -> list[list]:
    """Nodes of sequences (from the bucket's own turn on) by multikey quicksort: top, conv_id, depth in the bucket, parent, members, children, leaves, saved, ends.

    A group shares its first turns and is parted by the turn at `pos` into less, equal and greater; the equal part is a node."""
    nodes: list[list] = []
    above: list[int] = []
    work = [(list(range(len(ids))), 0, -1)]
    while work:
        group, pos, up = work.pop()
        if len(group) == 1:
            pivot = ids[group[0]][pos]
        else:
            pivot = ids[group[len(group) // 2]][pos]
            less, more = [i for i in group if ids[i][pos] < pivot], [i for i in group if ids[i][pos] > pivot]
            work += [(x, pos, up) for x in (less, more) if x]
            group = [i for i in group if ids[i][pos] == pivot]
        some, weight = group[0], sum(weights[i] for i in group)
        over = [i for i in group if len(ids[i]) == pos + 1]  # sequences differ, so one at most
        above.append(up)
        at = len(nodes)
        nodes.append([up < 0, min(convs[i] for i in group), pos + 1, parent if up < 0 else nodes[up][1], weight, 0, 0, (weight - 1) * words[some][pos], ends[over[0]] if over else _NOBODY])
        rest = [i for i in group if len(ids[i]) > pos + 1]
        if rest:
            work.append((rest, pos + 1, at))
    for at in range(len(nodes) - 1, -1, -1):  # children come after their parents
        node = nodes[at]
        node[6] = node[6] or 1
        if above[at] >= 0:
            up = nodes[above[at]]
            up[5] += 1
            up[6] += node[6]
            up[7] += node[7]
    return nodes


def _local(batches):
    held: list[list] = []

    def given():
        cols = list(zip(*held)) if held else [[]] * 9
        held.clear()
        kinds = [pa.bool_(), *[pa.int64()] * 7, pa.string()]
        return pa.RecordBatch.from_pydict({n.split()[0]: pa.array(c, t) for n, c, t in zip(_NODE.split(", "), cols, kinds)})

    for bucket in runs(batches, "bucket"):
        c, d, parent, w, ends, page, ids, words = (bucket.column(x).to_pylist() for x in ("c", "d", "parent", "w", "ends", "page", "ids", "words"))
        seqs: list[tuple] = []
        for i in range(len(c)):
            skip = max(0, d[i] - page[i] * PAGE)
            if i and c[i] == c[i - 1]:
                seqs[-1][0].extend(ids[i][skip:])
                seqs[-1][1].extend(words[i][skip:])
            else:
                seqs.append((ids[i][skip:], words[i][skip:], c[i], w[i], ends[i]))
        for node in sorted_nodes(*map(list, zip(*seqs)), parent[0]):
            node[2] += d[0]
            held.append(node)
        if len(held) > 5000:
            yield given()
    yield given()


def trie(turns: DataFrame, convs: DataFrame, folder: str) -> DataFrame:
    """All nodes of the sequences (turns: c, pos, h, words; convs: c, len, those without turns too)."""
    spark = turns.sparkSession
    pages = paged(turns, folder)
    live = distinct(convs, pages, folder).withColumn("bucket", F.lit(None).cast("long"))
    root = live.agg(F.min("c").alias("conv_id"), F.sum("w").alias("n_convs")).first()
    if root["conv_id"] is None:
        return spark.createDataFrame([], _NODE).select(*COLUMNS)
    live = live.withColumn("bucket", F.lit(root["conv_id"]))
    inner = [spark.createDataFrame([(root["conv_id"], None, root["n_convs"], 0)], "conv_id long, parent_conv_id long, n_convs long, words long")]
    over, given, d = [], [], 0
    while True:
        over.append(live.where(F.col("len") == d).select(F.col("bucket").alias("conv_id"), "ends"))
        digit = pages.where(F.col("page") == d // PAGE).select("c", F.get("ids", F.lit(d % PAGE)).alias("id"), F.get("words", F.lit(d % PAGE)).alias("words"))
        met = written(live.where(F.col("len") > d).join(digit, "c").withColumn("key", F.concat_ws(":", "bucket", "id")), f"{folder}/met-{d}")
        children = met.groupBy("key").agg(F.min("c").alias("conv"), F.first("bucket").alias("parent"), F.sum("w").alias("n_convs"), F.count("*").alias("n"), F.sum(F.col("len") - d).alias("rest"), F.max("words").alias("words"))
        children = written(children.withColumn("n_seqs", F.col("n")), f"{folder}/children-{d}")
        dealt = written(looked_up(met.select("key", "c", "w", "len", "ends"), "key", children.select("key", "conv", "parent", "n", "n_seqs", "rest")).withColumn("d", F.lit(d).cast("long")), f"{folder}/dealt-{d}")
        large = (F.col("n_seqs") > 1) & (F.col("rest") > LOCAL)
        given.append(dealt.where(~large))
        go_on = children.where(large)
        if not go_on.limit(1).count():
            break
        inner.append(go_on.select(F.col("conv").alias("conv_id"), F.col("parent").alias("parent_conv_id"), "n_convs", "words"))
        live = dealt.where(large).select("c", "w", "len", "ends", F.col("conv").alias("bucket"))
        d += 1
    rest = given[0]
    for x in given[1:]:
        rest = rest.unionByName(x)
    together = rest.where("n_seqs > 1").withColumn("bucket", F.concat_ws(":", "d", "conv")).select("bucket", "c", "w", "ends", "d", "parent")
    together = together.join(pages, "c").where(F.col("page") >= F.floor(F.col("d") / PAGE))
    local = together.repartition("bucket").sortWithinPartitions("bucket", "c", "page").mapInArrow(_local, _NODE)
    done = written(_chains(rest.where("n_seqs = 1"), pages).unionByName(local), f"{folder}/below")
    out = done.select(*COLUMNS)
    last = None
    for depth in range(len(inner) - 1, -1, -1):
        below = done.where(F.col("top") & (F.col("depth") == depth + 1)).select(*COLUMNS)
        below = below if last is None else below.unionByName(last)
        sums = below.groupBy(F.col("parent_conv_id").alias("conv_id")).agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"))
        nodes = inner[depth].join(sums, "conv_id", "left").join(over[depth], "conv_id", "left")
        last = written(
            nodes.select(
                "conv_id",
                F.lit(depth).cast("long").alias("depth"),
                "parent_conv_id",
                "n_convs",
                F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
                F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
                (F.coalesce("saved", F.lit(0)) + (F.col("n_convs") - 1) * F.col("words")).cast("long").alias("saved_tokens"),
                F.coalesce("ends", F.lit(_NOBODY)).alias("ends_sha256"),
            ),
            f"{folder}/inner-{depth}",
        )
        out = out.unionByName(last)
    return out


def query(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    folder = shared_dir(spark)
    out = trie(*rebuilt(conversations, folder), folder)
    for name in ("turns", "placed", "positions", "rebuilt", "dictionary", "named", "members"):
        drop(spark, f"{folder}/{name}")
    return out


SQL = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
    xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda acc, b: list_reduce(range(8), lambda a, i: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END), xor(acc, b)),
      CAST(4294967295 AS BIGINT)), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
parts AS (
  SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h),
seqs AS (
  SELECT c.conv_id, coalesce(list(md5(length(role) || ':' || role || text) ORDER BY own, pos) FILTER (own IS NOT NULL), []) AS seq,
    coalesce(list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY own, pos) FILTER (own IS NOT NULL), []) AS words
  FROM convs c LEFT JOIN parts p ON c.conv_id = p.conv_id GROUP BY c.conv_id),
prefixes AS (
  SELECT conv_id, CAST(d AS BIGINT) AS depth, len(seq) AS n, array_to_string(seq[1:d], ',') AS path, array_to_string(seq[1:d - 1], ',') AS above,
    CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words
  FROM seqs, unnest(range(0, len(seq) + 1)) AS r(d)),
nodes AS (
  SELECT path, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY path, depth),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.above = n.path) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.above),
ancestry AS (
  SELECT array_to_string(string_split(path, ',')[1:a], ',') AS path, a AS depth, n_children, (n_convs - 1) * words AS saved
  FROM linked, unnest(range(0, depth + 1)) AS r(a)),
summed AS (SELECT path, depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens FROM ancestry GROUP BY path, depth)
SELECT conv_id, l.depth, parent_conv_id, n_convs, CAST(n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM linked l JOIN summed s ON l.path = s.path AND l.depth = s.depth
"""
