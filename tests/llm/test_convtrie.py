"""The conversation trie against a plain trie and its SQL."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest

from tallymart.llm import convtrie


def by_hand(rows):
    """rows: (conv_id, turn, role, text) with no ties between unequal turns of a number."""
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    seqs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        seqs[c] = own.get(base, [])[:h] + own[c][h:]
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        mine = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in mine) or 1
        saved[p] = sum(saved[k] for k in mine) + ((len(nodes[p]) - 1) * len(p[-1][1].encode().split()) if p else 0)
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(c for c in nodes[p] if len(seqs[c]) == len(p)))).encode()).hexdigest()
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p], sha(p)) for p, m in nodes.items())


SCHEMA = "conv_id long, turn long, role string, text string, c string, h int, page int"


def found(spark, rows, parts=5):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(parts)
    got = sorted(map(tuple, convtrie.query(df).collect()), key=lambda r: (r[0], r[1]))
    return got


def made(seed, n):
    rng = np.random.default_rng(seed)
    rows = []
    hot = [("user", f"hot words {i}") for i in range(5)]
    for c in range(-25, n):
        if rng.random() < 0.15:
            continue
        kind = rng.random()
        turns = hot[: rng.integers(1, 6)] if kind < 0.3 else [("user" if i % 2 else None, f"w {rng.integers(0, 3)}" if rng.random() < 0.9 else None) for i in range(rng.integers(1, 9))]
        if kind > 0.97:
            turns = [("user", f"long {i % 7}") for i in range(150)] + turns
        rows += [(c, i if i else None, *t) for i, t in enumerate(turns)]
    return rows


@pytest.mark.parametrize("local", [1024, 6])
def test_against_a_plain_trie(spark, monkeypatch, local):
    monkeypatch.setattr(convtrie, "LOCAL", local)
    rows = made(local, 160)
    if local < 1024:  # levels are as many as shared turns: long copies would make hundreds
        rows = [r for r in rows if (r[1] or 0) < 7]
    assert found(spark, rows) == by_hand(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "a", "b"), (0, None, None, None), (0, 1, "u", "x y"), (0, 1, "u", "x y"), (1, 0, "u", ""), (7, 5, "u", "only"), (21, 0, "s", "q"), (20, 0, "u", "w " * 30000)]
    assert found(spark, rows) == by_hand(rows)
    assert found(spark, [], 1) == [] and found(spark, [(None, 1, "a", "b")]) == []
    assert found(spark, [(3, 1, "a", "b")]) == by_hand([(3, 1, "a", "b")])


def test_long_conversation_over_partitions(spark):
    rng = np.random.default_rng(9)
    rows = [(40, i, "u", f"t{i // 2 * 2}") for i in rng.permutation(3000).tolist()] + [(41, i, "u", f"t{i // 2 * 2}" if i < 5 else f"s{i}") for i in range(2000)] + [(c, 0, "u", "t0") for c in range(60, 90)]
    assert found(spark, rows, 7) == by_hand(rows)


def test_groups_of_copies(spark, monkeypatch):
    monkeypatch.setattr(convtrie, "CHUNK", 30)
    rows = [(c, i, "u", f"same {i} words") for c in range(300) for i in range(3)]
    assert found(spark, rows) == by_hand(rows)


def test_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    df = convtrie.query(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    got = con.execute(convtrie.SQL)
    assert [c[0] for c in got.description] == df.columns
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, df.collect()), key=key) == sorted(got.fetchall(), key=key)
