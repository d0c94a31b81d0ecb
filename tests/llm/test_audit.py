"""The filter audit against its SQL and against filters applied one after the other."""

import re
from itertools import permutations

import duckdb
import numpy as np
import pytest

from tallymart.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic). Applies each order to the documents themselves."""
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    judged = []
    for k, text, lang in docs:
        text = text or ""
        ws = WORD.findall(text)
        fails = set("A" * (len(ws) < 100) + "B" * (100 * len(set(ws)) < 80 * len(ws)) + "C" * (100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text)) + "D" * any(c in "#$%&*|" for c in text))
        if k is not None and any(j is not None and j < k and (t or "") == text for j, t, _ in docs):
            fails.add("E")
        judged.append((lang or "", fails, k in good, k in toxic))
    out, shares = {}, {}
    for part in {x[0] for x in judged}:
        mine = [x for x in judged if x[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for s, f in enumerate(order):
                now = [x for x in left if f in x[1]]
                earlier = set(order[:s])
                left = [x for x in left if f not in x[1]]
                out[part, "".join(order), s + 1] = [len(left), len(now), sum(f in x[1] and bool(x[1] & earlier) for x in mine), sum(x[1] == {f} for x in mine), sum(x[2] for x in now), sum(x[3] for x in now)]
                shares[part, f] = shares.get((part, f), 0) + len(now)
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    rows = df.collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0, "x"), (1, 0, 1, "x"), (4, 1, 1, "x"), (5, None, 1, "x"), (None, 1, 1, "x"), (99, 1, 1, "x")], "doc_id long, quality int, toxic int, part string")


def test_odd_rows(spark, odd, none, labels):
    docs = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    want = by_hand(docs, [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])
    assert found(audit.query(odd.withColumn("part", odd.source).withColumn("h", odd.source).withColumn("mask", odd.source), labels)) == want
    assert audit.query(none, labels).collect() == [] and audit.query(none, labels.limit(0)).collect() == []


def test_many_parts_and_copies(spark, labels):
    rng = np.random.default_rng(3)
    docs = []
    for i in range(400):  # a hot text, a hot part, texts that fail by chance
        text = "hot" if i % 3 == 0 else " ".join(("W" if rng.random() < 0.3 else "w") + str(rng.integers(0, 150)) for _ in range(rng.integers(60, 160))) + "#" * (i % 5 == 0)
        docs.append((int(rng.integers(0, 300)) if i % 11 else None, text if i % 50 else None, None if i % 4 == 0 else f"l{rng.integers(0, 5)}" if i % 2 else "hot"))
    marked = [(k, int(rng.integers(0, 2)), int(rng.integers(0, 2))) for k in range(0, 300, 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(7)
    assert found(audit.query(df, spark.createDataFrame(marked, "doc_id long, quality int, toxic int"))) == by_hand(docs, marked)


def test_bitsets_of_many_parts():
    rng = np.random.default_rng(5)
    codes = np.r_[np.arange(70), rng.integers(0, 70, 5000)]
    flags = [rng.random(len(codes)) < p for p in (0.5, 0.1, 0.9, 0.3)]
    first, present, bits = audit.bitsets(codes, flags)
    counts = audit.prefix_counts(first, present, bits[:3], bits[3:])
    for p in (0, 13, 69):
        for subset in range(8):
            kept = (codes == p) & ~np.any([flags[i] for i in range(3) if subset >> i & 1] or [np.zeros(len(codes), bool)], axis=0)
            assert counts[p, subset].tolist() == [kept.sum(), (kept & flags[3]).sum()]


def test_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = audit.query(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels")))
    got = con.execute(audit.SQL)
    assert [c[0] for c in got.description] == df.columns
    assert sorted(map(tuple, df.collect())) == sorted(got.fetchall())
