"""Repeated strings against a count of all windows."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from tallymart.llm import repeats


def by_hand(texts, w=400):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + w] for r in raws for i in range(len(r) - w + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, dtype=bool)
        for i in range(len(r) - w + 1):
            if seen[r[i : i + w]] > 1:
                gone[i : i + w] = True
        flat = gone[:-1]
        out.append((len(r), int(flat.sum()), int((gone[:-1] & ~np.r_[False, gone[:-2]][: len(r)]).sum()) if len(r) else 0, hashlib.sha256(bytes(np.frombuffer(r, np.uint8)[~flat])).hexdigest()))
    return out


def prose(rng, n):
    return "".join(rng.choice(list("abcdefgh é\n"), n))


def mixed(seed, n_docs):
    """Copies, near copies, passages of about the window's length in other surroundings, periodic and short texts."""
    rng = np.random.default_rng(seed)
    passages = [prose(rng, n) for n in (380, 399, 400, 401, 430, 700, 1500)]
    docs = [None, "", "x" * 399, "x" * 400, "ab" * 900, "y" * 3000, "漢字" * 120, "漢字" * 90 + "x"]
    for i in range(n_docs):
        t = prose(rng, rng.integers(0, 900))
        for _ in range(rng.integers(0, 4)):
            p = passages[rng.integers(0, len(passages))]
            if rng.random() < 0.4:
                a, b = sorted(rng.integers(0, len(p), 2))
                p = p[a:b]
            t += p + prose(rng, rng.integers(0, 300))
        if docs and rng.random() < 0.2:
            t = docs[rng.integers(2, len(docs))]
            if rng.random() < 0.6 and t:
                at = rng.integers(0, len(t))
                t = t[:at] + "#" + t[at + 1 :]
        docs.append(t)
    return docs


def measured(spark, docs, parts=5):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(docs)], "doc_id long, text string, row string, gram int").repartition(parts)
    found = sorted(repeats.query(df).collect())
    assert [r.doc_id for r in found] == list(range(len(docs)))
    return [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found]


@pytest.mark.parametrize("local", [512, 2])
def test_against_all_windows(spark, monkeypatch, local):
    monkeypatch.setattr(repeats, "LOCAL", local)  # 2: almost every core is divided
    docs = mixed(local, 90)
    assert measured(spark, docs) == by_hand(docs)


def test_hot_passage(spark, monkeypatch):
    monkeypatch.setattr(repeats, "LOCAL", 20)
    rng = np.random.default_rng(1)
    p = prose(rng, 520)
    docs = [prose(rng, 250) + p[: 520 - i % 90] + prose(rng, 260) for i in range(120)]
    assert measured(spark, docs) == by_hand(docs)


def test_long_texts_in_pieces(spark):
    rng = np.random.default_rng(2)
    long = "".join(map(chr, rng.integers(97, 123, 2_500_000)))
    p = long[1_048_000:1_049_000]  # across the edge of two pieces
    found = measured(spark, [long, "z" * 500 + p, long[:450]], 2)
    want = "".join((long[450:1_048_000], long[1_049_000:]))
    assert found[0] == (2_500_000, 1450, 2, hashlib.sha256(want.encode()).hexdigest())
    assert found[1][1:3] == (1101 + 0, 2) or found[1][1:3] == (1500, 1)
    assert found[2][1:3] == (450, 1)


def test_odd_rows(spark, odd, none):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    want = sorted((str(k), *x) for (k, _), x in zip(docs, by_hand([t for _, t in docs])))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.query(odd).collect()) == want
    assert repeats.query(none).collect() == []


def test_groups_hold_all_occurrences():
    rng = np.random.default_rng(6)
    for _ in range(60):
        n = int(rng.integers(2, 12))
        rights, lefts = ([bytes(rng.integers(97, 99, rng.integers(0, 6)).tolist()) for _ in range(n)] for _ in range(2))
        agree = lambda i, j: (repeats.common(lefts[i][::-1], lefts[j][::-1]), repeats.common(rights[i], rights[j]))
        want = set()
        for i in range(n):
            for j in range(i):
                a, b = agree(i, j)
                for x in range(a + 1):
                    for y in range(b + 1):
                        members = [m for m in range(n) if agree(i, m)[0] >= x and agree(i, m)[1] >= y]
                        if min(agree(p, q)[0] for p in members for q in members if p < q) == x and min(agree(p, q)[1] for p in members for q in members if p < q) == y:
                            want.add((x, y, tuple(members)))
        got = repeats.maximal_repeats(lefts, rights, 0)
        assert sorted((a, b, tuple(sorted(m))) for a, b, m in got) == sorted(want)
        assert {(a, b) for a, b, _ in repeats.maximal_repeats(lefts, rights, 0, whole=False)} <= {(a, b) for a, b, _ in want}


def test_groups_of_documents(spark):
    rng = np.random.default_rng(7)
    p = prose(rng, 450)
    docs = [prose(rng, 300) + "1" + p + "2" + prose(rng, 300), prose(rng, 280) + "3" + p + "4" + prose(rng, 300), "5" + p[:430] + "6"]
    raws = [t.encode() for t in docs]
    found = repeats.Repeats(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").coalesce(1), groups=True).spans.collect()
    by_group = {}
    for r in found:
        raw = raws[(r.row & 0xFFFFFFFF) - 1]
        by_group.setdefault(bytes(r.grp), set()).add((r.row, r.start, raw[r.start : r.start + r.len]))
    assert all(len({x[2] for x in g}) == 1 and len(g) > 1 for g in by_group.values())
    held = {next(iter(g))[2]: len(g) for g in by_group.values()}
    assert held[p.encode()] == 2 and held[p[:430].encode()] == 3


def test_kept_text(spark):
    p = "".join(map(chr, np.random.default_rng(4).integers(97, 123, 600)))
    df = spark.createDataFrame([(1, "a" + p), (2, p + "b"), (3, "clean")], "doc_id long, text string")
    found = {r.doc_id: r.kept for r in repeats.Repeats(df).cut(with_text=True).collect()}
    assert found == {1: b"a", 2: b"b", 3: b"clean"}
