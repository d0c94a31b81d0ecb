import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallymart.llm import forest, jaccard, trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return [w.decode() for w in (t or "").encode().lower().split()]


# --- language model ---


@pytest.mark.parametrize("n, top", [(1, 3), (1, 2**64 - 1), (700, 10**6), (900, 900), (500, 2**62), (800, 30), (64, 64), (5000, 9)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, top, n, dtype=np.uint64))
    e = trie.EliasFano(*trie.ef_encode(v).values())
    assert (e.get(np.arange(n)) == v).all() and (e.values() == v).all()
    q = np.r_[v, rng.integers(0, top, 300, dtype=np.uint64)]
    lo = (np.searchsorted(v, q) * rng.random(len(q))).astype(np.int64)  # what stands before is smaller
    hi = np.minimum(n, lo + rng.integers(0, n + 1, len(q)))
    want = [int(a + np.searchsorted(v[a:b], x)) for x, a, b in zip(q, lo, hi)]
    pos, equal = e.find(q, lo, hi)
    assert pos.tolist() == want and equal.tolist() == [i < b and v[i] == x for i, b, x in zip(want, hi, q)]


def model_by_hand(texts):
    """The same smoothing from plain dictionaries, without quantised codes."""
    c1, c2, c3 = Counter(), Counter(), Counter()
    for t in texts:
        ws = [*words(t), None]
        seq = ["<s>", *ws]
        c1.update(ws), c2.update(zip(seq, seq[1:])), c3.update(zip(seq, seq[1:], seq[2:]))
    n, v, d = sum(c1.values()), len(c1), trie.DISCOUNT
    types2, types3 = Counter(k[0] for k in c2), Counter(k[:2] for k in c3)
    total = lambda w: len(texts) if w == "<s>" else c1[w]
    p1 = lambda w: (c1[w] + 0.5) / (n + 0.5 * (v + 1))

    def p2(u, w):
        return (max(0, c2[u, w] - d) + d * types2[u] * p1(w)) / total(u) if types2[u] else p1(w)

    def p3(t, u, w):
        return (max(0, c3[t, u, w] - d) + d * types3[t, u] * p2(u, w)) / c2[t, u] if types3[t, u] else p2(u, w)

    def score(text):
        seq = ["<s>", *words(text), None]
        return sum(math.log10(p2(u, w) if t == "" else p3(t, u, w)) for t, u, w in zip(["", *seq], seq, seq[1:]))

    return score, p2, p3, c1, n, v


def check_scores(rows, texts, train, loose):
    score, p2, p3, c1, n, v = model_by_hand(train)
    assert len(rows) == len(texts)
    for r in rows:
        ws = [*words(texts[r.doc_id]), None]
        base = sum(math.log10((c1[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c1[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score(texts[r.doc_id]), abs=loose * len(ws))
    return p2, p3, c1, n, v


def test_trie_scores(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    train = [t for k, t in texts.items() if zlib.crc32(str(k).encode()) % 5 != 1]
    got = trie.query(docs).collect()
    p2, p3, c1, n, v = check_scores(got, texts, train, 0.02)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    context = next(w for w in c1 if w and c1[w] > 5)
    assert sum(p2(context, w) for w in [*c1, "\0new"]) == pytest.approx(1, abs=1e-9)
    assert len(trie.query(odd).collect()) == odd.count() and trie.query(none).collect() == []


def test_many_files_and_hot_words(spark):
    """Small files: many of words, many parts, frequent words and the beginning divided among several, counted in pieces."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(10_000 + i, "the the a the b " * (1 + i % 7)) for i in range(300)], "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = trie.learn(docs, part_tokens=100, file_words=500, count_tokens=777)
    assert model.bits > 2 and len(model.bounds) > 100 and model.vocabulary in model.hot and len(model.hot) > 3
    check_scores(trie.scored(docs, model).collect(), texts, list(texts.values()), 0.02)
    unseen = spark.createDataFrame([(1, "the nowhere the b"), (2, "nowhere"), (3, "b the the zzz"), (4, None), (5, "a " * 5000)], "doc_id long, text string")
    check_scores(trie.scored(unseen, model).collect(), {r.doc_id: r.text for r in unseen.collect()}, list(texts.values()), 0.03)


# --- nearest neighbours ---


def test_forest(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    extra = [(10_000, [float("nan")] * 64, 0), (10_001, [0.0] * 64, 0), (10_002, None, 0), (10_003, [1.0], 0), (10_004, [1.0] * 63 + [None], 0)]
    v = [float(x) for x in df.where("vec_id = 50").first().embedding]
    copies = [(i, v, 0) for i in range(20_000, 20_060)] + [(i, [2 * x for x in v], 0) for i in range(30_000, 30_003)]
    all_ = df.union(spark.createDataFrame(extra + copies, df.schema))
    rows = [(r.vec_id, r.embedding) for r in all_.collect() if r.vec_id < 10_000 or r.vec_id >= 20_000]
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=float)
    u = x / np.sqrt((x * x).sum(1))[:, None]
    got = defaultdict(list)
    for r in sorted(forest.query(all_).collect()):
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in ids.tolist() if i % 50 == 0}
    hit = n = 0
    for q, found in got.items():
        at = int(np.flatnonzero(ids == q)[0])
        s = np.round(u @ u[at], 12)
        want = [int(i) for i in ids[np.lexsort((ids, -s))] if i != q][:5]
        assert [f[0] for f in found] == [1, 2, 3, 4, 5]
        assert all(abs(s[int(np.flatnonzero(ids == f[1])[0])] - f[2]) < 1e-9 for f in found)
        hit, n = hit + len(set(want) & {f[1] for f in found}), n + 5
    assert hit / n >= 0.9
    assert forest.query(df.limit(0)).collect() == [] and forest.query(spark.createDataFrame(extra, df.schema)).collect() == []
    few = forest.query(df.where("vec_id in (0, 1, 2)")).collect()
    assert len(few) == 2


def test_forest_goes_on_until_it_has_all(spark, monkeypatch):
    rng = np.random.default_rng(11)
    vectors = np.concatenate([rng.normal(size=(700, 8)), -50 + rng.normal(size=(3, 8))])  # three far from all others
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(forest, "tuned", lambda *a, **b: (1, 1))  # one leaf a query
    got = forest.nearest(df, lambda i: i >= 690, sample=600, leaf=2).collect()
    assert sorted((r.query_id, r.rank) for r in got) == [(q, r) for q in range(690, 703) for r in range(1, 6)]
    assert all({r.vec_id for r in got if r.query_id == q} >= {700, 701, 702} - {q} for q in (700, 701, 702))


def test_forest_depth_and_cost(spark):
    """Depth grows beyond the sample's, and on clustered vectors few rows are visited for the recall."""
    rng = np.random.default_rng(1)
    centers = rng.standard_normal((400, 24)) * 3
    vectors = centers[rng.integers(0, 400, 12_000)] + rng.standard_normal((12_000, 24)) * 0.3
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    points = df.select(df.embedding.alias("v"))
    grown = forest.fit(points, 12_000, 24, sample=600, leaf=32)
    assert grown.depth == 8 and grown.depth > math.log2(600 / forest.SPLIT_ROWS)
    sizes = np.bincount(grown.leaves(forest.unit(vectors))[:, 0], minlength=256)
    assert sizes.max() < 12 * 32
    trees, visits = forest.tuned(points, grown, 12_000)
    assert trees >= 2 and visits * 12_000 / 256 < 0.2 * 12_000
    got = forest.nearest(df, lambda i: i % 50 == 0, sample=600, leaf=32).collect()
    u = forest.unit(vectors)
    hits = 0
    for q in range(0, 12_000, 50):
        s = u @ u[q]
        s[q] = -2
        hits += len(set(np.argsort(-s)[:5].tolist()) & {r.vec_id for r in got if r.query_id == q})
    assert hits >= 0.9 * 5 * 240


# --- near duplicates ---


def components_by_hand(texts):
    sets = {}
    for k, t in texts.items():
        ws = words(t)
        sets[k] = {tuple(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))} if ws else set()
    parent = {k: k for k in texts}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(k for k in sets if sets[k])
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if 10 * small >= 9 * large and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: (len(sets[k]), root(k)) for k in texts}


def test_jaccard(spark, sf_dir, odd, none):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 400, 130)]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if r.doc_id < 120}
    for i in range(90):  # a chain of edits and a star of edits of one text, at and around the threshold
        t = list(base if i % 2 else texts[1000 + i - 2].split() if i > 1 else base)
        for at in rng.integers(0, len(t), 1 + i % 5):
            t[at] = f"x{rng.integers(0, 50)}"
        texts[1000 + i] = " ".join(t)
    for i in range(20):  # short sets, in which one shingle more or less decides
        texts[2000 + i] = " ".join(base[: 9 + i % 7]) + (" tail" if i % 3 == 0 else "")
    texts |= {3000: None, 3001: "", 3002: "one", 3003: "ONE", 3004: "one two", 3005: " \n", 3006: "Él", 3007: "él"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.joined(df).collect()}
    assert got == components_by_hand(texts)
    rows = jaccard.joined(odd).collect()
    assert len(rows) == odd.count() and {r.component_id for r in rows if r.doc_id in (1, 5)} == {1}
    assert jaccard.joined(none).collect() == []


@pytest.mark.parametrize("percent", [80, 90])
def test_first_columns_never_miss(percent):
    rng, linked = np.random.default_rng(5), 0
    cells = rng.integers(0, 9, jaccard.CELLS).astype(np.uint8)
    for _ in range(800):
        n = int(rng.integers(4, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        d = int(rng.integers(1, max(2, len(a) // 4)))
        b = np.unique(np.r_[rng.permutation(a)[d // 2 :], rng.integers(0, 2**63, d - d // 2).astype(np.uint64)])
        both = len(np.intersect1d(a, b))
        if 100 * both >= percent * (len(a) + len(b) - both) and len(both := np.intersect1d(a, b)) < max(len(a), len(b)):
            linked += 1
            assert np.intersect1d(jaccard.first_columns(a, cells, percent), jaccard.first_columns(b, cells, percent)).size
            assert set(jaccard.ranges_of(len(a), percent)) & set(jaccard.ranges_of(len(b), percent))
            assert jaccard.apart(jaccard.sketch(a), jaccard.sketch(b)) <= len(np.setxor1d(a, b))
    assert linked > 100


def test_jaccard_odd_ids(spark):
    """Ids with several texts tie their texts' groups; rows without an id link like others; a hot group hangs together by members alone."""
    rows = [(2, "a a2 a3 a4"), (3, "b b2 b3 b4"), (7, "a a2 a3 a4"), (7, "b b2 b3 b4"), (8, "c c2 c3")]
    base = [f"w{i}" for i in range(60)]
    near = [*base[:-1], "tail"]
    rows += [(None, " ".join(near)), (20, " ".join(base)), (21, " ".join(["head", *near[1:]])), (None, "no one else"), (None, None), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.joined(df).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [(2, 2), (3, 2), (7, 2), (7, 2), (8, 8), (9, 9), (20, 20), (21, 20)]
    assert sorted(str(r.component_id) for r in got if r.doc_id is None) == ["20", "None", "None"]
    left = jaccard.representatives(spark.createDataFrame([(3, "b x y z"), (7, "b x y z"), (7, "c x y z"), (7, "c x y z"), (None, "c x y z")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in left) == [(3, "b x y z"), (7, "c x y z")]


@pytest.mark.parametrize("percent, edits, listed", [(90, 3, 0), (80, 7, 0), (80, 7, 8)])
def test_jaccard_hot_group(spark, monkeypatch, percent, edits, listed):
    """Many edits of one text at and around the threshold, so that most links are between members and not with the pivot."""
    monkeypatch.setattr(jaccard, "LISTED", listed)
    rng = np.random.default_rng(percent)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(220):
        t = list(base)
        for at in rng.choice(120, size=1 + int(rng.integers(0, edits)), replace=False):
            t[at] = f"x{rng.integers(0, 40)}"
        texts[i] = " ".join(t)
    sets = {i: {tuple(t.split()[j : j + 3]) for j in range(118)} for i, t in texts.items()}
    label = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in range(a):
                if label[a] != label[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.joined(df, percent=percent).collect()} == label
    assert len(set(label.values())) > 2
