"""The near-copy stage at 5 words and 80 % against brute force."""

import numpy as np
import pytest

import corpus_pipeline
from tallymart.llm import jaccard
from tests.llm.test_models import words

K, PERCENT = 5, 80


def components(texts, k=K, percent=PERCENT):
    sets = {}
    for i, t in texts.items():
        ws = words(t)
        sets[i] = {tuple(ws[j : j + k]) for j in range(max(1, len(ws) - k + 1))} if ws else set()
    label = {i: i for i in texts}
    links = [(a, b) for a in texts for b in texts if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(label[a], label[b])
            changed |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    return label


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rng = np.random.default_rng(8)
    found = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    base = [f"w{i}" for i in rng.integers(0, 900, 100)]
    for i in range(60):  # stars and chains of one to five edits in 100 words
        t = list(base if i % 3 else found[100_000 + i - 3].split() if i > 2 else base)
        for at in rng.integers(0, len(t), 1 + i % 5):
            t[at] = f"x{rng.integers(0, 50)}"
        found[100_000 + i] = " ".join(t)
    for i in range(24):  # short sets, in which one shingle more or less decides
        found[200_000 + i] = " ".join(base[: 5 + i % 12]) + (" tail" if i % 3 == 0 else "")
    return found


def test_two_edits_in_a_hundred_words(spark):
    base = [f"w{i}" for i in range(100)]
    edited = [*base]
    edited[30], edited[70] = "x", "y"
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(edited))], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()] == [1]


def test_stage(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = components(texts)
    assert {r.doc_id: r.component_id for r in jaccard.joined(docs, k=K, percent=PERCENT).collect()} == want
    assert sorted(r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()) == sorted(set(want.values()))


@pytest.mark.parametrize("percent", [30, 50, 60])
def test_low_shares(spark, percent):
    """Linked rows can be of very different sizes then."""
    rng = np.random.default_rng(percent)
    texts, at = {}, 0
    for size in (3, 5, 8, 11, 18, 40, 90):
        base = [f"b{size}-{i}" for i in range(size)]
        for share in (percent - 4, percent, percent + 3):
            longer = base + [f"t{at}-{i}" for i in range(size * 100 // share - size)]
            mixed = base[: size * 2 // 3] + [f"m{at}-{i}" for i in range(rng.integers(0, size))]
            for t in (base, longer, mixed):
                texts[at] = " ".join(t)
                at += 1
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.joined(docs, k=1, percent=percent).collect()} == components(texts, 1, percent)


def test_columns_of_any_name_stay(spark):
    texts = ["one two three four five six seven", "one two three four five six seven", "other words that nobody else has here"]
    docs = spark.createDataFrame([(i, t, f"h{i}", i, "k") for i, t in enumerate(texts)], "doc_id long, text string, _h string, _h2 long, _k string")
    got = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [(0, texts[0], "h0", 0, "k"), (2, texts[2], "h2", 2, "k")]


def test_pairs_of_a_large_group(spark, monkeypatch):
    """Rows of one group that share an element of their differences are pairs only if they can link: the joins made 1,958 pairs of these 500 rows."""
    rng = np.random.default_rng(5)
    base, made, rows = [f"w{i}" for i in range(60)], [], 500
    texts = {0: " ".join(base)}
    for i in range(1, rows):
        t = [*base]
        for at in rng.choice(len(t), 2 + i % 4, replace=False):
            t[at] = f"x{rng.integers(0, 12)}"
        texts[i] = " ".join(t)
    plain = jaccard._Work.counted

    def counted(self, diffs, pairs, name):
        made.append((name, pairs.count()))
        return plain(self, diffs, pairs, name)

    monkeypatch.setattr(jaccard._Work, "counted", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.joined(docs, k=K, percent=PERCENT).collect()} == components(texts)
    assert dict(made)["across"] <= rows, made


def test_parities_are_a_lower_bound():
    rng = np.random.default_rng(6)
    for size in (0, 1, 40, 300):
        a, b = (np.unique(rng.integers(0, 1 << 62, size, dtype=np.uint64)) for _ in range(2))
        b = np.unique(np.concatenate([a[: size // 2], b]))
        odd = sum(bin((int(x) ^ int(y)) & (1 << 64) - 1).count("1") for x, y in zip(jaccard.parities(a), jaccard.parities(b)))
        assert odd <= len(np.setxor1d(a, b)) and (size == 0 or odd > 0)
