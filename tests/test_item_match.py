"""Candidates of an item share any of its tokens, not only the rarest."""

from tallymart.operators import item_match

SCHEMA = "id long, grp string, tokens array<string>, category string, size double"


def test_all_shared_tokens_count(spark):
    items = spark.createDataFrame([(1, "g", ["red", "big", "steel", "odd"], "c", 1.0), (2, "h", ["alone"], "c", 1.0)], SCHEMA)
    canon = spark.createDataFrame([(10, "g", ["red", "big", "steel"], "c", 1.0), (11, "g", ["odd"], "x", 1.0), (12, "g", ["red", "big", "tin"], "x", 1.0), (13, "g", ["new"], "c", 1.0), (14, "h", ["red"], "c", 1.0)], SCHEMA)
    assert sorted(map(tuple, item_match.candidates(items, canon).collect())) == [(1, 10), (1, 11), (1, 12)]
    got = {r.item: (r.canonical, r.confidence, r.status) for r in item_match.decide(items, item_match.scores(items, canon)).collect()}
    assert got == {1: (10, 0.911, "MATCHED"), 2: (None, None, "UNMATCHED")}


def test_a_runner_up_without_the_rarest_token_takes_the_margin(spark):
    items = spark.createDataFrame([(1, "g", ["a", "b", "c", "d", "rare"], "c", 1.0)], SCHEMA)
    canon = spark.createDataFrame([(10, "g", ["a", "b", "c", "d", "rare"], "c", 1.0), (11, "g", ["a", "b", "c", "d"], "c", 1.0)], SCHEMA)
    got = item_match.decide(items, item_match.scores(items, canon)).first()
    assert (got.canonical, got.confidence, got.status) == (10, 1.0, "REVIEW")  # 0.931 is within the margin


def test_classes_decide_like_rows(spark):
    """Copies on both sides, sizes that differ and missing ones, ties and no partner."""
    words = [["a", "b"], ["a", "c"], ["c", "b", None], ["d"], ["a", "b", "e", "f"], ["c", "c"]]
    row = lambda i, s: (i, f"g{i % 2}" if i % 29 else None, words[i * s % 6], "xy"[i // 5 % 2] if i % 17 else None, float(i * s % 4) if i % 3 else None)
    items = spark.createDataFrame([row(i, 7) for i in range(1, 100)], SCHEMA)
    for canon in ([row(1000 + i, 5) for i in range(80)], [row(1000 + i, 5) for i in range(5)], []):
        canon = spark.createDataFrame(canon, SCHEMA)
        want = sorted(map(repr, item_match.decide(items, item_match.scores(items, canon)).collect()))
        assert sorted(map(repr, item_match.matched(items, canon).collect())) == want
    twin = spark.createDataFrame([(1, "g", ["a"], "c", 1.0)], SCHEMA), spark.createDataFrame([(10, "g", ["a"], "c", 1.0), (11, "g", ["a"], "c", 1.0)], SCHEMA)
    assert tuple(item_match.matched(*twin).first()) == (1, 10, 1.0, "REVIEW")
