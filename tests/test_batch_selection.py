"""A batch's selection against the choice one by one."""

import numpy as np
import pytest

from tallymart.operators import batch_selection
from tallymart.plans import merge_queries

SCHEMA = "id string, platform string, brand string, areas array<string>, rating_count long, rating double"


def one_by_one(rows, quota, platforms, controls, per_brand):
    left, chosen = dict(quota), {}
    pop = lambda r: (r["rating_count"] or 0) * 10 + (r["rating"] or 0)
    first, second = (sorted((r for r in rows if r["platform"] == p and r["brand"]), key=lambda r: (-pop(r), r["id"])) for p in platforms)

    def take(r, tier, key=None):
        if r["id"] in chosen or left.get(r["platform"], 0) <= 0:
            return False
        chosen[r["id"]] = (r["platform"], tier, key, r["brand"])
        left[r["platform"]] -= 1
        return True

    free = lambda d, t: left.get(platforms[0], 0) > 0 and left.get(platforms[1], 0) > 0 and d["id"] not in chosen and t["id"] not in chosen
    for d in first:
        for t in second:
            shared = sorted(set(d["areas"] or []) & set(t["areas"] or []))
            if d["brand"] == t["brand"] and shared and free(d, t):
                for x in (d, t):
                    take(x, "PAIR", f"{d['brand']}:{'+'.join(shared)}")
    paired, had = {x[3] for x in chosen.values()}, set()
    for d in first:
        if len(had) >= controls:
            break
        t = next((t for t in second if t["brand"] == d["brand"] and t["id"] not in chosen), None)
        if d["brand"] in paired | had or d["id"] in chosen or t is None or not free(d, t):
            continue
        for x in (d, t):
            take(x, "CONTROL", f"control:{d['brand']}")
        had.add(d["brand"])
    for rest in (first, second):
        count = {}
        for p, _, _, brand in chosen.values():
            if rest and p == rest[0]["platform"]:
                count[brand] = count.get(brand, 0) + 1
        for r in rest:
            if count.get(r["brand"], 0) < per_brand and take(r, "FILL"):
                count[r["brand"]] = count.get(r["brand"], 0) + 1
    return sorted((k, *v[:3]) for k, v in chosen.items())


def chosen(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed, quota, controls, cap", [(1, {"d": 25, "t": 30}, 4, 2), (2, {"d": 6, "t": 40}, 3, 1), (3, {"d": 200, "t": 200}, 50, 3), (4, {"d": 5}, 2, 2)])
def test_random_candidates(spark, seed, quota, controls, cap):
    rng = np.random.default_rng(seed)
    some = lambda x, p: x if rng.random() < p else None
    rows = [(f"{p}{i:03d}", p, some(f"b{rng.integers(0, 12)}", 0.95), [f"a{x}" for x in rng.integers(0, 8, rng.integers(0, 4))], some(int(rng.integers(0, 6)), 0.8), some(float(rng.integers(0, 5)), 0.8)) for p in "dtx" for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert chosen(batch_selection.selected(df, quota, ("d", "t"), controls, cap)) == one_by_one([r.asDict() for r in df.collect()], quota, ("d", "t"), controls, cap)


def test_query(spark, sf_dir):
    rows = [r.asDict() for r in merge_queries.selection_inputs(spark, sf_dir).collect()]
    want = one_by_one(rows, {"d": 40, "t": 60}, ("d", "t"), 5, 2)
    assert chosen(merge_queries.batch_selection_query(spark, sf_dir)) == want and {x[2] for x in want} >= {"PAIR", "FILL"}


def test_nobody(spark):
    assert chosen(batch_selection.selected(spark.createDataFrame([], SCHEMA), {"d": 5, "t": 5}, ("d", "t"))) == []
