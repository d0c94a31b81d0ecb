"""Merged bundles against the fold over them, one after the other."""

import numpy as np
from pyspark.sql import functions as F

from tallymart.operators import bundle_merge

SCHEMA = (
    "seq long, name string, retailers array<struct<retailer: string, external_id: string, url: string, price: double, in_stock: boolean, observed_at: string>>, tags array<string>, "
    "images array<string>, description string, rating double, review_count long, retailer_count int, lowest_price double, highest_price double, survivor string"
)


def keys_of(b):
    out = ["name:" + " ".join(b["name"].lower().split())]
    for r in b["retailers"] or []:
        if r[1]:
            out.append(f"{r[0]}:id:{r[1]}")
        elif r[2]:
            out.append(f"{r[0]}|{r[2]}")
    return out


def folded(bundles):
    at, done = {}, []
    for b in sorted(bundles, key=lambda b: b["seq"]):
        if not b["name"]:
            continue
        keys = keys_of(b)
        prev = next((at[k] for k in keys if k in at), None)
        if prev is None:
            prev = {**b, "retailers": list(b["retailers"] or []), "tags": list(dict.fromkeys(b["tags"] or [])), "images": list(b["images"] or []), "members": 1}
            done.append(prev)
        else:
            prev["members"] += 1
            for o in b["retailers"] or []:
                i = next((i for i, r in enumerate(prev["retailers"]) if r[0] == o[0]), None)
                if i is None:
                    prev["retailers"].append(o)
                elif (o[5] or "") >= (prev["retailers"][i][5] or ""):
                    prev["retailers"][i] = o
            prev["tags"] = list(dict.fromkeys(prev["tags"] + (b["tags"] or [])))
            if len(b["images"] or []) > len(prev["images"]):
                prev["images"] = list(b["images"])
            prev["description"] = prev["description"] if prev["description"] is not None else b["description"]
            if (-1 if b["review_count"] is None else b["review_count"]) > (-1 if prev["review_count"] is None else prev["review_count"]):
                prev["rating"], prev["review_count"] = b["rating"], b["review_count"]
            prices = [o[3] for o in prev["retailers"] if o[3] and o[3] > 0 and o[4] is not False]
            prev["retailer_count"], prev["lowest_price"], prev["highest_price"] = len(prev["retailers"]), min(prices, default=None), max(prices, default=None)
        for k in keys:
            at[k] = prev
    return done


def made(seed, n, names, ids):
    rng = np.random.default_rng(seed)
    some = lambda x, p=0.8: x if rng.random() < p else None
    out = []
    for seq in rng.permutation(n * 3)[:n].tolist():
        offers = [(f"r{rng.integers(0, 4)}", some(str(rng.integers(0, ids)), 0.6), some(f"https://shop.example/a/{rng.integers(0, ids)}"), some(float(rng.integers(-1, 9))), [True, False, None][rng.integers(0, 3)], some(f"2024-01-0{rng.integers(1, 5)}")) for _ in range(rng.integers(0, 4))]
        name = f"  Name {rng.integers(0, names)}" if rng.random() < 0.95 else ["", None][rng.integers(0, 2)]
        out.append({"seq": seq, "name": name, "retailers": some(offers, 0.95), "tags": some([f"t{x}" for x in rng.permutation(5)[: rng.integers(0, 4)]]), "images": some(["i"] * rng.integers(0, 4)), "description": some(f"d{seq}", 0.3), "rating": some(1.0), "review_count": some(int(rng.integers(0, 5))), "retailer_count": 7, "lowest_price": 1.5, "highest_price": 2.5, "survivor": "x"})
    return out


FIELDS = ("seq", "members", "name", "tags", "images", "description", "rating", "review_count", "retailer_count", "lowest_price", "highest_price")


def check(spark, bundles):
    df = spark.createDataFrame([tuple(b.values()) for b in bundles], SCHEMA).repartition(5).drop("survivor")
    got = sorted(bundle_merge.merged(df).collect())
    want = sorted(folded(bundles), key=lambda b: b["seq"])
    assert [tuple(r[f] for f in FIELDS) for r in got] == [tuple(b[f] for f in FIELDS) for b in want]
    assert [[tuple(o) for o in r.retailers] for r in got] == [b["retailers"] for b in want]


def test_random_bundles(spark):
    check(spark, made(1, 150, 400, 40))  # names rarely meet, listings form chains
    check(spark, made(2, 150, 12, 2000))


def test_blocks_and_repointing(spark, monkeypatch):
    monkeypatch.setattr(bundle_merge, "BLOCK", 3)
    check(spark, made(3, 120, 30, 30))


def test_long_chain(spark):
    keys = [(i, j, f"k{i - j}") for i in range(300) for j in range(2)]  # each bundle shares its second key with the one before
    df = spark.createDataFrame(keys, "seq long, at int, key string")
    assert {r.survivor for r in bundle_merge.survivors(df, bundle_merge.shared_folder(spark)).collect()} == {0}
    assert bundle_merge.parents(df).where(F.col("seq") - F.col("parent") > 1).count() == 0


def test_repointed_keys(spark):
    """3 has a key of 1 and one of 2: it joins 1, and the key of 2 points to 1 from then on, though 2 stays."""
    df = spark.createDataFrame([(1, 0, "a"), (2, 0, "b"), (3, 0, "a"), (3, 1, "b"), (4, 0, "b")], "seq long, at int, key string")
    assert {r.seq: r.survivor for r in bundle_merge.survivors(df, bundle_merge.shared_folder(spark)).collect()} == {1: 1, 2: 2, 3: 1, 4: 1}


def test_no_bundles(spark):
    assert bundle_merge.merged(spark.createDataFrame([], SCHEMA).drop("survivor")).collect() == []
