"""The plan of an identity run against the decisions taken one after the other."""

import math

import numpy as np
import pytest

from tallymart.operators import backfill
from tallymart.plans import merge_queries

SIGNALS = "names array<string>, brands array<string>, city string, area string, address string, lat double, lng double"


def metres(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return math.floor(2 * 6_371_000 * math.asin(min(1, math.sqrt(h))) + 0.5)


def verdict(s, t):
    """None, or (strong, method, confidence)."""
    name, brand = set(s["names"]) & set(t["names"]), set(s["brands"]) & set(t["brands"])
    if not name and not brand:
        return None
    d = metres((s["lat"], s["lng"]), (t["lat"], t["lng"])) if None not in (s["lat"], t["lat"]) else None
    near = d is not None and d <= 75
    if s["city"] and t["city"] and s["city"] != t["city"]:
        return None
    areas = s["area"] and t["area"] and (f" {s['area']} " in f" {t['area']} " or f" {t['area']} " in f" {s['area']} ")
    if s["area"] and t["area"] and not areas and not near:
        return None
    if d is not None and d > 500:
        return None
    address = s["address"] and s["address"] == t["address"]
    for ok, method, c in ((name and address, "NAME_ADDRESS", 0.95), (name and near, "NAME_LOCATION", 0.9), (brand and address, "BRAND_NAME_ADDRESS", 0.85)):
        if ok:
            return True, method, c
    return False, "EXACT_NAME" if name else "BRAND_NAME_ADDRESS", 0.5 if areas or (s["city"] and s["city"] == t["city"]) else 0.3


def one_by_one(listings, groups, mappings, rejected):
    held = {m["id"]: m for m in mappings if m["status"] in ("MATCHED", "REVIEW")}
    known = [(0, g["group_id"], g) for g in sorted(groups, key=lambda g: g["group_id"])]
    claims = {}
    for m in held.values():
        if m["status"] == "MATCHED":
            claims.setdefault((0, m["group_id"]), set()).add(m["platform"])
    out = {}
    for n, s in enumerate(sorted(listings, key=lambda x: (x["created_at"] is not None, x["created_at"] or 0, x["id"]))):
        if s["id"] in held:
            out[s["id"]] = ("ALREADY_MAPPED", held[s["id"]]["status"], None, None, held[s["id"]]["group_id"], None, None)
            continue
        matches, reviews = [], []
        for new, k, g in known:
            if not new and (s["id"], k) in rejected:
                continue
            v = verdict(s, g)
            if v is None:
                continue
            again = v[0] and s["platform"] in claims.get((new, k), ())
            rank = (-(0.5 if again else v[2]), new, g["n"] if new else 0, k)
            (matches if v[0] and not again else reviews).append((rank, new, k, v[1], -rank[0], again))
        target = lambda x: (x[2], None) if not x[1] else (None, x[2])
        if len(matches) == 1:
            x = matches[0]
            claims.setdefault((x[1], x[2]), set()).add(s["platform"])
            out[s["id"]] = ("MATCHED_EXISTING_GROUP", "MATCHED", x[3], x[4], *target(x), None)
        elif matches or reviews:
            x = min(matches or reviews)
            conflict = "MULTIPLE_CANDIDATES" if len(matches or reviews) > 1 else "SAME_PLATFORM_ALREADY_MAPPED" if x[5] else None
            out[s["id"]] = ("REVIEW", "REVIEW", x[3], 0.5 if matches else x[4], *target(x), conflict)
        elif s["address"] or s["area"] or s["lat"] is not None:
            known.append((1, s["id"], {**s, "n": n}))
            claims[1, s["id"]] = {s["platform"]}
            out[s["id"]] = ("GROUP_CREATED", "MATCHED", "SEED", 1.0, None, s["id"], None)
        else:
            out[s["id"]] = ("UNMATCHED", "UNMATCHED", None, None, None, None, "BRANCH_IDENTITY_UNKNOWN")
    return out


def made(seed, n):
    rng = np.random.default_rng(seed)
    some = lambda x, p: x if rng.random() < p else None
    pick = lambda *xs: xs[rng.integers(0, len(xs))]

    def signals(dense):
        pinned = rng.random() < 0.7
        names = [f"n{rng.integers(0, 6)}" for _ in range(rng.integers(1, 3))]
        return {"names": names, "brands": [f"b{names[0][1:]}"] if rng.random() < 0.6 else [], "city": some(pick("dubai", "sharjah"), 0.8), "area": some(pick("marina", "dubai marina", "deira", ""), 0.4), "address": some(f"{rng.integers(0, 5)} road", 0.5), "lat": float(25 + rng.integers(0, dense) * 0.0005) if pinned else None, "lng": float(55 + rng.integers(0, 2) * 0.0003) if pinned else None}

    listings = [{"id": f"{i:03d}", "created_at": some(int(rng.integers(0, 40)), 0.95), "platform": pick("t", "d", "n"), **signals(12)} for i in range(n)]
    groups = [{"group_id": f"G{i:02d}", **signals(12)} for i in range(8)]
    mappings = [{"id": x["id"], "group_id": some(f"G{rng.integers(0, 8):02d}", 1) if s != "UNMATCHED" else None, "status": s, "platform": x["platform"]} for x in listings if rng.random() < 0.3 for s in [pick("MATCHED", "REVIEW", "UNMATCHED")]]
    mappings += [{"id": "old", "group_id": "G01", "status": "MATCHED", "platform": "t"}]
    rejected = {(f"{rng.integers(0, n):03d}", f"G{rng.integers(0, 8):02d}") for _ in range(60)}
    return listings, groups, mappings, rejected


def planned(spark, listings, groups, mappings, rejected):
    frame = lambda rows, schema: spark.createDataFrame([tuple(r.values()) if isinstance(r, dict) else r for r in rows], schema)
    df = backfill.plan(
        frame([{**x, "outcome": "x"} for x in listings], f"id string, created_at long, platform string, {SIGNALS}, outcome string").repartition(4), frame(groups, f"group_id string, {SIGNALS}"),
        frame(mappings, "id string, group_id string, status string, platform string"), frame(list(rejected), "id string, group_id string"),
    )
    return {r.id: (r.outcome, r.status, r.method, r.confidence, r.group_id, r.seed, r.conflict) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_one_by_one(spark, seed):
    data = made(seed, 90)
    assert planned(spark, *data) == one_by_one(*data)


def test_later_listings_see_earlier_decisions(spark):
    at = {"names": ["a"], "brands": [], "city": "c", "area": None, "address": "1 road", "lat": None, "lng": None}
    listings = [{"id": str(i), "created_at": i, "platform": p, **at} for i, p in enumerate("tdtd")]
    got = planned(spark, listings, [], [], set())
    assert [got[str(i)][0] for i in range(4)] == ["GROUP_CREATED", "MATCHED_EXISTING_GROUP", "REVIEW", "REVIEW"]
    assert got["2"][5] == "0" and got["3"][6] == "SAME_PLATFORM_ALREADY_MAPPED"


def test_query(spark, sf_dir):
    listings, groups, mappings, rejected = ([r.asDict() for r in df.collect()] for df in merge_queries.identity_inputs(spark, sf_dir))
    want = one_by_one(listings, groups, mappings, {(r["id"], r["group_id"]) for r in rejected})
    got = {r.id: (r.outcome, r.status, r.method, r.confidence, r.group_id, r.seed, r.conflict) for r in merge_queries.identity_backfill(spark, sf_dir).collect()}
    assert got == want and len({x[0] for x in got.values()}) == 5


def test_no_listings(spark):
    assert planned(spark, [], [], [], set()) == {}


def test_listings_that_fit_a_stored_group_do_not_meet_one_another(spark, tmp_path):
    at = {"names": ["a"], "brands": ["x"], "city": "c", "area": None, "address": None, "lat": None, "lng": None}
    rows = [(f"{i:02d}", i, "t", *({**at, "area": "z"} if i % 2 else {**at, "names": ["n"], "brands": [], "address": "1 road"}).values()) for i in range(20)]
    listings = spark.createDataFrame(rows, f"id string, created_at long, platform string, {SIGNALS}")
    groups = spark.createDataFrame([("G", *at.values())], f"group_id string, {SIGNALS}")
    none = spark.createDataFrame([], "id string, group_id string, status string, platform string")
    got = {r.id: r.outcome for r in backfill.plan(listings, groups, none, none.select("id", "group_id"), f"file://{tmp_path}/work").collect()}
    assert got["00"] == "GROUP_CREATED" and {got[f"{i:02d}"] for i in range(1, 20)} == {"REVIEW"}
    met = spark.read.parquet(f"file://{tmp_path}/work/among")
    assert {(int(r.id1[2:]) % 2, int(r.id2[2:]) % 2) for r in met.collect()} == {(0, 0)} and met.count() == 45
