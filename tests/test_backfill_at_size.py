"""Listings without a pin meet all groups of their block, but write down no list of these."""

import pytest

from tallymart.operators import backfill
from tests.test_backfill import SIGNALS, made, one_by_one, planned


def test_weak_pairs_without_a_pin_are_not_listed(spark, tmp_path):
    """A pair of a listing and each of the 30 groups of its block used to be written."""
    at = {"names": ["a"], "brands": [], "city": "c", "area": None, "address": None, "lat": None, "lng": None}
    listings = [{"id": f"{i:03d}", "created_at": i, "platform": "t", **at, "address": f"{i % 7} road"} for i in range(80)]
    groups = [{"group_id": f"G{i:02d}", **at, "area": f"area {i % 3}"} for i in range(30)]
    rejected = {(f"{i:03d}", f"G{j:02d}") for i in range(0, 80, 9) for j in range(29 + i % 2)}
    frame = lambda rows, schema: spark.createDataFrame([tuple(r.values()) if isinstance(r, dict) else r for r in rows], schema)
    none = spark.createDataFrame([], "id string, group_id string, status string, platform string")
    df = backfill.plan(frame(listings, f"id string, created_at long, platform string, {SIGNALS}"), frame(groups, f"group_id string, {SIGNALS}"), none, frame(list(rejected), "id string, group_id string"), f"file://{tmp_path}/work")
    got = {r.id: (r.outcome, r.status, r.method, r.confidence, r.group_id, r.seed, r.conflict) for r in df.collect()}
    assert got == one_by_one(listings, groups, [], rejected)
    assert spark.read.parquet(f"file://{tmp_path}/work/edges").count() <= 2 * 80


@pytest.mark.parametrize("seed", [3])
def test_classes_against_one_by_one(spark, seed):
    """Many listings that say the same, with and without rejections."""
    listings, groups, mappings, rejected = made(seed, 60)
    more = [{**x, "id": f"x{x['id']}", "created_at": (x["created_at"] or 0) + 7, "platform": "q"} for x in listings]
    data = listings + more, groups + [{**g, "group_id": f"H{g['group_id']}"} for g in groups], mappings, rejected
    assert planned(spark, *data) == one_by_one(*data)
