"""Duplicate listings on two platforms, and the mappings after their merge."""

from tallymart.operators import duplicate_listings as dup

LISTING = "restaurant string, platform string, brand string, brands array<string>, city string, area string, address string, lat double, lng double, dishes array<string>"


def listing(r, lat, dishes=("a",), brand="x", brands=(), city="c", area=None):
    return (r, r[0], brand, list(brands), city, area, None, lat, 55.0, list(dishes))


def test_pairs_and_merges(spark):
    m = 1 / 111_195  # degrees of a metre
    rows = [
        listing("d1", 25.0), listing("t1", 25 + 60 * m),  # near: menus do not matter
        listing("d2", 26.0, "abcde"), listing("t2", 26 + 140 * m, "abcdxyz"),  # 0.8 of the smaller menu
        listing("d3", 27.0, "abcde"), listing("t3", 27 + 140 * m, "abcxyz"),  # 0.6
        listing("d4", 28.0, "ab"), listing("t4", 28 + 160 * m, "ab"),  # too far
        listing("d5", 29.0), listing("t5", 29.0), listing("t6", 29 + 10 * m),  # two partners
        listing("d7", 30.0, brand="p", brands=["q"]), listing("t7", 30.0, brand="r", brands=["q"]),
        listing("d8", 31.0, brand="p"), listing("t8", 31.0, brand="r"), listing("d9", None), listing("t9", None),
        listing("d10", 32.0, city="e"), listing("t10", 32.0), listing("d11", 33.0, area="marina"), listing("t11", 33 + 140 * m, area="deira"),
        listing("d12", 34.0, []), listing("t12", 34 + 140 * m, []), listing("d13", 35.0), listing("t13", 35.0),
    ]
    mappings = [(r[0], f"g-{r[0]}", "REVIEW" if r[0] in ("d1", "d7", "t7") else "MATCHED") for r in rows] + [("other", "g-d13", "MATCHED"), ("gone", "g-d1", "UNMATCHED")]
    maps = spark.createDataFrame(mappings, "restaurant string, grp string, status string")
    listings = spark.createDataFrame(rows, LISTING).join(dup.alone(maps), "restaurant")
    pairs = dup.candidates(listings, "d", "t")
    assert sorted((r.id1, r.id2, r.metres, r.overlap) for r in pairs.collect()) == [("d1", "t1", 60, 1.0), ("d2", "t2", 140, 0.8), ("d5", "t5", 0, 1.0), ("d5", "t6", 10, 1.0), ("d7", "t7", 0, 1.0)]
    plan = dup.merges(dup.unambiguous(pairs))
    assert sorted((r.id1, r.anchor, r.moving, r.outcome, r.joins, r.retired) for r in plan.collect()) == [
        ("d1", "t1", "d1", "merged", "g-t1", None), ("d2", "t2", "d2", "merged", "g-t2", "g-d2"), ("d7", "d7", "t7", "ANCHOR_NOT_MATCHED", None, None),
    ]
    after = {r.restaurant: (r.grp, r.status) for r in dup.applied(maps, plan).collect()}
    assert (after["d1"], after["d2"], after["d7"], after["t2"]) == (("g-t1", "MATCHED"), ("g-t2", "MATCHED"), ("g-d7", "REVIEW"), ("g-t2", "MATCHED")) and len(after) == len(mappings)


def test_nothing(spark):
    none = spark.createDataFrame([], LISTING + ", grp string, matched boolean")
    assert dup.merges(dup.unambiguous(dup.candidates(none, "d", "t"))).collect() == []


def test_a_partner_that_is_ambiguous_itself_still_counts(spark):
    """t1 has two partners, one of which has another one too: no pair of the three is certain."""
    m = 1 / 111_195
    rows = [listing("d1", 25.0), listing("t1", 25 + 60 * m), listing("d2", 25 + 120 * m), listing("t2", 25 + 180 * m), listing("d3", 26.0, brand="p", brands=["q", "q", None]), listing("t3", 26.0, brand="p", brands=["q"])]
    listings = spark.createDataFrame(rows, LISTING).selectExpr("*", "restaurant AS grp", "true AS matched")
    pairs = dup.candidates(listings, "d", "t")
    assert sorted((r.id1, r.id2) for r in pairs.collect()) == [("d1", "t1"), ("d2", "t1"), ("d2", "t2"), ("d3", "t3")]
    assert [(r.id1, r.id2) for r in dup.unambiguous(pairs).collect()] == [("d3", "t3")]
    assert [(r.id1, r.id2) for r in dup.lone_pairs(listings, "d", "t").collect()] == [("d3", "t3")]
    plan = dup.lone_pairs(listings, "d", "t").groupBy("id1").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "id2#" not in plan.split("Join")[0].split("Aggregate")[0]
