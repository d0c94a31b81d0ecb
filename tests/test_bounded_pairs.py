"""Steps that met all pairs of a group: results against loops, and plans that hold no list of pairs."""

import itertools

from pyspark.sql import functions as F

from tallymart.operators import bundles, decisions, menu_search, upkeep


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_cells_first_cards_are_found_before_the_join(spark):
    sources = [(i, f"cell00{i % 2}xx", ["a", "b", ""][i % 3]) for i in range(12)] + [(3, "cell000yy", "b"), (3, "cell000yy", "b")]
    cards = [(100 + i, f"cell00{i % 2}zz", ["a", "b", ""][i % 3], [2, 1, None, 1][i % 4]) for i in range(40)] + [(100, "cell000zz", "a", 2)]
    s, c = spark.createDataFrame(sources, "source long, geohash string, brand string"), spark.createDataFrame(cards, "card long, geohash string, brand string, place int")
    every = upkeep.nearby_branches(s, c).collect()
    got = upkeep.nearby_branches(s, c, most=2)
    order = lambda r: (r.place is not None, r.place or 0, r.card)
    want = [r for _, rs in itertools.groupby(sorted(every, key=lambda r: r.source), key=lambda r: r.source) for r in sorted(rs, key=order)[:2]]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want))
    below = _plan(got).split("Join", 1)[1]
    assert "row_number() windowspecdefinition(cell" in below


def test_group_candidates_without_a_list_of_pairs(spark, monkeypatch):
    monkeypatch.setattr(menu_search, "CLASS_ROW", 3)  # classes of several rows
    keys = lambda i: [f"n{i % 3}", None, f"b{i % 2}", f"n{i % 3}"] if i % 11 else []
    sources, groups = [(i, keys(i), f"c{i % 3}" if i % 5 else None) for i in range(60)], [(i, keys(i), f"c{i % 2}" if i % 7 else None) for i in range(50)]
    s, g = (spark.createDataFrame(x, "id long, keys array<string>, city string") for x in (sources, groups))
    meets = lambda a, b: {k for k in a[1] if k} & {k for k in b[1] if k} and (a[2] is None or b[2] is None or a[2] == b[2])
    got = menu_search.group_candidates(s, g)
    assert sorted(tuple(r) for r in got.collect()) == sorted((a[0], b[0]) for a in sources for b in groups if meets(a, b))
    assert "Aggregate [id1" not in _plan(got)


def test_search_works_out_items_once(spark):
    """Keys that a UDF makes are not made again for each of the joins."""
    items = spark.createDataFrame([(i, f"rice {i}") for i in range(30)], "id long, name string").withColumn("key", F.udf(str.lower, "string")("name"))
    split = F.split("key", " ")
    items = items.select("id", F.array("key").alias("names"), F.array().cast("array<string>").alias("aliases"), split.alias("keywords"), split.alias("name_tokens"), F.col("key").alias("display"))
    got = menu_search.ranked(items, menu_search.normalized_queries(spark.createDataFrame([(1, "rice 7"), (2, "ric")], "qid int, query string")), 3)
    assert "udf" not in _plan(got).lower() and "Python" not in _plan(got)
    assert sorted((r.qid, r.place, r.id, r.tier, r.truncated) for r in got.collect()) == [(1, 1, 7, 1, True), (1, 2, 0, 4, True), (1, 3, 1, 4, True), (2, 1, 0, 4, True), (2, 2, 1, 4, True), (2, 3, 2, 4, True)]


def test_namesakes_are_not_paired_with_reviews(spark):
    schema = "target long, group_id long, status string, name_en string, name_ar string, category_en string, category_ar string, portion string"
    canon = [(i, i % 2, "active" if i % 9 else "retired", f"n{i % 13}" if i % 4 else None, f"a{i % 17}" if i % 3 else None, "c", "d", None) for i in range(40)]
    reviews = [(i, i % 2, "matcher", i % 45, ["AMBIGUOUS_CANDIDATES"], f"n{i % 13}" if i % 5 else None, f"a{i % 17}" if i % 7 else None, "c", "d", None) for i in range(120)]
    r = spark.createDataFrame(reviews, "item long, group_id long, decided_by string, target long, conflicts array<string>, name_en string, name_ar string, category_en string, category_ar string, portion string")
    got = decisions.approval_skips(r, spark.createDataFrame(canon, schema), unique_twins=True)
    twins = lambda x: {c[0] for c in canon if c[2] == "active" and c[1] == x[1] and (x[5] is not None and c[3] == x[5] or x[6] is not None and c[4] == x[6])}
    assert {y.item: y.waived for y in got.collect()} == {x[0]: twins(x) == {x[3]} for x in reviews}
    joins = [line for line in _plan(got).splitlines() if "Join" in line]
    assert len(joins) == 3 and all("LeftOuter" in line for line in joins)  # an inner join would list the namesakes of each review


def test_names_of_listings_are_read_once_for_all_searches(spark):
    rows = [(f"q{q}", i, r, None, n, 10.0, True) for q in range(3) for i, (r, n) in enumerate([("A", "Samsung Galaxy S24 Black"), ("B", "Samsung Galaxy S24"), ("A", ""), ("C", None), ("C", "Lego City")])]
    got = bundles.placed(spark.createDataFrame(rows, "query string, seq long, retailer string, external_id string, name string, price double, available boolean"))
    assert sorted((r.query, r.seq, r.bundle) for r in got.collect()) == [(f"q{q}", i, b) for q in range(3) for i, b in ((0, 0), (1, 0), (4, 4))]
    assert "Aggregate [name" in _plan(got)
