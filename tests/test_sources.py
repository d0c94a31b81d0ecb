from pyspark.sql import functions as F

from tallymart.operators import upsert
from tallymart.sources import semistructured as S

PAGE = """<html><script type="application/ld+json">{"@graph": [{"@type": "Product", "name": "Mug",
 "offers": {"price": "1,234.50", "priceCurrency": "aed", "availability": "https://schema.org/OutOfStock"},
 "aggregateRating": {"ratingValue": 8, "bestRating": 10}}, {"@type": "Thing"}]}</script>
<script type="application/ld+json">{broken</script>
<script type="application/ld+json">[{"@type": "Product", "name": "Cup", "offers": [{"price": -1}]}]</script>
<script id="__NEXT_DATA__">{"props": {"items": [{"id": 1}, {"id": 2}]}}</script></html>"""


def test_json_ld(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "page_id long, html string")
    got = sorted(map(tuple, S.products(S.json_ld_nodes(pages)).collect()))
    assert got == [(1, "Cup", None, None, None, None), (1, "Mug", 1234.5, "AED", False, 4.0)]
    assert S.state(pages, "$.props.items").select("page_id", "position", F.expr("try_variant_get(row, '$.id', 'long')")).collect() == [(1, 0, 1), (1, 1, 2)]


def test_robots(spark):
    rules = spark.createDataFrame([("a", False, "/x"), ("a", True, "/x/y"), ("b", False, "/"), ("b", True, "/")], "host string, allow boolean, prefix string")
    urls = spark.createDataFrame([("a", "/x/1"), ("a", "/x/y/1"), ("a", "/z"), ("b", "/q"), ("c", "/")], "host string, path string")
    assert sorted(map(tuple, S.robots_allow(rules, urls).collect())) == [("a", "/x/1", False), ("a", "/x/y/1", True), ("a", "/z", True), ("b", "/q", True), ("c", "/", True)]


def test_upsert(spark, tmp_path):
    t = upsert.SnapshotTable(spark, str(tmp_path / "t"), "id")
    rows = lambda *x: spark.createDataFrame(x, "id long, v string, seen int")
    assert t.read() is None
    assert t.upsert(rows((1, "a", 1), (2, None, 1))) == {"created": 2}
    assert t.upsert(rows((1, "b", 2), (2, None, 2), (3, "c", 2)), ignore=("seen",)) == {"updated": 1, "unchanged": 1, "created": 1}
    assert sorted(map(tuple, t.read().collect())) == [(1, "b", 2), (2, None, 2), (3, "c", 2)]
    assert [tuple(r) for r in upsert.insert_absent(t.read(), rows((3, "x", 1), (4, "y", 1)), "id").collect()] == [(4, "y", 1)]


def test_validation(spark):
    df = spark.createDataFrame([(1, "a"), (-1, None), (None, "b")], "id long, v string")
    good, bad = upsert.split_valid(df, {"id positive": F.col("id") > 0, "v present": F.col("v").isNotNull()})
    assert good.count() == 1 and sorted(r.issues for r in bad.collect()) == [["id positive"], ["id positive", "v present"]]
