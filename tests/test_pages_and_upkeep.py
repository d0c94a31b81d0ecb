"""Files, empty tables and null columns of the page, decision and upkeep operators."""

import tempfile

from pyspark.sql import functions as F

from tallymart.functions import tags
from tallymart.operators import bundles, records, upkeep
from tallymart.sources import feeds, grocery


def test_bundles_written_and_read(spark):
    folder = tempfile.mkdtemp(prefix="spark-")
    with open(f"{folder}/in.json", "w") as f:
        f.write('{"bundles": [{"name": "a", "price": 1.5},\n {"name": "b"}], "at": "x"}')
    read = feeds.bundles(spark, f"file://{folder}/in.json")
    assert sorted(r["name"] for r in read.collect()) == ["a", "b"]
    grocery.write_bundles(read.withColumn("embedding", F.array(F.lit(1.0))), f"file://{folder}/out")
    again = spark.read.json(f"file://{folder}/out")
    assert sorted(again.columns) == ["name", "price"] and again.count() == 2
    with open(f"{folder}/none.json", "w") as f:
        f.write('{"at": "x"}')
    assert feeds.bundles(spark, f"file://{folder}/none.json").count() == 0


def test_empty_and_null_rows(spark):
    items = "query string, seq long, retailer string, external_id string, name string, price double, available boolean"
    assert bundles.placed(spark.createDataFrame([], items)).count() == 0
    alone = bundles.placed(spark.createDataFrame([("q", 1, "A", None, "x", None, None), ("q", 2, "A", None, None, 1.0, True)], items)).collect()
    assert [(r["seq"], r["bundle"]) for r in alone] == [(1, 1)]
    docs = "id long, match_key string, created_at long, images array<string>, tags array<string>, rating double, review_count long"
    rows = spark.createDataFrame([(1, None, 1, None, None, None, None), (2, "k", None, None, None, None, None), (3, "k", None, [], ["t"], 1.0, None)], docs)
    survivors, folded, clusters = upkeep.cluster_merge(rows)
    assert [(r["id"], r["images"], r["tags"], r["rating"]) for r in survivors.collect()] == [(2, [], ["t"], 1.0)]
    assert [r["id"] for r in folded.collect()] == [3] and clusters.count() == 1
    assert all(f.count() == 0 for f in upkeep.cluster_merge(rows.where("id = 1")))


def test_rehosted_keeps_the_last_image(spark):
    d = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "c", "c"]), (3, None)], "id long, images array<string>")
    o = spark.createDataFrame([(1, "r", "a"), (2, "r", "a"), (3, "r", None)], "id long, retailer string, image string")
    moved, gone = spark.createDataFrame([("c", "new")], "url string, new string"), spark.createDataFrame([("a",), ("b",)], "url string")
    galleries, offers = records.rehosted(d, o, moved, gone)
    assert {r["id"]: (r["images"], r["kept_last"]) for r in galleries.collect()} == {1: (["a", "b"], True), 2: (["new"], False)}
    assert {r["id"]: r["image"] for r in offers.collect()} == {1: "a", 2: "new", 3: None}


def test_modifier_digest_tells_menus_apart(spark):
    schema = "g array<struct<max: int, name: string, options: array<struct<name: string, price: double>>>>"
    menus = [[(1, "size", [("s", 1.0)])], [(1, "size", [("s", 1.0)])], [(2, "size", [("s", 1.0)])], [(None, "size", None)], [], None]
    found = [r["d"] for r in spark.createDataFrame([(m,) for m in menus], schema).select(tags.modifier_digest(F.col("g")).alias("d")).collect()]
    assert found[0] == found[1] and found[0]["hash"] != found[2]["hash"] and found[3]["options"] == 0 and found[4] is None and found[5] is None
