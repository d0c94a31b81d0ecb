"""Menus written to the store: items are worked out once for a write, whatever is asked of them."""

from pyspark.sql import functions as F

from tallymart.operators.menu_store import MenuStore
from tests.test_menu_store import batch, item, rows, run_of, store  # noqa: F401


def test_items_are_worked_out_once(spark, store):  # noqa: F811
    made = spark.sparkContext.accumulator(0)

    def counted(name):
        made.add(1)
        return name

    restaurants, categories, items, pages = batch(spark, [("a", "A")], [], [item("a", f"i{k}", f"n{k}") for k in range(9)] + [item("a", "i1", "n1")])
    items = items.withColumn("name", F.udf(counted, "string").asNondeterministic()("name"))
    got = store.write(restaurants, categories, items, pages, "en", "r1", "2024-01-01")
    assert made.value == 10
    # of two equal records one is stored
    assert rows(got, "source_key", "code") == [("i1", "DUPLICATE_KEY")] and MenuStore(spark, store.path, 4).read("items").count() == 9 and run_of(store, "r1")["a"].items_rejected == 1
