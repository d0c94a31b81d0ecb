"""Budgets in order, without a group of rows for each."""

from tallymart.operators import runs


def test_budget_over_several_batches(spark):
    calls = [(d or None, i, None if i % 11 == 5 else 1 + (i * 7 + d) % 25) for d in range(41) for i in range(9)]
    expected, used = set(), {}
    for d, i, c in calls:
        ok = c is not None and used.get(d, 0) + c <= 40
        used[d] = used.get(d, 0) + (c if ok else 0)
        expected.add((d, i, used[d], ok))
    rows = spark.createDataFrame(calls, "day int, at int, cost long")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, "4")
    try:
        found = runs.within_budget(rows, ["day"], ["at"], "cost", 40)
        assert {(r.day, r.at, r.spent, r.accepted) for r in found.collect()} == expected
    finally:
        spark.conf.set(key, was)
    assert "FlatMapGroups" not in found._jdf.queryExecution().executedPlan().toString()
