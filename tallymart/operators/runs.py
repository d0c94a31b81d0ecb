"""Run logs: streaks, budgets, counters, roll-ups of status."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def failure_streaks(df: DataFrame, key: str, at: list[str], failed: Column) -> DataFrame:
    """Longest and latest run of consecutive failures per key (gaps and islands)."""
    w = Window.partitionBy(key).orderBy(*at)
    rows = df.withColumn("_f", failed.cast("int")).withColumn("_island", F.sum(1 - F.col("_f")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = rows.groupBy(key, "_island").agg(F.sum("_f").alias("n"))
    return runs.groupBy(key).agg(F.max("n").alias("longest"), F.max_by("n", "_island").alias("current"))


def within_budget(df: DataFrame, keys: list[str], order: list[str], cost: str, cap: int) -> DataFrame:
    """Calls in order, each accepted if what is left of its budget covers it; a refused call consumes nothing, nor does one
    without a cost. `spent` is what the budget has given after the call. Each call depends on all before it, so the calls of one
    budget (a day's) pass one task in order; a task holds one batch of rows and where its budget stands, whatever a budget's length."""
    def step(batches):
        budget, used = None, 0
        for batch in batches:
            spent, accepted = [], []
            for *now, c in zip(*(batch.column(k).to_pylist() for k in (*keys, cost))):
                if budget is None or any(a != b and (a == a or b == b) for a, b in zip(now, budget)):
                    budget, used = now, 0
                ok = c is not None and used + c <= cap
                used += c if ok else 0
                spent.append(used)
                accepted.append(ok)
            columns = [*batch.columns, pa.array(spent, pa.int64()), pa.array(accepted, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "spent", "accepted"])

    schema = T.StructType([*df.schema.fields, T.StructField("spent", T.LongType()), T.StructField("accepted", T.BooleanType())])
    in_order = df.repartition(*keys).sortWithinPartitions(*keys, *(F.asc_nulls_last(c) for c in order))
    return in_order.mapInArrow(step, schema)


def status_rollup(df: DataFrame, key: str, status: str) -> DataFrame:
    """Complete if all parts are, failed if none is, else partial."""
    done = F.col(status) == "F"
    return df.groupBy(key).agg(F.when(F.every(done), "complete").when(~F.some(done), "failed").otherwise("partial").alias("status"), F.count("*").alias("parts"))
