"""Structured Streaming: windowed aggregates with a watermark, and merges of micro-batches that may arrive late or twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallymart.operators.merge import newer_wins


def hourly(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """Counts and sums by hour and type, on a table or a stream; a stream drops what is later than `late`."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("v"))


def merge_offers(stream: DataFrame, folder: str, checkpoint: str, keys: list[str]) -> StreamingQuery:
    """Each micro-batch is merged into the snapshot under `folder`; older observations never overwrite newer ones.

    Batch n reads snapshot n - 1 and writes snapshot n, so a batch that is run again writes the same snapshot again."""

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        w = Window.partitionBy(*keys).orderBy(F.desc("observed_at"), F.desc("price"))
        newest = batch.withColumn("_at", F.row_number().over(w)).where("_at = 1").drop("_at")
        if number:
            newest = newer_wins(spark.read.parquet(f"{folder}/{number - 1}"), newest, keys)
        newest.write.mode("overwrite").parquet(f"{folder}/{number}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
