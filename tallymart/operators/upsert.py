"""Snapshots of a keyed table: upserts with a status for each row, rejected rows apart, one pointer to the current version.

Parquet tables have no MERGE, so an upsert writes the whole next snapshot beside the current one and then moves the pointer.
A reader sees the old or the new snapshot; a run that fails leaves the old one in place. There is one writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def issues(rules: dict[str, Column]) -> Column:
    """Names of the rules that a row breaks, in order; a rule that yields null is broken."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items()]))


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejects with their `issues`."""
    marked = df.withColumn("issues", issues(rules))
    return marked.where(F.size("issues") == 0).drop("issues"), marked.where(F.size("issues") > 0)


def upserted(stored: DataFrame, incoming: DataFrame, key: str, ignore: tuple[str, ...] = ()) -> DataFrame:
    """K2/M9: the next snapshot with `status` (created, updated, unchanged, kept); `ignore` names columns that alone make no update."""
    columns = [c for c in stored.columns if c != key]
    s, i = stored.alias("s"), incoming.alias("i")
    new, old = F.col(f"s.{key}").isNull(), F.col(f"i.{key}").isNull()
    same = F.lit(True)
    for c in columns:
        if c not in ignore:
            same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"i.{c}"))
    status = F.when(new, "created").when(old, "kept").when(same, "unchanged").otherwise("updated")
    take = [F.when(old, F.col(f"s.{c}")).otherwise(F.col(f"i.{c}")).alias(c) for c in columns]
    return s.join(i, F.col(f"s.{key}") == F.col(f"i.{key}"), "full_outer").select(F.coalesce(f"s.{key}", f"i.{key}").alias(key), *take, status.alias("status"))


def insert_absent(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """K3: only rows whose key is not stored."""
    return incoming.join(stored.select(key), key, "left_anti")


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def _pointers(self) -> list[int]:
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/current")
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(at)) if fs.exists(at) else []

    def read(self) -> DataFrame | None:
        found = self._pointers()
        if not found:
            return None
        name = self.spark.read.text(f"{self.path}/current/{found[-1]}").first()[0]
        return self.spark.read.parquet(f"{self.path}/{name}")

    def upsert(self, incoming: DataFrame, ignore: tuple[str, ...] = ()) -> dict[str, int]:
        """Writes the next snapshot and returns its counts by status."""
        stored, found = self.read(), self._pointers()
        stored = incoming.limit(0) if stored is None else stored
        name = f"snapshot-{uuid.uuid4().hex}"
        staged = f"{self.path}/staged-{name}"
        upserted(stored, incoming, self.key, ignore).write.parquet(staged)
        rows = self.spark.read.parquet(staged)
        counts = {r["status"]: r["count"] for r in rows.groupBy("status").count().collect()}
        rows.drop("status").write.parquet(f"{self.path}/{name}")
        number = (found[-1] + 1) if found else 0
        self.spark.createDataFrame([(name,)], "name string").coalesce(1).write.text(f"{self.path}/current/{number}")
        return counts
