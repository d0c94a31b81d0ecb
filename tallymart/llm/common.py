"""What the operators share: reading tables, the shared folder, written intermediates and text batches."""

from __future__ import annotations

import re
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space; bytes.split() on UTF-8 finds the same runs.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Texts that one vectorised step handles together.
STEP_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which the driver and all executors reach, as a full URI."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"  # one machine: a temporary folder is shared by all
    at = spark._jvm.org.apache.hadoop.fs.Path(base)
    full = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return f"{re.sub('^file:/+', 'file:///', full).rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """df as a table in the shared folder: later steps start from files, so a lost executor costs no recomputation."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete an intermediate that no later step reads."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(conf).delete(at, True)


def fold(key: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts."""
    return F.crc32(F.col(key).cast("string")) % F.lit(parts)


def fold_of(key: int, parts: int) -> int:
    return zlib.crc32(str(key).encode()) % parts


def text_steps(batches: Iterator[pa.RecordBatch], *columns: str, text: str = "text", step: int = STEP_BYTES) -> Iterator[tuple]:
    """(columns..., texts) as lists, at most `step` characters of text at once; a null text is empty."""
    for batch in batches:
        rest = [batch.column(c).to_pylist() for c in columns]
        held, start, size = [], 0, 0
        for i, t in enumerate(batch.column(text)):
            t = t.as_py() or ""
            if held and size + len(t) > step:
                yield (*(c[start:i] for c in rest), held)
                held, start, size = [], i, 0
            held.append(t)
            size += len(t)
        if held:
            yield (*(c[start:] for c in rest), held)


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m"):
    """Arrow batches of about `size` for the jobs run inside, where a task needs its memory for something else."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, was)


#: A key of more than one part in so many of all rows is hot; there can be no more such keys than this.
HOT_PARTS = 1000


def looked_up(rows: DataFrame, key: str, found: DataFrame, how: str = "inner", total: int | None = None) -> DataFrame:
    """rows with the columns of `found`, whose `key` is unique and whose `n` is the number of rows that hold it (or more).

    Keys with over 1/HOT_PARTS of all rows are at most HOT_PARTS, as the counts add up to the rows, so these are broadcast and
    their rows stay where they are; all others meet by shuffle, and none of them is large. rows should be a written table, as
    it is read more than once. The column n is left out."""
    share = (rows.count() if total is None else total) // HOT_PARTS
    hot, rest = found.where(F.col("n") > share), found.where(F.col("n") <= share).drop("n")
    if not hot.limit(1).count():
        return rows.join(rest, key, how)
    near = rows.join(F.broadcast(hot.drop("n")), key)
    return near.unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key, how))
