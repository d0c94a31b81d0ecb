"""Token-count rollups that change by deltas.

Every batch of changes becomes a few signed sums by source, language and tokenizer version: an insert adds a document and
its tokens, a delete takes them away, a revision takes the old count away and adds the new one, under another version if
that changed. Totals are the sum of all committed deltas, so a batch costs what it changes and never reads the corpus.

A batch's sums are written to a folder of their own, and a commit file named by the batch's id is then put in place by one
exclusive rename, which fails if the id was committed before: a batch counts wholly or not at all, and once. What a failed
or late run wrote is in no commit file and is never read.

A compaction adds up the deltas committed so far into one base, and its base file names the ids that are in it, so commits
that come meanwhile count beside it. Base files are numbered and put in place by an exclusive rename too: of two compactions
at once one is dropped. Nothing is deleted then: readers may still hold what a base replaces. `sweep` deletes, after a grace
time, what the newest base replaces and what no commit names.

Null sources and languages are groups of their own; null counts are zero; repeated rows count each. An empty batch is
committed and adds nothing. A null or empty text has no tokens.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import bpe
from tallymart.llm.common import shared_dir, small_batches, text_steps, written
from tallymart.llm.tokens import coder

KEYS = ["source", "lang", "tokenizer_version"]
SCHEMA = "source string, lang string, tokenizer_version int, n_docs long, n_tokens long"


def inserts(df: DataFrame) -> DataFrame:
    """df: source, lang, tokenizer_version, n_tokens."""
    return _signed(df, 1)


def deletes(df: DataFrame) -> DataFrame:
    return _signed(df, -1)


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    return deletes(old).unionByName(inserts(new))


def _signed(df: DataFrame, sign: int) -> DataFrame:
    tokens = F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)) * sign
    return df.select(F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("tokenizer_version").cast("int").alias("tokenizer_version"), F.lit(sign).cast("long").alias("n_docs"), tokens.alias("n_tokens"))


def _summed(df: DataFrame) -> DataFrame:
    out = df.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    return out.where("n_docs <> 0 OR n_tokens <> 0")


class TokenRollup:
    """deltas/<name>: sums of one batch; commits/<id>: the name that counts for it; bases/<number>: name of a base, then the ids in it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._at = jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(conf)
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at(self.path).toUri(), conf)
        self._no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        for folder in ("deltas", "commits", "bases", "aside"):
            self._fs.mkdirs(self._at(f"{self.path}/{folder}"))

    def _names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(f"{self.path}/{folder}")) if not s.getPath().getName().startswith((".", "_")))

    def _put(self, lines: list[str], final: str) -> bool:
        """A small text file, whole or not at all; False if it is there already."""
        aside = self._at(f"{self.path}/aside/{uuid.uuid4().hex}")
        out = self._fs.create(aside)
        out.write(bytearray("\n".join(lines).encode()))
        out.close()
        try:
            self._files.rename(aside, self._at(f"{self.path}/{final}"), self._no_options)
            return True
        except Exception:
            if not self._fs.exists(self._at(f"{self.path}/{final}")):
                raise
            self._fs.delete(aside, False)
            return False

    def _lines(self, name: str) -> list[str]:
        source = self._fs.open(self._at(f"{self.path}/{name}"))
        try:
            return bytes(source.readAllBytes()).decode().split("\n")
        finally:
            source.close()

    def _base(self) -> tuple[str | None, set[str]]:
        found = self._names("bases")
        if not found:
            return None, set()
        name, *ids = self._lines(f"bases/{found[-1]}")
        return name, set(ids)

    def committed(self, batch_id: str) -> bool:
        return self._fs.exists(self._at(f"{self.path}/commits/{_checked(batch_id)}"))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """True if this call committed the batch, False if it was committed before."""
        if self.committed(batch_id):
            return False
        name = uuid.uuid4().hex
        _summed(changes).write.parquet(f"{self.path}/deltas/{name}")
        if self._put([name], f"commits/{batch_id}"):
            return True
        self._fs.delete(self._at(f"{self.path}/deltas/{name}"), True)
        return False

    def totals(self) -> DataFrame:
        """source, lang, tokenizer_version, n_docs, n_tokens over all committed batches; groups that came to nothing are left out."""
        base, inside = self._base()
        names = [self._lines(f"commits/{i}")[0] for i in self._names("commits") if i not in inside]
        paths = [f"{self.path}/deltas/{n}" for n in ([base] if base else []) + names]
        return _summed(self.spark.read.schema(SCHEMA).parquet(*paths)) if paths else self.spark.createDataFrame([], SCHEMA)

    def compact(self) -> bool:
        """One base in place of all deltas committed so far; their ids stay known. False if another compaction came first, which then counts."""
        number, (base, inside), ids = len(self._names("bases")), self._base(), self._names("commits")
        names = [self._lines(f"commits/{i}")[0] for i in ids if i not in inside]
        if not names:
            return False
        name = uuid.uuid4().hex
        _summed(self.spark.read.schema(SCHEMA).parquet(*(f"{self.path}/deltas/{n}" for n in ([base] if base else []) + names))).write.parquet(f"{self.path}/deltas/{name}")
        if self._put([name, *sorted(inside | set(ids))], f"bases/{number:08d}"):
            return True
        self._fs.delete(self._at(f"{self.path}/deltas/{name}"), True)
        return False

    def sweep(self, grace_seconds: float = 86_400) -> int:
        """Deletes the sums that neither the newest base is nor a commit outside it names, if nobody has written to them for the grace time
        and the newest base is as old as that; returns how many. The grace time must exceed what a commit, a compaction or a reader takes."""
        now = self.spark._jvm.System.currentTimeMillis()
        old = lambda name: now - self._fs.getFileStatus(self._at(f"{self.path}/{name}")).getModificationTime() >= 1000 * grace_seconds
        bases = self._names("bases")
        if bases and not old(f"bases/{bases[-1]}"):
            return 0
        found = self._names("deltas")  # before the commits, so a delta that is committed meanwhile is seen as such
        base, inside = self._base()
        counts = {base} | {self._lines(f"commits/{i}")[0] for i in self._names("commits") if i not in inside}
        gone = [n for n in found if n not in counts and old(f"deltas/{n}")]
        for n in gone:
            self._fs.delete(self._at(f"{self.path}/deltas/{n}"), True)
        return len(gone)


def _checked(batch_id: str) -> str:
    if not batch_id.replace("-", "").replace("_", "").isalnum():
        raise ValueError("a batch id is made of letters, digits, - and _")
    return batch_id


def counted(documents: DataFrame, word_path: str, byte_path: str) -> DataFrame:
    """doc_id, source, lang and the tokens of each text: v1 by the word-level tokenizer, v2 by the byte-level one, which only documents of the recount need (others: null)."""

    def rows(batches):
        first, second = coder(word_path), bpe.codec(byte_path)
        for ids, sources, langs, again, texts in text_steps(batches, "doc_id", "source", "lang", "again"):
            v1 = [len(raw) // 4 for raw in first.encode(texts)]
            chosen = np.flatnonzero(again)
            v2 = np.full(len(texts), -1, dtype=np.int64)
            if len(chosen):
                v2[chosen] = [len(x) // 4 for x in second.encode([texts[i] for i in chosen])]
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "source": pa.array(sources, pa.string()), "lang": pa.array(langs, pa.string()), "v1": pa.array(v1, pa.int64()), "v2": pa.array(v2, pa.int64(), mask=v2 < 0)})
        first.trim()

    again = F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), "text", again.alias("again"))
    return docs.mapInArrow(rows, "doc_id long, source string, lang string, v1 long, v2 long")


def query(documents: DataFrame, word_path: str, byte_path: str) -> DataFrame:
    """All documents are loaded under version 1; every third is counted again under version 2; every seventh is deleted and
    put back; the recount is replayed. So the totals are of all documents, each under the version that counted it last."""
    spark = documents.sparkSession
    folder = shared_dir(spark)
    rollup = TokenRollup(spark, f"{folder}/rollup")
    with small_batches(spark):
        docs = written(counted(documents, word_path, byte_path), f"{folder}/counted")
    at = lambda df, version: df.select("source", "lang", F.lit(version).alias("tokenizer_version"), F.col(f"v{version}").alias("n_tokens"))
    third, seventh = docs.where("v2 IS NOT NULL"), docs.where("doc_id % 7 = 0")
    latest = at(seventh.where("v2 IS NULL"), 1).unionByName(at(seventh.where("v2 IS NOT NULL"), 2))
    rollup.commit("load", inserts(at(docs, 1)))
    rollup.commit("recount", revisions(at(third, 1), at(third, 2)))
    rollup.commit("takedown", deletes(latest))
    rollup.commit("recount", revisions(at(third, 1), at(third, 2)))
    rollup.compact()
    rollup.commit("restore", inserts(latest))
    return rollup.totals()
