"""From raw documents to packed training sequences: quality rules, language ID, near-duplicate join, best-fit packing.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. Each stage works on all
that its predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import jaccard, language, packing, quality
from tallymart.llm.common import fold, shared_dir, table, written
from tallymart.llm.queries import tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, null and empty texts among them; of the others the failing lines go, and n_chars follows. Repeated rows are judged alike."""
    judged = quality.judged(docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text")))
    kept = judged.where("kept").select(*(F.col(f"row.{c}").alias(c) for c in docs.columns if c != "text"), F.col("clean_text").alias("text"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters (null and empty texts too) or with a narrow margin go; the others carry the language that was found."""
    languages = language.fit(docs.where(fold("doc_id", 4) != 2).select("doc_id", "text", "lang"))
    row = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = language.labelled(row, languages).where(~F.col("rejected"))
    return found.select(*(F.col("lang_pred").alias(c) if c == "lang" else F.col(f"row.{c}").alias(c) for c in docs.columns))


#: Near copies share at least 80 % of their 5-word shingles; op9's 3 words and 90 % bind that query alone.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the row of the smallest id stays, one without an id last. Rows without words stay; of equal rows one stays."""
    return jaccard.representatives(docs, k=NEAR_SHINGLE, percent=NEAR_PERCENT)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of each document, repeated rows and null or empty texts (one end id) included; other columns go."""
    return packing.packed(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("quality rules", quality_rules), ("language ID", language_id), ("n-gram Jaccard join", one_of_each_group), ("best-fit packing", packed_sequences)]

#: The language and packing stages have no SQL; tests/llm hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), shared_dir(spark)
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{i}")
    return docs
