"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import audit, bpe, convtrie, forest, jaccard, language, packing, quality, repeats, rollup, tokenfile, toxicity, trie
from tallymart.llm.common import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.query(table(spark, sf_dir, "documents"))


def op2_packed_token_ids(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return tokenfile.query(table(spark, sf_dir, "documents"), path or tokenizer_file("word_bpe_49k.json"))


def op3_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.query(table(spark, sf_dir, "documents"))


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.query(table(spark, sf_dir, "documents"))


def op6_token_rollup(spark: SparkSession, sf_dir: str, word_path: str | None = None, byte_path: str | None = None) -> DataFrame:
    return rollup.query(table(spark, sf_dir, "documents"), word_path or tokenizer_file("word_bpe_49k.json"), byte_path or tokenizer_file("byte_bpe_50k.json"))


def op7_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.query(table(spark, sf_dir, "embeddings"))


def op8_dominance_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), path or tokenizer_file("word_bpe_49k.json"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return bpe.query(table(spark, sf_dir, "documents"), path or tokenizer_file("byte_bpe_50k.json"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.query(table(spark, sf_dir, "conversations"))


def op13_interval_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.query(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_elias_fano_lm, op2_packed_token_ids, op3_toxicity_grammar, op4_compression_language, op5_line_quality, op6_token_rollup, op7_projection_forest, op8_dominance_packing, op9_ngram_jaccard, op10_byte_bpe, op11_filter_audit, op12_conversation_trie, op13_interval_repeats)}


def oracle_sql() -> dict[str, str]:
    return {"op5_line_quality": quality.SQL, "op11_filter_audit": audit.SQL, "op12_conversation_trie": convtrie.SQL}
