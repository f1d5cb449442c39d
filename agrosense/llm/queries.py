"""Registered queries of the corpus operators: ``opN_<name>(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrosense.llm.collocations import collocations
from agrosense.llm.common import table
from agrosense.llm.conversations import repaired_conversations
from agrosense.llm.decontaminate import contamination
from agrosense.llm.licenses import license_scan
from agrosense.llm.minmax import near_duplicates
from agrosense.llm.mixing import mix_sources
from agrosense.llm.outliers import quality_rules
from agrosense.llm.overlap_join import jaccard_components
from agrosense.llm.rules import score_documents
from agrosense.llm.shards import byte_shards
from agrosense.llm.suffixes import cut_repeats
from agrosense.llm.tokens import read_tokens, write_tokens
from agrosense.llm.warc import read_archives, write_archives
from agrosense.session import fresh_path


def op1_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents by a sparse rule ensemble."""
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight contiguous shards of nearly equal bytes."""
    return byte_shards(table(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside a 10-word window of a benchmark item."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all sources takes from each document."""
    return mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def token_digest(docs: DataFrame) -> DataFrame:
    """Encode ``docs``, write the token files, read them back and digest what was read."""
    import public_tokenizers

    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "token-files")
    write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), path)
    return read_tokens(spark, path, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    return token_digest(table(spark, sf_dir, "documents"))


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated WARC archives of all pages, read back."""
    path = fresh_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).drop("html")


def op7_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (three-word shingles, Jaccard 0.85)."""
    return near_duplicates(table(spark, sf_dir, "documents"), 3, (85, 100))


def op8_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and robust outlier verdicts of all documents."""
    return quality_rules(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    return license_scan(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document that repeat 50 bytes of a document with a smaller id."""
    return cut_repeats(table(spark, sf_dir, "documents"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents linked by a Jaccard similarity of 0.9 (three-word shingles)."""
    return jaccard_components(table(spark, sf_dir, "documents"), 3, (90, 100))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language over all documents."""
    return collocations(table(spark, sf_dir, "documents"))


def op13_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of the role structure of every damaged conversation."""
    return repaired_conversations(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_rule_ensemble, op2_byte_shards, op3_token_files, op4_decontaminate, op5_mix_sources, op6_warc_revisits,
    op7_minmax_dedup, op8_robust_outliers, op9_license_scan, op10_suffix_dedup,
    op11_jaccard_join, op12_collocations, op13_repair_conversations)}
