"""The corpus pipeline: five stages over ``documents``, each written and read again.

``STAGES`` lists (name, function) in order. A function takes (spark, docs, sf_dir), works on
all rows its predecessor kept and returns a DataFrame: the columns of ``documents`` for the
first four, the digest of the token files for the last.

Defined cases: a null text is scored and encoded as an empty one and has no shingles or
benchmark words; rows without words are their own near-duplicate group; rows without an id
are documents of their own; rows that repeat an id with its text are one document to the
near-duplicate stage; whole texts are used at any length; without labels every score is 0.5
and no row stays; without a benchmark the third stage keeps all; empty tables give empty
results; further columns are carried along and may have any name that does not begin with
two underscores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agrosense.llm.common import stored, table
from agrosense.llm.decontaminate import remove_contaminated
from agrosense.llm.minmax import drop_near_duplicates
from agrosense.llm.mixing import apply_mix
from agrosense.llm.queries import token_digest
from agrosense.llm.rules import accept_quality


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, accepts."""
    return accept_quality(docs, table(spark, sf_dir, "labels"))


def near_unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near-duplicates
    (five-word shingles, Jaccard similarity of 0.8 or more)."""
    return drop_near_duplicates(docs, 5, (80, 100))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often (0 to 3 times) as the mix of its source takes it."""
    return apply_mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, read back: a digest per row."""
    return token_digest(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("near-duplicates", near_unique),
    ("benchmark decontamination", benchmark_free),
    ("mixing sources", source_mix),
    ("token files", token_files),
]

# The fitted classifier and the tokenizer have no SQL form; tests/llm holds the stages against
# brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
