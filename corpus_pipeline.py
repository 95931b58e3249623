"""The corpus pipeline: quality, near-duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. Null texts: the quality stage rejects them with the other documents of fewer than 50
words, and the later stages accept them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliant.llm import decontamination, neardup, packing, privacy, quality, tokens
from foliant.llm.common import table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio; the others go."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.8 or more on five-word shingles, the one of smallest id."""
    return neardup.deduplicate(docs, neardup.Similarity(words=5, part=80, whole=100))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and revealing terms replaced in their texts."""
    return privacy.sanitise(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return packing.pack(docs, tokens.vocabulary_path())


STAGES = [
    ("quality rules", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal data", hide_personal_data),
    ("packing", pack_sequences),
]

#: SQL can express neither the likelihood ratio nor the sequences; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
