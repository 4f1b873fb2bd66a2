"""From raw documents to packed sequences: each stage works on what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm.common import table
from gleaner.llm.exact import without_copies
from gleaner.llm.jaccard import one_of_each
from gleaner.llm.mixing import mixture
from gleaner.llm.packing import packed
from gleaner.llm.quality import accepted
from gleaner.stage import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted on ``labels``, does not reject."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates."""
    return one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix of the sources takes them."""
    return mixture(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", near_dedup),
    ("mixing", mix),
    ("packing", pack),
]

# The classifier and the tokenizer have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
