"""The corpus pipeline: five stages, each one a corpus operator over all that the stage before it kept.

1. toxicity: documents scored one half or more by the string-kernel machine go.
2. exact dedup: one row of each group of equal texts stays (white space aside).
3. n-gram Jaccard join: one document of each component of similar texts stays.
4. benchmark decontamination: documents that hold a benchmark item go.
5. mixing sources: words to take of each document for the target weights.

Every stage but the last returns the columns of ``documents``.  A stage's rows
are written to the shared folder (``spark.checkpoint.dir``) as Parquet and read
again as the next stage's documents, so a lost executor costs one stage at
most.  Nulls, empty texts, repeated rows, empty tables and extra columns are
handled as the operators' docstrings state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, exact_dedup, jaccard_join, mix_sources, toxicity
from strata.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return toxicity.not_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts."""
    return jaccard_join.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of the documents left."""
    return mix_sources.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("mix", mix),
]

# A trained classifier and connected components: not expressible in SQL, tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
