"""Training-data pipeline over ``documents``: five stages, each on all rows that the one before it kept.

Rows of the first four stages have the columns of ``documents``; ``n_chars`` follows the text.  The last
stage returns packed pieces.  ``ORACLE_SQL`` is None: shingle sets, repeated passages and token ids are
outside SQL, so the stages are tested against brute-force versions in ``tests/llm``.

Defined cases of every stage: null, empty and word-free texts fail the quality rules and would pass the later stages
unchanged; of rows that repeat a doc_id one stays after the second stage; rows without doc_id cannot be told apart, so they
all stay and lose no passages; very long texts are taken whole; an empty table gives no rows; further columns are kept,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paracorpus.llm import near_copies, packing, quality, secrets, suffix_dedup
from paracorpus.llm.common import documents, stash

#: Words of the shortest repeated passage that is cut out, and of the grams that anchor it.
PASSAGE, GRAM = 51, 12


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.quality_filter(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles of similarity 0.8 or more the smallest doc_id stays."""
    return near_copies.one_of_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that start in more than one place are cut out of the texts."""
    return _counted(suffix_dedup.clean(docs, PASSAGE, GRAM, words=True))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked."""
    return _counted(secrets.masked(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of all that is left, packed."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
