"""The corpus pipeline: ``run`` applies STAGES, each written as Parquet and read again, to ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it left. All but the last return the
columns of documents; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fathomkit.llm.jaccard import one_of_each
from fathomkit.llm.jobs import query, table
from fathomkit.llm.mixing import apply_mixture, mixture
from fathomkit.llm.packing import pack
from fathomkit.llm.secrets import without_secrets
from fathomkit.llm.toxicity import without_toxic
from fathomkit.session import hold


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network rejects go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; every document stays."""
    return without_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Smaller sources are repeated up to one and a half times; every document stays at least once."""
    return apply_mixture(docs, mixture(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of 2,048 ids."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity), ("ngram_jaccard_join", near_duplicates), ("secret_scans", secrets),
    ("source_mixing", mixing), ("best_fit_packing", packing),
]

# Learned scores and vocabulary ids are beyond SQL; tests/llm/test_pipeline.py checks each stage by brute force.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = hold(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
