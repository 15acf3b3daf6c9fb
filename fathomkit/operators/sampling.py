"""Sorting, limits and repeatable sampling.

Every sample is taken from a hash of the row's key, so a lost and recomputed task picks the
same rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomkit.functions.scalars import key_bucket, key_uniform


def _cols(keys: Sequence[str]):
    return [F.col(k) for k in keys]


def bernoulli(df: DataFrame, fraction: float, keys: Sequence[str], seed: int = 42) -> DataFrame:
    return df.filter(key_uniform(_cols(keys), seed) < fraction)


def stratified_split(
    df: DataFrame, label: str, keys: Sequence[str], train: float = 0.8, seed: int = 42
) -> DataFrame:
    """Mark each row ``train`` or ``test``, every class split on its own.

    The hash is salted with the class, and each row lands in exactly one part.
    """
    draw = key_uniform([*_cols(keys), F.col(label)], seed)
    return df.withColumn("split", F.when(draw < train, "train").otherwise("test"))


def shuffled(df: DataFrame, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """All rows in a random but repeatable global order (a range-partitioned sort)."""
    return df.orderBy(key_bucket(_cols(keys), 1 << 62, seed), *keys)


def sample_exactly(df: DataFrame, k: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """``k`` rows without replacement: the ``k`` smallest hashes, found as a top-k."""
    return df.orderBy(key_bucket(_cols(keys), 1 << 62, seed), *keys).limit(k)


def top_groups(df: DataFrame, key: str, amount: str, k: int = 10) -> DataFrame:
    total = F.sum(F.col(amount).cast("decimal(18,2)")).alias("total")
    return df.groupBy(key).agg(total).orderBy(F.col("total").desc(), key).limit(k).withColumn(
        "total", F.col("total").cast("double")
    )


def top_by_abs(df: DataFrame, column: str, tie: Sequence[str], k: int) -> DataFrame:
    return df.orderBy(F.abs(column).desc(), *tie).limit(k)


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order; files have no order of their own."""
    return df.orderBy(*order).limit(n)
