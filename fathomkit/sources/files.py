"""Reading and writing tables as files; every write is distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, columns: Sequence[str] = ()
) -> DataFrame:
    """CSV with header and a stated schema; ``columns`` prunes what is parsed."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.select(*columns) if columns else df


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write, replacing stale output at ``path``."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path
