"""Cleaning and imputation over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomkit.functions.scalars import SENTINELS, key_bucket, sentinel_to_null
from fathomkit.operators.ordered import quantiles
from fathomkit.session import hold


def clean_sentinels(df: DataFrame, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """Null every sentinel text in every string column."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[sentinel_to_null(c, sentinels).alias(c) if c in texts else F.col(c) for c in df.columns]
    )


def attach_stats(df: DataFrame, stats: Mapping[str, Column], of: DataFrame | None = None) -> DataFrame:
    """Add whole-table aggregates to every row through one scalar subquery.

    The aggregate is one row by construction, so no join and no shuffle of ``df`` happens.
    """
    row = (of if of is not None else df).agg(
        F.struct(*[c.alias(n) for n, c in stats.items()]).alias("_stats")
    )
    return df.withColumn("_stats", row.scalar()).select(
        *df.columns, *[F.col(f"_stats.{n}").alias(n) for n in stats]
    )


def _quantile_columns(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles of all columns as one row holding a map from column name to array."""
    q = quantiles(df, columns, probs, names=[f"_p{i}" for i in range(len(probs))])
    return q.agg(
        F.map_from_entries(
            F.collect_list(F.struct("metric", F.array(*[f"_p{i}" for i in range(len(probs))])))
        ).alias("q")
    )


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    medians = _quantile_columns(df, columns, [0.5]).scalar()
    return df.withColumn("_q", medians).select(
        *[F.coalesce(F.col(c), F.try_element_at("_q", F.lit(c))[0]).alias(c) if c in columns
          else F.col(c) for c in df.columns]
    )


def cap_outliers(df: DataFrame, columns: Sequence[str], width: float = 3.0) -> DataFrame:
    """Clip to [Q1 - width*IQR, Q3 + width*IQR]; ``<c>_capped`` marks the clipped rows."""
    q = _quantile_columns(df, columns, [0.25, 0.75]).scalar()
    out = [F.col(c) for c in df.columns if c not in columns]
    for c in columns:
        q1 = F.try_element_at("_q", F.lit(c))[0]
        q3 = F.try_element_at("_q", F.lit(c))[1]
        lo, hi = q1 - width * (q3 - q1), q3 + width * (q3 - q1)
        clipped = F.when(F.col(c).isNotNull(), F.greatest(F.least(F.col(c), hi), lo))
        out += [
            clipped.alias(c),
            F.coalesce((F.col(c) < lo) | (F.col(c) > hi), F.lit(False)).cast("int").alias(f"{c}_capped"),
        ]
    return df.withColumn("_q", q).select(*out)


def null_exactly(df: DataFrame, column: str, keys: Sequence[str], k: int, seed: int = 0) -> DataFrame:
    """Null ``column`` in exactly ``k`` rows, picked by a repeatable hash of the unique key."""
    draw = key_bucket([F.col(c) for c in keys], 1 << 62, seed)
    picked = df.select(*keys).orderBy(draw, *keys).limit(k).withColumn("_hit", F.lit(True))
    marked = df.join(hold(picked), list(keys), "left")
    return marked.withColumn(column, F.when(F.col("_hit").isNull(), F.col(column))).select(*df.columns)


def dummies(df: DataFrame, terms: Mapping[str, tuple[str, str]]) -> DataFrame:
    """0/1 columns, ``name -> (source column, level)``; the left-out level is the reference."""
    return df.select(
        "*",
        *[(F.coalesce(F.col(src) == level, F.lit(False))).cast("double").alias(name)
          for name, (src, level) in terms.items()],
    )


def null_counts(df: DataFrame) -> DataFrame:
    """One (column, nulls) row per column, from one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column", "nulls")


def shape_report(df: DataFrame) -> DataFrame:
    """Column name, type and number of non-null values, and the row count."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    one = df.agg(
        F.count("*").alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns]
    )
    names = F.create_map(*[F.lit(x) for kv in types.items() for x in kv])
    return one.unpivot(["_rows"], df.columns, "column", "non_null").select(
        "column", names[F.col("column")].alias("type"), "non_null", F.col("_rows").alias("rows")
    )
