"""Grouped summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomkit.functions.scalars import rd, ratio


def overall(c: str) -> Column:
    """Grand total of a column of group totals; only ever used on grouped, small tables."""
    return F.sum(c).over(Window.partitionBy())


def money(c: Column | str) -> Column:
    """Exact sum of a two-decimal amount, free of summation order."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast("decimal(18,2)")).cast("double")


def class_share(df: DataFrame, key: str, digits: int = 4) -> DataFrame:
    """Count and percentage per level; the total is a scalar subquery, so any number of levels may occur."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("pct", rd(F.col("n") * 100.0 / total, digits))


def value_counts(df: DataFrame, key: str, digits: int = 1) -> DataFrame:
    """Frequency and normalised percentage of the non-null values."""
    return class_share(df.filter(F.col(key).isNotNull()), key, digits)


def group_rate(df: DataFrame, key: str, y: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(y).alias("rate"), F.count("*").alias("n")).orderBy("rate", key)


def class_mean_gap(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Mean of every column in both classes and their absolute difference, one pass."""
    one = df.agg(
        *[F.avg(F.when(F.col(label) == k, F.col(c))).alias(f"{c}_{k}") for c in columns for k in (0, 1)]
    )
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}_1").alias("mean_1"), F.col(f"{c}_0").alias("mean_0"))
        for c in columns
    ])).alias("r")
    return one.select(rows).select("r.*").withColumn(
        "abs_diff", F.abs(F.col("mean_1") - F.col("mean_0"))
    ).orderBy(F.col("abs_diff").desc(), "feature")


def rule_precision(scored: DataFrame, flag: str, normal: str, label: str) -> DataFrame:
    """Share of flagged rows and share of real hits among them, one pass."""
    flagged = F.col(flag) != normal
    return scored.agg(
        F.count("*").alias("total"),
        F.count_if(flagged).alias("flagged"),
        F.count_if(flagged & (F.col(label) == 1)).alias("hits"),
    ).select(
        "total", "flagged", "hits",
        rd(F.col("flagged") * 100.0 / F.nullif("total", F.lit(0)), 1).alias("flagged_pct"),
        rd(ratio(F.col("hits") * 100.0, F.col("flagged")), 1).alias("precision_pct"),
    )


def pivot_sum(df: DataFrame, rows: Sequence[str], column: str, values: Sequence, amount: str) -> DataFrame:
    """Two-key sums laid out wide; the stated ``values`` spare Spark a pass to find them."""
    wide = df.groupBy(*rows).pivot(column, list(values)).agg(money(amount))
    return wide.na.fill(0.0, [str(v) for v in values])


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of every pair of levels, zero cells included, with both margins.

    The grid is built from the distinct levels of two categorical columns, never from rows.
    """
    counts = df.groupBy(a, b).agg(F.count("*").alias("n"))
    levels = counts.agg(F.collect_set(b).alias("_levels")).scalar()
    grid = counts.select(a).distinct().select(a, F.explode(F.sort_array(levels)).alias(b))
    full = grid.join(counts, [a, b], "left").fillna(0, ["n"])
    return full.select(
        a, b, "n",
        F.sum("n").over(Window.partitionBy(a)).alias("row_n"),
        F.sum("n").over(Window.partitionBy(b)).alias("col_n"),
        overall("n").alias("all_n"),
    )


def month_end_totals(df: DataFrame, day: str, amount: str, margin: int = 0) -> DataFrame:
    """Sum per calendar month from the first to the last month, and ``margin`` months on either side; empty ones are 0."""
    sums = df.filter(F.col(day).isNotNull()).groupBy(
        F.last_day(F.col(day).cast("date")).alias("month_end")
    ).agg(money(amount).alias("total"))
    months = sums.agg(F.min("month_end").alias("a"), F.max("month_end").alias("b")).select(
        F.explode(F.sequence(F.add_months(F.trunc("a", "month"), -margin), F.add_months(F.trunc("b", "month"), margin),
                             F.expr("interval 1 month")))
        .alias("m")
    ).select(F.last_day("m").alias("month_end"))
    return months.join(sums, "month_end", "left").fillna(0.0, ["total"])


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier one, nulls equal; copies combine map-side."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates")
    )
