"""Descriptive statistics and the tables behind charts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomkit.functions.scalars import ratio, skew_label
from fathomkit.operators.ordered import quantiles
from fathomkit.session import hold


def per_column(df: DataFrame, columns: Sequence[str], stats: dict, by: Sequence[str] = ()) -> DataFrame:
    """``stats`` (name -> column function) of every column in one pass, one row per column."""
    aggs = [
        F.struct(F.lit(c).alias("metric"), *[f(F.col(c)).alias(n) for n, f in stats.items()])
        for c in columns
    ]
    rows = df.groupBy(*by).agg(F.array(*aggs).alias("_rows"))
    return rows.select(*by, F.explode("_rows").alias("_r")).select(*by, "_r.*")


def moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample sd, min and max."""
    return per_column(
        df, columns,
        {"n": F.count, "mean": F.avg, "sd": F.stddev, "lo": F.min, "hi": F.max}, by,
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``moments`` with linear-interpolated quartiles."""
    q = quantiles(df, columns, [0.25, 0.5, 0.75], names=["q1", "median", "q3"]).drop("n")
    return moments(df, columns).join(q, "metric")


def shape(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bias-corrected skewness G1 and excess kurtosis G2 with a verbal class."""
    raw = per_column(df, columns, {"n": F.count, "g1": F.skewness, "g2": F.kurtosis})
    n = F.col("n").cast("double")
    big_g1 = ratio(F.sqrt(n * (n - 1)) * F.col("g1"), n - 2)
    big_g2 = ratio((n - 1) * ((n + 1) * F.col("g2") + 6), (n - 2) * (n - 3))
    return raw.select("metric", "n", big_g1.alias("skewness"), big_g2.alias("kurtosis")).withColumn(
        "distribution", skew_label(F.col("skewness"))
    )


def second_skewness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson's 3 (mean - median) / sd."""
    d = describe(df, columns)
    return d.select("metric", ratio(3 * (F.col("mean") - F.col("median")), F.col("sd")).alias("skew2"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairs in one pass; a pair skips the rows where either side is null."""
    pairs = list(combinations_with_replacement(columns, 2))
    one = df.agg(*[F.corr(a, b).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)])
    both = [
        F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"_r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs) for x, y in {(a, b), (b, a)}
    ]
    return one.select(F.explode(F.array(*both)).alias("_p")).select("_p.*")


def correlation_with(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    one = df.agg(*[F.corr(c, target).alias(c) for c in columns])
    return one.unpivot([], list(columns), "feature", "r").orderBy(F.abs("r").desc(), "feature")


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width counts over the common range, last bin closed, empty bins kept."""
    v = F.col(column)
    ends = df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi")).alias("e"))
    base = df.filter(v.isNotNull()).select(
        *([by] if by else []), v.cast("double").alias("_v")
    ).withColumn("_e", ends.scalar())
    lo, hi = F.col("_e.lo"), F.col("_e.hi")
    width = (hi - lo) / bins
    spot = F.coalesce(F.floor(ratio(F.col("_v") - lo, width)), F.lit(0))
    keys = [by] if by else []
    counts = base.select(*keys, F.least(spot, F.lit(bins - 1)).cast("int").alias("bin")).groupBy(
        *keys, "bin"
    ).agg(F.count("*").alias("n"))
    all_bins = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    spark = df.sparkSession
    grid = counts.select(*keys).distinct().select(*keys, all_bins) if by else spark.range(1).select(all_bins)
    out = grid.join(counts, [*keys, "bin"], "left").fillna(0, ["n"]).withColumn("_e", ends.scalar())
    total = F.sum("n").over(Window.partitionBy(*keys))
    return out.select(
        *keys, "bin", (lo + F.col("bin") * width).alias("left_edge"), "n",
        ratio(F.col("n"), total * width).alias("density"),
    )


BOX_WIDTH = 0.5  # of a box of values, in units of sqrt(2) bandwidths
KDE_ORDER = 16  # moments of a box; what is left out of the expansion is below 1e-12 of the density's peak
KDE_REACH = 8.6  # bandwidths, beyond which a kernel is below 1e-16


def kde(df: DataFrame, column: str, points: int = 1000) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on the usual plotting grid.

    Values are summed up in boxes of less than a bandwidth: a box keeps its moments, from which the Hermite expansion of
    the kernel gives what the box adds to a grid point. Rows are read once into the moments; boxes meet only the grid
    points within reach, so what is exploded depends on the grid and not on the rows.
    """
    v = F.col(column).cast("double")
    stats = df.agg(F.struct(
        F.count(column).cast("double").alias("n"), F.stddev(v).alias("sd"),
        F.min(v).alias("lo"), F.max(v).alias("hi"),
    ).alias("s")).scalar()
    h = F.col("s.sd") * F.pow(F.col("s.n"), F.lit(-0.2))
    unit = h * 2 ** 0.5
    lo = F.col("s.lo") - 0.5 * (F.col("s.hi") - F.col("s.lo"))
    gap = 2 * (F.col("s.hi") - F.col("s.lo")) / (points - 1)

    middle = F.col("s.lo") + (F.col("box") + 0.5) * unit * BOX_WIDTH
    placed = df.filter(F.col(column).isNotNull()).select(v.alias("v")).withColumn("s", stats).withColumn(
        "box", F.floor(ratio(F.col("v") - F.col("s.lo"), unit * BOX_WIDTH))).select(
        "box", ratio(F.col("v") - middle, unit).alias("u"))
    moments, power = [], F.lit(1.0)
    for k in range(KDE_ORDER):
        moments.append(F.sum(power).alias(f"m{k}"))
        power = power * F.col("u")
    boxes = placed.groupBy("box").agg(*moments).withColumn("s", stats)

    # sum of m_k / k! times the Hermite polynomial of order k, as one polynomial in t
    t = ratio(F.col("x") - middle, unit)
    hermite = [np.polynomial.hermite.herm2poly([0] * k + [1]) / math.factorial(k) for k in range(KDE_ORDER)]
    value = F.lit(0.0)
    for j in reversed(range(KDE_ORDER)):
        own = sum((F.col(f"m{k}") * float(c[j]) for k, c in enumerate(hermite) if k >= j and c[j]), F.lit(0.0))
        value = value * F.col("t") + own
    first = F.ceil(F.greatest(F.lit(0.0), ratio(middle - KDE_REACH * h - lo, gap)))
    last = F.floor(F.least(F.lit(float(points - 1)), ratio(middle + KDE_REACH * h - lo, gap)))
    near = boxes.select("*", first.alias("first"), last.alias("last")).where("first <= last").select(
        "*", F.explode(F.sequence("first", "last")).alias("i")).withColumn("x", lo + F.col("i") * gap).withColumn("t", t)
    sums = near.select("i", (value * F.exp(-F.col("t") * F.col("t")) / (F.col("s.n") * h * (2 * np.pi) ** 0.5)).alias("k")).groupBy(
        "i").agg(F.sum("k").alias("density"))
    grid = df.sparkSession.range(points).select(F.col("id").alias("i")).withColumn("s", stats).where("s.n > 0")
    return grid.join(sums, "i", "left").select(
        F.col("i").cast("int").alias("i"), (lo + F.col("i") * gap).alias("x"), F.coalesce("density", F.lit(0.0)).alias("density"))


def box_stats(df: DataFrame, column: str, by: str) -> DataFrame:
    """Quartiles, whiskers at the last point within 1.5 IQR, and outliers, per group."""
    q = quantiles(df, [column], [0.25, 0.5, 0.75], by=[by], names=["q1", "median", "q3"])
    q = hold(q.select(by, "q1", "median", "q3"))
    v = F.col(column)
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    return df.join(q, by).groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(v >= lo, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi, v)).alias("whisker_hi"),
        F.count_if((v < lo) | (v > hi)).alias("outliers"),
    )


def mean_interval(df: DataFrame, key: str, value: str, z: float = 1.96) -> DataFrame:
    """Group mean with its +-z SE interval and the mean of all rows."""
    per = df.groupBy(key).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev(value).alias("sd"),
        F.sum(value).alias("_sum"),
    )
    se = F.col("sd") / F.sqrt(F.col("n"))
    whole = Window.partitionBy()
    return per.select(
        key, "n", "mean", "sd", se.alias("se"),
        (F.col("mean") - z * se).alias("lo"), (F.col("mean") + z * se).alias("hi"),
        (F.sum("_sum").over(whole) / F.sum("n").over(whole)).alias("grand_mean"),
    )


def ranked_intervals(draws: DataFrame, param: str, value: str) -> DataFrame:
    """Per parameter: mean, 95 % interval, side of zero, and rank by mean."""
    q = quantiles(draws, [value], [0.025, 0.975], by=[param], names=["q2_5", "q97_5"])
    means = draws.groupBy(param).agg(F.avg(value).alias("mean"))
    side = F.when(F.col("q2_5") > 0, "above").when(F.col("q97_5") < 0, "below").otherwise("spans 0")
    # one row per parameter from here on
    return means.join(q.select(param, "q2_5", "q97_5"), param).select(
        param, "mean", "q2_5", "q97_5", side.alias("interval_class"),
        F.row_number().over(Window.partitionBy().orderBy("mean", param)).alias("rank"),
    )


def share(c: Column, total: Column) -> Column:
    return ratio(c * 100.0, total)
