import datetime

import numpy as np
from pyspark.sql import functions as F

from fathomkit.functions import scalars as sc
from fathomkit.operators import describe as d
from fathomkit.operators.grouping import month_end_totals
from fathomkit.operators.joins import compatible_left_join, left_join
from fathomkit.operators.sampling import bernoulli, sample_exactly, stratified_split


def test_skewness_and_kurtosis(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    r = d.shape(df, ["v"]).first()
    assert np.isclose(r["skewness"], 1.763632614803888) and np.isclose(r["kurtosis"], 3.228, atol=1e-3)
    assert r["distribution"].startswith("right-skewed")


def test_correlation_skips_pairs_with_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.5), (None, 9.0), (3.0, None), (4.0, 7.0)], "a double, b double")
    got = {(r["a"], r["b"]): r["r"] for r in d.correlations(df, ["a", "b"]).collect()}
    assert np.isclose(got["a", "b"], 0.9819805060619657) and got["a", "b"] == got["b", "a"]


def test_date_repair(spark):
    df = spark.createDataFrame(
        [(datetime.date(2022, 5, 1), "1/27/2022"), (datetime.date(2022, 1, 27), "nonsense")], "d date, t string"
    )
    got = df.select(sc.swap_day_month(F.col("d")).alias("d"), sc.month_first_date(F.col("t")).alias("t")).collect()
    assert [r["d"] for r in got] == [datetime.date(2022, 1, 5), datetime.date(2022, 1, 27)]
    assert [r["t"] for r in got] == [datetime.date(2022, 1, 27), None]


def test_cleaning_helpers(spark):
    df = spark.createDataFrame(
        [("Y", "(null)", "12", "BLACK", "March"), (None, "x", "abc", "?", "Brumaire")],
        "a string, b string, c string, r string, m string",
    )
    got = df.select(
        sc.yes_flag("a"), sc.sentinel_to_null("b"), sc.to_number("c"), sc.recode("r", sc.RACE_GROUPS),
        sc.month_number("m"), sc.contains_flag("b", "x"),
    ).collect()
    assert [tuple(r) for r in got] == [(1, None, 12.0, "Black", 3, 0), (0, "x", None, "Other", None, 1)]


def test_null_safe_composite_join(spark):
    a = spark.createDataFrame([(1, None), (2, 2)], "k int, h int").withColumn("x", F.lit(1))
    b = spark.createDataFrame([(1, None, 9), (2, 2, 8)], "k int, h int, v int")
    assert sorted(r["v"] for r in left_join(a, b, ["k", "h"], ["h"]).collect()) == [8, 9]
    assert sorted(str(r["v"]) for r in left_join(a, b, ["k", "h"]).collect()) == ["8", "None"]


def test_open_shared_variable(spark):
    teams = spark.createDataFrame([("a", None), ("b", "x"), ("c", "x")], "team string, country string")
    players = spark.createDataFrame([("a", "p", "y"), ("b", "q", "x"), ("c", "r", "y")], "team string, player string, country string")
    got = {tuple(r) for r in compatible_left_join(teams, players, ["team"], "country").select("team", "country", "player").collect()}
    assert got == {("a", "y", "p"), ("b", "x", "q"), ("c", "x", None)}


def test_empty_months_are_zero(spark):
    df = spark.createDataFrame([(datetime.date(2024, 1, 31), 5.0), (datetime.date(2024, 4, 2), 1.5)], "d date, v double")
    got = [(str(r[0]), r[1]) for r in month_end_totals(df, "d", "v").orderBy("month_end").collect()]
    assert got == [("2024-01-31", 5.0), ("2024-02-29", 0.0), ("2024-03-31", 0.0), ("2024-04-30", 1.5)]


def test_sampling_invariants(spark):
    df = spark.range(20_000).withColumn("label", (F.col("id") % 50 == 0).cast("int"))
    assert 1800 < bernoulli(df, 0.1, ["id"]).count() < 2200
    picked = sample_exactly(df, 300, ["id"])
    assert picked.count() == picked.select("id").distinct().count() == 300
    assert sorted(r[0] for r in picked.select("id").collect()) == sorted(
        r[0] for r in sample_exactly(df.repartition(7), 300, ["id"]).select("id").collect()
    )
    split = stratified_split(df, "label", ["id"])
    rates = {(r["label"], r["split"]): r["n"] for r in split.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    assert sum(rates.values()) == 20_000
    for k in (0, 1):
        assert abs(rates[k, "train"] / (rates[k, "train"] + rates[k, "test"]) - 0.8) < 0.06


def test_normal_quantile(spark):
    from statistics import NormalDist

    ps = [1e-300, 1e-14, 1e-9, 0.001, 0.0749, 0.076, 0.3, 0.5, 0.8, 0.95, 0.999999, 1 - 1e-12]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select("p", sc.normal_quantile(F.col("p")).alias("z"))
    for r in got.collect():
        assert np.isclose(r["z"], NormalDist().inv_cdf(r["p"]), rtol=1e-12, atol=1e-15)
