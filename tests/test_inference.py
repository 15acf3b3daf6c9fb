import math
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fathomkit.functions import tails
from fathomkit.operators import inference as inf


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    n = 400
    pdf = pd.DataFrame({
        "id": np.arange(n), "a": rng.normal(size=n), "b": rng.uniform(0, 5, n),
        "g": rng.choice(["x", "y", "z"], n, p=[0.6, 0.3, 0.1]),
    })
    pdf["y"] = 2 + 1.5 * pdf["a"] - 0.7 * pdf["b"] + (pdf["g"] == "z") * 3 + rng.normal(size=n) * (1 + pdf["b"])
    return pdf


@pytest.fixture(scope="module")
def fitted(spark, data):
    df = spark.createDataFrame(data)
    return df, inf.fit_ols(df, "y", ["a", "b"], {"g": inf.factor_levels(df, "g", "y")})


def design(pdf):
    return np.column_stack([np.ones(len(pdf)), pdf["a"], pdf["b"], pdf["g"] == "x", pdf["g"] == "z"]).astype(float)


def test_least_squares(spark, data, fitted):
    df, fit = fitted
    x, y = design(data), data["y"].to_numpy()
    beta, rss, *_ = np.linalg.lstsq(x, y, rcond=None)
    assert fit.terms == ["(Intercept)", "a", "b", "gx", "gz"]
    assert np.allclose(fit.beta, beta) and np.isclose(fit.rss, rss[0])
    rows = {r["term"]: r for r in inf.coefficient_table(spark, fit).collect()}
    se = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * rss[0] / (len(y) - 5))
    assert np.allclose([rows[t]["std_error"] for t in fit.terms], se)
    assert rows["a"]["conf_low"] < rows["a"]["estimate"] < rows["a"]["conf_high"]
    m = inf.fit_metrics(spark, fit).first()
    assert np.isclose(m["r2"], 1 - rss[0] / ((y - y.mean()) ** 2).sum()) and m["p_value"] < 1e-6


def test_row_diagnostics(data, fitted):
    df, fit = fitted
    x, y = design(data), data["y"].to_numpy()
    h = np.einsum("ij,jk,ik->i", x, np.linalg.inv(x.T @ x), x)
    e = y - x @ fit.beta
    got = inf.normal_qq(inf.diagnostics(df, fit), "std_residual", "id").toPandas().sort_values("id")
    assert np.allclose(got["leverage"], h) and np.isclose(got["leverage"].sum(), 5)
    r = e / (fit.sigma * np.sqrt(1 - h))
    assert np.allclose(got["std_residual"], r) and np.allclose(got["cooks_distance"], r**2 * h / (5 * (1 - h)))
    want = [NormalDist().inv_cdf((i - 0.5) / len(r)) for i in pd.Series(r).rank(method="first")]
    assert np.allclose(got["theoretical"], want)


def test_breusch_pagan_and_inflation(spark, data, fitted):
    df, fit = fitted
    x, e2 = design(data), (data["y"].to_numpy() - design(data) @ fit.beta) ** 2
    b, rss, *_ = np.linalg.lstsq(x, e2, rcond=None)
    bp = inf.breusch_pagan(df, fit).first()
    assert np.isclose(bp["lm"], len(e2) * (1 - rss[0] / ((e2 - e2.mean()) ** 2).sum())) and bp["df"] == 4
    r = np.corrcoef(x[:, 1:].T)
    want = np.linalg.det(r[np.ix_([2, 3], [2, 3])]) * np.linalg.det(r[:2, :2]) / np.linalg.det(r)
    got = {q["term"]: q for q in inf.inflation_factors(spark, fit).collect()}
    assert np.isclose(got["g"]["gvif"], want) and np.isclose(got["g"]["gvif_scaled"], want**0.25)


def test_anderson_darling(spark):
    rng = np.random.default_rng(4)
    for sample, normal in ((rng.normal(size=500).round(2), True), (rng.exponential(size=500).round(2), False)):
        df = spark.createDataFrame(pd.DataFrame({"v": sample}))
        z = np.sort((sample - sample.mean()) / sample.std(ddof=1))
        n, cdf = len(z), NormalDist().cdf
        a = -n - sum(
            (2 * i + 1) * (math.log(cdf(z[i])) + math.log(1 - cdf(z[n - 1 - i]))) for i in range(n)
        ) / n
        got = inf.anderson_darling(df, "v").first()
        assert np.isclose(got["a"], a) and (got["p_value"] > 0.05) == normal


def test_two_groups_f_is_t_squared(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": ["a"] * 30 + ["b"] * 20, "v": rng.normal(size=50)})
    df = spark.createDataFrame(pdf)
    a, b = pdf[pdf.g == "a"].v, pdf[pdf.g == "b"].v
    pooled = ((len(a) - 1) * a.var() + (len(b) - 1) * b.var()) / 48
    t = (a.mean() - b.mean()) / math.sqrt(pooled * (1 / len(a) + 1 / len(b)))
    f = inf.with_p(inf.anova(df, "g", "v"), tails.f_tail, "f", "df_between", "df_within").first()
    assert np.isclose(f["f"], t * t) and np.isclose(f["p_value"], tails.t_tail(spark, t, 48))
    hsd = inf.tukey_hsd(df, "g", "v").first()
    assert hsd["pair"] == "b-a" and np.isclose(hsd["p_adj"], f["p_value"], atol=1e-6)


def test_studentized_range_table():
    # published upper 5 % points
    assert np.isclose(tails.studentized_range_quantile(0.95, 3, 10), 3.877, atol=2e-3)
    assert np.isclose(tails.studentized_range_quantile(0.95, 5, 60), 3.977, atol=2e-3)


def test_chi_square_two_by_two(spark):
    rows = [("a", "x")] * 12 + [("a", "y")] * 5 + [("b", "x")] * 7 + [("b", "y")] * 9
    df = spark.createDataFrame(rows, "r string, c string")
    n, det = 33, 12 * 9 - 5 * 7
    want = n * (abs(det) - n / 2) ** 2 / (17 * 16 * 19 * 14)
    got = inf.chi_square(df, "r", "c").first()
    assert np.isclose(got["chi_sq"], want) and got["df"] == 1


def test_levels_beyond_the_bound_are_refused(spark, monkeypatch):
    monkeypatch.setattr(inf, "MAX_TERMS", 3)
    df = spark.range(10).select(F.col("id").cast("string").alias("g"))
    with pytest.raises(ValueError):
        inf.factor_levels(df, "g")


def test_large_values_keep_their_digits(spark):
    rng = np.random.default_rng(8)
    x, y = 1e6 + rng.normal(size=2000), None
    y = 1e6 + 2 * (x - 1e6) + rng.normal(size=2000)
    fit = inf.fit_ols(spark.createDataFrame(pd.DataFrame({"x": x, "y": y})), "y", ["x"])
    beta, rss, *_ = np.linalg.lstsq(np.column_stack([np.ones(2000), x - 1e6]), y - 1e6, rcond=None)
    assert np.isclose(fit.rss, rss[0], rtol=1e-6) and np.isclose(fit.beta[1], beta[1], rtol=1e-6)


def test_two_wide_factors_and_unknown_levels(spark):
    rng = np.random.default_rng(9)
    n, k = 6000, 120
    a, b = rng.integers(0, k, n), rng.integers(0, k, n)
    y = a * 0.1 - b * 0.05 + rng.normal(size=n)
    df = spark.createDataFrame(pd.DataFrame({"a": [f"a{i:03d}" for i in a], "b": [f"b{i:03d}" for i in b], "y": y}))
    fit = inf.fit_ols(df, "y", [], {c: inf.factor_levels(df, c) for c in ("a", "b")})
    x = np.column_stack([np.ones(n), *[(a == i) for i in range(1, k)], *[(b == i) for i in range(1, k)]]).astype(float)
    beta, rss, *_ = np.linalg.lstsq(x, y, rcond=None)
    assert fit.p == 2 * k - 1 and np.isclose(fit.rss, rss[0]) and np.allclose(fit.beta, beta, atol=1e-6)
    got = inf.with_fitted(df, fit).agg(F.sum("leverage"), F.sum(F.col("residual") * F.col("residual"))).first()
    assert np.isclose(got[0], fit.p) and np.isclose(got[1], rss[0])
    odd = spark.createDataFrame([("a001", "nowhere", 1.0)], "a string, b string, y double")
    assert inf.with_fitted(odd, fit).first()["fitted"] is None


def test_studentized_range_for_any_degrees_of_freedom():
    from fathomkit.functions.tails import _range_cdf, studentized_range_tail

    normal = 1 - _range_cdf(np.array([3.6]), 4)[0]
    gaps = [studentized_range_tail(3.6, 4, df) - normal for df in (1e4, 2.4e4, 2.6e4, 1e5, 1e7, 1e11)]
    assert all(a > b > 0 for a, b in zip(gaps, gaps[1:])) and gaps[-1] < 1e-8
    for a, df in zip(gaps, (1e4, 2.4e4, 2.6e4, 1e5, 1e7)):
        assert np.isclose(a * df, gaps[0] * 1e4, rtol=1e-2)  # the leading term falls as 1 / df


def test_diagnostics_are_written_once_before_they_are_ranked(spark, sf, monkeypatch):
    """The rows go to disk as they come and once more by ranges, not a third time."""
    from fathomkit.operators import ordered
    from fathomkit.plans import testing

    wide = []
    for module in (ordered, testing):
        real = module.hold
        monkeypatch.setattr(module, "hold", lambda df, real=real: wide.append("leverage" in df.columns) or real(df))
    assert testing.j06(spark, sf).filter("rank = 1").count() == 1
    assert sum(wide) == 2
