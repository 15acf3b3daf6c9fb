import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fathomkit.operators import bayes as b


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(6)
    n = 1500
    g = rng.integers(1, 9, n)
    x = np.column_stack([rng.integers(-2, 3, n), rng.integers(0, 2, n)]).astype(float)
    u = rng.normal(size=9) * 0.8
    p = 1 / (1 + np.exp(-(-0.3 + 0.5 * x[:, 0] - 0.8 * x[:, 1] + u[g])))
    return pd.DataFrame({"id": np.arange(n), "a": x[:, 0], "w": x[:, 1], "g": g, "y": (rng.random(n) < p).astype(int)})


@pytest.fixture(scope="module")
def patterns(spark, data):
    return b.covariate_patterns(spark.createDataFrame(data), "y", ["a", "w"], "g")


def test_patterns_keep_every_row(patterns, data):
    r = patterns.agg(F.sum("_n"), F.sum("_y")).first()
    assert (r[0], r[1]) == (len(data), data["y"].sum())


def test_map_is_the_mode(patterns, data):
    fit = b.fit_map(patterns, ["a", "w"], tau=0.16)
    x = np.column_stack([np.ones(len(data)), data["a"], data["w"]])
    p = 1 / (1 + np.exp(-x @ fit.theta))
    assert np.abs(x.T @ (data["y"] - p) - 0.16 * fit.theta).max() < 1e-5
    hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.16 * np.eye(3)
    assert np.allclose(fit.covariance, np.linalg.inv(hessian))


def dense(fit, data, kinds, groups=8):
    """The fit as one vector, its design matrix and the precision of its prior."""
    z = np.eye(groups)[data["g"] - 1]
    parts = [z, z * data["w"].to_numpy()[:, None]][:kinds]
    x = np.column_stack([np.ones(len(data)), data["a"], data["w"], *parts])
    e = np.stack([r["e"] for r in fit.effects.orderBy("_group").collect()])
    prior = np.zeros((3 + kinds * groups,) * 2)
    prior[:3, :3] = 0.16 * np.eye(3)
    prior[3:, 3:] = np.kron(np.linalg.inv(fit.sigma), np.eye(groups))
    return np.concatenate([fit.theta, *e.T]), x, prior


@pytest.mark.parametrize("kinds", [1, 2])
def test_group_fit_is_the_mode(spark, patterns, data, kinds):
    fit = b.fit_map(patterns, ["a", "w"], kinds=kinds, slope="w")
    theta, x, prior = dense(fit, data, kinds)
    p = 1 / (1 + np.exp(-x @ theta))
    assert np.abs(x.T @ (data["y"] - p) - prior @ theta).max() < 1e-4
    assert fit.sigma[0, 0] > 0.05 and fit.gradient_norm < 1e-4
    covariance = np.linalg.inv((x * (p * (1 - p))[:, None]).T @ x + prior)
    got = {r["param"]: (r["mean"], r["sd"]) for r in b.coefficient_summary(spark, fit).collect()}
    names = [*fit.names, *(f"{k}[{g}]" for k in ("u", "v")[:kinds] for g in range(1, 9))]
    for name, mean, sd in zip(names, theta, np.sqrt(np.diag(covariance))):
        assert np.allclose(got[name], (mean, sd), rtol=1e-5, atol=1e-6), name


@pytest.mark.parametrize("kinds", [0, 1, 2])
def test_the_last_step_is_taken(patterns, data, kinds):
    """A step below the tolerance leaves a gradient that grows with the rows; taken, it squares what is left."""
    fit = b.fit_map(patterns, ["a", "w"], kinds=kinds, slope="w", tol=1e-2)
    if kinds:
        theta, x, prior = dense(fit, data, kinds)
    else:
        theta, x, prior = fit.theta, np.column_stack([np.ones(len(data)), data["a"], data["w"]]), 0.16 * np.eye(3)
    left = np.abs(x.T @ (data["y"] - 1 / (1 + np.exp(-x @ theta))) - prior @ theta).max()
    assert left < fit.gradient_norm / 5


@pytest.mark.parametrize("kinds", [1, 2])
def test_the_spread_is_the_highest_of_its_neighbours(patterns, data, kinds):
    """The Laplace marginal of the spread, evaluated densely, falls to all sides of the one that was found."""
    fit = b.fit_map(patterns, ["a", "w"], kinds=kinds, slope="w")
    theta, x, prior = dense(fit, data, kinds)
    p = 1 / (1 + np.exp(-x @ theta))
    curv = (x * (p * (1 - p))[:, None]).T @ x
    linear = x.T @ (data["y"].to_numpy() - p) + curv @ theta

    def value(sigma):
        pr = prior.copy()
        pr[3:, 3:] = np.kron(np.linalg.inv(sigma), np.eye(8))
        h = curv + pr
        like = -np.linalg.slogdet(h)[1] / 2 + linear @ np.linalg.solve(h, linear) / 2
        if kinds == 1:
            return like - 8 * np.log(sigma[0, 0]) / 2 - sigma[0, 0] / 2
        return like - 7 * np.linalg.slogdet(sigma)[1] / 2 - np.trace(np.linalg.inv(sigma)) / 2

    best = value(fit.sigma)
    rng = np.random.default_rng(1)
    for scale in (1e-3, 1e-2, 0.1):
        for _ in range(20):
            root = np.linalg.cholesky(fit.sigma) @ (np.eye(kinds) + scale * rng.normal(size=(kinds, kinds)))
            assert value(root @ root.T) <= best + 1e-9


def test_ten_thousand_groups_fit(spark):
    rng = np.random.default_rng(21)
    g, n = np.repeat(np.arange(10_000), 6), 60_000
    u, x = rng.normal(size=10_000) * 0.7, rng.integers(0, 3, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.2 + 0.4 * x + u[g])))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"x": x.astype(float), "g": g, "y": y}))
    fit = b.fit_map(b.covariate_patterns(df, "y", ["x"], "g"), ["x"], kinds=1)
    assert fit.effects.count() == 10_000 and fit.covariance.shape == (2, 2)
    assert abs(fit.theta[1] - 0.4) < 0.1 and 0.4 < fit.sigma[0, 0] ** 0.5 < 0.9
    e = np.array([r["e"][0] for r in fit.effects.orderBy("_group").collect()])
    eta = fit.theta[0] + fit.theta[1] * x + e[g]
    r = y - 1 / (1 + np.exp(-eta))
    assert np.abs(np.bincount(g, r) - e / fit.sigma[0, 0]).max() < 1e-4 and abs(r.sum() - 0.16 * fit.theta[0]) < 1e-3


def test_a_stronger_prior_shrinks(patterns):
    got = b.prior_sensitivity(patterns, ["a", "w"], [("tight", 100.0), ("wide", 0.01)]).toPandas()
    size = got.assign(m=got["mean"].abs()).groupby("prior")["m"].sum()
    assert size["tight"] < size["wide"] and len(got) == 6


def matrix(draws):
    """All draws as one table, parameters in columns."""
    return b.long_draws(draws).toPandas().pivot(index=["chain", "iter"], columns="param", values="value")


@pytest.mark.parametrize("numbers", [1_000_000, 900])
def test_draws_match_their_gaussian(spark, patterns, monkeypatch, numbers):
    monkeypatch.setattr(b, "DRAW_NUMBERS", numbers)
    fit = b.fit_map(patterns, ["a", "w"])
    draws = b.laplace_draws(spark, fit, chains=3, iterations=2000)
    m = matrix(draws)[fit.names].to_numpy()
    assert m.shape == (6000, 3)
    sd = np.sqrt(np.diag(fit.covariance))
    assert (np.abs(m.mean(axis=0) - fit.theta) < 5 * sd / np.sqrt(6000)).all()
    assert np.allclose(np.cov(m.T), fit.covariance, rtol=0.15, atol=0.1 * sd.min() ** 2)
    again = matrix(b.laplace_draws(spark, fit, chains=3, iterations=2000))[fit.names].to_numpy()
    assert np.array_equal(m, again)
    long = b.long_draws(draws)
    assert b.rhat(long).filter("rhat > 1.01").count() == 0
    assert b.effective_size(long).agg(F.min("ess")).first()[0] > 1500
    few = matrix(b.laplace_draws(spark, fit, chains=3, iterations=2000, limit=500))[fit.names].to_numpy()
    assert np.array_equal(few, m[::12])


@pytest.mark.parametrize("kinds", [1, 2])
def test_group_draws_have_the_whole_covariance(spark, patterns, data, monkeypatch, kinds):
    monkeypatch.setattr(b, "DRAW_NUMBERS", 5000)
    monkeypatch.setattr(b, "GROUP_BUCKET", 3)
    fit = b.fit_map(patterns, ["a", "w"], kinds=kinds, slope="w")
    theta, x, prior = dense(fit, data, kinds)
    p = 1 / (1 + np.exp(-x @ theta))
    want = np.linalg.inv((x * (p * (1 - p))[:, None]).T @ x + prior)
    names = [*fit.names, *(f"{k}[{g}]" for k in ("u", "v")[:kinds] for g in range(1, 9))]
    m = matrix(b.laplace_draws(spark, fit, chains=2, iterations=5000))[names].to_numpy()
    sd = np.sqrt(np.diag(want))
    assert (np.abs(m.mean(axis=0) - theta) < 5 * sd / 100).all()
    assert np.abs(np.cov(m.T) / np.outer(sd, sd) - want / np.outer(sd, sd)).max() < 0.08


def _ess(x):
    n = len(x)
    x = x - x.mean()
    acf = np.correlate(x, x, mode="full")[n - 1 :] / (x.var() * n)
    total, t = 1.0, 1
    while t + 1 < n and acf[t] + acf[t + 1] > 0:
        total += 2 * (acf[t] + acf[t + 1])
        t += 2
    return n / max(total, 1.0)


def test_effective_size_over_segments(spark):
    rng = np.random.default_rng(7)
    chains = []
    for c in range(2):
        x = np.zeros(700)
        for i in range(1, 700):
            x[i] = 0.9 * x[i - 1] + rng.normal()
        chains.append(x)
    rows = [("p", c, i, float(v)) for c, x in enumerate(chains) for i, v in enumerate(x)]
    rows += [("const", 0, i, 1.0) for i in range(50)]
    df = spark.createDataFrame(rows, "param string, chain int, iter int, value double")
    want = sum(_ess(x) for x in chains)
    for segment, reach in ((65_536, 1_024), (64, 64), (64, 6), (4096, 2)):
        got = {r["param"]: r["ess"] for r in b.effective_size(df, segment, reach).collect()}
        assert np.isclose(got["p"], want, rtol=1e-9) and got["const"] == 1.0


def test_short_chains_have_an_effective_size(spark):
    rng = np.random.default_rng(9)
    for n in (1, 2, 3, 4, 9):
        x = np.cumsum(rng.normal(size=n))
        df = spark.createDataFrame([("p", 0, i, float(v)) for i, v in enumerate(x)], "param string, chain int, iter int, value double")
        assert np.isclose(b.effective_size(df).first()["ess"], _ess(x) if x.var() else 1.0)


def test_identical_chains(spark):
    rows = [("p", c, i, float(i % 7)) for c in range(3) for i in range(70)]
    df = spark.createDataFrame(rows, "param string, chain int, iter int, value double")
    assert np.isclose(b.rhat(df).first()["rhat"], np.sqrt(69 / 70))


@pytest.mark.parametrize("numbers, chunk", [(1_000_000, 50_000), (30, 90)])
def test_draws_against_rows(spark, data, monkeypatch, numbers, chunk):
    monkeypatch.setattr(b, "DRAW_NUMBERS", numbers)
    monkeypatch.setattr(b, "ROW_CHUNK", chunk)
    rng = np.random.default_rng(8)
    theta, u = rng.normal(size=(40, 3)) * 0.3, rng.normal(size=(40, 8)) * 0.3
    obs = spark.createDataFrame(data).repartition(4)
    fixed = spark.createDataFrame([(i, t.tolist()) for i, t in enumerate(theta)], "draw long, theta array<double>")
    effects = spark.createDataFrame([(i, g + 1, [float(u[i, g])]) for i in range(40) for g in range(8)],
                                    "draw long, group long, e array<double>")
    draws = b.packed_draws(fixed, ["alpha", "a", "w"], effects, 1)
    x = data[["a", "w"]].to_numpy()
    plain = theta[:, 0] + x @ theta[:, 1:].T
    for given, group, eta in ((b.packed_draws(fixed, ["alpha", "a", "w"]), None, plain),
                              (draws, "g", plain + u[:, data["g"] - 1].T)):
        ll = data["y"].to_numpy()[:, None] * eta - np.logaddexp(0, eta)
        d = -2 * ll.sum(axis=0)
        totals = b.draw_totals(obs, "y", ["a", "w"], given, group)
        got = b.dic(totals).first()
        assert np.isclose(got["dic"], d.mean() + d.var() / 2)
        means = [r["mean_p"] for r in totals.orderBy("draw").collect()]
        assert np.allclose(means, (1 / (1 + np.exp(-eta))).mean(axis=0))
        lse = lambda a: np.log(np.exp(a).sum(axis=1))
        point = lse(2 * ll) - lse(ll)
        e = b.elpd([("m", b.pointwise(obs, "y", "id", ["a", "w"], given, group))]).first()
        assert np.isclose(e["elpd"], point.sum()) and np.isclose(e["se"], np.sqrt(len(point) * point.var(ddof=1)))
        assert np.isclose(e["elpd_loo"], (np.log(40) - lse(-ll)).sum())


def test_slopes_reach_the_rows(spark, data, patterns):
    fit = b.fit_map(patterns, ["a", "w"], kinds=2, slope="w")
    draws = b.laplace_draws(spark, fit, chains=1, iterations=30)
    m = matrix(draws)
    eta = m["alpha"].to_numpy() + data[["a", "w"]].to_numpy() @ m[["beta[a]", "beta[w]"]].to_numpy().T
    for name, times in (("u", np.ones(len(data))), ("v", data["w"].to_numpy())):
        eta += m[[f"{name}[{g}]" for g in range(1, 9)]].to_numpy()[:, data["g"] - 1].T * times[:, None]
    want = (data["y"].to_numpy()[:, None] * eta - np.logaddexp(0, eta)).sum(axis=0)
    got = b.draw_totals(spark.createDataFrame(data), "y", ["a", "w"], draws, "g").orderBy("draw").toPandas()
    assert np.allclose(got["loglik"], want)


def test_predictive_check_covers_the_truth(spark, data, patterns):
    draws = b.laplace_draws(spark, b.fit_map(patterns, ["a", "w"], kinds=1), limit=200)
    obs = spark.createDataFrame(data).withColumn("half", F.when(F.col("g") < 5, "low").otherwise("high"))
    got = b.predictive_check(obs, "y", "id", "half", ["a", "w"], draws, "g").toPandas().set_index("level")
    assert set(got.index) == {"ALL", "low", "high"} and got["covered"].all()
    assert np.isclose(got.loc["ALL", "observed"], data["y"].mean())
