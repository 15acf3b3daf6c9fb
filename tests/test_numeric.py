import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fathomkit.functions.scalars import log_normal_cdf, skew_label
from fathomkit.operators import describe as d
from fathomkit.operators import inference as inf
from fathomkit.operators import ordered as o


def test_log_normal_cdf_in_all_regions(spark):
    z = np.concatenate([np.linspace(-38, 38, 4001), [-0.6629, 0.6629, -5.6568, 5.6568, 0.0, 1e-9, -1e-9]])
    got = spark.createDataFrame(pd.DataFrame({"z": z})).select("z", log_normal_cdf(F.col("z")).alias("l")).toPandas()
    for x, l in zip(got["z"], got["l"]):
        tail = math.erfc(abs(x) / math.sqrt(2)) / 2
        if x < 0 and tail > 1e-290:
            assert math.isclose(l, math.log(tail), rel_tol=2e-14, abs_tol=2e-14), x
        elif x >= 0:
            assert math.isclose(l, math.log1p(-tail), rel_tol=1e-13, abs_tol=1e-300), x


def test_log_normal_cdf_far_out(spark):
    """Against the continued fraction of Mills' ratio, where the function itself is zero in double precision."""
    for x in (40.0, 100.0, 1e4):
        ratio = 0.0
        for k in range(200, 0, -1):
            ratio = k / (x + ratio)
        want = -x * x / 2 - math.log(2 * math.pi) / 2 - math.log(x + ratio)
        got = spark.range(1).select(log_normal_cdf(F.lit(-x))).first()[0]
        assert math.isclose(got, want, rel_tol=1e-14)


def test_normality_has_no_python_worker(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=3000), [12.0, -45.0]]).round(3)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    z = np.sort((x - x.mean()) / x.std(ddof=1))
    n, i = len(z), np.arange(1, len(z) + 1)

    def log_cdf(v):
        out = []
        for t in v:
            tail = math.erfc(-t / math.sqrt(2)) / 2
            out.append(math.log(tail) if tail > 0 else -t * t / 2 - math.log(-t) - math.log(2 * math.pi) / 2 + math.log1p(-1 / t ** 2))
        return np.array(out)

    want = -n - ((2 * i - 1) * (log_cdf(z) + log_cdf(-z[::-1]))).sum() / n
    got = inf.anderson_darling(df, "x").first()
    assert any(math.isclose(v, want, rel_tol=1e-6) or math.isclose(v, want * (1 + 0.75 / n + 2.25 / n ** 2), rel_tol=1e-6)
               for v in got if isinstance(v, float))


@pytest.mark.parametrize("seed", range(4))
def test_kernel_density_against_direct_sums(spark, seed):
    rng = np.random.default_rng(seed)
    x = [rng.normal(size=500), rng.exponential(size=900).round(2), np.r_[rng.normal(size=300), 40 + rng.normal(size=5)],
         rng.integers(0, 4, 200).astype(float)][seed]
    got = d.kde(spark.createDataFrame(pd.DataFrame({"x": x})), "x", 400).toPandas().sort_values("i")
    h = x.std(ddof=1) * len(x) ** -0.2
    lo, hi = x.min(), x.max()
    grid = lo - 0.5 * (hi - lo) + np.arange(400) * 2 * (hi - lo) / 399
    want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    assert np.allclose(got["x"], grid) and np.abs(got["density"].to_numpy() - want).max() < 1e-10 * want.max()


def test_kernel_density_explodes_boxes_only(spark):
    df = spark.range(200_000).select((F.col("id") % 9973).cast("double").alias("x"))
    plan = d.kde(df, "x")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Aggregate [box")  # above the aggregate in the tree


def test_fill_across_stores(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = pd.DataFrame({"s": rng.integers(0, 60, 800), "d": rng.integers(0, 5, 800), "t": np.arange(800)})
    rows["v"] = np.where((rng.random(800) < 0.4) & (rows["s"] % 4 == 1) & (rows["s"] > 6), rng.integers(0, 99, 800), np.nan)
    df = spark.createDataFrame(rows).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    want = rows.sort_values(["s", "d", "t"]).copy()
    want["v"] = want.groupby("s")["v"].transform(lambda x: x.ffill().bfill())
    want["v"] = want["v"].ffill().bfill()
    for size in (1_000_000, 7):
        monkeypatch.setattr(o, "RANGE_ROWS", size)
        got = o.fill_across(df, "s", "d", "t", ["v"]).toPandas().sort_values("t")
        assert np.allclose(got["v"], want.sort_values("t")["v"])
    none = o.fill_across(df.withColumn("v", F.lit(None).cast("double")), "s", "d", "t", ["v"])
    assert none.where("v IS NOT NULL").isEmpty()


def test_skew_classes(spark):
    got = [r[0] for r in spark.createDataFrame([(x,) for x in (-2.0, -0.5, -0.49, 0.0, 0.49, 0.5, 3.0)], "s double").select(
        skew_label(F.col("s"))).collect()]
    assert [t.split("-")[0].split()[0] for t in got] == ["left", "left", "approximately", "approximately", "approximately", "right", "right"]
