import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomkit.operators import ordered as o
from fathomkit.operators.clean import cap_outliers, fill_median, null_counts, null_exactly


@pytest.fixture
def skewed(spark):
    """A third of all rows share one group and one value; some values are null."""
    rng = np.random.default_rng(1)
    rows = [(i, "hot", 7.5) for i in range(1000)]
    rows += [(1000 + i, f"g{i % 5}", float(round(v, 2))) for i, v in enumerate(rng.normal(size=1990) * 50)]
    rows += [(2990 + i, "g1", None) for i in range(10)]
    return spark.createDataFrame(rows, "id long, g string, v double").repartition(6)


@pytest.mark.parametrize("cells", [1_024, 3])
def test_quantiles_are_exact_with_any_number_of_cells(skewed, monkeypatch, cells):
    monkeypatch.setattr(o, "CELLS", cells)
    probs = [0.0, 0.025, 0.25, 0.5, 0.75, 0.975, 1.0]
    pdf = skewed.toPandas().dropna()
    got = {r["g"]: r for r in o.quantiles(skewed, ["v"], probs, by=["g"]).collect()}
    for g, part in pdf.groupby("g"):
        want = np.quantile(part["v"], probs)
        have = [got[g][f"p{p * 100:g}".replace(".", "_")] for p in probs]
        assert np.allclose(have, want), g
    one = o.quantiles(skewed, ["v"], [0.5]).first()
    assert one["n"] == 2990 and np.isclose(one["p50"], pdf["v"].median())


def test_quartile_fixture(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    r = o.quantiles(df, ["v"], [0.25, 0.5]).first()
    assert (r["p25"], r["p50"]) == (1.75, 2.5)


def test_quantiles_of_hard_values(spark):
    hard = [1e308, -1e308, 5e-324, -5e-324, 0.0, 1.0, 1.0 + 2 ** -52, 1e-300, 3.0, 3.0, 3.0, float("nan")]
    df = spark.createDataFrame([(x, None) for x in hard] + [(None, None)], "v double, w double")
    probs = [0.0, 0.1, 0.33, 0.5, 0.77, 0.9]
    got = o.quantiles(df, ["v", "w"], probs).collect()
    assert len(got) == 1 and got[0]["n"] == 11
    want = np.quantile(np.asarray(hard[:-1]), probs)
    assert np.allclose([got[0][f"p{p * 100:g}"] for p in probs], want, rtol=1e-12, atol=0)
    ends = spark.createDataFrame([(float("-inf"),), (float("inf"),), (2.0,)], "v double")
    assert o.quantiles(ends, ["v"], [0.0, 0.5, 1.0]).first()[2:] == (float("-inf"), 2.0, float("inf"))


def test_many_ranges_give_the_same(skewed, monkeypatch):
    monkeypatch.setattr(o, "RANGE_ROWS", 50)
    test_running_totals_and_rank(skewed)


def test_running_totals_and_rank(skewed):
    pdf = skewed.toPandas().dropna()
    per = skewed.filter("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("n"))
    got = o.running_totals(per, ["v"], ["n"]).toPandas().sort_values("v")
    assert (got["cum_n"].to_numpy() == got["n"].cumsum().to_numpy()).all()
    assert (got["tot_n"] == 2990).all()
    for down in (False, True):
        ranked = o.global_rank(skewed.filter("v IS NOT NULL"), "v", "id", descending=down).toPandas()
        want = pdf.sort_values(["v", "id"], ascending=[not down, True])["id"].tolist()
        assert ranked.sort_values("rank")["id"].tolist() == want


def test_tiles_match_ntile(spark):
    for n in (3, 5, 12, 17):
        df = spark.range(1, n + 1).select(
            F.col("id").alias("rank"), o.tile_of(F.col("id"), F.lit(n), 5).alias("t")
        )
        spark.range(1, n + 1).createOrReplaceTempView("r")
        want = [x[0] for x in spark.sql("SELECT ntile(5) OVER (ORDER BY id) t FROM r ORDER BY id").collect()]
        assert [r["t"] for r in df.orderBy("rank").collect()] == want


def test_fill_forward_then_backward(spark):
    rng = np.random.default_rng(2)
    rows = [
        (i, "hot" if i % 3 == 0 else f"s{i % 7}", int(rng.integers(0, 20)), None if rng.random() < 0.7 else float(i))
        for i in range(600)
    ]
    rows += [(900 + i, "empty", i, None) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, s string, d int, v double")
    pdf = df.toPandas().sort_values(["s", "d", "id"])
    want = pdf.groupby("s")["v"].transform(lambda c: c.ffill().bfill())
    got = o.fill_along(df, "s", "d", "id", ["v"]).toPandas().set_index("id").loc[pdf["id"]]
    assert np.array_equal(got["v"].to_numpy(), want.to_numpy(), equal_nan=True)


def test_dense_index_of_any_type_and_size(spark):
    df = spark.createDataFrame([(x,) for x in (30, 10, 10, 99, 30, None)], "c int")
    assert {tuple(r) for r in o.dense_index(df, "c", "i").collect()} == {(10, 1), (30, 2), (99, 3)}
    codes = spark.range(250_000).select(F.concat(F.lit("code-"), F.hex("id")).alias("c"))
    got = o.dense_index(codes, "c", "i")
    place = {r["c"]: r["i"] for r in got.collect()}
    assert [place[c] for c in sorted(place)] == list(range(1, 250_001))


def test_imputation_and_capping(skewed):
    filled = fill_median(skewed, ["v"]).toPandas()
    assert filled["v"].notna().all() and len(filled) == 3000
    capped = cap_outliers(skewed, ["v"], width=0.5)
    pdf = skewed.toPandas()["v"].dropna()
    q1, q3 = pdf.quantile(0.25), pdf.quantile(0.75)
    out = capped.toPandas()
    assert out["v_capped"].sum() == ((pdf < q1 - 0.5 * (q3 - q1)) | (pdf > q3 + 0.5 * (q3 - q1))).sum()
    assert out["v"].isna().sum() == 10
    holed = null_exactly(skewed.filter("v IS NOT NULL"), "v", ["id"], 500)
    assert {r["column"]: r["nulls"] for r in null_counts(holed).collect()} == {"id": 0, "g": 0, "v": 500}


def test_global_rank_deals_the_rows_out_once(spark):
    """Whole rows are held once beside what they came from, and no join or window deals them out again."""
    df = spark.range(0, 3000, 1, 4).select(F.col("id"), (F.col("id") % 7).cast("double").alias("v"), F.lit("x" * 20).alias("rest"))
    ranked = o.global_rank(df.withColumn("v", F.when(F.col("id") >= 10, F.col("v"))), "v", "id")
    assert "SortMergeJoin" not in (plan := ranked._jdf.queryExecution().executedPlan().toString()) and "Window" not in plan
    got = ranked.orderBy("rank").collect()
    want = sorted((i % 7, i) for i in range(10, 3000))  # ten rows without a value stand before all others
    assert [(r["v"], r["id"], r["rank"], r["total"]) for r in got] == [(v, i, n, 3000) for n, (v, i) in enumerate(want, 11)]
