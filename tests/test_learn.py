import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from fathomkit.operators import evaluate as ev
from fathomkit.operators import learn
from fathomkit.operators import neighbours as nb
from fathomkit.session import fresh_path


def brute(x, k):
    """Distances of each distinct point to its k nearest others, with its copies."""
    distinct, weight = np.unique(x, axis=0, return_counts=True)
    d = np.sqrt(((distinct[:, None] - distinct[None]) ** 2).sum(axis=2))
    return {tuple(r): (int(w), np.sort(row)[1:k + 1]) for r, w, row in zip(distinct, weight, d)}


def check_neighbours(rows, x, k):
    want = brute(x, k)
    assert len(rows) == len(want)
    for r in rows:
        own, d = want[tuple(r["x"])]
        assert r["w"] == own
        if own <= k:  # else its copies are its neighbours
            have, used = own - 1, 0
            while have < k:
                have += r["near"][used]["w"]
                used += 1
            assert np.allclose([m["d"] for m in r["near"][:used]], d[:used])


@pytest.mark.parametrize("part_size, visits", [(10_000, 20_000), (60, 30)])
def test_neighbours_match_brute_force(spark, monkeypatch, part_size, visits):
    monkeypatch.setattr(nb, "VISITS", visits)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 3)).round(2)
    x[:200] = x[0]  # a third of all points are one point
    x[200:203] = x[203]
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>")
    check_neighbours(nb.nearest(df, 5, part_size).collect(), x, 5)


def clustered(n, seed=14, dims=30, clusters=24):
    """Points of many dimensions that lie near few centres, a third of them near one."""
    rng = np.random.default_rng(seed)
    of = np.where(rng.random(n) < 1 / 3, 0, rng.integers(0, clusters, n))
    return rng.normal(size=(clusters, dims))[of] * 4 + rng.normal(size=(n, dims)) * rng.uniform(0.2, 0.8, clusters)[of, None]


def test_neighbours_in_thirty_dimensions(spark):
    x = clustered(4000)
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>")
    for part_size in (10_000, 300):
        rows = nb.nearest(df, 5, part_size).collect()
        check_neighbours(rows, x, 5)
        share = sum(r["compared"] for r in rows) / len(x) ** 2
        assert share < 0.3, (part_size, share)


def test_neighbours_without_structure_stay_exact(spark):
    x = np.random.default_rng(15).normal(size=(700, 30))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>")
    check_neighbours(nb.nearest(df, 3, 150).collect(), x, 3)


def test_neighbours_are_named_until_the_nearest_are_known(spark, monkeypatch):
    """No table on the way holds the coordinates of neighbours, nor one row for each visit."""
    x, held, real = clustered(900), [], nb.hold
    monkeypatch.setattr(nb, "hold", lambda df: held.append(real(df)) or held[-1])
    rows = nb.nearest(spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>"), 5, 100).collect()
    check_neighbours(rows, x, 5)
    assert not [df.columns for df in held if "near" in df.columns and "x:" in df.schema["near"].dataType.simpleString()]
    assert max(df.count() for df in held) <= len(rows)


def test_only_near_pairs_are_measured():
    """One matrix product leaves out what is too far, and nothing else; the distances stay those of the definition."""
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(60, 30)) + 1e4, rng.normal(size=(200, 30)) + 1e4
    b[:20] = a[:20]
    d = nb._distances(a, b)
    than = np.sort(d, axis=1)[:, 4]
    i, j, got = nb._nearer(a, b, than)
    assert (got == d[i, j]).all() and set(zip(*np.nonzero(d <= than[:, None]))) <= set(zip(i, j)) and len(i) < 0.2 * d.size
    assert len(nb._nearer(a, b, np.full(60, np.inf))[0]) == d.size


def test_few_points(spark):
    one = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0],)], "x array<double>")
    assert [(r["w"], r["near"]) for r in nb.nearest(one, 5).collect()] == [(2, [])]
    assert nb.nearest(one.where("false"), 5).collect() == []


def test_smote_invariants(spark):
    rng = np.random.default_rng(10)
    common = [(0, float(a), float(b)) for a, b in rng.normal(size=(900, 2))]
    rare = [(1, float(a), float(b)) for a, b in rng.normal(size=(60, 2)) + 4]
    rare += [(1, 4.0, 4.0)] * 30
    df = spark.createDataFrame(common + rare, "label int, f0 double, f1 double")
    out = learn.smote(df, ["f0", "f1"], "label", part_size=20).toPandas()
    kept = out[out["synthetic"] == 0]
    assert len(kept) == 990 and (out["label"] == 1).sum() == 450
    pts = np.array([(a, b) for _, a, b in rare])
    for p in out[out["synthetic"] == 1][["f0", "f1"]].to_numpy():
        # on a segment between two minority rows: |ap| + |pb| = |ab| for some pair
        d = np.sqrt(((pts - p) ** 2).sum(axis=1))
        ab = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(axis=2))
        assert np.abs(d[:, None] + d[None] - ab).min() < 1e-6
    again = learn.smote(df.repartition(5), ["f0", "f1"], "label", part_size=20).toPandas()
    order = ["synthetic", "f0", "f1"]
    assert np.allclose(out.sort_values(order)[order].to_numpy(), again.sort_values(order)[order].to_numpy())


def test_hot_point_quota_is_spread(spark):
    df = spark.createDataFrame([(0, float(i)) for i in range(9000)] + [(1, 1.0)] * 9 + [(1, 2.0)], "label int, f0 double")
    out = learn.smote(df, ["f0"], "label").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in out} == {0: 9000, 1: 4500}


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(11)
    y = (rng.random(800) < 0.2).astype(int)
    s = np.clip(rng.normal(size=800) * 0.2 + 0.3 + 0.25 * y, 0, 1).round(3)
    return spark.createDataFrame(pd.DataFrame({"model": "m", "score": s, "label": y}))


def test_metrics_match_the_evaluators(scored):
    raw = scored.withColumn("rawPrediction", F.col("score")).withColumn("label", F.col("label").cast("double"))
    auc = BinaryClassificationEvaluator(numBins=0).evaluate(raw)
    assert np.isclose(ev.roc_auc(ev.roc_points(scored)).first()["auc"], auc)
    m = ev.weighted_metrics(ev.confusion(scored)).first()
    pred = raw.withColumn("prediction", (F.col("score") >= 0.5).cast("double"))
    for ours, theirs in (
        ("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1"),
    ):
        assert np.isclose(m[ours], MulticlassClassificationEvaluator(metricName=theirs).evaluate(pred)), ours


def test_threshold_scan_matches_a_pass_per_threshold(scored):
    pdf = scored.toPandas()
    got = ev.threshold_scan(scored, ev.default_thresholds()).toPandas().sort_values("threshold")
    assert len(got) == 200
    for t, tp, fp, fn in zip(got["threshold"], got["tp"], got["fp"], got["fn"]):
        hit = pdf["score"] >= t
        assert (tp, fp, fn) == ((hit & (pdf.label == 1)).sum(), (hit & (pdf.label == 0)).sum(), (~hit & (pdf.label == 1)).sum())
    best = ev.best_threshold(ev.threshold_scan(scored, ev.default_thresholds())).first()
    assert np.isclose(best["f2"], got["f2"].max())


def test_average_precision(scored):
    pdf = scored.toPandas().sort_values("score", ascending=False)
    per = pdf.groupby("score")["label"].agg(["sum", "count"]).sort_index(ascending=False)
    tp, n = per["sum"].cumsum(), per["count"].cumsum()
    want = (per["sum"] / pdf["label"].sum() * tp / n).sum()
    got = ev.pr_summary(ev.pr_points(scored)).first()
    assert np.isclose(got["average_precision"], want) and abs(got["near_recall"] - 0.9) < 0.02


def test_search_save_and_scores(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(300, 2))
    y = (x[:, 0] + 0.3 * rng.normal(size=300) > 0).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"f0": x[:, 0], "f1": x[:, 1], "label": y}))
    train = learn.ensure_features(df)
    for estimator, grid in (
        (LogisticRegression(), {"regParam": [0.01], "elasticNetParam": [0.0, 0.5]}),
        (RandomForestClassifier(seed=1), {"numTrees": [5], "maxDepth": [2, 3]}),
        (GBTClassifier(seed=1), {"maxIter": [3], "stepSize": [0.2, 0.3]}),
    ):
        best, grid = learn.grid_search(estimator, grid, train, ["f0", "f1"])
        scores = learn.score_table(best, train, "m")
        assert ev.roc_auc(ev.roc_points(scores)).first()["auc"] > 0.9
        assert learn.grid_table(spark, {"m": grid}).count() == 2
    model = LogisticRegression().fit(train)
    again = LogisticRegressionModel.load(learn.save_model(model, fresh_path(spark, "m")))
    assert np.allclose(again.coefficients.toArray(), model.coefficients.toArray())
    top = learn.ranked_weights(spark, ["f0", "f1"], model.coefficients.toArray(), "coefficient").first()
    assert top["feature"] == "f0"


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, None), (3.0, 5.0)], "c double, v double")
    got = learn.min_max(learn.standardise(df, ["c"]), ["c", "v"]).collect()
    assert [(r["c_scaled"], r["c_norm"], r["v_norm"]) for r in got] == [(0.0, 0.0, 0.0), (0.0, 0.0, None), (0.0, 0.0, 1.0)]


def test_logistic_fits_share_passes_and_match_the_learner(spark, monkeypatch):
    """Each fit is that of the learner outside its fold; the search fits by the learner only once, and ranks as it does."""
    rng = np.random.default_rng(21)
    x = rng.normal(size=(600, 4)) * [1, 3, 0.5, 1]
    x[:, 3] = x[:, 0] + 0.1 * x[:, 3]
    y = (x[:, 0] - 0.5 * x[:, 1] + rng.normal(size=600) > 1).astype(int)
    keys = ["f0", "f1", "f2", "f3"]
    train = learn.ensure_features(spark.createDataFrame(pd.DataFrame(x, columns=keys).assign(label=y)))
    grid = {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0]}
    points = [(r, e) for r in grid["regParam"] for e in grid["elasticNetParam"]]
    rows = learn.folded(train, keys)
    fits = learn.logistic_fits(rows, keys, "label", points, 1e-6, 100)
    for f, i in ((0, 0), (1, 1), (2, 2), (0, 4), (1, 5)):
        want = LogisticRegression(standardization=False, tol=1e-12, maxIter=1000, regParam=points[i][0],
                                  elasticNetParam=points[i][1]).fit(rows.where(F.col("_fold") != f))
        assert np.allclose(fits[f, i], np.r_[want.intercept, want.coefficients.toArray()], atol=1e-4), (f, i)
    make = LogisticRegression(standardization=False, tol=1e-6)
    want_model, want_areas = learn.grid_search(make, grid, train, keys)
    times, fit = [], LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, df: times.append(1) or fit(self, df))
    model, areas = learn.logistic_search(make, grid, train, keys)
    assert len(times) == 1 and [p for p, _ in areas] == [p for p, _ in want_areas]
    assert np.allclose([a for _, a in areas], [a for _, a in want_areas], atol=2e-3)
    assert np.allclose(model.coefficients.toArray(), want_model.coefficients.toArray(), atol=1e-4)


def test_fits_run_over_even_tasks(spark, monkeypatch):
    """Files of any size are dealt out evenly; many tasks leave room for one fit at a time."""
    monkeypatch.setattr(learn, "FIT_ROWS", 100)
    lopsided = spark.range(0, 10, 1, 5).union(spark.range(10, 1000, 1, 1)).select(F.col("id").cast("double").alias("f0"))
    rows = learn.folded(lopsided, ["f0"])
    sizes = rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(sizes) == 10 and min(sizes) > 80 and max(sizes) < 120
    assert learn.at_once(rows, 6) == 4 and learn.at_once(rows.repartition(40), 6) == 1 and learn.at_once(rows.coalesce(1), 6) == 6


def test_forest_search_keeps_the_nodes_of_rows(spark, monkeypatch):
    """Rows do not walk the trees from their roots at each level, and the trees are the same."""
    x = np.random.default_rng(22).normal(size=(500, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0.5).astype(int)
    train = learn.ensure_features(spark.createDataFrame(pd.DataFrame(x, columns=["f0", "f1", "f2"]).assign(label=y)))
    forest, kept, fit = RandomForestClassifier(seed=3), [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: kept.append(self.getCacheNodeIds()) or fit(self, df))
    grid = {"numTrees": [3], "maxDepth": [5]}
    best, _ = learn.forest_search(forest, grid, train, ["f0", "f1", "f2"])
    assert len(kept) == 4 and all(kept)
    rows = learn.folded(train, ["f0", "f1", "f2"])
    walked = forest.copy({forest.numTrees: 3, forest.maxDepth: 5}).fit(rows)
    assert best.toDebugString.split("\n", 1)[1] == walked.toDebugString.split("\n", 1)[1]


def test_boosted_fits_share_passes_and_match_the_learner(spark, monkeypatch):
    """The areas of all folds and points are the learner's; the search fits by the learner only once, and picks as it does."""
    rng = np.random.default_rng(23)
    x = rng.normal(size=(900, 4)).round(2)
    x[:, 1], x[:, 2] = rng.integers(0, 5, 900), 7.0  # few values, and one
    y = (x[:, 0] * x[:, 3] + 0.4 * x[:, 1] + rng.normal(size=900) > 1.5).astype(int)
    keys = ["f0", "f1", "f2", "f3"]
    flat = spark.createDataFrame(pd.DataFrame(x, columns=keys).assign(label=y))
    grid = {"maxIter": [4], "maxDepth": [2, 5], "stepSize": [0.1, 0.3]}
    make = GBTClassifier(labelCol="label", seed=3)
    want_model, want = learn.grid_search(make, grid, learn.ensure_features(flat), keys)
    times, fit = [], GBTClassifier._fit
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, df: times.append(1) or fit(self, df))
    model, areas = learn.boosted_search(make, grid, flat, keys)
    assert len(times) == 1 and [p for p, _ in areas] == [p for p, _ in want]
    assert np.allclose([a for _, a in areas][:2], [a for _, a in want][:2], atol=1e-9)
    assert np.allclose([a for _, a in areas], [a for _, a in want], atol=2e-3)  # deep nodes have few rows and many equal cuts
    assert model.toDebugString.split("\n", 1)[1] == want_model.toDebugString.split("\n", 1)[1]
    with pytest.raises(ValueError):
        learn.boosted_search(make, {"maxIter": [2, 4]}, flat, keys)


def test_forests_share_passes_and_match_the_learner(spark, monkeypatch):
    """No forest is fitted by the learner; one tree of all rows and features is the learner's, areas are near to its own."""
    rng = np.random.default_rng(24)
    x = rng.normal(size=(1500, 5)).round(2)
    x[:, 1], x[:, 2] = rng.integers(0, 5, 1500), 7.0  # few values, and one
    y = (x[:, 0] * x[:, 3] + 0.4 * x[:, 1] + 0.5 * rng.normal(size=1500) > 1.2).astype(int)
    keys = [f"f{i}" for i in range(5)]
    flat = spark.createDataFrame(pd.DataFrame(x, columns=keys).assign(label=y))
    train = learn.ensure_features(flat)
    one = RandomForestClassifier(seed=3, featureSubsetStrategy="all", bootstrap=False)
    tree = {"numTrees": [1], "maxDepth": [2, 4], "minInstancesPerNode": [20]}
    want_model, want = learn.forest_search(one, tree, train, keys)
    forest = RandomForestClassifier(seed=3, featureSubsetStrategy="sqrt")
    grid = {"numTrees": [20, 40], "maxDepth": [3, 6], "minInstancesPerNode": [1, 5]}
    _, want_forest = learn.forest_search(forest, grid, train, keys)
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: pytest.fail("a fit of its own"))
    model, areas = learn.shared_forest_search(one, tree, flat, keys)
    assert [p for p, _ in areas] == [p for p, _ in want] and np.allclose([a for _, a in areas], [a for _, a in want], atol=1e-9)
    assert model.toDebugString.split("\n", 1)[1] == want_model.toDebugString.split("\n", 1)[1]
    assert np.allclose(model.featureImportances.toArray(), want_model.featureImportances.toArray())
    monkeypatch.setattr(learn, "BAG", 200)
    best, areas = learn.shared_forest_search(forest, grid, flat, keys)
    assert [p for p, _ in areas] == [p for p, _ in want_forest]
    assert np.allclose([a for _, a in areas], [a for _, a in want_forest], atol=0.04)
    assert ev.roc_auc(ev.roc_points(learn.score_table(best, train, "m"))).first()["auc"] > 0.95
    assert f"numTrees={best.getNumTrees}" in max(areas, key=lambda a: a[1])[0]
    few = {"numTrees": [3], "maxDepth": [3]}
    best, areas = learn.shared_forest_search(forest, few, flat, keys)
    monkeypatch.setattr(learn, "WAVE_BYTES", 1)  # one tree at a time grows the same forest
    again, one_by_one = learn.shared_forest_search(forest, few, flat, keys)
    assert np.isclose(areas[0][1], one_by_one[0][1]) and again.toDebugString.split("\n", 1)[1] == best.toDebugString.split("\n", 1)[1]
    with pytest.raises(ValueError):
        learn.shared_forest_search(forest, {**grid, "maxBins": [16]}, flat, keys)


def test_balance_writes_wide_rows_once(spark, sf, monkeypatch):
    """Statistics, scaling and oversampling read the joined orders, which are not written in scaled form as well."""
    from fathomkit.plans import learning
    seen, real = [], learning.hold
    monkeypatch.setattr(learning, "hold", lambda df: seen.append(df.columns) or real(df))
    learning.k05_balance(spark, sf).collect()
    assert seen == [["o_orderkey", *learning.WIDE_FEATURES, "label"]]
