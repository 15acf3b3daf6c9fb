import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fathomkit import store as st
from fathomkit.operators import learn
from fathomkit.session import fresh_path


@pytest.fixture
def store(spark):
    return st.Store(spark, fresh_path(spark, "store"))


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1200, 4)).round(3)
    y = (x[:, 0] * x[:, 1] + x[:, 2] + rng.normal(size=1200) > 1).astype(int)
    flat = [(*map(float, r), int(c)) for r, c in zip(x, y)]
    return spark.createDataFrame(flat, "f0 double, f1 double, f2 double, f3 double, label int")


def test_fingerprint_follows_rows_and_not_their_order(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, 1, "x"), (2, 2, None)], "a int, b int, c string")
    same = st.fingerprint(df)
    assert same == st.fingerprint(df.repartition(3).orderBy(F.desc("c")))
    others = [df.union(df.limit(1)), df.where("a = 2"), df.withColumn("a", F.col("b")), df.withColumnRenamed("a", "z"),
              spark.createDataFrame([(None, 1, "x"), (None, 1, "x"), (2, 2, None)], df.schema), df.limit(0)]
    assert len({same, *map(st.fingerprint, others)}) == 1 + len(others)


def test_keys_follow_values_and_code():
    assert st.key_of("a", {"x": 1, "y": [2]}) == st.key_of("a", {"y": [2], "x": 1})
    keys = [st.key_of("a"), st.key_of("b"), st.key_of("a", {"x": 2}), st.key_of("a", modules=(learn,)),
            st.key_of("a", modules=(st,))]
    assert len(set(keys)) == len(keys)


def test_a_table_is_made_once(spark, store):
    made = []

    def make():
        made.append(1)
        return spark.range(5)

    assert store.table("k", make).count() == 5 and store.table("k", make).count() == 5
    assert len(made) == 1 and store.has("tables", "k") and not store.has("tables", "other")


def test_what_fails_leaves_no_entry(spark, store):
    with pytest.raises(Exception):
        store.table("k", lambda: spark.range(3).select(F.raise_error(F.lit("no")).alias("x")))
    assert not store.has("tables", "k")
    assert store.table("k", lambda: spark.range(3)).count() == 3


def test_the_first_of_two_writers_wins(spark, store):
    def late():
        store.table("k", lambda: spark.range(7))
        return spark.range(2)

    assert store.table("k", late).count() == 7


def test_a_search_is_fitted_once(spark, store, rows):
    made = []

    def make():
        made.append(1)
        return learn.grid_search(
            LogisticRegression(), {"regParam": [0.01, 0.1]}, learn.ensure_features(rows), ["f0", "f1"])

    first, again = (store.search("k", make, LogisticRegressionModel) for _ in range(2))
    assert len(made) == 1 and first.grid == again.grid and first.seconds == again.seconds > 0
    assert [p for p, _ in first.grid] == ["regParam=0.01", "regParam=0.1"] and all(0.5 < a < 1 for _, a in first.grid)
    assert np.array_equal(first.model.coefficients.toArray(), again.model.coefficients.toArray())


def area(scored, column):
    return BinaryClassificationEvaluator(rawPredictionCol=column, labelCol="label").evaluate(scored)


def test_whole_forest_scores_are_the_models(spark, rows):
    train = learn.ensure_features(rows)
    model = RandomForestClassifier(numTrees=7, maxDepth=6, seed=3).fit(train)
    shares = learn.forest_shares(spark, model, [0, 2, 6])
    assert len(shares) == 7
    scored = learn.forest_scores(model, train, [0, 2, 6], [3, 7]).orderBy("label").toPandas()
    grown = np.stack(scored["grown"])
    assert grown.shape == (1200, 6)
    want = model.transform(train).select("label", vector_to_array("probability")[1].alias("p")).toPandas()
    assert np.allclose(np.sort(grown[:, 5]), np.sort(want["p"]))
    # at depth 0 every row is at the root, whose share is that of the tree's own sample
    assert np.ptp(grown[:, 0]) == 0 and abs(grown[0, 1] - want["label"].mean()) < 0.05


def test_cut_trees_are_the_shallow_ones(spark, rows):
    """Without samples of rows and features a tree cut at a depth is the tree grown to that depth."""
    train = learn.ensure_features(rows)
    forest = RandomForestClassifier(numTrees=1, featureSubsetStrategy="all", bootstrap=False, seed=3)
    deep = forest.copy({forest.maxDepth: 8}).fit(train)
    cut = np.stack(learn.forest_scores(deep, train, [1, 3, 6], [1]).toPandas()["grown"])
    for i, depth in enumerate((1, 3, 6)):
        flat = forest.copy({forest.maxDepth: depth}).fit(train)
        want = flat.transform(train).select(vector_to_array("probability")[1].alias("p")).toPandas()["p"]
        assert np.allclose(np.sort(cut[:, i]), np.sort(want)), depth


def test_forest_search_finds_the_grid(spark, rows):
    train = learn.ensure_features(rows)
    grid = {"numTrees": [3, 12], "maxDepth": [1, 5], "minInstancesPerNode": [1, 40]}
    model, areas = learn.forest_search(RandomForestClassifier(seed=1, labelCol="label"), grid, train, ["f0", "f1"])
    assert len({p for p, _ in areas}) == 8
    best = dict(p.split("=") for p in max(areas, key=lambda a: a[1])[0].split(", "))
    assert model.getNumTrees == int(best["numTrees"]) and model.getOrDefault("maxDepth") == int(best["maxDepth"])
    by = dict(areas)
    assert by["maxDepth=5, minInstancesPerNode=1, numTrees=12"] > by["maxDepth=1, minInstancesPerNode=1, numTrees=3"]
