"""Feature, oversampling, training and evaluation jobs."""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel,
    RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomkit.functions.scalars import rd
from fathomkit.operators import evaluate as ev
from fathomkit.operators import bayes, learn, neighbours, sampling
from fathomkit.operators.sampling import stratified_split
from fathomkit.plans import inputs
from fathomkit.plans.inputs import WIDE, WIDE_FEATURES, table, wide_orders
from fathomkit.plans.ordering import SCORES, scores
from fathomkit.plans.registry import query, rsql
from fathomkit.session import fresh_path, hold
from fathomkit.sources.files import read_csv, read_parquet, write_csv, write_parquet
from fathomkit.store import Store, fingerprint, key_of

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]

# Large quantities at a deep discount are mostly rare, and a part of what lies near them is too; which part depends on
# the order and not on the features, so no model can be perfect.
RARE = (
    "(l_quantity >= 48 AND l_discount >= 0.09 AND l_orderkey % 10 <> 3) OR "
    "(l_quantity >= 44 AND l_discount >= 0.07 AND l_orderkey % 12 = 5)"
)

# The three searches. How an estimator is made, the grid it is searched over, and the class of its model.
SEARCHES = {
    "Logistic Regression": (
        lambda: LogisticRegression(labelCol="label", standardization=False, tol=1e-6),
        {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0]}, LogisticRegressionModel,
    ),
    "Random Forest": (
        lambda: RandomForestClassifier(labelCol="label", seed=learn.SEED, featureSubsetStrategy="sqrt"),
        {"numTrees": [50, 100], "maxDepth": [8, 12], "minInstancesPerNode": [1, 5]}, RandomForestClassificationModel,
    ),
    "Gradient-Boosted Trees": (
        lambda: GBTClassifier(labelCol="label", seed=learn.SEED),
        {"maxIter": [50], "maxDepth": [4, 6], "stepSize": [0.1, 0.2, 0.3]}, GBTClassificationModel,
    ),
}
WIDE_FLAT = [f"f{i}" for i in range(len(WIDE_FEATURES))]


def rare_lines(spark, sf_dir):
    """Order lines with a rare class."""
    return table(spark, sf_dir, "lineitem").select(
        *KEYS, *FEATURES, F.expr(f"CAST({RARE} AS INT)").alias("label"),
    )


class LearningSets:
    """Orders with 30 scaled features f0..f29, split per class, and the three searches on them.

    The split, the oversampled training rows and every search come from the store where an earlier job left them.
    """

    def __init__(self, spark, sf_dir):
        self.store, rows = Store(spark), wide_orders(spark, sf_dir)
        self.of = key_of(fingerprint(rows), modules=(inputs, learn, neighbours, sampling, bayes))
        self.split = self.store.table(key_of("split", self.of), lambda: self._split(rows))
        self.test = learn.ensure_features(self.split.filter("split = 'test'"))

    @staticmethod
    def _split(rows):
        scaled = learn.standardise(rows, WIDE_FEATURES).select(
            "o_orderkey", "label", *[F.col(f"{c}_scaled").alias(f) for c, f in zip(WIDE_FEATURES, WIDE_FLAT)])
        return stratified_split(scaled, "label", ["o_orderkey"])

    def oversampled(self):
        return self.store.table(key_of("train", self.of), lambda: learn.smote(
            self.split.filter("split = 'train'"), WIDE_FLAT, "label"))

    def search(self, name):
        make, grid, kind = SEARCHES[name]
        run = {LogisticRegressionModel: learn.logistic_search, RandomForestClassificationModel: learn.shared_forest_search,
               GBTClassificationModel: learn.boosted_search}[kind]
        estimator = make()
        set_to = {p.name: str(v) for p, v in estimator.extractParamMap().items()}
        key = key_of(name, grid, {k: v for k, v in set_to.items() if not k.endswith("Col")}, self.of)
        return self.store.search(key, lambda: run(estimator, grid, self.oversampled(), WIDE_FLAT), kind)

    def scores(self):
        """(model, score, label) of the three best models on the untouched test rows."""
        return reduce(DataFrame.unionByName, (
            learn.score_table(self.search(name).model, self.test, name) for name in SEARCHES))


@query("k01_standardise", f"""
SELECT l_orderkey, l_linenumber, """ + ", ".join(
    f"""{rsql(f"(@ - (SELECT avg(@) FROM lineitem)) / (SELECT stddev(@) FROM lineitem)".replace("@", c), 5)} AS {c}_scaled"""
    for c in FEATURES) + " FROM lineitem")
def k01(spark, sf_dir):
    return learn.standardise(rare_lines(spark, sf_dir), FEATURES).select(
        "l_orderkey", "l_linenumber", *[rd(f"{c}_scaled", 5).alias(f"{c}_scaled") for c in FEATURES]
    )


@query("k02_standardise_population", f"""
SELECT o_orderkey, {rsql("(o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / (SELECT stddev_pop(o_totalprice) FROM orders)", 5)} AS o_totalprice_std
FROM orders""")
def k02(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return learn.standardise(rows, ["o_totalprice"], population=True, suffix="_std").select(
        "o_orderkey", rd("o_totalprice_std", 5).alias("o_totalprice_std")
    )


@query("k03_min_max", f"""
SELECT o_orderkey, {rsql("(o_totalprice - (SELECT min(o_totalprice) FROM orders)) / (SELECT max(o_totalprice) - min(o_totalprice) FROM orders)", 6)} AS o_totalprice_norm,
       0.0::DOUBLE AS flat_norm FROM orders""")
def k03(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.lit(3.0).alias("flat"))
    return learn.min_max(rows, ["o_totalprice", "flat"]).select(
        "o_orderkey", rd("o_totalprice_norm", 6).alias("o_totalprice_norm"), "flat_norm"
    )


@query("k04_assemble", """
SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2, l_tax AS f3
FROM lineitem WHERE l_orderkey % 13 <> 0""")
def k04(spark, sf_dir):
    """Rows whose discount is missing (every 13th order) are skipped by the assembler."""
    holed = rare_lines(spark, sf_dir).withColumn(
        "l_discount", F.when(F.col("l_orderkey") % 13 != 0, F.col("l_discount"))
    )
    packed = learn.assemble(holed, FEATURES).select("l_orderkey", "l_linenumber", "features")
    return learn.flatten(packed, "features", len(FEATURES))


@query("k04_wide_features", f"""WITH {WIDE}
SELECT o_orderkey, label, {", ".join(f"{rsql(c, 6)} AS f{i}" for i, c in enumerate(WIDE_FEATURES))} FROM wide""")
def k04_wide(spark, sf_dir):
    """Thirty features an order, packed and unpacked again."""
    packed = learn.assemble(wide_orders(spark, sf_dir), WIDE_FEATURES).select("o_orderkey", "label", "features")
    flat = learn.flatten(packed, "features", len(WIDE_FEATURES))
    return flat.select("o_orderkey", "label", *[rd(c, 6).alias(c) for c in WIDE_FLAT])


@query("k05_smote")
def k05(spark, sf_dir):
    return LearningSets(spark, sf_dir).oversampled()


@query("k05_smote_balance", f"""WITH {WIDE}, c AS (
SELECT count(*) FILTER (label = 1) AS rare, count(*) FILTER (label = 0) AS common FROM wide)
SELECT 0 AS label, 0 AS synthetic, common AS n FROM c UNION ALL SELECT 1, 0, rare FROM c
UNION ALL SELECT 1, 1, CAST(floor(0.5 * common) AS BIGINT) - rare FROM c""")
def k05_balance(spark, sf_dir):
    """Oversampling of all rows in 30 dimensions: originals kept, minority at exactly half the majority."""
    rows = learn.standardise(hold(wide_orders(spark, sf_dir)), WIDE_FEATURES)
    return learn.smote(rows, [f"{c}_scaled" for c in WIDE_FEATURES], "label").groupBy(
        "label", "synthetic"
    ).agg(F.count("*").alias("n"))


@query("k06_logistic_regression")
def k06(spark, sf_dir):
    model = LearningSets(spark, sf_dir).search("Logistic Regression").model
    return learn.ranked_weights(spark, WIDE_FEATURES, model.coefficients.toArray(), "coefficient")


@query("k07_random_forest")
def k07(spark, sf_dir):
    model = LearningSets(spark, sf_dir).search("Random Forest").model
    return learn.ranked_weights(spark, WIDE_FEATURES, model.featureImportances.toArray(), "importance")


@query("k08_boosted_trees")
def k08(spark, sf_dir):
    model = LearningSets(spark, sf_dir).search("Gradient-Boosted Trees").model
    return learn.ranked_weights(spark, WIDE_FEATURES, model.featureImportances.toArray(), "importance")


@query("model_grids", f"""SELECT * FROM (VALUES {", ".join(
    f"('{name}', {len(list(itertools.product(*grid.values())))}, TRUE)" for name, (_, grid, _) in SEARCHES.items())}
) t(model, points, better_than_chance)""")
def model_grids(spark, sf_dir):
    """Grid points of each search; the mean area under the curve of every one is better than chance."""
    sets = LearningSets(spark, sf_dir)
    return learn.grid_table(spark, {name: sets.search(name).grid for name in SEARCHES}).groupBy("model").agg(
        F.count_distinct("params").cast("int").alias("points"), F.bool_and(F.expr("auc > 0.5 AND auc <= 1")).alias("better_than_chance"))


_CONF = f"""{SCORES}, c AS (SELECT model, count(*) FILTER (score >= 0.5 AND label = 1) AS tp,
  count(*) FILTER (score >= 0.5 AND label = 0) AS fp, count(*) FILTER (score < 0.5 AND label = 0) AS tn,
  count(*) FILTER (score < 0.5 AND label = 1) AS fn FROM scores GROUP BY 1)"""
_WEIGHTED = f"""{_CONF}, r AS (SELECT model, CAST(tp + fp + tn + fn AS DOUBLE) AS n, tp, fp, tn, fn,
  coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tn / nullif(tn + fn, 0), 0) AS p0,
  coalesce(tp / nullif(tp + fn, 0), 0) AS r1, coalesce(tn / nullif(tn + fp, 0), 0) AS r0 FROM c),
w AS (SELECT *, (tp + fn) / n AS w1, (tn + fp) / n AS w0, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1,
  coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0 FROM r),
m AS (SELECT model, (tp + tn) / n AS acc, w1 * p1 + w0 * p0 AS wp, w1 * r1 + w0 * r0 AS wr, w1 * f1 + w0 * f0 AS wf,
  tp / (tp + fp + 1e-10) AS p, tp / (tp + fn + 1e-10) AS r FROM w)"""


@query("k09_confusion", f"WITH {_CONF} SELECT * FROM c")
def k09(spark, sf_dir):
    return ev.confusion(scores(spark, sf_dir))


@query("k10_weighted_metrics", f"""WITH {_WEIGHTED}
SELECT model, {rsql("acc", 6)} AS accuracy, {rsql("wp", 6)} AS weighted_precision, {rsql("wr", 6)} AS weighted_recall,
       {rsql("wf", 6)} AS weighted_f1 FROM m""")
def k10(spark, sf_dir):
    return ev.weighted_metrics(ev.confusion(scores(spark, sf_dir))).select(
        "model", *[rd(c, 6).alias(c) for c in ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")]
    )


@query("k11_class_metrics", f"""WITH {_WEIGHTED}
SELECT model, {rsql("p", 6)} AS precision, {rsql("r", 6)} AS recall, {rsql("2 * p * r / (p + r + 1e-10)", 6)} AS f1,
       {rsql("5 * p * r / (4 * p + r + 1e-10)", 6)} AS f2, {rsql("5 * wp * wr / (4 * wp + wr + 1e-10)", 6)} AS weighted_f2 FROM m""")
def k11(spark, sf_dir):
    return ev.class_metrics(ev.weighted_metrics(ev.confusion(scores(spark, sf_dir)))).select(
        "model", *[rd(c, 6).alias(c) for c in ("precision", "recall", "f1", "f2", "weighted_f2")]
    )


_CURVE = f"""{SCORES}, g AS (SELECT model, score, sum(label) AS tp, sum(1 - label) AS fp FROM scores GROUP BY 1, 2),
u AS (SELECT *, sum(tp) OVER w AS ctp, sum(fp) OVER w AS cfp, sum(tp) OVER (PARTITION BY model) AS ttp,
      sum(fp) OVER (PARTITION BY model) AS tfp FROM g WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
auc AS (SELECT model, sum(CAST(fp AS DOUBLE) * (2 * ctp - tp) / 2) / (max(CAST(ttp AS DOUBLE)) * max(tfp)) AS auc FROM u GROUP BY 1),
pr AS (SELECT *, ctp / (ctp + cfp) AS prec, ctp / ttp AS rec FROM u),
ap AS (SELECT model, sum(tp / ttp * prec) AS ap, max(ttp / (ttp + tfp)) AS prev FROM pr GROUP BY 1)"""


@query("k12_roc_curve", f"""WITH {_CURVE} SELECT model, {rsql("score", 6)} AS score, {rsql("cfp / tfp", 6)} AS fpr, {rsql("ctp / ttp", 6)} AS tpr FROM u""")
def k12(spark, sf_dir):
    return ev.roc_points(scores(spark, sf_dir)).select(
        "model", rd("score", 6).alias("score"), rd("fpr", 6).alias("fpr"), rd("tpr", 6).alias("tpr")
    )


@query("k12_roc_auc", f"WITH {_CURVE} SELECT model, {rsql('auc', 6)} AS auc FROM auc")
def k12_auc(spark, sf_dir):
    return ev.roc_auc(ev.roc_points(scores(spark, sf_dir))).withColumn("auc", rd("auc", 6))


@query("k13_pr_curve", f"""WITH {_CURVE} SELECT model, {rsql("score", 6)} AS score, {rsql("prec", 6)} AS precision, {rsql("rec", 6)} AS recall FROM pr""")
def k13(spark, sf_dir):
    return ev.pr_points(scores(spark, sf_dir)).select(
        "model", rd("score", 6).alias("score"), rd("precision", 6).alias("precision"), rd("recall", 6).alias("recall")
    )


@query("k13_pr_summary", f"""WITH {_CURVE}, n AS (SELECT model, score, prec, rec,
  row_number() OVER (PARTITION BY model ORDER BY abs(rec - 0.9), score) AS i FROM pr)
SELECT ap.model, {rsql("ap", 6)} AS average_precision, {rsql("prev", 6)} AS prevalence, {rsql("n.prec", 6)} AS near_precision,
       {rsql("n.rec", 6)} AS near_recall FROM ap JOIN n ON ap.model = n.model AND n.i = 1""")
def k13_summary(spark, sf_dir):
    return ev.pr_summary(ev.pr_points(scores(spark, sf_dir))).select(
        "model", *[rd(c, 6).alias(c) for c in ("average_precision", "prevalence", "near_precision", "near_recall")]
    )


_THRESHOLDS = "[" + ", ".join(repr(t) for t in ev.default_thresholds()) + "]::DOUBLE[]"
_SCAN = f"""{SCORES}, t AS (SELECT unnest({_THRESHOLDS}) AS threshold),
d AS (SELECT model, score, sum(label) AS pos, count(*) AS n FROM scores GROUP BY 1, 2),
k AS (SELECT model, threshold, sum(CASE WHEN score >= threshold THEN pos ELSE 0 END) AS tp,
      sum(CASE WHEN score >= threshold THEN n - pos ELSE 0 END) AS fp,
      sum(CASE WHEN score < threshold THEN pos ELSE 0 END) AS fn FROM d, t GROUP BY 1, 2),
pr AS (SELECT *, tp / (tp + fp + 1e-10) AS p, tp / (tp + fn + 1e-10) AS r FROM k),
f AS (SELECT *, 5 * p * r / (4 * p + r + 1e-10) AS f2 FROM pr)"""


@query("k14_threshold_scan", f"""WITH {_SCAN} SELECT model, {rsql("threshold", 6)} AS threshold, CAST(tp AS BIGINT) AS tp,
  CAST(fp AS BIGINT) AS fp, {rsql("p", 6)} AS precision, {rsql("r", 6)} AS recall, {rsql("f2", 6)} AS f2 FROM f""")
def k14(spark, sf_dir):
    scan = ev.threshold_scan(scores(spark, sf_dir), ev.default_thresholds())
    return scan.select(
        "model", rd("threshold", 6).alias("threshold"), "tp", "fp",
        *[rd(c, 6).alias(c) for c in ("precision", "recall", "f2")],
    )


@query("k14_best_threshold", f"""WITH {_SCAN}, b AS (
SELECT *, row_number() OVER (PARTITION BY model ORDER BY f2 DESC, threshold) AS i FROM f)
SELECT model, {rsql("threshold", 6)} AS threshold, {rsql("f2", 6)} AS f2 FROM b WHERE i = 1""")
def k14_best(spark, sf_dir):
    best = ev.best_threshold(ev.threshold_scan(scores(spark, sf_dir), ev.default_thresholds()))
    return best.select("model", rd("threshold", 6).alias("threshold"), rd("f2", 6).alias("f2"))


@query("k15_score_export")
def k15(spark, sf_dir):
    made = LearningSets(spark, sf_dir).scores()
    path = write_csv(made, fresh_path(spark, "scores-csv"))
    return read_csv(spark, path, made.schema)


@query("k15_score_counts", f"""WITH {WIDE}
SELECT m.model, (SELECT count(*) FROM wide) AS n, (SELECT sum(label) FROM wide)::BIGINT AS positives, TRUE AS consistent
FROM (VALUES {", ".join(f"('{name}')" for name in SEARCHES)}) m(model)""")
def k15_counts(spark, sf_dir):
    """Scored test rows and training rows make up all orders, and what is found or missed all positives."""
    sets = LearningSets(spark, sf_dir)
    scored, train = sets.scores(), sets.split.filter("split = 'train'").agg(
        F.count("*").alias("n"), F.sum("label").alias("p"))
    counts, rest = ev.confusion(scored), train.select("n").scalar()
    seen = scored.groupBy("model").agg(F.count("*").alias("rows"), F.sum("label").alias("rare"),
                                       F.bool_and(F.expr("score BETWEEN 0 AND 1")).alias("shares"))
    return counts.join(seen, "model").select(
        "model", (F.col("rows") + rest).alias("n"), (F.col("rare") + train.select("p").scalar()).alias("positives"),
        (F.col("shares") & (F.expr("tp + fn") == F.col("rare")) & (F.expr("tp + fp + tn + fn") == F.col("rows")))
        .alias("consistent"))


@query("model_comparison")
def model_comparison(spark, sf_dir):
    """The three searched models side by side on the test rows, with the seconds of their searches."""
    sets = LearningSets(spark, sf_dir)
    took = F.create_map(*[F.lit(x) for name in SEARCHES for x in (name, sets.search(name).seconds)])
    return ev.model_summary(hold(sets.scores())).withColumn("train_seconds", F.round(took[F.col("model")], 1))


@query("k16_best_models", f"""WITH {_WEIGHTED.replace(SCORES, _CURVE, 1)},
s AS (SELECT m.model, acc AS accuracy, r AS recall, 2 * p * r / (p + r + 1e-10) AS f1,
  5 * p * r / (4 * p + r + 1e-10) AS f2, auc, ap AS average_precision FROM m JOIN auc ON m.model = auc.model JOIN ap ON m.model = ap.model),
l AS (SELECT * FROM (UNPIVOT s ON accuracy, recall, f1, f2, auc, average_precision INTO NAME metric VALUE value)),
b AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value DESC, model) AS i FROM l)
SELECT metric, model, {rsql("value", 6)} AS value FROM b WHERE i = 1""")
def k16(spark, sf_dir):
    summary = ev.model_summary(scores(spark, sf_dir))
    return ev.best_models(summary, ["accuracy", "recall", "f1", "f2", "auc", "average_precision"]).withColumn(
        "value", rd("value", 6)
    )


@query("a09_model_reload", f"""WITH {WIDE} SELECT count(*) AS rows, 0::BIGINT AS different FROM wide""")
def a09(spark, sf_dir):
    """A saved and reloaded model scores all rows; 0 may differ from the original."""
    rows = learn.assemble(learn.standardise(wide_orders(spark, sf_dir), WIDE_FEATURES), [f"{c}_scaled" for c in WIDE_FEATURES])
    model = LogisticRegression(featuresCol="features", labelCol="label", regParam=0.01, standardization=False).fit(rows)
    again = LogisticRegressionModel.load(learn.save_model(model, fresh_path(spark, "model")))
    both = again.transform(model.transform(rows).select(
        "features", F.col("prediction").alias("first"), F.col("probability").alias("share")))
    return both.agg(F.count("*").alias("rows"), F.count_if(
        (F.col("prediction") != F.col("first")) | (vector_to_array("probability")[1] != vector_to_array("share")[1])
    ).alias("different"))


@query("a10_split_reload", """
SELECT l_orderkey, l_linenumber, l_quantity AS second, l_tax AS tenth FROM lineitem""")
def a10(spark, sf_dir):
    """Eleven columns f0..f10 reloaded: f10 must come last, not after f1."""
    flat = rare_lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("f1"), F.col("l_tax").alias("f10"),
        *[F.lit(float(i)).alias(f"f{i}") for i in (0, 2, 3, 4, 5, 6, 7, 8, 9)],
    )
    loaded = read_parquet(spark, write_parquet(flat, fresh_path(spark, "split")))
    packed = learn.ensure_features(loaded).select("l_orderkey", "l_linenumber", "features")
    return learn.flatten(packed, "features", 11).select(
        "l_orderkey", "l_linenumber", F.col("f1").alias("second"), F.col("f10").alias("tenth")
    )
