"""Feature preparation, oversampling and model training."""

from __future__ import annotations

import itertools
import json
import re
import zlib
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomkit.functions.scalars import key_bucket, key_uniform, ratio
from fathomkit.operators.bayes import vector_sums
from fathomkit.operators.clean import attach_stats
from fathomkit.operators.neighbours import nearest
from fathomkit.operators.ordered import running_totals
from fathomkit.session import fresh_path, hold, shared_dir

SEED = 42
FOLDS = 3
FIT_ROWS = 100_000
CHUNK = 1_000  # rows whose products are formed at once
BLOCK = 10_000  # rows whose counts and gradients are summed at once; 4 * BLOCK < ONE / 2, so that one sum tells both
ONE, FINE = 2.0 ** 17, 2.0 ** 20
BAG = 65_536  # rows of a block of the forests, whose places in it take two bytes
RARE = 2.0 ** 26  # one sum tells rows and rows of class 1, below this number of draws in a task
WAVE_BYTES = 128_000_000  # a core's share of the places of rows in trees that grow at the same time


# --- scaling and assembly ----------------------------------------------------------------
def _rescale(df: DataFrame, columns: Sequence[str], low, span, suffix: str) -> DataFrame:
    stats = {}
    for c in columns:
        stats[f"_l_{c}"], stats[f"_s_{c}"] = low(F.col(c)), span(F.col(c))
    zero = F.lit(0.0)
    return attach_stats(df, stats).select(
        *df.columns,
        *[F.when(F.col(c).isNotNull(), F.coalesce(ratio(F.col(c) - F.col(f"_l_{c}"), F.col(f"_s_{c}")), zero))
          .alias(f"{c}{suffix}") for c in columns],
    )


def standardise(df: DataFrame, columns: Sequence[str], population: bool = False, suffix: str = "_scaled") -> DataFrame:
    """z-scores with the sample (default) or population sd; a constant column becomes 0."""
    return _rescale(df, columns, F.avg, F.stddev_pop if population else F.stddev, suffix)


def min_max(df: DataFrame, columns: Sequence[str], suffix: str = "_norm") -> DataFrame:
    """Rescale to [0, 1]; a constant column becomes 0."""
    return _rescale(df, columns, F.min, lambda c: F.max(c) - F.min(c), suffix)


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Pack columns into a vector; rows with a null are skipped."""
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="skip").transform(df)


def flatten(df: DataFrame, vector: str, size: int, prefix: str = "f") -> DataFrame:
    """Vector to columns f0, f1, ..."""
    a = vector_to_array(vector)
    return df.select(*[c for c in df.columns if c != vector], *[a[i].alias(f"{prefix}{i}") for i in range(size)])


def ensure_features(df: DataFrame, out: str = "features", prefix: str = "f") -> DataFrame:
    """Re-assemble f0..fn of a reloaded split, in numeric order of the suffix."""
    if out in df.columns:
        return df
    found = [c for c in df.columns if re.fullmatch(rf"{prefix}\d+", c)]
    return assemble(df, sorted(found, key=lambda c: int(c[len(prefix) :])), out)


# --- oversampling ------------------------------------------------------------------------
def smote(
    df: DataFrame, features: Sequence[str], label: str, share: float = 0.5, k: int = 5,
    seed: int = SEED, part_size: int = 20_000,
) -> DataFrame:
    """Add synthetic minority rows until they are ``share`` of the majority.

    A synthetic row lies between a minority row and one of its k nearest minority neighbours.
    Every minority row gets the same number of them, the remainder goes to the lowest hashes.
    """
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    minority, majority = sizes.get(1, 0), sizes.get(0, 0)
    need = int(share * majority) - minority
    originals = df.select(*features, label, F.lit(0).alias("synthetic"))
    if need <= 0:
        return originals
    if minority < 2:
        raise ValueError("oversampling needs at least two minority rows")
    rare = df.filter(F.col(label) == 1).select(
        F.array(*[F.col(c).cast("double") for c in features]).alias("x")
    )
    near = nearest(rare, k, part_size).withColumn("h", key_uniform([F.col("x")], seed))
    ranked = running_totals(near, ["h"], ["w"])
    base, rest = need // minority, need % minority
    extra = F.least(F.col("cum_w"), F.lit(rest)) - F.least(F.col("cum_w") - F.col("w"), F.lit(rest))
    copies = F.array_repeat(F.struct(F.lit(0.0).alias("d"), "x", F.lit(1).cast("long").alias("w")), F.least(F.col("w") - 1, F.lit(k)).cast("int"))
    others = F.flatten(F.transform(
        F.coalesce("near", F.array().cast("array<struct<d:double,x:array<double>,w:bigint>>")),
        lambda m: F.array_repeat(m, F.least(m["w"], F.lit(k)).cast("int")),
    ))
    quota = ranked.select(
        "vid", "x", (F.col("w") * base + extra).alias("quota"),
        F.transform(F.slice(F.concat(copies, others), 1, k), lambda m: m["x"]).alias("nn"),
    ).filter("quota > 0")
    # a point with a huge quota is first cut into blocks, the blocks are spread over tasks
    block = 1_000
    blocks = quota.withColumn(
        "b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("quota") - 1) / block)))
    ).repartition("vid", "b")
    one = blocks.withColumn("c", F.explode(F.sequence(
        F.col("b") * block, F.least((F.col("b") + 1) * block, F.col("quota")) - 1
    )))
    pick = F.floor(key_uniform([F.col("x"), F.col("c"), F.lit(1)], seed) * F.size("nn")).cast("int")
    u = key_uniform([F.col("x"), F.col("c"), F.lit(2)], seed)
    made = one.select("x", F.get("nn", pick).alias("y"), u.alias("u")).select(
        *[(F.col("x")[i] + F.col("u") * (F.col("y")[i] - F.col("x")[i])).alias(c) for i, c in enumerate(features)],
        F.lit(1).alias(label), F.lit(1).alias("synthetic"),
    )
    return originals.unionByName(made)


# --- models ------------------------------------------------------------------------------
def folded(train: DataFrame, keys: Sequence[str]) -> DataFrame:
    """With ``_fold`` from a hash of the row, so a rerun sees the same folds, in even tasks of about ``FIT_ROWS`` rows.

    A fit runs hundreds of short jobs over these rows: small tasks spend them on being started, and the files they come
    from are so uneven that some cores would wait for others. Sorted, so that a repeated task sees the same order.
    """
    tasks = max(1, -(-train.count() // FIT_ROWS))
    fold = key_bucket([F.col(c) for c in keys], FOLDS, SEED).cast("int")
    return train.withColumn("_fold", fold).repartition(tasks).sortWithinPartitions(*keys)


def at_once(rows: DataFrame, most: int) -> int:
    """Fits that run side by side: as many as give each core four tasks, since each holds the rows in its own form."""
    return max(1, min(most, -(-4 * rows.sparkSession.sparkContext.defaultParallelism // rows.rdd.getNumPartitions())))


def told(params: Mapping[str, object]) -> str:
    """Parameter values as one text, by name."""
    return ", ".join(f"{name}={value}" for name, value in sorted(params.items()))


def grid_search(
    estimator: Estimator, grid: Mapping[str, Sequence], train: DataFrame, keys: Sequence[str], label: str = "label",
    parallelism: int = 6,
) -> tuple[Model, list[tuple[str, float]]]:
    """Search over every combination of the listed parameter values, by area under the ROC curve over three folds.

    The best model, fitted anew on all rows, and the mean area of each combination.
    """
    points = ParamGridBuilder()
    for name, values in grid.items():
        points = points.addGrid(estimator.getParam(name), list(values))
    rows = folded(train, keys).persist()
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=points.build(), numFolds=FOLDS, foldCol="_fold",
        evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC"),
        parallelism=at_once(rows, parallelism),
    )
    try:
        found = search.fit(rows)
    finally:
        rows.unpersist()
    areas = [(told({p.name: v for p, v in m.items()}), float(a))
             for m, a in zip(found.getEstimatorParamMaps(), found.avgMetrics)]
    return found.bestModel, areas


def _penalised_newton(b: np.ndarray, grad: np.ndarray, curv: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """Where the quadratic model around ``b`` and both penalties are least; the intercept, first, has no penalty."""
    grad, curv = grad + l2 * np.r_[0, b[1:]], curv + l2 * np.diag(np.r_[0, np.ones(len(b) - 1)])
    if not l1:
        return b - np.linalg.solve(curv, grad)
    x, slope = b.copy(), grad.copy()
    for _ in range(1000):
        far = 0.0
        for j, c in enumerate(curv.diagonal()):
            to = x[j] - slope[j] / c if c > 0 else 0.0
            if j:
                to = np.sign(to) * max(abs(to) - l1 / c, 0.0) if c > 0 else 0.0
            if to != x[j]:
                slope += curv[:, j] * (to - x[j])
                far, x[j] = max(far, abs(to - x[j])), to
        if far < 1e-12:
            break
    return x


def logistic_fits(
    rows: DataFrame, keys: Sequence[str], label: str, points: Sequence[tuple[float, float]], tol: float, max_steps: int,
) -> np.ndarray:
    """(fold, point, coefficient), the intercept first: the fits of all points on the rows outside each fold.

    A point is (regParam, elasticNetParam), the loss that of ``LogisticRegression`` without standardisation. All fits take
    their Newton steps in the same passes, one pass a step; only sums reach the driver. A step that does not lower the
    loss is halved, and the last one, shorter than ``tol``, is taken too.
    """
    keys, q = list(keys), 1 + len(keys)
    iu = np.triu_indices(q)
    at = np.zeros((FOLDS, len(points), q))
    good, least = at.copy(), np.full(at.shape[:2], np.inf)
    left = [(f, i) for f in range(FOLDS) for i in range(len(points))]
    for _ in range(max_steps):
        if not left:
            break

        def partial(batches: Iterator[pd.DataFrame], at=at, left=tuple(left)) -> Iterator[pd.DataFrame]:
            total = np.zeros((len(left), 2 + q + len(iu[0])))
            for b in batches:
                fold = b["_fold"].to_numpy()
                z, y = np.hstack([np.ones((len(b), 1)), b[keys].to_numpy(float)]), b[label].to_numpy(float)
                for out in range(FOLDS):
                    mine = [n for n, (f, _) in enumerate(left) if f != out]
                    inside = np.flatnonzero(fold == out)
                    for part in np.split(inside, range(CHUNK, len(inside), CHUNK)) if mine else ():
                        zs, ys = z[part], y[part, None]
                        eta = zs @ np.stack([at[left[n]] for n in mine]).T
                        p = 1 / (1 + np.exp(-eta))
                        loss = np.maximum(eta, 0) + np.log1p(np.exp(-np.abs(eta))) - ys * eta
                        zt = np.ascontiguousarray(zs.T)
                        curv = (zt[iu[0]] * zt[iu[1]]) @ (p * (1 - p))
                        total[mine] += np.vstack([np.full(len(mine), len(zs)), loss.sum(0), zt @ (p - ys), curv]).T
            yield pd.DataFrame({"i": np.arange(len(left)), "v": list(total)})

        sums = vector_sums(rows.mapInPandas(partial, "i int, v array<double>"))
        at, again = at.copy(), []
        for n, place in enumerate(left):
            reg, mix = points[place[1]]
            l1, l2 = reg * mix, reg * (1 - mix)
            mean, now = sums[n][1:] / sums[n][0], at[place]
            value = mean[0] + l1 * np.abs(now[1:]).sum() + l2 / 2 * (now[1:] ** 2).sum()
            if value > least[place] + 1e-12:
                to = (now + good[place]) / 2
            else:
                good[place], least[place] = now, value
                curv = np.zeros((q, q))
                curv[iu] = curv.T[iu] = mean[1 + q:]
                to = _penalised_newton(now, mean[1:1 + q], curv, l1, l2)
            if np.abs(to - now).max() >= tol:
                again.append(place)
            at[place] = to
        left = again
    return at


def held_out_areas(scored: DataFrame, points: int, parallelism: int) -> np.ndarray:
    """Mean over the folds of the area under the ROC curve of p0, p1, ... of (label, fold, p0, p1, ...)."""
    rate = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", metricName="areaUnderROC")
    scored = scored.persist()

    def area(job) -> float:
        return rate.evaluate(scored.where(F.col("fold") == job[0]).select("label", F.col(f"p{job[1]}").alias("score")))

    try:
        scored.count()
        jobs = [(f, i) for f in range(FOLDS) for i in range(points)]
        with ThreadPoolExecutor(parallelism) as pool:
            got = list(pool.map(inheritable_thread_target(scored.sparkSession)(area), jobs))
    finally:
        scored.unpersist()
    return np.array(got).reshape(FOLDS, -1).mean(0)


def logistic_search(
    logistic: Estimator, grid: Mapping[str, Sequence], train: DataFrame, keys: Sequence[str], label: str = "label",
    parallelism: int = 6,
) -> tuple[Model, list[tuple[str, float]]]:
    """``grid_search`` over the penalties of a logistic regression on the columns ``keys``, without standardisation.

    The fits of all folds and points share their passes, see ``logistic_fits``, instead of some thirty passes for each; the
    best point is fitted once more by ``logistic`` itself, on all rows. Rows with a null are skipped.
    """
    if logistic.getStandardization() or not logistic.getFitIntercept() or set(grid) - {"regParam", "elasticNetParam"}:
        raise ValueError("only penalties are searched, for an intercept and features as they are")
    combos = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    made = [logistic.copy({logistic.getParam(n): v for n, v in c.items()}) for c in combos]
    points = [(m.getRegParam(), m.getElasticNetParam()) for m in made]
    if min(reg for reg, _ in points) <= 0:
        raise ValueError("without a penalty a fit need not exist")
    keys = list(keys)
    whole = train.select(*keys, F.col(label).cast("double").alias(label)).dropna(subset=keys)
    rows = folded(whole, keys).persist()
    try:
        fits = logistic_fits(rows, keys, label, points, logistic.getTol(), logistic.getMaxIter())

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out, fold = np.empty((len(b), len(points))), b["_fold"].to_numpy()
                z = np.hstack([np.ones((len(b), 1)), b[keys].to_numpy(float)])
                for f in range(FOLDS):
                    out[fold == f] = z[fold == f] @ fits[f].T
                got = pd.DataFrame(out, columns=[f"p{i}" for i in range(len(points))])
                yield got.assign(label=b[label].to_numpy(), fold=fold)

        told_as = ", ".join([f"p{i} double" for i in range(len(points))] + ["label double", "fold int"])
        areas = held_out_areas(rows.mapInPandas(score, told_as), len(points), parallelism)
        return made[int(areas.argmax())].fit(assemble(rows, keys)), [(told(c), float(a)) for c, a in zip(combos, areas)]
    finally:
        rows.unpersist()


def _thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Where a feature may be cut: between its values, or near its quantiles where it has more values than bins."""
    at, n = np.unique(values, return_counts=True)
    between = (at[:-1] + at[1:]) / 2
    if len(between) < bins:
        return between
    upto, cuts = n.cumsum(), []
    for i, cut in enumerate(between):
        target = (len(cuts) + 1) * len(values) / bins
        if abs(upto[i] - target) < abs(upto[i + 1] - target):
            cuts.append(cut)
    return np.array(cuts)


def _placed(bins: np.ndarray, tree: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The node of each row below the levels of a tree; a level is the feature and the last left bin of its nodes."""
    at, rows = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
    for feature, last in tree:
        at = 2 * at + (bins[feature[at], rows] > last[at])
    return at


def _best_cut(sums: np.ndarray, least: int) -> tuple:
    """Gain, feature and last left bin of the cut that lowers the variance most, and the means on both sides of it."""
    left = sums.cumsum(2)
    whole = left[:, :, -1:]
    (nl, sl), (nr, sr) = left[:, :, :-1], (whole - left)[:, :, :-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = sl * sl / nl + sr * sr / nr - (whole[1] ** 2 / whole[0])
    gain[(nl < least) | (nr < least)] = -np.inf
    j, c = best = np.unravel_index(gain.argmax(), gain.shape)
    if not gain[best] > 0:
        return 0.0, 0, 0, 0.0, 0.0
    return float(gain[best]), int(j), int(c), float(sl[best] / nl[best]), float(sr[best] / nr[best])


def boosted_fits(
    rows: DataFrame, keys: Sequence[str], label: str, points: Sequence[tuple[int, float]], rounds: int, bins: int, least: int,
) -> DataFrame:
    """(label, fold, p0, p1, ...): the margin that each point, fitted on the rows outside a fold, gives the rows inside.

    A point is (maxDepth, stepSize), the trees those of ``GBTClassifier`` with its logistic loss: regression trees over
    binned features, the first on the labels as -1 and 1, the others on the gradients. The trees of all fits grow in
    the same passes, one pass a level. Tasks sum counts and gradients per node, feature and bin, the sums meet in a
    shuffle, and only the best cut of each node reaches the driver. Margins stay with the rows. Thresholds come from the
    rows outside the fold, or from as many of them as the learner looks at.
    """
    keys, q, spark = list(keys), len(keys), rows.sparkSession
    per = {r["_fold"]: r["n"] for r in rows.groupBy("_fold").agg(F.count("*").alias("n")).collect()}
    n, most, cuts = sum(per.values()), max(bins * bins, 10_000), []
    for f in range(FOLDS):
        share = most / max(1, n - per.get(f, 0))
        seen = rows.where(F.col("_fold") != f).select(*keys)
        seen = (seen if share >= 1 else seen.sample(share, SEED)).toPandas()
        cuts.append([_thresholds(seen[c].to_numpy(float), bins) for c in keys])
    fits = [(f, *p) for f in range(FOLDS) for p in points]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for b in (b[i:i + BLOCK] for i in range(0, len(b), BLOCK)):
                binned = np.stack([np.searchsorted(c, b[k].to_numpy(float)) for of in cuts for k, c in zip(keys, of)])
                yield pd.DataFrame({"bins": [binned.astype(np.uint8).tobytes()], "label": [b[label].to_numpy(np.int8).tobytes()],
                                    "fold": [b["_fold"].to_numpy(np.int8).tobytes()]})

    def block(r) -> tuple:
        fold = np.frombuffer(r["fold"], np.int8)
        sign = 2.0 * np.frombuffer(r["label"], np.int8) - 1
        return np.frombuffer(r["bins"], np.uint8).reshape(FOLDS, q, -1), sign, fold, np.zeros((len(fits), len(fold)))

    cores = spark.sparkContext.defaultParallelism
    tasks = cores * -(-n // (5 * FIT_ROWS * cores))
    state = rows.mapInPandas(cut, "bins binary, label binary, fold binary").repartition(tasks).rdd.map(block)
    state = state.persist(StorageLevel.MEMORY_AND_DISK)
    old, kept = None, []
    for turn in range(rounds):
        trees, values = [[] for _ in fits], [np.zeros(1) for _ in fits]
        growing = {(k, 0) for k in range(len(fits))}
        for level in range(max(d for _, d, _ in fits)):
            open_at = [np.array([(k, v) in growing for v in range(1 << level)]) for k in range(len(fits))]

            def summed(part: Iterator[tuple], trees=trees, open_at=open_at, level=level, turn=turn) -> Iterator[tuple]:
                total = {}
                for binned, sign, fold, margin in part:
                    for f in range(FOLDS):
                        inside = np.flatnonzero(fold != f)
                        mine, y = binned[f][:, inside].astype(np.int64), sign[inside]
                        for k in (k for k, fit in enumerate(fits) if fit[0] == f and open_at[k].any()):
                            x, at = mine, _placed(mine, trees[k])
                            to = 4 * y / (1 + np.exp(2 * y * margin[k, inside])) if turn else y
                            # a row counts as ONE, and gradients as multiples of 1 / FINE: sums are exact in any order
                            to = np.rint(to * FINE) / FINE + ONE
                            if not open_at[k].all():
                                some = np.flatnonzero(open_at[k][at])
                                x, at, to = mine[:, some], at[some], to[some]
                            at *= bins
                            both = np.stack([np.bincount(at + x[j], to, bins << level) for j in range(q)])
                            counted = np.rint(both / ONE)
                            got = total.setdefault(k, np.zeros((2, *both.shape)))
                            got += counted, both - counted * ONE
                for k, got in total.items():
                    got = got.reshape(2, q, 1 << level, bins)
                    for v in np.flatnonzero(open_at[k]).tolist():
                        yield (k, v), np.ascontiguousarray(got[:, :, v])

            found = dict(state.mapPartitions(summed).reduceByKey(np.add, cores).mapValues(
                lambda sums: _best_cut(sums, least)).collect())
            if old is not None:
                old.unpersist()
                old = None
            growing = set()
            for k, (_, depth, _) in enumerate(fits):
                if level >= depth:
                    continue
                # a node that is not cut sends all rows to the left, with its own mean
                feature, last = np.zeros(1 << level, np.int64), np.full(1 << level, 255, np.uint8)
                means = np.repeat(values[k], 2)
                for v in range(1 << level):
                    gain, j, c, *sides = found.get((k, v), (0.0, 0, 0))
                    if gain > 0:
                        feature[v], last[v], means[2 * v:2 * v + 2] = j, c, sides
                        if level + 1 < depth:
                            growing |= {(k, 2 * v), (k, 2 * v + 1)}
                trees[k].append((feature, last))
                values[k] = means

        def step(b: tuple, trees=trees, values=values, turn=turn) -> tuple:
            binned, sign, fold, margin = b
            moved = [(rate if turn else 1) * value[_placed(binned[f], tree)]
                     for (f, _, rate), tree, value in zip(fits, trees, values)]
            return binned, sign, fold, margin + moved

        old, state = state, state.map(step).persist(StorageLevel.MEMORY_AND_DISK)
        if turn % 20 == 19:  # else a lost task would go back to the first tree
            shared_dir(spark)
            state.checkpoint()
            kept.append(state)

    def held(b: tuple) -> Iterator[tuple]:
        _, sign, fold, margin = b
        own = margin.reshape(FOLDS, len(points), -1)[fold, :, np.arange(len(fold))]
        for y, f, p in zip(sign.tolist(), fold.tolist(), own.tolist()):
            yield (y + 1) / 2, f, *p

    told_as = ", ".join(["label double", "fold int"] + [f"p{i} double" for i in range(len(points))])
    scored = hold(spark.createDataFrame(state.flatMap(held), told_as, verifySchema=False))
    for done in (old, state):
        if done is not None:
            done.unpersist()
    for done in kept:
        where = spark._jvm.org.apache.hadoop.fs.Path(done.getCheckpointFile())
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return scored


def boosted_search(
    boosted: Estimator, grid: Mapping[str, Sequence], train: DataFrame, keys: Sequence[str], label: str = "label",
    parallelism: int = 6,
) -> tuple[Model, list[tuple[str, float]]]:
    """``grid_search`` over depths and step sizes of boosted trees on the columns ``keys``.

    The trees of all folds and points grow in shared passes, see ``boosted_fits``; the best point is fitted once more by
    ``boosted`` itself, on all rows. Rows with a null are skipped.
    """
    combos = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    made = [boosted.copy({boosted.getParam(n): v for n, v in c.items()}) for c in combos]
    one = made[0]
    if set(grid) - {"maxIter", "maxDepth", "stepSize"} or len({m.getMaxIter() for m in made}) > 1 or (
            one.getSubsamplingRate(), one.getMinInfoGain(), one.getMinWeightFractionPerNode(), one.getFeatureSubsetStrategy(),
            one.getLossType()) != (1, 0, 0, "all", "logistic") or one.getMaxBins() > 256 or any(
            one.isDefined(p) for p in (one.weightCol, one.validationIndicatorCol)):
        raise ValueError("only depths and step sizes are searched, for one number of trees on all rows and features")
    keys = list(keys)
    whole = train.select(*keys, F.col(label).cast("double").alias(label)).dropna(subset=keys)
    rows = folded(whole, keys).persist()
    try:
        scored = boosted_fits(rows, keys, label, [(m.getMaxDepth(), m.getStepSize()) for m in made], one.getMaxIter(),
                              one.getMaxBins(), one.getMinInstancesPerNode())
        areas = held_out_areas(scored, len(made), parallelism)
        return made[int(areas.argmax())].fit(assemble(rows, keys)), [(told(c), float(a)) for c, a in zip(combos, areas)]
    finally:
        rows.unpersist()


def cut_shares(
    first: np.ndarray, inner: np.ndarray, left: np.ndarray, right: np.ndarray, stats: np.ndarray, depths: Sequence[int],
) -> tuple[list[np.ndarray], np.ndarray]:
    """For each depth the share of class 1 that trees grown to that depth give the rows of a node, and whether a node is a
    leaf or below one at the last depth. ``first`` are the roots; siblings that are leaves and predict one class are
    merged into their parent, as the learner does.
    """
    share, rare = stats[:, 1] / stats.sum(1), stats[:, 1] > stats[:, 0]
    levels = [first]
    while len(up := levels[-1][inner[levels[-1]]]):
        levels.append(np.r_[left[up], right[up]])
    out, leaf = [], ~inner
    for depth in depths:
        leaf, at = ~inner, share.copy()
        for nodes_at in levels[depth:depth + 1]:
            leaf[nodes_at] = True
        for nodes_at in reversed(levels[:depth]):
            up = nodes_at[inner[nodes_at]]
            leaf[up] = leaf[left[up]] & leaf[right[up]] & (rare[left[up]] == rare[right[up]])
        for nodes_at in levels:
            up = nodes_at[leaf[nodes_at] & inner[nodes_at]]
            for child in (left[up], right[up]):
                at[child], leaf[child] = at[up], True
        out.append(at)
    return out, leaf


def forest_shares(spark: SparkSession, model: Model, depths: Sequence[int]) -> list[np.ndarray]:
    """Per tree an array (leaf, depth): the share of class 1 that the tree grown to that depth gives the rows of a leaf.

    Leaves are numbered from left to right, as ``leafCol`` numbers them. A tree grown to a depth has the same nodes down
    to it; siblings that are leaves and predict one class are merged into their parent, as the learner does. The nodes
    are read from the saved model; there are at most 2^(maxDepth + 1) a tree.
    """
    path = save_model(model, fresh_path(spark, "forest"))
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.leftChild", "nodeData.rightChild", "nodeData.impurityStats",
    ).orderBy("treeID", "id").toPandas()
    tree = nodes["treeID"].to_numpy()
    first = np.flatnonzero(np.r_[True, np.diff(tree) != 0])  # ids count from 0 in each tree
    base = np.repeat(first, np.diff(np.r_[first, len(tree)]))
    inner = nodes["leftChild"].to_numpy() >= 0
    left, right = (np.where(inner, base + nodes[side].to_numpy(), 0) for side in ("leftChild", "rightChild"))
    stats = np.stack(nodes["impurityStats"].to_numpy())
    out = [at[~inner] for at in cut_shares(first, inner, left, right, stats, depths)[0]]
    return np.split(np.stack(out, 1), np.flatnonzero(np.diff(tree[~inner])) + 1)


def forest_scores(model: Model, rows: DataFrame, depths: Sequence[int], sizes: Sequence[int]) -> DataFrame:
    """``rows`` with ``grown``: the mean share of class 1 by the first trees, cut at a depth; depths outer, sizes inner."""
    tables = rows.sparkSession.sparkContext.broadcast(forest_shares(rows.sparkSession, model, depths))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shares = tables.value
        for b in batches:
            if not len(b):
                continue
            leaves = np.stack(b["leaves"].to_numpy()).astype(int)
            total, got = np.zeros((len(b), len(depths))), []
            for t, table in enumerate(shares):
                total += table[leaves[:, t]]
                if t + 1 in sizes:
                    got.append(total / (t + 1))
            yield pd.DataFrame({"label": b["label"], "grown": list(np.stack(got, 2).reshape(len(b), -1))})

    leafed = model.setLeafCol("_leaves").transform(rows).select(
        F.col("label").cast("double").alias("label"), vector_to_array("_leaves").alias("leaves"))
    return leafed.mapInPandas(score, "label double, grown array<double>")


def forest_search(
    forest: Estimator, grid: Mapping[str, Sequence], train: DataFrame, keys: Sequence[str], parallelism: int = 3,
) -> tuple[Model, list[tuple[str, float]]]:
    """``grid_search`` for forests that fits only the largest: a smaller forest is its first trees, and a shallower tree
    is a deep one cut at that depth, since a node is split on the rows that reach it whatever may lie below.

    Fits: folds times the combinations of the other parameters, and the best once more on all rows.
    """
    depths, sizes = sorted(grid["maxDepth"]), sorted(grid["numTrees"])
    others = [n for n in grid if n not in ("maxDepth", "numTrees")]
    combos = [dict(zip(others, values)) for values in itertools.product(*(grid[n] for n in others))]
    rows = folded(train, keys).persist()

    def fit(params: Mapping[str, object], part: DataFrame) -> Model:
        set_to = {**params, "cacheNodeIds": True}  # else every row walks every tree from its root at each level
        return forest.copy({forest.getParam(n): v for n, v in set_to.items()}).fit(part)

    def areas(job) -> list[float]:
        combo, fold = job
        model = fit({**combo, "maxDepth": depths[-1], "numTrees": sizes[-1]}, rows.where(F.col("_fold") != fold))
        held = rows.where(F.col("_fold") == fold)
        scored = forest_scores(model, held, depths, sizes).persist()
        rate = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", metricName="areaUnderROC")
        try:
            return [rate.evaluate(scored.select("label", F.col("grown")[i].alias("score")))
                    for i in range(len(depths) * len(sizes))]
        finally:
            scored.unpersist()

    try:
        jobs = [(c, f) for c in combos for f in range(FOLDS)]
        with ThreadPoolExecutor(at_once(rows, parallelism)) as pool:
            got = np.array(list(pool.map(inheritable_thread_target(rows.sparkSession)(areas), jobs)))
        mean = got.reshape(len(combos), FOLDS, -1).mean(1)
        points = [({**c, "maxDepth": d, "numTrees": n}, a) for c, per in zip(combos, mean)
                  for (d, n), a in zip(itertools.product(depths, sizes), per)]
        best = max(points, key=lambda p: p[1])[0]
        return fit(best, rows), [(told(p), float(a)) for p, a in points]
    finally:
        rows.unpersist()


def _best_gini(sums: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """For each node the gain of the cut that lowers the Gini impurity most, the place of its feature among those drawn,
    its last left bin, and rows by class on its left and in all; ``sums`` is (class, feature, node, bin)."""
    left = sums.cumsum(3).swapaxes(1, 2)
    whole = left[..., -1:]
    left, right = left[..., :-1], (whole - left)[..., :-1]
    nl, nr, n = left.sum(0), right.sum(0), whole.sum(0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = ((left ** 2).sum(0) / nl + (right ** 2).sum(0) / nr - (whole ** 2).sum(0) / n) / n
    gain[(nl < max(least, 1)) | (nr < max(least, 1))] = -np.inf
    flat = gain.reshape(len(gain), -1)
    best, v = flat.argmax(1), np.arange(len(flat))
    j, c = np.divmod(best, gain.shape[2])
    return flat[v, best], j, c, left[:, v, j, c].T, whole[:, :, 0, 0].T


class Tree:
    """A tree that grows level by level; the children of a node stand side by side."""

    def __init__(self):
        self.feature, self.cut, self.left, self.gain, self.stats = [], [], [], [], []
        self.live = np.zeros(1, np.int64)  # nodes of the last level that may be cut

    def grow(self, found: tuple, drawn: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cut the live nodes; feature and last left bin of each, and for its two sides the place among the live nodes then,
        or -1 where rows stop. No node of the ``last`` level is cut again."""
        gain, j, cut, to_left, whole = found
        if not self.stats:
            self._add(whole)
        split = gain > 0
        feature = np.where(split, drawn[np.arange(len(j)), j], 0)
        sides = np.stack([to_left, whole - to_left], 1)[split]
        first = len(self.feature) + 2 * np.arange(len(sides))
        self.feature_cut(self.live[split], feature[split], cut[split], first, gain[split])
        self._add(sides.reshape(-1, 2))
        alive = (sides > 0).all(2) & (not last)  # a side of one class is done
        sides_at = np.full((len(split), 2), -1)
        sides_at[split] = np.where(alive, alive.cumsum().reshape(-1, 2) - 1, -1)
        self.live = (first[:, None] + [0, 1])[alive]
        return feature.astype(np.int64), np.where(split, cut, 255).astype(np.uint8), sides_at

    def _add(self, stats: np.ndarray) -> None:
        at = len(self.feature)
        self.feature += [0] * len(stats)
        self.cut += [255] * len(stats)
        self.left += range(at, at + len(stats))  # a leaf leads to itself
        self.gain += [-1.0] * len(stats)
        self.stats += stats.tolist()

    def feature_cut(self, nodes: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, gain: np.ndarray) -> None:
        for v, *of in zip(nodes.tolist(), feature.tolist(), cut.tolist(), left.tolist(), gain.tolist()):
            self.feature[v], self.cut[v], self.left[v], self.gain[v] = of

    def done(self) -> tuple[np.ndarray, ...]:
        return (np.array(self.feature, np.int16), np.array(self.cut, np.uint8), np.array(self.left, np.int32),
                np.array(self.gain), np.array(self.stats).reshape(-1, 2))


class Forests:
    """Forests of one size and depth that grow on the same rows in the same passes, one pass a level.

    A fit is (fold, least rows of a node): it learns from the rows outside the fold, or from all where that is None. Trees
    are those of ``RandomForestClassifier``: binned features, rows that are ``bagged`` drawn a Poisson number of times (the
    same in all fits), features drawn anew for each node. Tasks sum rows per node, feature and bin and the sums of a tree
    meet in one place; only the cuts reach the driver. Of a row a tree keeps the node that it stands in, as long as this
    is cut again, and the number of draws. As many trees grow at once as ``WAVE_BYTES`` allow. Draws follow from the
    seed and the rows of a block, so that a repeated task repeats them.
    """

    def __init__(self, rows: DataFrame, keys: Sequence[str], label: str, folds: Sequence[int | None], bins: int):
        self.keys, self.folds, self.bins, self.spark = list(keys), list(folds), bins, rows.sparkSession
        per = {r["_fold"]: r["n"] for r in rows.groupBy("_fold").agg(F.count("*").alias("n")).collect()}
        self.n, most, self.cuts = sum(per.values()), max(bins * bins, 10_000), []
        for f in self.folds:
            share = most / max(1, self.n - per.get(f, 0))
            seen = (rows if f is None else rows.where(F.col("_fold") != f)).select(*self.keys)
            seen = (seen if share >= 1 else seen.sample(share, SEED)).toPandas()
            self.cuts.append([_thresholds(seen[c].to_numpy(float), bins) for c in self.keys])
        cuts, columns, q = self.cuts, self.keys, len(self.keys)

        def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held, size = [], 0
            for b in itertools.chain((b[i:i + BAG] for b in batches for i in range(0, len(b), BAG)), [None]):
                if held and (b is None or size + len(b) > BAG):
                    whole, held, size = pd.concat(held), [], 0
                    binned = np.stack([np.stack([np.searchsorted(c, whole[k].to_numpy(float)) for k, c in zip(columns, of)], 1)
                                       for of in cuts])
                    yield pd.DataFrame({"bins": [binned.astype(np.uint8).tobytes()], "label": [whole[label].to_numpy(np.int8).tobytes()],
                                        "fold": [whole["_fold"].to_numpy(np.int8).tobytes()]})
                if b is not None and len(b):
                    held.append(b)
                    size += len(b)

        def block(r) -> tuple:
            fold = np.frombuffer(r["fold"], np.int8)
            return np.frombuffer(r["bins"], np.uint8).reshape(len(cuts), len(fold), q), np.frombuffer(r["label"], np.int8), fold

        self.cores = rows.sparkSession.sparkContext.defaultParallelism
        tasks = self.cores * -(-self.n // (5 * FIT_ROWS * self.cores))
        self.blocks = rows.repartition(tasks).mapInPandas(cut, "bins binary, label binary, fold binary").rdd.map(block).persist(
            StorageLevel.MEMORY_AND_DISK)

    def close(self) -> None:
        self.blocks.unpersist()

    def fit(self, fits: Sequence[tuple[int | None, int]], trees: int, depth: int, drawn: int, seed: int, bagged: bool) -> list[list[tuple]]:
        """The trees of every fit, as ``Tree.done`` tells them."""
        share = sum(1 if f is None else 1 - 1 / FOLDS for f, _ in fits)
        each = self.n * share * 0.64 * 5 + 1  # rows that are drawn, and bytes of one
        most, out = int(max(1, WAVE_BYTES * self.cores // each)), [[] for _ in fits]
        waves = -(-trees // most)
        for of in np.array_split(np.arange(trees), waves):
            for grown, made in zip(out, self._wave(fits, of.tolist(), depth, drawn, seed, bagged)):
                grown += made
        return out

    def _wave(self, fits, of: list[int], depth: int, drawn: int, seed: int, bagged: bool) -> list[list[tuple]]:
        q, bins, context = len(self.keys), self.bins, self.spark.sparkContext
        places = [self.folds.index(f) for f, _ in fits]
        node_type = np.uint16 if depth <= 16 else np.uint32
        jobs = [(i, t) for i in range(len(fits)) for t in of]
        grown = [Tree() for _ in jobs]

        def sown(b: tuple) -> tuple:
            binned, label, fold = b
            crc, at = zlib.crc32(label.tobytes(), zlib.crc32(binned.tobytes())), []
            draws = []
            for t in of:
                w = np.random.default_rng([seed, crc, t]).poisson(1, len(fold)).astype(np.uint8) if bagged else np.ones(len(fold), np.uint8)
                rows = np.flatnonzero(w > 0)
                draws.append((rows.astype(np.uint16), w.take(rows), fold.take(rows)))
            for f, _ in fits:
                for rows, w, own in draws:
                    mine = np.flatnonzero(own != f) if f is not None else slice(None)
                    at.append((rows[mine], w[mine]))
            return binned, label, [(rows, np.zeros(len(rows), node_type), w) for rows, w in at]

        old, state, steps = None, self.blocks.map(sown).persist(StorageLevel.MEMORY_AND_DISK), []
        for level in range(depth):
            ks = [k for k, tree in enumerate(grown) if len(tree.live)]
            if not ks:
                break
            features = {k: np.random.default_rng([seed, *jobs[k], level]).random((len(grown[k].live), q)).argpartition(
                drawn - 1)[:, :drawn].astype(np.uint8) if drawn < q else np.tile(np.arange(q, dtype=np.uint8), (len(grown[k].live), 1))
                for k in ks}
            sent = context.broadcast(features)

            def summed(part: Iterator[tuple], sent=sent) -> Iterator[tuple]:
                part = [(binned.reshape(len(binned), -1), label, at) for binned, label, at in part]
                weight = np.array([1, 1 + RARE])
                for k, of_node in sent.value.items():
                    size, columns = len(of_node) * bins, np.ascontiguousarray(of_node.T).astype(np.int64)
                    total = np.zeros((len(columns), size))
                    for binned, label, at in part:
                        rows, node, w = at[k]
                        if not len(rows):
                            continue
                        flat, first, node = binned[places[jobs[k][0]]], rows.astype(np.int64) * q, node.astype(np.int64)
                        value, base = w * weight.take(label.take(rows)), node * bins
                        for j, feature in enumerate(columns):
                            total[j] += np.bincount(base + flat.take(first + feature.take(node)), value, size)
                    total = total.ravel()
                    some = np.flatnonzero(total)
                    if len(some):
                        yield k, (some.astype(np.uint32), total[some])

            def met(got: tuple, sent=sent) -> tuple:
                k, parts = got
                shape = sent.value[k].shape
                total = np.zeros((2, shape[0] * shape[1] * bins))
                for some, value in parts:
                    rare = np.floor(value / RARE)
                    total[0, some] += value - rare * RARE - rare
                    total[1, some] += rare
                return k, _best_gini(total.reshape(2, shape[1], shape[0], bins), fits[jobs[k][0]][1])

            found = dict(state.mapPartitions(summed).groupByKey(min(len(ks), 4 * self.cores)).map(met).collect())
            if old is not None:
                old.unpersist()
            steps.append(sent)
            moves = {}
            for k in ks:
                moves[k] = grown[k].grow(found[k], features[k], level + 1 == depth)
            if level + 1 == depth or not any(len(tree.live) for tree in grown):
                break
            moved = context.broadcast(moves)

            def step(b: tuple, moved=moved) -> tuple:
                binned, label, at = b
                flat, to = binned.reshape(len(binned), -1), []
                for k, (rows, node, w) in enumerate(at):
                    if len(rows) and k in moved.value:
                        feature, cut, sides = moved.value[k]
                        node = node.astype(np.int64)
                        place = feature.take(node)
                        place += rows.astype(np.int64) * q
                        right = flat[places[jobs[k][0]]].take(place) > cut.take(node)
                        node *= 2
                        node += right
                        node = sides.take(node)
                        stay = np.flatnonzero(node >= 0)
                        rows, node, w = rows.take(stay), node.take(stay).astype(node_type), w.take(stay)
                    to.append((rows, node, w))
                return binned, label, to

            steps.append(moved)
            old, state = state, state.map(step).persist(StorageLevel.MEMORY_AND_DISK)
        for done in (old, state):
            if done is not None:
                done.unpersist()
        for sent in steps:
            sent.unpersist()
        return [[tree.done() for (i, _), tree in zip(jobs, grown) if i == n] for n in range(len(fits))]

    def scores(self, fits: Sequence[tuple[int, int]], trees: list[list[tuple]], depths: Sequence[int], sizes: Sequence[int]) -> DataFrame:
        """(label, fold, p0, p1, ...): the mean share of class 1 that the fits outside a fold give the rows inside, by the
        first trees, cut at a depth; the least rows of a node outermost, then depths, then sizes."""
        places = [self.folds.index(f) for f, _ in fits]
        leasts = list(dict.fromkeys(least for _, least in fits))
        points = len(leasts) * len(depths) * len(sizes)
        tables = []
        for forest in trees:
            tables.append([])
            for feature, cut, left, _, stats in forest:
                inner = left != np.arange(len(left))
                shares = cut_shares(np.zeros(1, np.int64), inner, left, left + 1, stats, depths)[0]
                tables[-1].append((feature, cut, left, np.stack(shares, 1)))
        sent = self.spark.sparkContext.broadcast(tables)

        def score(b: tuple) -> Iterator[tuple]:
            binned, label, fold = b
            q, out = binned.shape[2], np.zeros((len(fold), points))
            for i, (f, least) in enumerate(fits):
                mine = np.flatnonzero(fold == f)
                flat, first, total = binned[places[i]].ravel(), mine * q, np.zeros((len(mine), len(depths)))
                got = []
                for t, (feature, cut, left, share) in enumerate(sent.value[i]):
                    at = np.zeros(len(mine), np.int64)
                    for _ in range(depths[-1]):
                        at = left[at] + (flat[first + feature[at]] > cut[at])
                    total += share[at]
                    if t + 1 in sizes:
                        got.append(total / (t + 1))
                width = len(depths) * len(sizes)
                a = leasts.index(least) * width
                out[mine, a:a + width] = np.stack(got, 2).reshape(len(mine), width)
            for y, f, p in zip(label.tolist(), fold.tolist(), out.tolist()):
                yield float(y), f, *p

        told_as = ", ".join(["label double", "fold int"] + [f"p{i} double" for i in range(points)])
        try:
            return hold(self.spark.createDataFrame(self.blocks.flatMap(score), told_as, verifySchema=False))
        finally:
            sent.unpersist()


def forest_model(forest: Estimator, trees: Sequence[tuple], cuts: Sequence[np.ndarray], spark: SparkSession) -> Model:
    """The model that ``forest`` would give with these trees, written as the learner writes its models and read again."""
    columns = {c: [] for c in ("tree", "id", "zero", "one", "gain", "left", "right", "feature", "threshold")}
    for t, (feature, cut, left, gain, stats) in enumerate(trees):
        inner = left != np.arange(len(left))
        inner &= ~cut_shares(np.zeros(1, np.int64), inner, left, left + 1, stats, [forest.getMaxDepth()])[1]
        size = np.ones(len(left), np.int64)  # nodes of the subtree, children stand behind their parent
        for v in np.flatnonzero(inner)[::-1]:
            size[v] = 1 + size[left[v]] + size[left[v] + 1]
        ids, seen = np.full(len(left), -1), np.zeros(len(left), bool)
        ids[0], seen[0] = 0, True
        for v in np.flatnonzero(inner):
            ids[left[v]] = ids[v] + 1
            ids[left[v] + 1] = ids[v] + 1 + size[left[v]]
            seen[[left[v], left[v] + 1]] = True
        order = np.flatnonzero(seen)
        order = order[np.argsort(ids[order])]
        split = inner[order]
        of = order[split]
        columns["tree"].append(np.full(len(order), t))
        columns["id"].append(ids[order])
        columns["zero"].append(stats[order, 0])
        columns["one"].append(stats[order, 1])
        for name, value, none in (
                ("gain", gain[of], -1.0), ("left", ids[left[of]], -1), ("right", ids[left[of] + 1], -1), ("feature", feature[of], -1),
                ("threshold", np.array([cuts[f][c] for f, c in zip(feature[of], cut[of])], float), np.nan)):
            put = np.full(len(order), none)
            put[split] = value
            columns[name].append(put)
    nodes = spark.createDataFrame(pa.table({c: np.concatenate(v) for c, v in columns.items()}))
    total, leaf = F.expr("zero + one"), F.col("left") < 0
    data = nodes.select(F.col("tree").cast("int").alias("treeID"), F.struct(
        F.col("id").cast("int").alias("id"), (F.col("one") > F.col("zero")).cast("double").alias("prediction"),
        F.expr("1 - pow(zero / (zero + one), 2) - pow(one / (zero + one), 2)").alias("impurity"),
        F.array("zero", "one").alias("impurityStats"), total.cast("long").alias("rawCount"), F.col("gain"),
        F.col("left").cast("int").alias("leftChild"), F.col("right").cast("int").alias("rightChild"),
        F.struct(F.col("feature").cast("int").alias("featureIndex"),
                 F.when(leaf, F.expr("CAST(array() AS ARRAY<DOUBLE>)")).otherwise(F.array("threshold")).alias("leftCategoriesOrThreshold"),
                 F.lit(-1).alias("numCategories")).alias("split")).alias("nodeData"))
    path = fresh_path(spark, "forest")
    forest.write().save(f"{path}/estimator")
    about = json.loads(spark.read.text(f"{path}/estimator/metadata").first()[0])
    about["class"] = "org.apache.spark.ml.classification.RandomForestClassificationModel"
    one = {**about, "class": "org.apache.spark.ml.classification.DecisionTreeClassificationModel"}
    for kind in ("paramMap", "defaultParamMap"):
        one[kind] = {k: v for k, v in about[kind].items()
                     if k not in ("numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap")}
    size = {"numFeatures": len(cuts), "numClasses": 2}
    each = [(t, json.dumps({**one, **size, "uid": f"dtc_{t}"}), 1.0) for t in range(len(trees))]
    spark.createDataFrame([(json.dumps({**about, **size, "numTrees": len(trees)}),)], "value string").coalesce(1).write.text(
        f"{path}/model/metadata")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    data.repartition(1).sortWithinPartitions("treeID", "nodeData.id").write.parquet(f"{path}/model/data")
    return RandomForestClassificationModel.load(f"{path}/model")


def shared_forest_search(
    forest: Estimator, grid: Mapping[str, Sequence], train: DataFrame, keys: Sequence[str], label: str = "label",
    parallelism: int = 6,
) -> tuple[Model, list[tuple[str, float]]]:
    """``forest_search`` on the columns ``keys`` whose forests, of all folds and points, grow in shared passes, see
    ``Forests``; the best point grows once more on all rows, in the same way. Rows with a null are skipped.
    """
    depths, sizes, leasts = sorted(grid["maxDepth"]), sorted(grid["numTrees"]), list(grid.get("minInstancesPerNode", [forest.getMinInstancesPerNode()]))
    q, strategy = len(keys), forest.getFeatureSubsetStrategy()
    if set(grid) - {"maxDepth", "numTrees", "minInstancesPerNode"} or strategy not in ("auto", "all", "sqrt") or (
            forest.getSubsamplingRate(), forest.getMinInfoGain(), forest.getMinWeightFractionPerNode(),
            forest.getImpurity()) != (1, 0, 0, "gini") or forest.getMaxBins() > 256 or forest.isDefined(forest.weightCol):
        raise ValueError("only trees, depths and least rows are searched, for rows without weights and the Gini impurity")
    drawn = q if strategy == "all" or (strategy == "auto" and sizes[-1] == 1) else int(np.ceil(np.sqrt(q)))
    keys, seed = list(keys), forest.getSeed() % (1 << 63)
    whole = train.select(*keys, F.col(label).cast("double").alias(label)).dropna(subset=keys)
    rows = folded(whole, keys).persist()
    grower = None
    try:
        grower = Forests(rows, keys, label, [*range(FOLDS), None], forest.getMaxBins())
        fits = [(f, least) for least in leasts for f in range(FOLDS)]
        trees = grower.fit(fits, sizes[-1], depths[-1], drawn, seed, forest.getBootstrap())
        areas = held_out_areas(grower.scores(fits, trees, depths, sizes), len(leasts) * len(depths) * len(sizes), parallelism)
        points = [({**({"minInstancesPerNode": least} if "minInstancesPerNode" in grid else {}), "maxDepth": d, "numTrees": n}, least)
                  for least, d, n in itertools.product(leasts, depths, sizes)]
        best, least = points[int(areas.argmax())]
        made = forest.copy({forest.getParam(n): v for n, v in {**best, "cacheNodeIds": True}.items()})
        (final,) = grower.fit([(None, least)], best["numTrees"], best["maxDepth"], drawn, seed, forest.getBootstrap())
        return forest_model(made, final, grower.cuts[-1], rows.sparkSession), [(told(p), float(a)) for (p, _), a in zip(points, areas)]
    finally:
        if grower is not None:
            grower.close()
        rows.unpersist()


def ranked_weights(spark: SparkSession, names: Sequence[str], values, kind: str) -> DataFrame:
    """Coefficients or importances, the largest magnitude first; one row per feature."""
    rows = [(n, float(v), abs(float(v))) for n, v in zip(names, values)]
    rows.sort(key=lambda r: (-r[2], r[0]))
    return spark.createDataFrame(rows, f"feature string, {kind} double, magnitude double")


def grid_table(spark: SparkSession, areas: Mapping[str, Sequence[tuple[str, float]]]) -> DataFrame:
    """Mean area of every grid point by model."""
    rows = [(model, params, area) for model, grid in areas.items() for params, area in grid]
    return spark.createDataFrame(rows, "model string, params string, auc double")


def score_table(model: Model, df: DataFrame, name: str, label: str = "label") -> DataFrame:
    """(model, score, label): the positive-class probability of every row."""
    return model.transform(df).select(
        F.lit(name).alias("model"), vector_to_array("probability")[1].alias("score"),
        F.col(label).cast("int").alias("label"),
    )


def save_model(model: Model, path: str) -> str:
    model.write().overwrite().save(path)
    return path
