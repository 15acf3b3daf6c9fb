"""Logistic models with normal priors, draw tables and their summaries.

The rows are collapsed to distinct covariate patterns once; every Newton step is one pass over the patterns that leaves
one row of sums per group. The system of a group model is bordered block-diagonal: the block of a group meets only
itself and the coefficients, so the groups are eliminated inside the tasks and a system as large as the coefficients
reaches the driver, however many groups there are. Draws are made the same way, the coefficients first and the groups
given these, and meet the rows as blocks of draws by chunks of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathomkit.functions.scalars import expit, key_uniform, ratio
from fathomkit.operators.describe import histogram, ranked_intervals
from fathomkit.operators.ordered import quantiles
from fathomkit.session import hold

DRAW_NUMBERS = 1_000_000  # numbers in one block of draws
ROW_CHUNK = 50_000  # rows that meet a block of draws in one task
GROUP_BUCKET = 256  # groups whose draws one task makes


# --- maximum a posteriori fits -----------------------------------------------------------
@dataclass
class MapFit:
    """``effects``: per group its effects ``e``, the block ``b`` against the coefficients and the inverse ``d`` of its own.

    ``covariance`` is that of intercept and coefficients, groups integrated out.
    """

    names: list[str]
    theta: np.ndarray
    covariance: np.ndarray
    effects: DataFrame | None
    sigma: np.ndarray  # covariance of the group effects, 0x0 / 1x1 / 2x2
    slope: str | None
    covariates: list[str]
    gradient_norm: float  # before the last step
    steps: int

    @property
    def kinds(self) -> int:
        return len(self.sigma)


def covariate_patterns(df: DataFrame, y: str, covariates: Sequence[str], group: str | None = None) -> DataFrame:
    """Distinct covariate rows with their size and number of positives: all a fit needs."""
    keys = [F.col(c).cast("double").alias(c) for c in covariates]
    keys.append((F.col(group) if group else F.lit(0)).cast("long").alias("_group"))
    return hold(df.groupBy(*keys).agg(
        F.count("*").cast("double").alias("_n"), F.sum(F.col(y).cast("double")).alias("_y")
    ))


def _columns(width: int) -> list[str]:
    return [f"v{i}" for i in range(width)]


def _summed(parts: DataFrame, keys: Sequence[str], width: int, *more: Column) -> DataFrame:
    """Vectors in columns v0, v1, ... added up per key."""
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _columns(width)], *more)


def vector_sums(parts: DataFrame) -> dict[int, np.ndarray]:
    """Vectors v of (i, v) added up per i; there is one row per task and i, and only the sums reach the driver."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": pdf["i"].iloc[:1], "v": [np.stack(pdf["v"].to_numpy()).sum(axis=0)]})

    sums = parts.groupBy("i").applyInPandas(add, "i int, v array<double>")
    return {r["i"]: np.array(r["v"]) for r in sums.collect()}


def _reduced(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and the sums of their rows."""
    order = np.argsort(keys, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0])
    return keys[order][starts], np.add.reduceat(rows[order], starts, axis=0)


def _width(q: int) -> int:
    """Log-likelihood, gradient and upper half of the curvature of ``q`` coefficients."""
    return 1 + q + q * (q + 1) // 2


def _derivatives(z: np.ndarray, n: np.ndarray, y: np.ndarray, eta: np.ndarray) -> np.ndarray:
    """One row of sums per pattern; ``z`` has a column of ones first."""
    iu = np.triu_indices(z.shape[1])
    p = 1 / (1 + np.exp(-eta))
    r, w = y - n * p, n * p * (1 - p)
    ll = y * eta - n * (np.maximum(eta, 0) + np.log1p(np.exp(-np.abs(eta))))
    return np.hstack([ll[:, None], r[:, None] * z, (w[:, None] * z)[:, iu[0]] * z[:, iu[1]]])


def _unfolded(v: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihoods, gradients and curvatures of rows of sums."""
    iu = np.triu_indices(q)
    full = np.zeros((len(v), q, q))
    full[:, iu[0], iu[1]] = full[:, iu[1], iu[0]] = v[:, 1 + q:]
    return v[:, 0], v[:, 1: 1 + q], full


def _design(b: pd.DataFrame, covariates: Sequence[str]) -> np.ndarray:
    return np.hstack([np.ones((len(b), 1)), b[list(covariates)].to_numpy(float)])


def fits_without_groups(
    patterns: DataFrame, covariates: Sequence[str], taus: Sequence[float], tol: float = 1e-6, max_steps: int = 50,
) -> list[MapFit]:
    """Newton fits under N(0, 1/tau) priors, all of them in the same passes: one pass a step, whatever their number.

    The last step, shorter than ``tol``, is taken too: it squares what is left of the gradient, which grows with the rows.
    """
    covariates, q = list(covariates), 1 + len(covariates)
    theta = [np.zeros(q) for _ in taus]
    before: list = [None] * len(taus)
    done: list = [None] * len(taus)
    for step in range(1, max_steps + 1):
        left = [i for i, fit in enumerate(done) if fit is None]
        at = {i: theta[i] for i in left}

        def partial(batches: Iterator[pd.DataFrame], at=at) -> Iterator[pd.DataFrame]:
            total = {i: np.zeros(_width(q)) for i in at}
            for b in batches:
                z, n, y = _design(b, covariates), b["_n"].to_numpy(float), b["_y"].to_numpy(float)
                for i, t in at.items():
                    total[i] += _derivatives(z, n, y, z @ t).sum(axis=0)
            yield pd.DataFrame({"i": list(total), "v": list(total.values())})

        for i, v in vector_sums(patterns.mapInPandas(partial, "i int, v array<double>")).items():
            prior = taus[i]
            ll, grad, curv = (x[0] for x in _unfolded(v[None, :], q))
            value = ll - prior * theta[i] @ theta[i] / 2
            if before[i] is not None and value - before[i][1] < -1e-9 * abs(ll):
                theta[i] = (theta[i] + before[i][0]) / 2
                continue
            score, hessian = grad - prior * theta[i], curv + prior * np.eye(q)
            move = np.linalg.solve(hessian, score)
            if np.abs(move).max() < tol:
                names = ["alpha", *[f"beta[{c}]" for c in covariates]]
                done[i] = MapFit(names, theta[i] + move, np.linalg.inv(hessian), None, np.zeros((0, 0)), None, covariates,
                                 float(np.abs(score).max()), step)
                continue
            before[i], theta[i] = (theta[i], value), theta[i] + move
        if all(done):
            return done
    raise RuntimeError(f"no convergence in {max_steps} steps")


def _group_parts(b: pd.DataFrame, q: int, at: list[int], theta: np.ndarray):
    """Per group: log-likelihood, gradient, curvature, effects, their curvature, border, linear term of the model."""
    ll, grad, curv = _unfolded(b[_columns(_width(q))].to_numpy(float), q)
    e = np.stack(b["e"].to_numpy()).astype(float)
    own, border = curv[:, at][:, :, at], curv[:, :, at]
    linear = grad[:, at] + np.einsum("gij,gj->gi", own, e) + theta @ border
    return ll, grad, curv, e, own, border, linear


class _Blocks:
    """The sums of all groups at one point of the fit, held as a table: _group, e, v0, v1, ..."""

    def __init__(self, sums: DataFrame, q: int, at: list[int], theta: np.ndarray):
        self.sums, self.q, self.at, self.theta = sums, q, at, theta

    def totals(self) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """Log-likelihood, gradient, curvature and linear term of the coefficients, sum of e e', number of groups."""
        q, at, theta, kinds = self.q, self.at, self.theta, len(self.at)
        width = 2 + 2 * q + q * q + kinds * kinds

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(width)
            for b in batches:
                if not len(b):
                    continue
                ll, grad, curv, e, _, border, _ = _group_parts(b, q, at, theta)
                linear = grad.sum(0) + curv.sum(0) @ theta + np.einsum("gij,gj->i", border, e)
                total += np.concatenate(
                    [[ll.sum(), len(b)], grad.sum(0), linear, curv.sum(0).ravel(), (e.T @ e).ravel()])
            yield pd.DataFrame({"i": [0], "v": [total]})

        v = vector_sums(self.sums.mapInPandas(partial, "i int, v array<double>"))[0]
        cut = np.split(v[2:], np.cumsum([q, q, q * q]))
        return v[0], cut[0], cut[2].reshape(q, q), cut[1], cut[3].reshape(kinds, kinds), int(v[1])

    def eliminated(self, precisions: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, float, float]]:
        """For each precision of the effects what the groups take from the curvature and the linear term of the
        coefficients, the sum of b' D^-1 b, and the log determinant of their blocks. One pass for all of them."""
        q, at, theta = self.q, self.at, self.theta
        width = q * q + q + 2

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((len(precisions), width))
            for b in batches:
                if not len(b):
                    continue
                *_, own, border, linear = _group_parts(b, q, at, theta)
                for i, precision in enumerate(precisions):
                    d = own + precision
                    by = np.linalg.solve(d, border.transpose(0, 2, 1))
                    x = np.linalg.solve(d, linear[:, :, None])[:, :, 0]
                    total[i] += np.concatenate([
                        np.einsum("gik,gkj->ij", border, by).ravel(), np.einsum("gik,gk->i", border, x),
                        [(linear * x).sum(), np.linalg.slogdet(d)[1].sum()]])
            yield pd.DataFrame({"i": range(len(precisions)), "v": list(total)})

        sums = vector_sums(self.sums.mapInPandas(partial, "i int, v array<double>"))
        return [(v[: q * q].reshape(q, q), v[q * q: -2], v[-2], v[-1]) for _, v in sorted(sums.items())]

    def solved(self, precision: np.ndarray, ahead: np.ndarray) -> DataFrame:
        """Per group: e at the solution of the model, p (what it was), its block b and d, largest move and gradient."""

        q, at, theta = self.q, self.at, self.theta

        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if not len(b):
                    continue
                _, grad, _, e, own, border, linear = _group_parts(b, q, at, theta)
                d = np.linalg.inv(own + precision)
                new = np.einsum("gij,gj->gi", d, linear - ahead @ border)
                slope = grad[:, at] - e @ precision
                yield pd.DataFrame({
                    "_group": b["_group"], "e": list(new), "p": list(e), "b": list(border.reshape(len(b), -1)),
                    "d": list(d.reshape(len(b), -1)), "move": np.abs(new - e).max(1), "grad": np.abs(slope).max(1)})

        return self.sums.mapInPandas(each, (
            "_group long, e array<double>, p array<double>, b array<double>, d array<double>, move double, grad double"))


def _group_sums(patterns: DataFrame, covariates: Sequence[str], theta: np.ndarray, effects: DataFrame, at: list[int]):
    """Per group the sums at the current coefficients and effects; the effects stay beside them."""
    width = _width(len(theta))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            z, e = _design(b, covariates), np.stack(b["e"].to_numpy())
            eta = z @ theta + (e * z[:, at]).sum(axis=1)
            groups, sums = _reduced(
                b["_group"].to_numpy(), _derivatives(z, b["_n"].to_numpy(float), b["_y"].to_numpy(float), eta))
            rows = pd.DataFrame(sums, columns=_columns(width))
            rows.insert(0, "_group", groups)
            rows["e"] = list(e[np.unique(b["_group"].to_numpy(), return_index=True)[1]])
            yield rows

    schema = "_group long, " + ", ".join(f"{c} double" for c in _columns(width)) + ", e array<double>"
    parts = patterns.join(effects.select("_group", "e"), "_group").mapInPandas(partial, schema)
    return _summed(parts, ["_group"], width, F.first("e").alias("e"))


def _spread_of(x: np.ndarray) -> np.ndarray:
    """Covariance of the effects from log sds and, for two kinds, the inverse hyperbolic tangent of their correlation."""
    sd = np.exp(x[:2])
    if len(x) == 1:
        return np.array([[sd[0] ** 2]])
    across = np.tanh(x[2]) * sd[0] * sd[1]
    return np.array([[sd[0] ** 2, across], [across, sd[1] ** 2]])


def _highest(values: Callable[[list[np.ndarray]], np.ndarray], x: np.ndarray, close: float) -> np.ndarray:
    """The maximum near ``x`` by Newton steps on differences; ``values`` takes many points at once.

    A step asks for the points of the differences, and then for the points along its direction.
    """
    n, h = len(x), 1e-3
    low, high = np.array([-7.0, -7.0, -6.0])[:n], np.array([3.0, 3.0, 6.0])[:n]
    units = np.eye(n) * h
    for _ in range(60):
        pairs = [(i, j) for i in range(n) for j in range(i)]
        points = [x, *(x + u for u in units), *(x - u for u in units)]
        points += [x + s * (units[i] + units[j]) for i, j in pairs for s in (1, -1)]
        f = values(points)
        up, down = f[1: 1 + n], f[1 + n: 1 + 2 * n]
        slope, curve = (up - down) / (2 * h), np.diag((up - 2 * f[0] + down) / h ** 2)
        for k, (i, j) in enumerate(pairs):
            both = f[1 + 2 * n + 2 * k: 3 + 2 * n + 2 * k].sum()
            curve[i, j] = curve[j, i] = (both - up[i] - down[i] - up[j] - down[j] + 2 * f[0]) / (2 * h ** 2)
        root, axes = np.linalg.eigh(curve)
        step = axes @ ((axes.T @ slope) / np.maximum(np.abs(root), 1e-2))
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-300))
        if np.abs(step).max() < close:
            return np.clip(x + step, low, high)
        lengths = [2.0, 1.0, 0.5, 0.25, 0.1, 0.02]
        ahead = [np.clip(x + t * step, low, high) for t in lengths]
        found = values(ahead)
        best = int(found.argmax())
        if found[best] <= f[0] or np.abs(ahead[best] - x).max() < close:
            return x if found[best] <= f[0] else ahead[best]
        x = ahead[best]
    raise RuntimeError("the spread of the group effects did not settle")


def fit_map(
    patterns: DataFrame, covariates: Sequence[str], tau: float = 0.16, kinds: int = 0,
    slope: str | None = None, tau_sigma: float = 1.0, tol: float = 1e-6, max_steps: int = 50,
) -> MapFit:
    """Newton fit under N(0, 1/tau) priors on intercept and coefficients.

    ``kinds`` 0: no group effects; 1: group intercepts with a half-normal prior on their sd;
    2: correlated group intercepts and slopes of covariate ``slope`` under a Wishart(I, 2)
    prior on their precision. One pass over the patterns per step; the spread of the effects
    maximises its Laplace marginal posterior on the quadratic model of that pass.
    """
    if not kinds:
        return fits_without_groups(patterns, covariates, [tau], tol, max_steps)[0]
    covariates = list(covariates)
    q = 1 + len(covariates)
    at = [0] if kinds == 1 else [0, 1 + covariates.index(slope)]
    theta, x, before = np.zeros(q), np.zeros(1 if kinds == 1 else 3), None
    effects = hold(patterns.select("_group").distinct().select(
        "_group", F.array(*[F.lit(0.0)] * kinds).alias("e"), F.array(*[F.lit(0.0)] * kinds).alias("p")))
    moved = np.inf
    for step in range(1, max_steps + 1):
        blocks = _Blocks(hold(_group_sums(patterns, covariates, theta, effects, at)), q, at, theta)
        ll, grad, curv, linear, squares, j = blocks.totals()
        precision = np.linalg.inv(_spread_of(x))
        if before is not None:
            old = before[1] - tau * before[0] @ before[0] / 2 - np.sum(precision * before[2]) / 2
            if ll - tau * theta @ theta / 2 - np.sum(precision * squares) / 2 - old < -1e-9 * abs(ll):
                theta = (theta + before[0]) / 2
                effects = hold(effects.select(
                    "_group", F.zip_with("e", "p", lambda a, b: (a + b) / 2).alias("e"), "p"))
                continue

        def marginal(points: list[np.ndarray]) -> np.ndarray:
            spreads = [_spread_of(p) for p in points]
            out = []
            for spread, (taken, pulled, own, logdet) in zip(
                    spreads, blocks.eliminated(np.array([np.linalg.inv(s) for s in spreads]))):
                s, r, size = curv + tau * np.eye(q) - taken, linear - pulled, np.linalg.slogdet(spread)[1]
                prior = -j * size / 2 - tau_sigma * spread[0, 0] / 2 if kinds == 1 else (
                    -(j - 1) * size / 2 - np.trace(np.linalg.inv(spread)) / 2)
                out.append(prior - (logdet + np.linalg.slogdet(s)[1]) / 2 + (own + r @ np.linalg.solve(s, r)) / 2)
            return np.array(out)

        x = _highest(marginal, x, 1e-7 if moved < 0.1 else 1e-3)
        precision = np.linalg.inv(_spread_of(x))
        taken, pulled, *_ = blocks.eliminated(precision[None])[0]
        covariance = np.linalg.inv(curv + tau * np.eye(q) - taken)
        ahead = covariance @ (linear - pulled)
        solved = hold(blocks.solved(precision, ahead))
        far = solved.agg(F.max("move"), F.max("grad")).first()
        moved = max(float(np.abs(ahead - theta).max()), far[0])
        if moved < tol:
            norm = max(float(np.abs(grad - tau * theta).max()), far[1])
            names = ["alpha", *[f"beta[{c}]" for c in covariates]]
            return MapFit(names, ahead, covariance, solved.select("_group", "e", "b", "d"),
                          _spread_of(x), slope, covariates, norm, step)
        before, theta, effects = (theta, ll, squares), ahead, solved.select("_group", "e", "p")
    raise RuntimeError(f"no convergence in {max_steps} steps; last move {moved:.3g}")


def _effect_names(kinds: int) -> list[str]:
    return ["u", "v"][:kinds]


def coefficient_summary(spark: SparkSession, fit: MapFit) -> DataFrame:
    """Estimate, Laplace sd from the inverse Hessian, and the 95 % interval."""
    rows = [(n, float(m), float(s)) for n, m, s in zip(fit.names, fit.theta, np.sqrt(np.diag(fit.covariance)))]
    told = spark.createDataFrame(rows, "param string, mean double, sd double")
    if fit.kinds:
        kinds, q, covariance = fit.kinds, len(fit.theta), fit.covariance

        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for g in batches:
                if not len(g):
                    continue
                d, b = np.stack(g["d"]).reshape(-1, kinds, kinds), np.stack(g["b"]).reshape(-1, q, kinds)
                way = np.einsum("gik,gkl->gil", b, d)
                var = d + np.einsum("gik,ij,gjl->gkl", way, covariance, way)
                e = np.stack(g["e"])
                for i, name in enumerate(_effect_names(kinds)):
                    yield pd.DataFrame({"param": [f"{name}[{x}]" for x in g["_group"]], "mean": e[:, i],
                                        "sd": np.sqrt(var[:, i, i])})

        told = told.union(fit.effects.mapInPandas(each, "param string, mean double, sd double"))
    told = told.select("*", (F.col("mean") - 1.96 * F.col("sd")).alias("lo"), (F.col("mean") + 1.96 * F.col("sd")).alias("hi"))
    if fit.kinds:
        spread = [("sigma_u", fit.sigma[0, 0] ** 0.5)]
        if fit.kinds == 2:
            sv = fit.sigma[1, 1] ** 0.5
            spread += [("sigma_v", sv), ("rho", fit.sigma[0, 1] / (spread[0][1] * sv))]
        told = told.union(spark.createDataFrame(
            [(n, float(v), None, None, None) for n, v in spread], told.schema))
    return told


def prior_sensitivity(patterns: DataFrame, covariates: Sequence[str], priors: Sequence[tuple[str, float]]) -> DataFrame:
    """Fits under each prior precision, in the same passes, and their summaries in one table."""
    out = None
    for (label, _), fit in zip(priors, fits_without_groups(patterns, covariates, [tau for _, tau in priors])):
        one = coefficient_summary(patterns.sparkSession, fit).select(F.lit(label).alias("prior"), "*")
        out = one if out is None else out.union(one)
    return out


# --- draws -------------------------------------------------------------------------------
@dataclass
class Draws:
    """Blocks of draws. ``fixed``: block, draws and theta, the flat matrix of intercept and coefficients by draw;
    ``effects``: block, group and e, the flat matrix of the group's effects by draw."""

    names: list[str]
    fixed: DataFrame
    effects: DataFrame | None
    kinds: int
    slope: int | None  # the column of the design whose slope is the second effect
    iterations: int


_FIXED = "block long, draws array<long>, theta array<double>"


def packed_draws(
    draws: DataFrame, names: Sequence[str], effects: DataFrame | None = None, kinds: int = 0, slope: int | None = None,
) -> Draws:
    """Blocks of given draws: (draw, theta) and, for group effects, (draw, group, e); draws are numbered from 0."""
    per = max(1, DRAW_NUMBERS // len(names))
    block = F.floor(F.col("draw") / per).alias("block")
    fixed = draws.groupBy(block).agg(F.array_sort(F.collect_list(F.struct("draw", "theta"))).alias("d")).select(
        "block", F.col("d.draw").alias("draws"), F.flatten("d.theta").alias("theta"))
    if effects is not None:
        effects = effects.groupBy(block, "group").agg(
            F.array_sort(F.collect_list(F.struct("draw", "e"))).alias("d")).select(
            "block", "group", F.flatten("d.e").alias("e"))
    return Draws(list(names), fixed, effects, kinds if effects is not None else 0, slope, 0)


def _uniform(keys: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit keys."""
    with np.errstate(over="ignore"):
        z = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / float(1 << 53)


def _normals(draws: np.ndarray, group: int, kinds: int, seed: int) -> np.ndarray:
    """Normal numbers (draw, kind) of a group; the same for the same draw and group wherever they are made."""
    odd = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7)]
    with np.errstate(over="ignore"):
        key = draws.astype(np.uint64)[:, None] * odd[0] + np.uint64(group % (1 << 64)) * odd[1]
        key = key + (np.arange(2 * kinds, dtype=np.uint64) + np.uint64(seed)) * odd[2]
    u = _uniform(key)
    return np.sqrt(-2 * np.log(1 - u[:, :kinds])) * np.cos(2 * np.pi * u[:, kinds:])


def laplace_draws(
    spark: SparkSession, fit: MapFit, chains: int = 3, iterations: int = 2000, seed: int = 42, limit: int | None = None,
) -> Draws:
    """Draws from the Gaussian approximation at the mode: coefficients first, then each group given these.

    ``limit``: only so many evenly spaced draws. Every normal number is a hash of its draw and place, so a repeated task
    repeats it.
    """
    root, centre, q = np.linalg.cholesky(fit.covariance), fit.theta, len(fit.theta)
    every = 1 if limit is None else max(1, chains * iterations // limit)
    count = -(-chains * iterations // every) if limit is None else min(limit, -(-chains * iterations // every))
    per = max(1, DRAW_NUMBERS // q)

    def normal(j: Column) -> Column:
        u1 = key_uniform([F.col("id"), j, F.lit(1)], seed)
        u2 = key_uniform([F.col("id"), j, F.lit(2)], seed)
        return F.sqrt(-2 * F.log(1 - u1)) * F.cos(2 * np.pi * u2)

    def place(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("id")
        theta = centre + np.stack(b["z"].to_numpy()) @ root.T
        return pd.DataFrame({"block": b["block"].iloc[:1], "draws": [b["id"].to_numpy()], "theta": [theta.ravel()]})

    numbers = spark.range(count).select(
        F.floor(F.col("id") / per).alias("block"), (F.col("id") * every).alias("id"),
    ).withColumn("z", F.transform(F.sequence(F.lit(0), F.lit(q - 1)), normal))
    fixed = hold(numbers.groupBy("block").applyInPandas(place, _FIXED))
    slope = 1 + fit.covariates.index(fit.slope) if fit.kinds == 2 else None
    draws = Draws(fit.names, fixed, None, fit.kinds, slope, iterations)
    if not fit.kinds:
        return draws

    kinds = fit.kinds
    blocks = -(-count // per)
    buckets = F.floor((fit.effects.agg(F.count("*")).scalar() - 1) / GROUP_BUCKET) + 1
    groups = fit.effects.withColumn("bucket", F.pmod(F.xxhash64("_group"), buckets)).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    wide = fixed.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), buckets - 1)))

    def given(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ids = np.asarray(right["draws"].iloc[0])
        off = np.asarray(right["theta"].iloc[0]).reshape(-1, q) - centre
        out = []
        for g, e, b, d in zip(*(left[c] for c in ("_group", "e", "b", "d"))):
            d = np.asarray(d).reshape(kinds, kinds)
            mean = np.asarray(e) - off @ np.asarray(b).reshape(q, kinds) @ d
            out.append((mean + _normals(ids, g, kinds, seed) @ np.linalg.cholesky(d).T).ravel())
        return pd.DataFrame({"block": right["block"].iloc[0], "group": left["_group"], "e": out})

    effects = groups.groupBy("bucket", "block").cogroup(wide.groupBy("bucket", "block")).applyInPandas(
        lambda left, right: given(left, right) if len(left) else pd.DataFrame(
            {"block": pd.Series(dtype="int64"), "group": pd.Series(dtype="int64"), "e": []}),
        "block long, group long, e array<double>")
    draws.effects = hold(effects)
    return draws


def long_draws(draws: Draws) -> DataFrame:
    """(param, chain, iter, value)."""
    q, kinds, per_chain = len(draws.names), draws.kinds, F.lit(draws.iterations or 1 << 62)
    labels = F.array(*map(F.lit, draws.names))

    def told(rows: DataFrame, param: Column) -> DataFrame:
        return rows.select(param.alias("param"), F.floor(F.col("draw") / per_chain).cast("int").alias("chain"),
                           (F.col("draw") % per_chain).cast("int").alias("iter"), "value")

    fixed = draws.fixed.select("draws", F.posexplode("theta").alias("i", "value")).select(
        "i", "value", F.col("draws")[(F.col("i") / q).cast("int")].alias("draw"))
    out = told(fixed, labels[F.col("i") % q])
    if kinds:
        each = draws.effects.join(draws.fixed.select("block", "draws"), "block").select(
            "group", "draws", F.posexplode("e").alias("i", "value")).select(
            "group", "i", "value", F.col("draws")[(F.col("i") / kinds).cast("int")].alias("draw"))
        kind = F.array(*map(F.lit, _effect_names(kinds)))[F.col("i") % kinds]
        out = out.union(told(each, F.concat(kind, F.lit("["), F.col("group").cast("string"), F.lit("]"))))
    return out


def posterior_summary(draws: DataFrame) -> DataFrame:
    """Mean, population sd, 95 % interval and P(> 0) per parameter."""
    q = quantiles(draws, ["value"], [0.025, 0.975], by=["param"], names=["q2_5", "q97_5"])
    return draws.groupBy("param").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd"),
        F.avg((F.col("value") > 0).cast("int")).alias("prob_pos"),
    ).join(q.select("param", "q2_5", "q97_5"), "param")


def odds_ratios(summary: DataFrame) -> DataFrame:
    """exp of mean and interval; ``clear`` where the interval excludes an odds ratio of 1."""
    return summary.select(
        "param", F.exp("mean").alias("or_mean"), F.exp("q2_5").alias("or_lo"), F.exp("q97_5").alias("or_hi"),
        (~((F.col("q2_5") < 0) & (F.col("q97_5") > 0))).alias("clear"),
    ).orderBy("or_mean")


def rhat(draws: DataFrame, limit: float = 1.01) -> DataFrame:
    """Potential scale reduction from the mean and variance of each chain."""
    chains = draws.groupBy("param", "chain").agg(
        F.count("*").alias("n"), F.avg("value").alias("m"), F.variance("value").alias("v")
    )
    per = chains.groupBy("param").agg(
        F.avg("n").alias("n"), F.avg("v").alias("w"), F.variance("m").alias("vm"),
    )
    b = F.col("n") * F.col("vm")
    hat = F.sqrt(ratio((F.col("n") - 1) / F.col("n") * F.col("w") + b / F.col("n"), F.col("w")))
    return per.select("param", hat.alias("rhat"), (hat > limit).alias("flagged"))


def _lagged_products(segment: int, reach: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Sums of x(i) x(i + t) for t = 0 .. ``reach``, i in one segment of a chain and i + t in it or its successor."""

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        at = (pdf["iter"] - pdf["seg"] * segment).to_numpy(int)
        both = np.zeros(at.max() + 1)
        both[at] = pdf["x"].to_numpy(float)
        size = 1 << int(len(both) + reach).bit_length()
        pair = np.conj(np.fft.rfft(both[:segment], size)) * np.fft.rfft(both, size)
        return pdf[["param", "chain", "n", "v"]].iloc[:1].assign(s=[np.fft.irfft(pair, size)[: reach + 1]])

    return sums


def _stopped(reach: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Sum of autocorrelations in pairs of lags up to the first pair that is not positive, if that is within ``reach``."""

    def stop(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf[["param", "chain", "n"]].iloc[:1]
        n, v = int(pdf["n"].iloc[0]), float(pdf["v"].iloc[0])
        if not v:
            return first.assign(rho=float(n), done=True)
        acf = np.stack(pdf["s"].to_numpy()).sum(axis=0) / (v * n)
        pairs = acf[1: reach: 2] + acf[2: reach + 1: 2]
        ends = (pairs <= 0) | (2 * np.arange(len(pairs)) + 2 >= n)
        done = bool(ends.any())
        return first.assign(rho=1 + 2 * pairs[: int(ends.argmax()) if done else 0].sum(), done=done)

    return stop


def effective_size(draws: DataFrame, segment: int = 65_536, reach: int = 1_024, limit: float = 400) -> DataFrame:
    """Effective sample size per parameter: autocorrelation pairs up to the first one <= 0.

    A chain is cut into segments; each meets the beginning of its successor in one Fourier product, which gives every lag
    up to ``reach`` at once, so a chain of any length takes one pass and no task holds it. Chains whose pairs stay positive
    that far go on, alone, with a larger reach. Iterations are numbered without gaps; chain results are summed.
    """
    keys = ["param", "chain"]
    stats = hold(draws.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("v")))
    left = hold(draws.join(stats, keys).select(
        *keys, "n", "v", F.col("iter").cast("long").alias("iter"), (F.col("value") - F.col("m")).alias("x")))
    results = None
    while True:
        segment = max(segment, reach)
        own = F.floor(F.col("iter") / segment)
        early = (F.col("iter") % segment < reach) & (own > 0)
        spread = left.select(*keys, "n", "v", "iter", "x", F.explode(
            F.when(early, F.array(own - 1, own)).otherwise(F.array(own))).alias("seg"))
        products = spread.groupBy(*keys, "seg").applyInPandas(
            _lagged_products(segment, reach), "param string, chain int, n long, v double, s array<double>")
        found = hold(products.groupBy(*keys).applyInPandas(
            _stopped(reach), "param string, chain int, n long, rho double, done boolean"))
        ready = found.where("done")
        results = ready if results is None else results.union(ready)
        more = found.where("NOT done").select(*keys)
        if more.isEmpty():
            break
        left, reach = left.join(more, keys, "left_semi"), reach * 16
    size = F.sum(F.col("n") / F.greatest("rho", F.lit(1.0)))
    return results.groupBy("param").agg(size.alias("ess")).withColumn("flagged", F.col("ess") < limit)


def group_effects(draws: DataFrame, prefix: str) -> DataFrame:
    """Group effects ranked by posterior mean with the side of zero of their interval."""
    return ranked_intervals(draws.filter(F.col("param").startswith(f"{prefix}[")), "param", "value")


def draw_histogram(draws: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(draws, "value", bins, by="param")


# --- draws against rows ------------------------------------------------------------------
def _against_draws(
    obs: DataFrame, columns: Sequence[str], covariates: Sequence[str], draws: Draws, group: str | None,
    use: Callable[[pd.DataFrame, np.ndarray, np.ndarray], pd.DataFrame], schema: str,
) -> DataFrame:
    """``use(rows, draws, eta)`` for every chunk of rows and block of draws; eta is the predictor, rows x draws.

    Rows are dealt by their group into chunks of about ``ROW_CHUNK``, a large group into several; the blocks of the
    coefficients go to all chunks, those of a group's effects to the chunks of the group. A slice of rows x draws exists
    at a time. ``use`` is called with slices of a chunk.
    """
    if (group is None) != (draws.effects is None):
        raise ValueError("group effects need the group of each row, and the other way round")
    cols, q, kinds = list(covariates), len(draws.names), draws.kinds
    slope = draws.slope
    rows = hold(obs.select(
        *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)], *columns,
        (F.col(group).cast("long") if group else F.lit(0).cast("long")).alias("_group")))
    sizes = hold(rows.groupBy("_group").agg(F.ceil(F.count("*") / ROW_CHUNK).cast("int").alias("_salts")))
    buckets = F.floor((rows.agg(F.count("*")).scalar() - 1) / ROW_CHUNK) + 1
    bucket = F.pmod(F.xxhash64("_group"), buckets).alias("_bucket")
    dealt = rows.join(sizes, "_group").withColumn("_salt", F.pmod(
        F.xxhash64(*[f"_x{i}" for i in range(len(cols))], *columns), F.col("_salts")).cast("int")).withColumn("_bucket", bucket)
    chunks = sizes.select("_group", bucket, F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"))
    blocks = draws.fixed.agg(F.max("block")).scalar()
    every = F.explode(F.sequence(F.lit(0).cast("long"), blocks)).alias("block")
    left = dealt.select(*rows.columns, "_bucket", "_salt", every)
    right = chunks.select("_bucket", "_salt").distinct().select("_bucket", "_salt", every).join(draws.fixed, "block").select(
        "_bucket", "_salt", "block", F.lit(None).cast("long").alias("group"), "draws", F.col("theta").alias("numbers"))
    if kinds:
        right = right.unionByName(chunks.withColumnRenamed("_group", "group").join(draws.effects, "group").select(
            "_bucket", "_salt", "block", "group", F.array().cast("array<long>").alias("draws"),
            F.col("e").alias("numbers")))

    def meet(asked: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        own = told["group"].isna()
        ids = np.asarray(told.loc[own, "draws"].iloc[0])
        theta = np.asarray(told.loc[own, "numbers"].iloc[0]).reshape(-1, q)
        effects = {int(g): np.asarray(e).reshape(-1, kinds) for g, e in told.loc[~own, ["group", "numbers"]].to_numpy()}
        asked, out = asked.sort_values("_group", kind="stable"), []
        step = max(1, 2_000_000 // len(ids))
        for g, part in asked.groupby("_group", sort=False) if kinds else [(0, asked)]:
            for a in range(0, len(part), step):
                few = part.iloc[a: a + step]
                z = np.hstack([np.ones((len(few), 1)), few[[f"_x{i}" for i in range(len(cols))]].to_numpy(float)])
                eta = z @ theta.T
                if kinds:
                    eta += effects[g][:, 0]
                if kinds == 2:
                    eta += z[:, [slope]] * effects[g][:, 1]
                out.append(use(few, ids, eta))
        return pd.concat(out)

    empty = {f.split()[0]: [] for f in schema.split(", ")}
    keys = ("_bucket", "_salt", "block")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        lambda a, b: meet(a, b) if len(a) and len(b) else pd.DataFrame(empty), schema)


def _loglik(y: np.ndarray, eta: np.ndarray) -> np.ndarray:
    return y[:, None] * eta - (np.maximum(eta, 0) + np.log1p(np.exp(-np.abs(eta))))


def draw_totals(obs: DataFrame, y: str, covariates: Sequence[str], draws: Draws, group: str | None = None) -> DataFrame:
    """Log-likelihood and mean probability of all rows under every draw; one sum per draw and slice leaves a task.

    ``group`` holds the group of each row where the draws have group effects.
    """

    def sums(rows: pd.DataFrame, ids: np.ndarray, eta: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"draw": ids, "ll": _loglik(rows["_y"].to_numpy(float), eta).sum(axis=0),
                             "p": (1 / (1 + np.exp(-eta))).sum(axis=0), "n": len(rows)})

    used = obs.withColumn("_y", F.col(y).cast("double"))
    parts = _against_draws(used, ["_y"], covariates, draws, group, sums, "draw long, ll double, p double, n long")
    return parts.groupBy("draw").agg(
        F.sum("ll").alias("loglik"), (F.sum("p") / F.sum("n")).alias("mean_p"), F.sum("n").alias("n")
    )


def dic(totals: DataFrame) -> DataFrame:
    """Mean deviance, effective parameters var(D)/2 and their sum."""
    d = -2 * F.col("loglik")
    return totals.agg(F.avg(d).alias("d_bar"), (F.var_pop(d) / 2).alias("p_d")).withColumn(
        "dic", F.col("d_bar") + F.col("p_d")
    )


def pointwise(
    obs: DataFrame, y: str, key: str, covariates: Sequence[str], draws: Draws, group: str | None = None,
) -> DataFrame:
    """Per row: the self-weighted log density and the importance-sampling leave-one-out one; ``key`` tells rows apart.

    A block of draws gives three log-sum-exps of a row, which add up over the blocks.
    """

    def lse(a: np.ndarray) -> np.ndarray:
        m = a.max(axis=1)
        return m + np.log(np.exp(a - m[:, None]).sum(axis=1))

    def rows(few: pd.DataFrame, ids: np.ndarray, eta: np.ndarray) -> pd.DataFrame:
        ll = _loglik(few["_y"].to_numpy(float), eta)
        return pd.DataFrame({"key": few["_key"], "twice": lse(2 * ll), "once": lse(ll), "minus": lse(-ll), "n": len(ids)})

    used = obs.withColumn("_y", F.col(y).cast("double")).withColumn("_key", F.col(key).cast("string"))
    parts = _against_draws(used, ["_y", "_key"], covariates, draws, group, rows,
                           "key string, twice double, once double, minus double, n long")
    peaks = ("twice", "once", "minus")
    per = parts.groupBy("key").agg(
        *[F.collect_list(c).alias(c) for c in peaks], F.sum("n").alias("n")  # one number per block of draws
    ).select("n", *[F.expr(
        f"array_max({c}) + ln(aggregate({c}, 0.0D, (a, x) -> a + exp(x - array_max({c}))))").alias(c) for c in peaks])
    return per.select((F.col("twice") - F.col("once")).alias("elpd"), (F.log("n") - F.col("minus")).alias("elpd_loo"))


def elpd(models: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Sum and standard error per model, and the difference to the best model."""
    out = None
    for name, rows in models:
        one = rows.agg(
            F.sum("elpd").alias("elpd"), F.sqrt(F.count("*") * F.variance("elpd")).alias("se"),
            F.sum("elpd_loo").alias("elpd_loo"),
        ).select(F.lit(name).alias("model"), "*")
        out = one if out is None else out.union(one)
    return out.withColumn("delta", F.col("elpd") - F.max("elpd").over(Window.partitionBy()))


def predictive_check(
    obs: DataFrame, y: str, key: str, by: str, covariates: Sequence[str], draws: Draws,
    group: str | None = None, seed: int = 42,
) -> DataFrame:
    """Replicated against observed rate, over all rows and per level of ``by``.

    The uniform number of a (row, draw) pair is a hash of both, so recomputation repeats it.
    """

    def hits(rows: pd.DataFrame, ids: np.ndarray, eta: np.ndarray) -> pd.DataFrame:
        with np.errstate(over="ignore"):
            salt = (ids.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
            drawn = _uniform(rows["_key"].to_numpy(np.int64).view(np.uint64)[:, None] + salt[None, :])
        rep, levels = drawn < 1 / (1 + np.exp(-eta)), rows["_by"].to_numpy()
        return pd.concat([pd.DataFrame({
            "level": lv, "draw": ids, "hits": rep[levels == lv].sum(axis=0), "n": int((levels == lv).sum())})
            for lv in pd.unique(levels)])

    used = obs.withColumn("_key", F.xxhash64(key)).withColumn("_by", F.col(by).cast("string"))
    counts = _against_draws(used, ["_key", "_by"], covariates, draws, group, hits,
                            "level string, draw long, hits double, n long")
    both = F.explode(F.array(F.col("level"), F.lit("ALL"))).alias("level")
    rates = counts.select(both, "draw", "hits", "n").groupBy("level", "draw").agg(
        (F.sum("hits") / F.sum("n")).alias("rate")
    )
    rates = hold(rates)
    q = quantiles(rates, ["rate"], [0.025, 0.975], by=["level"], names=["lo", "hi"])
    seen = obs.select(F.explode(F.array(F.col(by).cast("string"), F.lit("ALL"))).alias("level"), y).groupBy(
        "level"
    ).agg(F.avg(y).alias("observed"))
    return rates.groupBy("level").agg(F.avg("rate").alias("predicted")).join(
        q.select("level", "lo", "hi"), "level"
    ).join(seen, "level").withColumn("covered", F.col("observed").between(F.col("lo"), F.col("hi")))


def prior_predictive(keys: DataFrame, key: str, sds: dict[str, float], bins: int = 80, seed: int = 42) -> DataFrame:
    """Histogram of the probability implied by a normal prior, one simulated draw per key."""
    u1, u2 = key_uniform([F.col(key), F.lit(1)], seed), key_uniform([F.col(key), F.lit(2)], seed)
    z = F.sqrt(-2 * F.log(1 - u1)) * F.cos(2 * np.pi * u2)
    each = F.explode(F.array(*[
        F.struct(F.lit(n).alias("prior"), expit(F.col("_z") * sd).alias("p")) for n, sd in sds.items()
    ])).alias("s")
    return histogram(keys.select(z.alias("_z")).select(each).select("s.*"), "p", bins, by="prior")
