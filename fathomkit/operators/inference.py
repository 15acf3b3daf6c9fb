"""Regression, analysis of variance and contingency tests.

Rows are only touched by grouped Spark aggregates; the driver sees totals per factor cell
and solves p x p systems.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathomkit.functions import tails
from fathomkit.functions.scalars import log_normal_cdf, normal_quantile, ratio, threshold_label
from fathomkit.operators.grouping import contingency
from fathomkit.operators.ordered import global_rank, quantiles, running_totals
from fathomkit.session import hold

MAX_TERMS = 5_000  # a model of p terms needs a p x p system on the driver


# --- linear model ------------------------------------------------------------------------
@dataclass
class Fit:
    """Least squares of ``y`` on numeric columns and factors (first level = reference).

    ``gram``, ``xy`` and ``yy`` are sums of products of deviations: ``y`` and the numeric columns have their means
    taken off first, so digits are not lost where values are large against their spread.
    """

    y: str
    numeric: Sequence[str]
    factors: Mapping[str, Sequence[str]]
    means: np.ndarray
    y_mean: float
    gram: np.ndarray
    xy: np.ndarray
    yy: float
    n: int
    centred: np.ndarray = field(init=False)
    centred_inverse: np.ndarray = field(init=False)
    beta: np.ndarray = field(init=False)
    inverse: np.ndarray = field(init=False)

    def __post_init__(self):
        scale = np.sqrt(np.maximum(np.diag(self.gram), np.finfo(float).tiny))
        scaled = np.linalg.cholesky(self.gram / np.outer(scale, scale))
        half = np.linalg.inv(scaled) / scale
        self.centred_inverse = half.T @ half
        self.centred = self.centred_inverse @ self.xy
        # one step of refinement takes off what the inverse leaves
        self.centred = self.centred + self.centred_inverse @ (self.xy - self.gram @ self.centred)
        back = np.eye(len(self.xy))
        back[0, 1: 1 + len(self.numeric)] = -self.means
        self.beta = back @ self.centred
        self.beta[0] += self.y_mean
        self.inverse = back @ self.centred_inverse @ back.T

    @property
    def terms(self) -> list[str]:
        return ["(Intercept)", *self.numeric, *[f"{f}{lv}" for f, ls in self.factors.items() for lv in ls[1:]]]

    @property
    def p(self) -> int:
        return len(self.beta)

    @property
    def rss(self) -> float:
        return float(self.yy - self.centred @ self.xy)

    @property
    def tss(self) -> float:
        return float(self.yy - self.xy[0] ** 2 / self.n)

    @property
    def sigma(self) -> float:
        return math.sqrt(self.rss / (self.n - self.p))

    @property
    def starts(self) -> dict[str, int]:
        """Place of the second level of each factor among the terms."""
        at, out = 1 + len(self.numeric), {}
        for f, levels in self.factors.items():
            out[f] = at
            at += len(levels) - 1
        return out


def factor_levels(df: DataFrame, factor: str, reference: str | None = None) -> list[str]:
    """Sorted levels of a categorical column, the reference moved to the front."""
    found = [r[0] for r in df.select(factor).distinct().orderBy(factor).limit(MAX_TERMS + 1).collect()]
    if len(found) > MAX_TERMS:
        raise ValueError(f"{factor} has too many levels for a factor")
    found = [x for x in found if x is not None]
    if reference is not None:
        found = [reference, *[x for x in found if x != reference]]
    return found


def fit_ols(
    df: DataFrame, y: str, numeric: Sequence[str], factors: Mapping[str, Sequence[str]] | None = None
) -> Fit:
    """Normal equations from grouped aggregates over deviations from the means.

    Besides the totals they need one table per factor and one count per pair of factors; the combinations of all
    factors are never formed. Shuffle and driver carry these tables, whatever the number of rows.
    """
    factors, numeric = dict(factors or {}), list(numeric)
    k = len(numeric)
    size = 1 + k + sum(len(v) - 1 for v in factors.values())
    if size > MAX_TERMS:
        raise ValueError("too many terms for one linear model")
    vs = [*numeric, y]
    rows = hold(df.select(*factors, *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(vs)]).dropna())
    for f, levels in factors.items():
        rows = rows.filter(F.col(f).isin(list(levels)))
    mean = rows.agg(F.count("*").alias("n"), *[F.avg(f"_v{i}").alias(f"m{i}") for i in range(k + 1)]).first()
    n, means = mean["n"], [float(mean[f"m{i}"] or 0.0) for i in range(k + 1)]
    rows = rows.select(*factors, *[(F.col(f"_v{i}") - F.lit(means[i])).alias(f"_v{i}") for i in range(k + 1)])
    sums = [F.sum(f"_v{i}").alias(f"s{i}") for i in range(k + 1)]
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    total = rows.agg(*sums, *[F.sum(F.col(f"_v{i}") * F.col(f"_v{j}")).alias(f"p{i}_{j}") for i, j in pairs]).first()

    gram, xy = np.zeros((size, size)), np.zeros(size)
    gram[0, 0], xy[0] = n, total[f"s{k}"] or 0.0
    for i in range(k):
        gram[0, 1 + i] = gram[1 + i, 0] = total[f"s{i}"] or 0.0
        xy[1 + i] = total[f"p{i}_{k}"] or 0.0
        for j in range(i, k):
            gram[1 + i, 1 + j] = gram[1 + j, 1 + i] = total[f"p{i}_{j}"] or 0.0
    place, at = {}, 1 + k
    for f, levels in factors.items():
        place[f] = {lv: at + i for i, lv in enumerate(levels[1:])}
        at += len(levels) - 1
        for r in rows.groupBy(f).agg(F.count("*").alias("n"), *sums).collect():
            if (row := place[f].get(r[f])) is not None:
                gram[row, row] = gram[0, row] = gram[row, 0] = r["n"]
                gram[1: k + 1, row] = gram[row, 1: k + 1] = [r[f"s{i}"] for i in range(k)]
                xy[row] = r[f"s{k}"]
    for f, g in combinations(factors, 2):
        for r in rows.groupBy(f, g).agg(F.count("*").alias("n")).collect():
            a, b = place[f].get(r[f]), place[g].get(r[g])
            if a is not None and b is not None:
                gram[a, b] = gram[b, a] = r["n"]
    return Fit(y, numeric, factors, np.asarray(means[:k]), means[k], gram, xy, float(total[f"p{k}_{k}"] or 0.0), n)


def coefficient_table(spark: SparkSession, fit: Fit, level: float = 0.95) -> DataFrame:
    """Estimate, SE, t, p, interval and significance per term."""
    df = fit.n - fit.p
    se = fit.sigma * np.sqrt(np.diag(fit.inverse))
    q = tails.t_quantile(spark, 0.5 + level / 2, df)
    rows = []
    for term, b, s in zip(fit.terms, fit.beta, se):
        p = tails.t_tail(spark, b / s, df)
        rows.append((term, float(b), float(s), float(b / s), float(p), float(b - q * s),
                     float(b + q * s), "p < 0.05" if p < 0.05 else "p >= 0.05"))
    return spark.createDataFrame(
        rows, "term string, estimate double, std_error double, t double, p_value double, "
        "conf_low double, conf_high double, significant string",
    )


def fit_metrics(spark: SparkSession, fit: Fit) -> DataFrame:
    n, p, rss = fit.n, fit.p, fit.rss
    r2 = 1 - rss / fit.tss
    f = ((fit.tss - rss) / (p - 1)) / (rss / (n - p))
    aic = n * math.log(2 * math.pi) + n * math.log(rss / n) + n + 2 * (p + 1)
    row = (n, r2, 1 - (1 - r2) * (n - 1) / (n - p), f, p - 1, n - p,
           tails.f_tail(spark, f, p - 1, n - p), fit.sigma, aic)
    return spark.createDataFrame(
        [tuple(float(x) if i and i not in (4, 5) else int(x) for i, x in enumerate(row))],
        "n long, r2 double, adj_r2 double, f double, df1 int, df2 long, p_value double, sigma double, aic double",
    )


def inflation_factors(spark: SparkSession, fit: Fit) -> DataFrame:
    """Generalised VIF per term from the correlation matrix of the predictors."""
    mean = fit.gram[0, 1:] / fit.n
    cov = fit.gram[1:, 1:] / fit.n - np.outer(mean, mean)
    sd = np.sqrt(np.diag(cov))
    corr = cov / np.outer(sd, sd)
    blocks, at = [], 0
    for name in fit.numeric:
        blocks.append((name, [at]))
        at += 1
    for name, levels in fit.factors.items():
        blocks.append((name, list(range(at, at + len(levels) - 1))))
        at += len(levels) - 1
    rows = []
    for name, own in blocks:
        rest = [i for i in range(at) if i not in own]
        det = np.linalg.det
        gvif = det(corr[np.ix_(own, own)]) * (det(corr[np.ix_(rest, rest)]) if rest else 1.0) / det(corr)
        rows.append((name, len(own), float(gvif), float(gvif ** (1 / (2 * len(own))))))
    return spark.createDataFrame(rows, "term string, df int, gvif double, gvif_scaled double")


def with_fitted(df: DataFrame, fit: Fit) -> DataFrame:
    """Add ``fitted``, ``residual`` and ``leverage`` to every row; null where a level is not in the fit.

    Both are polynomials of the deviations whose factor parts are joined, one small table per factor and one per pair
    of factors; the rest is evaluated in generated code.
    """
    spark, k, m, b = df.sparkSession, len(fit.numeric), fit.centred_inverse, fit.centred
    z = [F.col(c).cast("double") - F.lit(float(mean)) for c, mean in zip(fit.numeric, fit.means)]
    joined, starts = df, fit.starts
    fitted, h = F.lit(float(fit.y_mean + b[0])), F.lit(float(m[0, 0]))
    for i in range(k):
        fitted = fitted + F.lit(float(b[1 + i])) * z[i]
        h = h + F.lit(float(2 * m[0, 1 + i])) * z[i]
        for j in range(k):
            h = h + F.lit(float(m[1 + i, 1 + j])) * z[i] * z[j]
    for f, levels in fit.factors.items():
        rows = [(levels[0], 0.0, 0.0, [0.0] * k)]
        for at, level in enumerate(levels[1:], starts[f]):
            rows.append((level, float(b[at]), float(2 * m[0, at] + m[at, at]), [float(2 * x) for x in m[at, 1: k + 1]]))
        part = spark.createDataFrame(rows, f"`{f}` string, `_b_{f}` double, `_h_{f}` double, `_l_{f}` array<double>")
        joined = joined.join(part, f, "left")
        fitted, h = fitted + F.col(f"_b_{f}"), h + F.col(f"_h_{f}")
        for i in range(k):
            h = h + F.col(f"_l_{f}")[i] * z[i]
    for f, g in combinations(fit.factors, 2):
        rows = [(lf, lg, float(2 * m[a, c])) for a, lf in enumerate(fit.factors[f][1:], starts[f])
                for c, lg in enumerate(fit.factors[g][1:], starts[g])]
        name = f"_h_{f}_{g}"
        joined = joined.join(spark.createDataFrame(rows, f"`{f}` string, `{g}` string, `{name}` double"), [f, g], "left")
        h = h + F.coalesce(F.col(name), F.lit(0.0))
    return joined.select(
        *df.columns, fitted.alias("fitted"), (F.col(fit.y) - fitted).alias("residual"), h.alias("leverage")
    )


def breusch_pagan(df: DataFrame, fit: Fit) -> DataFrame:
    """Studentised test: n R^2 of the squared residuals on the same predictors."""
    spark = df.sparkSession
    squared = with_fitted(df, fit).withColumn("_e2", F.col("residual") * F.col("residual"))
    aux = fit_ols(squared, "_e2", fit.numeric, fit.factors)
    lm = aux.n * (1 - aux.rss / aux.tss)
    p = tails.chi2_tail(spark, lm, fit.p - 1)
    verdict = "heteroscedastic" if p < 0.05 else "no evidence against constant variance"
    return spark.createDataFrame(
        [(float(lm), fit.p - 1, float(p), verdict)], "lm double, df int, p_value double, verdict string"
    )


def anderson_darling(df: DataFrame, column: str) -> DataFrame:
    """Normality test with estimated mean and sd (Stephens 1986 correction and p-values).

    Equal values share a row, ranks come from distributed running totals.
    """
    spark = df.sparkSession
    v = F.col(column).cast("double")
    stats = df.agg(F.avg(v).alias("m"), F.stddev(v).alias("s")).first()
    z = ((v - F.lit(stats["m"])) / F.lit(stats["s"])).alias("z")
    per = df.filter(F.col(column).isNotNull()).select(z).groupBy("z").agg(F.count("*").alias("n"))
    ranked = running_totals(per, ["z"], ["n"])

    hi = F.col("cum_n").cast("double")
    odd = hi * hi - (hi - F.col("n")) * (hi - F.col("n"))
    up = 2.0 * F.col("tot_n") * F.col("n") - odd
    term = (odd * log_normal_cdf(F.col("z")) + up * log_normal_cdf(-F.col("z"))) / F.col("tot_n")
    got = ranked.agg(F.sum("n").alias("n"), F.sum(term).alias("t")).first()
    n, a = got["n"], -got["n"] - got["t"]
    aa = (1 + 0.75 / n + 2.25 / n**2) * a
    # fixed values: Stephens' piecewise approximation
    if aa < 0.2:
        p = 1 - math.exp(-13.436 + 101.14 * aa - 223.73 * aa**2)
    elif aa < 0.34:
        p = 1 - math.exp(-8.318 + 42.796 * aa - 59.938 * aa**2)
    elif aa < 0.6:
        p = math.exp(0.9177 - 4.279 * aa - 1.38 * aa**2)
    elif aa < 10:
        p = math.exp(1.2937 - 5.709 * aa + 0.0186 * aa**2)
    else:
        p = 3.7e-24
    verdict = "not normal" if p < 0.05 else "no evidence against normality"
    return spark.createDataFrame(
        [(n, float(a), float(p), verdict)], "n long, a double, p_value double, verdict string"
    )


def diagnostics(df: DataFrame, fit: Fit) -> DataFrame:
    """Fitted value, residual, standardised residual, its root, leverage and Cook's distance."""
    rows = with_fitted(df, fit)
    std = F.col("residual") / (fit.sigma * F.sqrt(1 - F.col("leverage")))
    cook = std * std * F.col("leverage") / (fit.p * (1 - F.col("leverage")))
    return rows.withColumns({
        "std_residual": std, "root_abs": F.sqrt(F.abs(std)), "cooks_distance": cook,
    })


def normal_qq(rows: DataFrame, column: str, key: str) -> DataFrame:
    """Add the normal quantile that belongs to each row's global rank."""
    ranked = global_rank(rows, column, key)
    a = F.when(F.col("total") > 10, 0.5).otherwise(0.375)
    p = (F.col("rank") - a) / (F.col("total") + 1 - 2 * a)
    return ranked.withColumn("theoretical", normal_quantile(p))


# --- one factor --------------------------------------------------------------------------
def group_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).groupBy(group).agg(
        F.count("*").alias("n"), F.avg(value).alias("mean"), F.variance(value).alias("var")
    )


def with_p(df: DataFrame, tail, *args: str) -> DataFrame:
    """Add ``p_value`` to a one-row table; ``tail`` sees only its finished statistics."""
    df = hold(df)
    row = df.first().asDict()
    p = tail(df.sparkSession, *[float(row[a]) for a in args])
    return df.withColumn("p_value", F.lit(float(p)))


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """SS, df, MS, F and eta squared from the n, mean and variance of each group."""
    stats = group_stats(df, group, value)
    whole = Window.partitionBy()
    grand = F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole)
    sums = stats.withColumn("_g", grand).agg(
        F.sum(F.col("n") * F.pow(F.col("mean") - F.col("_g"), 2)).alias("ss_between"),
        F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("ss_within"),
        (F.count("*") - 1).alias("df_between"),
        (F.sum("n") - F.count("*")).alias("df_within"),
    )
    msb = ratio(F.col("ss_between"), F.col("df_between"))
    msw = ratio(F.col("ss_within"), F.col("df_within"))
    eta = ratio(F.col("ss_between"), F.col("ss_between") + F.col("ss_within"))
    return sums.withColumns({"ms_between": msb, "ms_within": msw}).withColumns({
        "f": ratio(F.col("ms_between"), F.col("ms_within")),
        "eta_sq": eta,
        "effect": threshold_label(eta, [(0.14, "Large"), (0.06, "Medium")], "Small"),
    })


def levene(df: DataFrame, group: str, value: str) -> DataFrame:
    """Median-centred Levene test: analysis of variance of the absolute deviations."""
    med = quantiles(df, [value], [0.5], by=[group], names=["_med"]).select(group, "_med")
    dev = df.join(hold(med), group).select(
        group, F.abs(F.col(value) - F.col("_med")).alias("_dev")
    )
    return anova(dev, group, "_dev").select("df_between", "df_within", "f")


def welch(df: DataFrame, group: str, value: str) -> DataFrame:
    stats = group_stats(df, group, value).withColumn("w", F.col("n") / F.col("var"))
    whole = Window.partitionBy()
    k, sw = F.count("*").over(whole), F.sum("w").over(whole)
    rows = stats.withColumns({"k": k, "sw": sw}).withColumn(
        "m", F.sum(F.col("w") * F.col("mean")).over(whole) / F.col("sw")
    )
    sums = rows.groupBy("k").agg(
        F.sum(F.col("w") * F.pow(F.col("mean") - F.col("m"), 2)).alias("a"),
        F.sum(F.pow(1 - F.col("w") / F.col("sw"), 2) / (F.col("n") - 1)).alias("lam"),
    )
    kk = F.col("k").cast("double")
    f = (F.col("a") / (kk - 1)) / (1 + 2 * (kk - 2) / (kk * kk - 1) * F.col("lam"))
    return sums.select(
        (kk - 1).alias("df1"), ((kk * kk - 1) / (3 * F.col("lam"))).alias("df2"), f.alias("f")
    )


def tukey_pairs(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean difference and studentized range statistic of every pair of groups.

    The pairs are of group summaries (one row per level), never of rows.
    """
    stats = group_stats(df, group, value)
    whole = Window.partitionBy()
    pooled = stats.select(
        group, "n", "mean",
        (F.sum((F.col("n") - 1) * F.col("var")).over(whole)
         / (F.sum("n").over(whole) - F.count("*").over(whole))).alias("mse"),
        (F.sum("n").over(whole) - F.count("*").over(whole)).alias("df"),
        F.count("*").over(whole).alias("k"),
        F.sort_array(F.collect_list(F.struct(F.col(group).alias("g"), F.col("n").alias("m"),
                                             F.col("mean").alias("x"))).over(whole)).alias("others"),
    )
    pairs = pooled.withColumn("o", F.explode("others")).filter(F.col("o.g") > F.col(group))
    se = F.sqrt(F.col("mse") / 2 * (1 / F.col("n") + 1 / F.col("o.m")))
    diff = F.col("o.x") - F.col("mean")
    return pairs.select(
        F.concat_ws("-", F.col("o.g"), F.col(group)).alias("pair"), diff.alias("diff"),
        (F.abs(diff) / se).alias("q"), se.alias("se"), "k", "df",
    )


def tukey_hsd(df: DataFrame, group: str, value: str, level: float = 0.95) -> DataFrame:
    """``tukey_pairs`` with simultaneous intervals and adjusted p-values."""
    pairs = tukey_pairs(df, group, value).collect()
    spark = df.sparkSession
    rows = []
    for r in pairs:
        crit = tails.studentized_range_quantile(level, r["k"], r["df"]) if not rows else crit
        p = tails.studentized_range_tail(r["q"], r["k"], r["df"])
        rows.append((r["pair"], r["diff"], r["diff"] - crit * r["se"], r["diff"] + crit * r["se"],
                     float(p), bool(p < 0.05)))
    return spark.createDataFrame(
        rows, "pair string, diff double, lwr double, upr double, p_adj double, significant boolean"
    )


# --- two factors -------------------------------------------------------------------------
def expected_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Observed, expected and standardised residual of every cell."""
    t = contingency(df, a, b)
    n = F.col("all_n").cast("double")
    e = F.col("row_n") * F.col("col_n") / n
    spread = F.sqrt(e * (1 - F.col("row_n") / n) * (1 - F.col("col_n") / n))
    return t.withColumn("expected", e).withColumn("std_residual", ratio(F.col("n") - e, spread))


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Statistic (continuity-corrected only for 2 x 2), df, Cramer's V and its size."""
    cells = expected_counts(df, a, b)
    shape = cells.agg(F.count_distinct(a).alias("r"), F.count_distinct(b).alias("c")).first()
    r, c = shape["r"], shape["c"]
    gap = F.abs(F.col("n") - F.col("expected"))
    if r == 2 and c == 2:
        least = Window.partitionBy()
        gap = gap - F.least(F.lit(0.5), F.min(gap).over(least))
    cells = cells.withColumn("_gap", gap)
    x2 = F.sum(ratio(F.col("_gap") * F.col("_gap"), F.col("expected")))
    v = F.sqrt(F.col("chi_sq") / (F.col("n") * (min(r, c) - 1)))
    return cells.agg(x2.alias("chi_sq"), F.max("all_n").alias("n")).select(
        "chi_sq", F.lit((r - 1) * (c - 1)).alias("df"), "n", v.alias("cramers_v"),
        threshold_label(v, [(0.25, "Large"), (0.10, "Medium")], "Small/Negligible").alias("effect"),
    )
