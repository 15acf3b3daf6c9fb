"""Regression, analysis of variance and chi-square jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomkit.functions import tails
from fathomkit.functions.scalars import rd
from fathomkit.operators import inference as inf
from fathomkit.plans.inputs import LINES, SHOP, lines, shop
from fathomkit.plans.registry import query, rsql
from fathomkit.session import hold

NUMERIC = ["Discount", "Quantity", "UnitPrice"]


def _regression_rows(spark, sf_dir):
    """Order lines of the two wanted statuses, kept once for the passes that follow."""
    return hold(lines(spark, sf_dir).filter(F.col("OrderStatus").isin("F", "O")))


def _factors(rows):
    return {
        "Category": inf.factor_levels(rows, "Category", "ECONOMY"),
        "Flag": inf.factor_levels(rows, "Flag", "N"),
    }


def _full_fit(rows):
    return inf.fit_ols(rows, "TotalAmount", NUMERIC, _factors(rows))


_SIMPLE = f"""{LINES}, f AS (
SELECT regr_slope("TotalAmount", "Quantity") AS b, regr_intercept("TotalAmount", "Quantity") AS a,
       regr_sxx("TotalAmount", "Quantity") AS sxx, regr_syy("TotalAmount", "Quantity") AS syy,
       regr_r2("TotalAmount", "Quantity") AS r2, avg("Quantity") AS mx, count(*) AS n FROM lines),
s AS (SELECT *, syy * (1 - r2) AS rss, syy * (1 - r2) / (n - 2) AS s2 FROM f)"""


def _simple(spark, sf_dir):
    rows = lines(spark, sf_dir)
    return rows, inf.fit_ols(rows, "TotalAmount", ["Quantity"])


@query("j01_ols_factors")
def j01(spark, sf_dir):
    rows = _regression_rows(spark, sf_dir)
    return inf.coefficient_table(spark, _full_fit(rows))


@query("j01_ols_simple", f"""WITH {_SIMPLE}
SELECT '(Intercept)' AS term, {rsql("a", 4)} AS estimate, {rsql("sqrt(s2 * (1.0 / n + mx * mx / sxx))", 4)} AS std_error,
       {rsql("a / sqrt(s2 * (1.0 / n + mx * mx / sxx))", 4)} AS t FROM s
UNION ALL SELECT 'Quantity', {rsql("b", 4)}, {rsql("sqrt(s2 / sxx)", 4)}, {rsql("b / sqrt(s2 / sxx)", 4)} FROM s""")
def j01_simple(spark, sf_dir):
    _, fit = _simple(spark, sf_dir)
    return inf.coefficient_table(spark, fit).select(
        "term", *[rd(c, 4).alias(c) for c in ("estimate", "std_error", "t")]
    )


@query("j02_fit_metrics")
def j02(spark, sf_dir):
    return inf.fit_metrics(spark, _full_fit(_regression_rows(spark, sf_dir)))


@query("j02_fit_metrics_simple", f"""WITH {_SIMPLE}
SELECT n, {rsql("r2", 6)} AS r2, {rsql("1 - (1 - r2) * (n - 1) / (n - 2)", 6)} AS adj_r2,
       {rsql("syy * r2 / s2", 3)} AS f, {rsql("sqrt(s2)", 4)} AS sigma,
       {rsql("n * ln(2 * pi()) + n * ln(rss / n) + n + 6", 3)} AS aic FROM s""")
def j02_simple(spark, sf_dir):
    _, fit = _simple(spark, sf_dir)
    return inf.fit_metrics(spark, fit).select(
        "n", rd("r2", 6).alias("r2"), rd("adj_r2", 6).alias("adj_r2"), rd("f", 3).alias("f"),
        rd("sigma", 4).alias("sigma"), rd("aic", 3).alias("aic"),
    )


@query("j03_inflation_factors")
def j03(spark, sf_dir):
    return inf.inflation_factors(spark, _full_fit(_regression_rows(spark, sf_dir)))


@query("j03_inflation_factors_pair", f"""WITH {LINES}, r AS (
SELECT 1 / (1 - pow(corr("Quantity", "UnitPrice"), 2)) AS v FROM lines)
SELECT 'Quantity' AS term, {rsql("v", 6)} AS gvif FROM r UNION ALL SELECT 'UnitPrice', {rsql("v", 6)} FROM r""")
def j03_pair(spark, sf_dir):
    fit = inf.fit_ols(lines(spark, sf_dir), "TotalAmount", ["Quantity", "UnitPrice"])
    return inf.inflation_factors(spark, fit).select("term", rd("gvif", 6).alias("gvif"))


@query("j04_breusch_pagan")
def j04(spark, sf_dir):
    rows = _regression_rows(spark, sf_dir)
    return inf.breusch_pagan(rows, _full_fit(rows))


@query("j04_breusch_pagan_simple", f"""WITH {_SIMPLE}, e AS (
SELECT pow("TotalAmount" - a - b * "Quantity", 2) / 1e9 AS e2, "Quantity" AS x FROM lines, s)
SELECT {rsql("count(*) * regr_r2(e2, x)", 4)} AS lm, 1 AS df FROM e""")
def j04_simple(spark, sf_dir):
    rows, fit = _simple(spark, sf_dir)
    return inf.breusch_pagan(rows, fit).select(rd("lm", 4).alias("lm"), "df")


@query("j05_anderson_darling")
def j05(spark, sf_dir):
    rows = _regression_rows(spark, sf_dir)
    return inf.anderson_darling(inf.with_fitted(rows, _full_fit(rows)), "residual")


# Fixed value: the terms of the series of the normal distribution function, enough for the residuals of a bounded amount.
_TERMS = 120
_NORMAL = f"""{_SIMPLE}, e AS (SELECT "TotalAmount" - a - b * "Quantity" AS e FROM lines, s),
z AS (SELECT (e - avg(e) OVER ()) / stddev(e) OVER () AS z FROM e),
k AS (SELECT z, row_number() OVER (ORDER BY z) AS i, count(*) OVER () AS n,
  0.5 + exp(-z * z / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, {_TERMS}), lambda j: z
    * exp(j * ln(greatest(z * z, 1e-300)) - (lgamma(2 * j + 2) - lgamma(j + 1) - j * ln(2))))) AS p FROM z),
a AS (SELECT max(n) AS n, -max(n) - sum((2 * i - 1) * ln(p) + (2 * n + 1 - 2 * i) * ln(1 - p)) / max(n) AS a2 FROM k)"""


@query("j05_anderson_darling_simple", f"""WITH {_NORMAL}
SELECT n, {rsql("a2 / 100", 5)} AS a_hundredths FROM a""")
def j05_simple(spark, sf_dir):
    """The statistic for the residuals of one predictor."""
    rows, fit = _simple(spark, sf_dir)
    return inf.anderson_darling(inf.with_fitted(rows, fit), "residual").select(
        "n", rd(F.col("a") / 100, 5).alias("a_hundredths"))


@query("j06_diagnostics")
def j06(spark, sf_dir):
    rows = _regression_rows(spark, sf_dir)
    keyed = rows.withColumn(
        "line_id", F.xxhash64("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    )
    checked = inf.diagnostics(keyed, _full_fit(rows)).select(
        "line_id", "fitted", "residual", "std_residual", "root_abs", "leverage", "cooks_distance"
    )
    return inf.normal_qq(checked, "std_residual", "line_id")  # the ranking holds its rows itself


@query("j06_diagnostics_simple", f"""WITH {_SIMPLE}, d AS (
SELECT l_orderkey, a + b * "Quantity" AS fitted, "TotalAmount" - a - b * "Quantity" AS e,
       1.0 / n + pow("Quantity" - mx, 2) / sxx AS h, sqrt(s2) AS sg FROM lines, s)
SELECT l_orderkey, {rsql("fitted", 4)} AS fitted, {rsql("e / (sg * sqrt(1 - h))", 6)} AS std_residual,
       {rsql("h * 1e4", 6)} AS leverage_e4, {rsql("1e4 * pow(e / (sg * sqrt(1 - h)), 2) * h / (2 * (1 - h))", 5)} AS cook_e4
FROM d""")
def j06_simple(spark, sf_dir):
    rows, fit = _simple(spark, sf_dir)
    return inf.diagnostics(rows, fit).select(
        "l_orderkey", rd("fitted", 4).alias("fitted"), rd("std_residual", 6).alias("std_residual"),
        rd(F.col("leverage") * 1e4, 6).alias("leverage_e4"),
        rd(F.col("cooks_distance") * 1e4, 5).alias("cook_e4"),
    )


def _delivered(spark, sf_dir):
    return shop(spark, sf_dir).filter(F.col("OrderStatus") == "F")


_STATS = f"""{SHOP}, y AS (SELECT "Category" AS g, "TotalAmount" AS v FROM shop WHERE "OrderStatus" = 'F'),
gs AS (SELECT g, count(*) AS n, avg(v) AS m, variance(v) AS s2 FROM y GROUP BY 1),
ss AS (SELECT sum(n * pow(m - (SELECT avg(v) FROM y), 2)) AS ssb, sum((n - 1) * s2) AS ssw,
       count(*) - 1 AS dfb, CAST(sum(n) - count(*) AS BIGINT) AS dfw FROM gs)"""


def _verdict(table, found):
    return table.withColumn("verdict", F.when(F.col("p_value") < 0.05, found).otherwise("no evidence of a difference"))


@query("j07_levene", f"""WITH {SHOP}, y0 AS (
SELECT "Category" AS g, "TotalAmount" AS v FROM shop WHERE "OrderStatus" = 'F'),
y AS (SELECT y0.g, abs(v - md) AS v FROM y0 JOIN (SELECT g, median(v) AS md FROM y0 GROUP BY 1) q ON y0.g = q.g),
gs AS (SELECT g, count(*) AS n, avg(v) AS m, variance(v) AS s2 FROM y GROUP BY 1),
ss AS (SELECT sum(n * pow(m - (SELECT avg(v) FROM y), 2)) AS ssb, sum((n - 1) * s2) AS ssw,
       count(*) - 1 AS dfb, CAST(sum(n) - count(*) AS BIGINT) AS dfw FROM gs)
SELECT dfb AS df_between, dfw AS df_within, {rsql("(ssb / dfb) / (ssw / dfw)", 5)} AS f FROM ss""")
def j07(spark, sf_dir):
    return inf.levene(_delivered(spark, sf_dir), "Category", "TotalAmount").withColumn("f", rd("f", 5))


@query("j07_levene_p")
def j07_p(spark, sf_dir):
    table = inf.levene(_delivered(spark, sf_dir), "Category", "TotalAmount")
    return _verdict(inf.with_p(table, tails.f_tail, "f", "df_between", "df_within"), "variances differ")


@query("j08_anova", f"""WITH {_STATS}
SELECT dfb AS df_between, dfw AS df_within, {rsql("ssb / 1e6", 3)} AS ss_between_m, {rsql("ssw / 1e9", 3)} AS ss_within_g,
       {rsql("(ssb / dfb) / (ssw / dfw)", 5)} AS f FROM ss""")
def j08(spark, sf_dir):
    return inf.anova(_delivered(spark, sf_dir), "Category", "TotalAmount").select(
        "df_between", "df_within", rd(F.col("ss_between") / 1e6, 3).alias("ss_between_m"),
        rd(F.col("ss_within") / 1e9, 3).alias("ss_within_g"), rd("f", 5).alias("f"),
    )


@query("j08_anova_p")
def j08_p(spark, sf_dir):
    table = inf.anova(_delivered(spark, sf_dir), "Category", "TotalAmount")
    return inf.with_p(table, tails.f_tail, "f", "df_between", "df_within")


@query("j09_eta_squared", f"""WITH {_STATS}
SELECT {rsql("ssb / (ssb + ssw)", 7)} AS eta_sq, CASE WHEN ssb / (ssb + ssw) >= 0.14 THEN 'Large'
       WHEN ssb / (ssb + ssw) >= 0.06 THEN 'Medium' ELSE 'Small' END AS effect FROM ss""")
def j09(spark, sf_dir):
    return inf.anova(_delivered(spark, sf_dir), "Category", "TotalAmount").select(
        rd("eta_sq", 7).alias("eta_sq"), "effect"
    )


@query("j10_welch", f"""WITH {_STATS}, w AS (SELECT *, n / s2 AS w, count(*) OVER () AS k FROM gs),
t AS (SELECT *, sum(w) OVER () AS sw, sum(w * m) OVER () / sum(w) OVER () AS mm FROM w),
a AS (SELECT max(k) AS k, sum(w * pow(m - mm, 2)) AS a, sum(pow(1 - w / sw, 2) / (n - 1)) AS lam FROM t)
SELECT CAST(k - 1 AS DOUBLE) AS df1, {rsql("(k * k - 1) / (3 * lam)", 4)} AS df2,
       {rsql("(a / (k - 1)) / (1 + 2.0 * (k - 2) / (k * k - 1) * lam)", 5)} AS f FROM a""")
def j10(spark, sf_dir):
    return inf.welch(_delivered(spark, sf_dir), "Category", "TotalAmount").select(
        "df1", rd("df2", 4).alias("df2"), rd("f", 5).alias("f")
    )


@query("j10_welch_p")
def j10_p(spark, sf_dir):
    table = inf.welch(_delivered(spark, sf_dir), "Category", "TotalAmount")
    return _verdict(inf.with_p(table, tails.f_tail, "f", "df1", "df2"), "means differ")


@query("j11_tukey_pairs", f"""WITH {_STATS}, e AS (SELECT ssw / dfw AS mse FROM ss)
SELECT b.g || '-' || a.g AS pair, {rsql("b.m - a.m", 3)} AS diff,
       {rsql("abs(b.m - a.m) / sqrt(mse / 2 * (1.0 / a.n + 1.0 / b.n))", 5)} AS q
FROM gs a JOIN gs b ON a.g < b.g, e""")
def j11(spark, sf_dir):
    return inf.tukey_pairs(_delivered(spark, sf_dir), "Category", "TotalAmount").select(
        "pair", rd("diff", 3).alias("diff"), rd("q", 5).alias("q")
    )


@query("j11_tukey_hsd")
def j11_hsd(spark, sf_dir):
    return inf.tukey_hsd(_delivered(spark, sf_dir), "Category", "TotalAmount")


_CHI = f"""{SHOP}, g AS (SELECT a."Category", b."OrderStatus" FROM (SELECT DISTINCT "Category" FROM shop) a,
       (SELECT DISTINCT "OrderStatus" FROM shop) b),
o AS (SELECT g.*, count(s."Category") AS n FROM g LEFT JOIN shop s
      ON g."Category" = s."Category" AND g."OrderStatus" = s."OrderStatus" GROUP BY ALL),
x AS (SELECT *, sum(n) OVER (PARTITION BY "Category") AS r, sum(n) OVER (PARTITION BY "OrderStatus") AS c,
      sum(n) OVER () AS t FROM o),
e AS (SELECT *, CAST(r AS DOUBLE) * c / t AS e FROM x),
q AS (SELECT sum(pow(n - e, 2) / e) AS chi, max(t) AS t, count(DISTINCT "Category") AS nr,
      count(DISTINCT "OrderStatus") AS nc FROM e)"""


@query("j12_chi_square", f"""WITH {_CHI}
SELECT {rsql("chi", 5)} AS chi_sq, CAST((nr - 1) * (nc - 1) AS INTEGER) AS df, CAST(t AS BIGINT) AS n FROM q""")
def j12(spark, sf_dir):
    return inf.chi_square(shop(spark, sf_dir), "Category", "OrderStatus").select(
        rd("chi_sq", 5).alias("chi_sq"), "df", "n"
    )


@query("j12_chi_square_p")
def j12_p(spark, sf_dir):
    table = inf.chi_square(shop(spark, sf_dir), "Category", "OrderStatus")
    return inf.with_p(table, tails.chi2_tail, "chi_sq", "df")


@query("j13_cramers_v", f"""WITH {_CHI}, v AS (SELECT sqrt(chi / (t * (least(nr, nc) - 1))) AS v FROM q)
SELECT {rsql("v", 6)} AS cramers_v, CASE WHEN v >= 0.25 THEN 'Large' WHEN v >= 0.10 THEN 'Medium'
       ELSE 'Small/Negligible' END AS effect FROM v""")
def j13(spark, sf_dir):
    return inf.chi_square(shop(spark, sf_dir), "Category", "OrderStatus").select(
        rd("cramers_v", 6).alias("cramers_v"), "effect"
    )


@query("j14_std_residuals", f"""WITH {_CHI}
SELECT "Category", "OrderStatus", n, {rsql("e", 1)} AS expected,
       {rsql("(n - e) / sqrt(e * (1 - CAST(r AS DOUBLE) / t) * (1 - CAST(c AS DOUBLE) / t))", 3)} AS std_residual FROM e""")
def j14(spark, sf_dir):
    return inf.expected_counts(shop(spark, sf_dir), "Category", "OrderStatus").select(
        "Category", "OrderStatus", "n", rd("expected", 1).alias("expected"),
        rd("std_residual", 3).alias("std_residual"),
    )
