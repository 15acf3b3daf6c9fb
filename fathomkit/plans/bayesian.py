"""Bayesian jobs over stop records and draw tables."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomkit.functions import scalars as sc
from fathomkit.functions.scalars import rd
from fathomkit.operators import bayes as b
from fathomkit.operators.clean import attach_stats, clean_sentinels, dummies
from fathomkit.operators.describe import box_stats
from fathomkit.operators.ordered import dense_index
from fathomkit.plans.inputs import STOPS, stops, table
from fathomkit.plans.registry import query, rsql
from fathomkit.session import hold

# Dummy name -> (column, level); the first level of each term is left out.
TERMS = {
    "race_WH": ("race_grp", "White Hispanic"), "race_BH": ("race_grp", "Black Hispanic"),
    "race_W": ("race_grp", "White"), "race_O": ("race_grp", "Other"),
    "crime_PT": ("crime_grp", "Property/Theft"), "crime_V": ("crime_grp", "Violence"),
    "crime_T": ("crime_grp", "Trespass"), "crime_O": ("crime_grp", "Other"),
    "boro_Bk": ("borough", "Brooklyn"), "boro_Ma": ("borough", "Manhattan"),
    "boro_Qu": ("borough", "Queens"), "boro_SI": ("borough", "Staten Island"),
    "seas_Win": ("season", "Winter"), "seas_Spr": ("season", "Spring"), "seas_Sum": ("season", "Summer"),
}
# Flags of a stop and the names of their columns.
FLAGS = {
    "frisked_flag": "frisked_bin", "searched_flag": "searched_bin", "weapon_flag": "weapon_found_bin",
    "firearm_flag": "firearm_bin", "violent_flag": "violent_bg_bin", "known_flag": "known_weapon_bin",
}
COVARIATES = ["age_z", "male_bin", *FLAGS.values(), "self_init", *TERMS]
PRIORS = [("Narrow: N(0,1)", 1.0), ("Chosen: N(0,2.5^2)", 0.16), ("Wide: N(0,5^2)", 0.04)]
TAU = 0.16


def clean_stops(spark, sf_dir):
    """Text records to model columns, rows that miss a needed field dropped."""
    raw = clean_sentinels(stops(spark, sf_dir))
    coded = raw.select(
        "stop_id", sc.yes_flag("arrested_flag").alias("y"),
        *[sc.yes_flag(flag).alias(name) for flag, name in FLAGS.items()],
        sc.yes_flag("sex_text", "MALE").alias("male_bin"),
        sc.contains_flag("initiated_text", "Self").alias("self_init"),
        sc.to_number("age_text").alias("age_num"),
        F.when(F.col("race_text").isNotNull(), sc.recode("race_text", sc.RACE_GROUPS)).alias("race_grp"),
        F.when(F.col("crime_text").isNotNull(), sc.bucket_recode("crime_text", sc.CRIME_GROUPS)).alias("crime_grp"),
        sc.month_number("month_text").alias("month_num"),
        F.initcap("boro_text").alias("borough"),
        F.col("precinct_text").try_cast("int").alias("precinct"),
    ).dropna().filter(F.col("age_num").between(10, 80))
    rows = hold(coded.withColumn("season", sc.season("month_num")))
    indexed = dense_index(rows, "precinct", "precinct_idx")
    scaled = attach_stats(indexed, {"_m": F.avg("age_num"), "_s": F.stddev("age_num")}, of=rows)
    return scaled.withColumn(
        "age_z", ((F.col("age_num") - F.col("_m")) / F.col("_s")).cast("float")
    ).drop("_m", "_s")


def model_rows(spark, sf_dir):
    return dummies(clean_stops(spark, sf_dir), TERMS)


def _patterns(spark, sf_dir):
    return b.covariate_patterns(model_rows(spark, sf_dir), "y", COVARIATES, "precinct_idx")


CLEAN = f"""{STOPS}, n AS (
SELECT stop_id, CASE WHEN arrested_flag = 'Y' THEN 1 ELSE 0 END AS y,
  CASE WHEN contains(coalesce(initiated_text, ''), 'Self') THEN 1 ELSE 0 END AS self_init,
  TRY_CAST(age_text AS DOUBLE) AS age_num,
  CASE WHEN crime_text = '#N/A' THEN NULL WHEN crime_text IN ('CPW') THEN 'Weapon'
       WHEN crime_text IN ('ROBBERY', 'PETIT LARCENY') THEN 'Property/Theft' WHEN crime_text = 'ASSAULT' THEN 'Violence'
       WHEN crime_text = 'CRIMINAL TRESPASS' THEN 'Trespass' ELSE 'Other' END AS crime_grp,
  nullif(month_text, '(null)') AS m, TRY_CAST(nullif(precinct_text, '') AS INTEGER) AS precinct FROM stops),
k AS (SELECT * FROM n WHERE age_num BETWEEN 10 AND 80 AND crime_grp IS NOT NULL AND m IS NOT NULL AND precinct IS NOT NULL)"""


@query("l00_clean_stops", f"""WITH {CLEAN}
SELECT stop_id, y, self_init, crime_grp, CASE WHEN m IN ('December', 'January', 'February') THEN 'Winter'
  WHEN m IN ('March', 'April', 'May') THEN 'Spring' WHEN m IN ('June', 'July', 'August') THEN 'Summer' ELSE 'Autumn' END AS season,
  dense_rank() OVER (ORDER BY precinct) AS precinct_idx,
  {rsql("(age_num - avg(age_num) OVER ()) / stddev(age_num) OVER ()", 4)} AS age_z FROM k""")
def l00(spark, sf_dir):
    return clean_stops(spark, sf_dir).select(
        "stop_id", "y", "self_init", "crime_grp", "season", "precinct_idx",
        rd(F.col("age_z").cast("double"), 4).alias("age_z"),
    )


@query("l01_map_logistic")
def l01(spark, sf_dir):
    return b.coefficient_summary(spark, b.fit_map(_patterns(spark, sf_dir), COVARIATES))


@query("l02_map_group_intercepts")
def l02(spark, sf_dir):
    return b.coefficient_summary(spark, b.fit_map(_patterns(spark, sf_dir), COVARIATES, kinds=1))


@query("l03_map_group_slopes")
def l03(spark, sf_dir):
    fit = b.fit_map(_patterns(spark, sf_dir), COVARIATES, kinds=2, slope="weapon_found_bin")
    return b.coefficient_summary(spark, fit)


def _stationary(rows, fit):
    """Whether the gradient of the posterior, summed over the single rows, is zero at the fit, for coefficients and groups."""
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in COVARIATES]]
    eta = F.lit(0.0)
    for value, c in zip(fit.theta, x):
        eta += F.lit(float(value)) * c
    at = [x[0]] if fit.kinds else []
    if fit.kinds:
        rows = rows.withColumn("_group", F.col("precinct_idx").cast("long")).join(fit.effects.select("_group", "e"), "_group")
        if fit.kinds == 2:
            at.append(x[1 + COVARIATES.index(fit.slope)])
        for i, c in enumerate(at):
            eta += F.col("e")[i] * c
    gap = F.col("y") - sc.expit(eta)
    slopes = rows.agg(*[F.sum(gap * c).alias(f"g{i}") for i, c in enumerate(x)]).select(F.greatest(
        *[F.abs(F.col(f"g{i}") - TAU * float(t)) for i, t in enumerate(fit.theta)], F.lit(0.0)).alias("worst"))
    if fit.kinds:
        precision = np.linalg.inv(fit.sigma)
        pulls = [sum(F.col("e")[j] * float(precision[i, j]) for j in range(fit.kinds)) for i in range(fit.kinds)]
        per = rows.groupBy("_group", "e").agg(*[F.sum(gap * c).alias(f"g{i}") for i, c in enumerate(at)])
        slopes = slopes.union(per.select(F.greatest(
            *[F.abs(F.col(f"g{i}") - pull) for i, pull in enumerate(pulls)], F.lit(0.0))))
    return slopes.agg((F.max("worst") < 1e-3).alias("stationary"))


@query("l03_fit_invariants", f"""WITH {CLEAN}
SELECT m.model, (SELECT count(*) FROM k) AS rows, (SELECT count(DISTINCT precinct) FROM k) * m.kinds + {1 + len(COVARIATES)} AS parameters,
       TRUE AS stationary FROM (VALUES ('M1', 0), ('M2', 1), ('M3', 2)) m(model, kinds)""")
def l03_invariants(spark, sf_dir):
    """The three models: rows, parameters, and that each fit is a mode, checked over the single rows."""
    rows = hold(model_rows(spark, sf_dir))
    patterns = b.covariate_patterns(rows, "y", COVARIATES, "precinct_idx")
    out = []
    for kinds, name in enumerate(("M1", "M2", "M3")):
        fit = b.fit_map(patterns, COVARIATES, TAU, kinds, "weapon_found_bin" if kinds == 2 else None)
        spread = {0: 0, 1: 1, 2: 3}[kinds]
        told = b.coefficient_summary(spark, fit).agg((F.count("*") - spread).alias("parameters"))
        out.append(_stationary(rows, fit).select(
            F.lit(name).alias("model"), rows.agg(F.count("*")).scalar().alias("rows"),
            told.scalar().alias("parameters"), "stationary"))
    return reduce(DataFrame.unionByName, out)


def _draws(spark, sf_dir, kinds=1):
    return b.laplace_draws(spark, b.fit_map(_patterns(spark, sf_dir), COVARIATES, kinds=kinds))


@query("l04_laplace_draws")
def l04(spark, sf_dir):
    return b.long_draws(_draws(spark, sf_dir))


@query("l04_draw_invariants", f"""WITH {CLEAN}, j AS (SELECT count(DISTINCT precinct) AS j FROM k)
SELECT CAST({1 + len(COVARIATES)} + j AS BIGINT) AS params, (6000 * ({1 + len(COVARIATES)} + j))::BIGINT AS draws, TRUE AS centred,
       TRUE AS mixed, TRUE AS effective FROM j""")
def l04_invariants(spark, sf_dir):
    """Three chains of 2,000 draws of every parameter, centred on the fit, with the spread of the fit, and independent."""
    fit = b.fit_map(_patterns(spark, sf_dir), COVARIATES, kinds=1)
    long = hold(b.long_draws(b.laplace_draws(spark, fit)))
    told = b.coefficient_summary(spark, fit).filter("sd IS NOT NULL").select("param", F.col("mean").alias("mode"), "sd")
    per = long.groupBy("param").agg(F.count("*").alias("n"), F.avg("value").alias("m"), F.stddev("value").alias("s"))
    both = per.join(told, "param").join(b.rhat(long, 1.05), "param").join(b.effective_size(long, limit=1000), "param")
    return both.agg(
        F.count("*").alias("params"), F.sum("n").alias("draws"),
        F.bool_and((F.abs(F.col("m") - F.col("mode")) < 0.08 * F.col("sd")) & (F.col("s") / F.col("sd")).between(0.9, 1.1)).alias("centred"),
        F.bool_and(F.col("rhat") < 1.05).alias("mixed"), F.bool_and(F.col("ess") > 1000).alias("effective"))


# Draws made from the lines: one parameter per discount level, three chains.
DRAWS = """
draws AS (SELECT 'beta[' || CAST(round(l_discount * 100) AS INTEGER) || ']' AS param, l_suppkey % 3 AS chain,
  (l_extendedprice - 53000) / 30000 + (l_discount - 0.05) * 60 AS value FROM lineitem)"""


def draws_of_lines(spark, sf_dir):
    level = F.round(F.col("l_discount") * 100).cast("int").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("beta["), level, F.lit("]")).alias("param"), (F.col("l_suppkey") % 3).alias("chain"),
        ((F.col("l_extendedprice") - 53000) / 30000 + (F.col("l_discount") - 0.05) * 60).alias("value"),
    )


_SUMMARY = f"""{DRAWS}, summ AS (SELECT param, avg(value) AS mean, stddev_pop(value) AS sd,
  quantile_cont(value, 0.025) AS lo, quantile_cont(value, 0.975) AS hi, avg(CASE WHEN value > 0 THEN 1 ELSE 0 END) AS pp
  FROM draws GROUP BY 1)"""


@query("l05_posterior_summary", f"""WITH {_SUMMARY}
SELECT param, {rsql("mean", 5)} AS mean, {rsql("sd", 5)} AS sd, {rsql("lo", 5)} AS q2_5, {rsql("hi", 5)} AS q97_5,
       {rsql("pp", 5)} AS prob_pos FROM summ""")
def l05(spark, sf_dir):
    return b.posterior_summary(draws_of_lines(spark, sf_dir)).select(
        "param", *[rd(c, 5).alias(c) for c in ("mean", "sd", "q2_5", "q97_5", "prob_pos")]
    )


@query("l05_posterior_summary_fit")
def l05_fit(spark, sf_dir):
    return b.posterior_summary(b.long_draws(_draws(spark, sf_dir)))


@query("l06_rhat", f"""WITH {DRAWS}, c AS (
SELECT param, chain, count(*) AS n, avg(value) AS m, variance(value) AS v FROM draws GROUP BY 1, 2),
p AS (SELECT param, avg(n) AS n, avg(v) AS w, variance(m) AS vm FROM c GROUP BY 1)
SELECT param, {rsql("sqrt(((n - 1) / n * w + vm) / w)", 6)} AS rhat, sqrt(((n - 1) / n * w + vm) / w) > 1.01 AS flagged FROM p""")
def l06(spark, sf_dir):
    return b.rhat(draws_of_lines(spark, sf_dir)).withColumn("rhat", rd("rhat", 6))


@query("l07_effective_size")
def l07(spark, sf_dir):
    return b.effective_size(b.long_draws(_draws(spark, sf_dir)))


@query("l08_odds_ratios", f"""WITH {_SUMMARY}
SELECT param, {rsql("exp(mean)", 4)} AS or_mean, {rsql("exp(lo)", 4)} AS or_lo, {rsql("exp(hi)", 4)} AS or_hi,
       NOT (lo < 0 AND hi > 0) AS clear FROM summ""")
def l08(spark, sf_dir):
    return b.odds_ratios(b.posterior_summary(draws_of_lines(spark, sf_dir))).select(
        "param", *[rd(c, 4).alias(c) for c in ("or_mean", "or_lo", "or_hi")], "clear"
    )


# One draw per nation against every order; group effects sit in the columns after the slope.
GIVEN = """
theta AS (SELECT n_nationkey AS draw, (n_regionkey - 2) * 0.1 AS a, (n_nationkey - 12) / 50.0 AS b FROM nation),
obs AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, o_totalprice / 250000.0 - 1 AS x,
        c_nationkey % 5 AS grp FROM orders JOIN customer ON o_custkey = c_custkey),
ll1 AS (SELECT draw, o_orderkey, y * (a + b * x) - (greatest(a + b * x, 0) + ln(1 + exp(-abs(a + b * x)))) AS ll,
        1 / (1 + exp(-(a + b * x))) AS p FROM obs, theta),
ll2 AS (SELECT draw, o_orderkey, y * (a + b * x + (grp - 2) * 0.2) - (greatest(a + b * x + (grp - 2) * 0.2, 0)
        + ln(1 + exp(-abs(a + b * x + (grp - 2) * 0.2)))) AS ll FROM obs, theta)"""


def _given(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    obs = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        (F.col("o_totalprice") / 250000.0 - 1).alias("x"), (F.col("c_nationkey") % 5).alias("grp"),
    )
    nations = table(spark, sf_dir, "nation").withColumn("draw", F.col("n_nationkey").cast("long"))
    draws = nations.select("draw", F.array(
        (F.col("n_regionkey") - 2) * 0.1, (F.col("n_nationkey") - 12) / 50.0).alias("theta"))
    groups = obs.select(F.col("grp").cast("long").alias("group")).distinct()
    effects = nations.select("draw", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))).alias("group")).join(
        groups, "group").select("draw", "group", F.array((F.col("group") - 2) * 0.2).alias("e"))
    return obs, b.packed_draws(draws, ["a", "b"]), b.packed_draws(draws, ["a", "b"], effects, 1)


@query("c07_attach_group_effect", f"""WITH {GIVEN}
SELECT o_orderkey, {rsql("0.3 + 0.2 * x + (grp - 2) * 0.2", 6)} AS eta FROM obs""")
def c07(spark, sf_dir):
    obs, _, draws = _given(spark, sf_dir)
    effects = draws.effects.filter("block = 0").select(F.col("group").alias("grp"), F.col("e")[0].alias("u"))
    return obs.join(effects, "grp").select(
        "o_orderkey", rd(0.3 + 0.2 * F.col("x") + F.col("u"), 6).alias("eta")
    )


@query("c08_draws_against_rows", f"""WITH {GIVEN}
SELECT draw, {rsql("avg(p)", 7)} AS mean_p, count(*) AS n FROM ll1 GROUP BY 1""")
def c08(spark, sf_dir):
    obs, plain, _ = _given(spark, sf_dir)
    return b.draw_totals(obs, "y", ["x"], plain).select(
        F.col("draw").cast("int").alias("draw"), rd("mean_p", 7).alias("mean_p"), "n")


@query("l09_dic", f"""WITH {GIVEN}, d AS (SELECT 'M1' AS model, draw, -2 * sum(ll) AS d FROM ll1 GROUP BY 2
UNION ALL SELECT 'M2', draw, -2 * sum(ll) FROM ll2 GROUP BY 2)
SELECT model, {rsql("avg(d)", 3)} AS d_bar, {rsql("var_pop(d) / 2 / 1000", 4)} AS p_d_k FROM d GROUP BY 1""")
def l09(spark, sf_dir):
    obs, plain, grouped = _given(spark, sf_dir)
    one = b.dic(b.draw_totals(obs, "y", ["x"], plain))
    two = b.dic(b.draw_totals(obs, "y", ["x"], grouped, "grp"))
    both = one.select(F.lit("M1").alias("model"), "*").union(two.select(F.lit("M2"), "*"))
    return both.select("model", rd("d_bar", 3).alias("d_bar"), rd(F.col("p_d") / 1000, 4).alias("p_d_k"))


@query("l10_elpd", f"""WITH {GIVEN}, e AS (
SELECT 'M1' AS model, o_orderkey, ln(sum(exp(2 * ll))) - ln(sum(exp(ll))) AS e, ln(25) - ln(sum(exp(-ll))) AS l FROM ll1 GROUP BY 2
UNION ALL SELECT 'M2', o_orderkey, ln(sum(exp(2 * ll))) - ln(sum(exp(ll))), ln(25) - ln(sum(exp(-ll))) FROM ll2 GROUP BY 2),
s AS (SELECT model, sum(e) AS elpd, sqrt(count(*) * variance(e)) AS se, sum(l) AS loo FROM e GROUP BY 1)
SELECT model, {rsql("elpd", 3)} AS elpd, {rsql("se", 4)} AS se, {rsql("loo", 3)} AS elpd_loo,
       {rsql("elpd - max(elpd) OVER ()", 3)} AS delta FROM s""")
def l10(spark, sf_dir):
    obs, plain, grouped = _given(spark, sf_dir)
    out = b.elpd([
        ("M1", b.pointwise(obs, "y", "o_orderkey", ["x"], plain)),
        ("M2", b.pointwise(obs, "y", "o_orderkey", ["x"], grouped, "grp")),
    ])
    return out.select(
        "model", rd("elpd", 3).alias("elpd"), rd("se", 4).alias("se"), rd("elpd_loo", 3).alias("elpd_loo"),
        rd("delta", 3).alias("delta"),
    )


@query("l11_predictive_check")
def l11(spark, sf_dir):
    rows = hold(model_rows(spark, sf_dir))
    patterns = b.covariate_patterns(rows, "y", COVARIATES, "precinct_idx")
    draws = b.laplace_draws(spark, b.fit_map(patterns, COVARIATES, kinds=1), limit=500)
    return b.predictive_check(rows, "y", "stop_id", "borough", COVARIATES, draws, "precinct_idx")


@query("l11_check_invariants", f"""WITH {CLEAN}, o AS (SELECT k.y, t.boro_text FROM k JOIN stops t USING (stop_id)),
l AS (SELECT CASE boro_text {" ".join(f"WHEN '{x.upper()}' THEN '{x}'" for x in ("Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island"))}
  END AS level, y FROM o UNION ALL SELECT 'ALL', y FROM o)
SELECT level, {rsql("avg(y)", 6)} AS observed, TRUE AS inside FROM l GROUP BY 1""")
def l11_invariants(spark, sf_dir):
    """Observed rates, and that the predicted ones are shares inside their interval."""
    return l11(spark, sf_dir).select("level", rd("observed", 6).alias("observed"), F.expr(
        "lo >= 0 AND hi <= 1 AND predicted BETWEEN lo AND hi").alias("inside"))


@query("l12_prior_totals", """SELECT p.prior, count(*) AS n, 80 AS bins, TRUE AS symmetric FROM orders, (VALUES ('chosen'), ('default')) p(prior)
GROUP BY 1""")
def l12_totals(spark, sf_dir):
    """Every simulated draw is in one of 80 bins, as many below one half as above."""
    made = l12(spark, sf_dir)
    low = F.sum(F.when(F.col("bin") < 40, F.col("n")).otherwise(0)) / F.sum("n")
    return made.groupBy("prior").agg(
        F.sum("n").alias("n"), F.count("*").cast("int").alias("bins"), low.between(0.4, 0.6).alias("symmetric"))


@query("l12_prior_predictive")
def l12(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select("o_orderkey")
    return b.prior_predictive(keys, "o_orderkey", {"chosen": 2.5, "default": (1 / 0.001) ** 0.5})


@query("l13_prior_sensitivity")
def l13(spark, sf_dir):
    return b.prior_sensitivity(_patterns(spark, sf_dir), COVARIATES, PRIORS)


@query("l13_prior_invariants", f"""SELECT t.prior, {1 + len(COVARIATES)}::BIGINT AS params, TRUE AS ordered
FROM (VALUES {", ".join(f"('{name}')" for name, _ in PRIORS)}) t(prior), (SELECT count(*) FROM orders)""")
def l13_invariants(spark, sf_dir):
    """Every coefficient under every prior, and no larger a sum of squares under a tighter one."""
    made = l13(spark, sf_dir).groupBy("prior").agg(F.count("*").alias("params"), F.sum(F.col("mean") ** 2).alias("size"))
    order = F.create_map(*[F.lit(x) for name, tau in PRIORS for x in (name, tau)])
    looser = Window.partitionBy(F.lit(1)).orderBy(F.col("tau").desc())
    return made.withColumn("tau", order[F.col("prior")]).withColumn("before", F.lag("size").over(looser)).select(
        "prior", "params", F.coalesce(F.col("before") <= F.col("size"), F.lit(True)).alias("ordered"))


@query("l14_group_effects", f"""WITH {_SUMMARY}
SELECT param, {rsql("mean", 5)} AS mean, {rsql("lo", 5)} AS q2_5, {rsql("hi", 5)} AS q97_5,
       CASE WHEN lo > 0 THEN 'above' WHEN hi < 0 THEN 'below' ELSE 'spans 0' END AS interval_class,
       CAST(row_number() OVER (ORDER BY mean, param) AS INTEGER) AS rank FROM summ""")
def l14(spark, sf_dir):
    return b.group_effects(draws_of_lines(spark, sf_dir), "beta").select(
        "param", *[rd(c, 5).alias(c) for c in ("mean", "q2_5", "q97_5")], "interval_class", "rank"
    )


@query("l15_draw_distribution", f"""WITH {DRAWS}, e AS (SELECT min(value) AS lo, max(value) AS hi FROM draws),
h AS (SELECT param, CAST(least(floor((value - lo) / ((hi - lo) / 40)), 39) AS INTEGER) AS bin FROM draws, e),
c AS (SELECT param, bin, count(*) AS n FROM h GROUP BY 1, 2),
g AS (SELECT param, CAST(unnest(range(40)) AS INTEGER) AS bin FROM (SELECT DISTINCT param FROM draws)),
q AS (SELECT param, quantile_cont(value, 0.5) AS md FROM draws GROUP BY 1)
SELECT g.param, g.bin, coalesce(c.n, 0) AS n, {rsql("md", 5)} AS median FROM g LEFT JOIN c ON g.param = c.param AND g.bin = c.bin
JOIN q ON g.param = q.param""")
def l15(spark, sf_dir):
    draws = draws_of_lines(spark, sf_dir)
    boxes = box_stats(draws, "value", "param").select("param", rd("median", 5).alias("median"))
    return b.draw_histogram(draws).select("param", "bin", "n").join(boxes, "param")
