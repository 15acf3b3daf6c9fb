"""Order-dependent jobs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathomkit.functions.scalars import rd
from fathomkit.operators.clean import attach_stats
from fathomkit.operators.describe import ranked_intervals
from fathomkit.operators.ordered import dense_index, fill_across, fill_along, running_totals
from fathomkit.plans.inputs import RETAIL, SALES, STOPS, retail, stops, table
from fathomkit.plans.joining import weekly
from fathomkit.plans.registry import query, rsql


@query("e01_fill_forward_backward", f"""WITH {SALES}
SELECT "Row", "Store", coalesce(
  last_value("CPI" IGNORE NULLS) OVER (PARTITION BY "Store" ORDER BY "Date", "Row"
     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value("CPI" IGNORE NULLS) OVER (PARTITION BY "Store" ORDER BY "Date", "Row"
     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS cpi FROM weekly""")
def e01(spark, sf_dir):
    rows = weekly(spark, sf_dir).select("Row", "Store", "Date", F.col("CPI").alias("cpi"))
    return fill_along(rows, "Store", "Date", "Row", ["cpi"]).select("Row", "Store", "cpi")


@query("e01_fill_across_stores", f"""WITH {SALES}, w AS (
SELECT "Row", "Store", "Date", CASE WHEN "Store" % 3 <> 1 THEN "CPI" END AS known FROM weekly),
s AS (SELECT "Row", "Store", coalesce(
  last_value(known IGNORE NULLS) OVER (PARTITION BY "Store" ORDER BY "Date", "Row"
     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(known IGNORE NULLS) OVER (PARTITION BY "Store" ORDER BY "Date", "Row"
     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS cpi, "Date" FROM w)
SELECT "Row", "Store", coalesce(
  last_value(cpi IGNORE NULLS) OVER (ORDER BY "Store", "Date", "Row" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(cpi IGNORE NULLS) OVER (ORDER BY "Store", "Date", "Row"
     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS cpi FROM s""")
def e01_across(spark, sf_dir):
    """A third of the stores knows no value at all and takes one from the stores around it."""
    known = F.when(F.col("Store") % 3 != 1, F.col("CPI")).alias("cpi")
    rows = weekly(spark, sf_dir).select("Row", "Store", "Date", known)
    return fill_across(rows, "Store", "Date", "Row", ["cpi"]).select("Row", "Store", "cpi")


@query("e02_dense_index", f"""WITH {STOPS}, p AS (
SELECT stop_id, TRY_CAST(precinct_text AS INTEGER) AS precinct FROM stops)
SELECT stop_id, precinct, dense_rank() OVER (ORDER BY precinct) AS precinct_idx FROM p WHERE precinct IS NOT NULL""")
def e02(spark, sf_dir):
    rows = stops(spark, sf_dir).select(
        "stop_id", F.col("precinct_text").try_cast("int").alias("precinct")
    )
    return dense_index(rows, "precinct", "precinct_idx")


@query("e03_share_in_group", f"""WITH {RETAIL}
SELECT "Product_line", "Gender", count(*) AS n,
       {rsql('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY "Product_line")', 4)} AS pct
FROM retail GROUP BY 1, 2""")
def e03(spark, sf_dir):
    counts = retail(spark, sf_dir).groupBy("Product_line", "Gender").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("Product_line"))
    return counts.withColumn("pct", rd(F.col("n") * 100.0 / total, 4))


@query("e04_ranked_intervals", f"""WITH d AS (
SELECT CAST(round(l_discount * 100) AS INTEGER) AS param,
       l_quantity - 25.5 + (l_discount - 0.05) * 600 AS v FROM lineitem),
s AS (SELECT param, avg(v) AS m, quantile_cont(v, 0.025) AS lo, quantile_cont(v, 0.975) AS hi FROM d GROUP BY 1)
SELECT param, {rsql("m", 4)} AS mean, {rsql("lo", 4)} AS q2_5, {rsql("hi", 4)} AS q97_5,
       CASE WHEN lo > 0 THEN 'above' WHEN hi < 0 THEN 'below' ELSE 'spans 0' END AS interval_class,
       CAST(row_number() OVER (ORDER BY m, param) AS INTEGER) AS rank FROM s""")
def e04(spark, sf_dir):
    draws = table(spark, sf_dir, "lineitem").select(
        F.round(F.col("l_discount") * 100).cast("int").alias("param"),
        (F.col("l_quantity") - 25.5 + (F.col("l_discount") - 0.05) * 600).alias("value"),
    )
    out = ranked_intervals(draws, "param", "value")
    return out.select(
        "param", *[rd(c, 4).alias(c) for c in ("mean", "q2_5", "q97_5")], "interval_class", "rank"
    )


SCORES = """
scores AS (
  SELECT 'quantity' AS model, (l_quantity * 20 + l_partkey % 37) / 1037.0 AS score,
         CASE WHEN l_quantity >= 40 AND l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem
  UNION ALL
  SELECT 'blend', (l_suppkey % 100 + l_quantity * 9) / 550.0,
         CASE WHEN l_quantity >= 40 AND l_returnflag = 'R' THEN 1 ELSE 0 END FROM lineitem
  UNION ALL
  SELECT 'noise', (l_linenumber + l_partkey % 93) / 101.0,
         CASE WHEN l_quantity >= 40 AND l_returnflag = 'R' THEN 1 ELSE 0 END FROM lineitem)
"""


def scores(spark, sf_dir):
    """Score tables of three formulas, tagged by model, from one scan."""
    label = ((F.col("l_quantity") >= 40) & (F.col("l_returnflag") == "R")).cast("int")
    made = {
        "quantity": (F.col("l_quantity") * 20 + F.col("l_partkey") % 37) / 1037.0,
        "blend": (F.col("l_suppkey") % 100 + F.col("l_quantity") * 9) / 550.0,
        "noise": (F.col("l_linenumber") + F.col("l_partkey") % 93) / 101.0,
    }
    each = F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), c.alias("score")) for m, c in made.items()
    ])).alias("s")
    return table(spark, sf_dir, "lineitem").select(label.alias("label"), each).select(
        "s.model", "s.score", "label"
    )


@query("e05_cumulative_hits", f"""WITH {SCORES}, g AS (
SELECT model, score, sum(label) AS tp, sum(1 - label) AS fp FROM scores GROUP BY 1, 2)
SELECT model, score, CAST(sum(tp) OVER w AS BIGINT) AS cum_tp, CAST(sum(fp) OVER w AS BIGINT) AS cum_fp
FROM g WINDOW w AS (PARTITION BY model ORDER BY score DESC)""")
def e05(spark, sf_dir):
    from fathomkit.operators.evaluate import cumulative_hits

    return cumulative_hits(scores(spark, sf_dir)).select("model", "score", "cum_tp", "cum_fp")


@query("e06_rank_weighted_sum", f"""WITH r AS (
SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice) AS i, count(*) OVER () AS n FROM lineitem)
SELECT {rsql("sum((2 * i - 1) * v / n) / max(n)", 3)} AS weighted, max(n) AS n FROM r""")
def e06(spark, sf_dir):
    """sum((2i-1) v_i) over the globally sorted values; equal values share one row."""
    values = table(spark, sf_dir, "lineitem").groupBy(F.col("l_extendedprice").alias("v")).agg(
        F.count("*").alias("n")
    )
    ranked = running_totals(values, ["v"], ["n"])
    hi, lo = F.col("cum_n").cast("double"), (F.col("cum_n") - F.col("n")).cast("double")
    return ranked.agg(
        rd(F.sum((hi * hi - lo * lo) * F.col("v") / F.col("tot_n")) / F.max("tot_n"), 3).alias("weighted"),
        F.max("tot_n").alias("n"),
    )


@query("e07_standardise", f"""
SELECT o_orderkey, {rsql("(o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / (SELECT stddev(o_totalprice) FROM orders)", 5)} AS z
FROM orders""")
def e07(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return attach_stats(
        orders, {"_m": F.avg("o_totalprice"), "_sd": F.stddev("o_totalprice")}
    ).select("o_orderkey", rd((F.col("o_totalprice") - F.col("_m")) / F.col("_sd"), 5).alias("z"))
