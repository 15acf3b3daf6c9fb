"""Descriptive jobs and the tables behind charts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathomkit.functions.scalars import rd, shorten
from fathomkit.operators import describe as d
from fathomkit.operators.grouping import overall
from fathomkit.plans.inputs import (
    RETAIL, SALES, SHOP, TRANSACTIONS, retail, sales, shop, table, transactions,
)
from fathomkit.plans.joining import weekly
from fathomkit.plans.registry import query, rsql

NUMS = {"l_quantity": "quantity", "l_extendedprice": "price", "l_discount": "discount", "l_tax": "tax"}


def _each(template: str) -> str:
    return " UNION ALL ".join(template.replace("@", c) for c in NUMS)


@query("i01_describe", _each(f"""
SELECT '@' AS metric, count(@) AS n, {rsql("avg(@)", 4)} AS mean, {rsql("stddev(@)", 4)} AS sd,
       min(@) AS lo, max(@) AS hi FROM lineitem"""))
def i01(spark, sf_dir):
    return d.moments(table(spark, sf_dir, "lineitem"), list(NUMS)).select(
        "metric", "n", rd("mean", 4).alias("mean"), rd("sd", 4).alias("sd"), "lo", "hi"
    )


@query("i02_describe_quartiles", _each(f"""
SELECT '@' AS metric, count(@) AS n, {rsql("avg(@)", 4)} AS mean, {rsql("stddev(@)", 4)} AS sd,
       min(@) AS lo, max(@) AS hi, {rsql("quantile_cont(@, 0.25)", 4)} AS q1,
       {rsql("quantile_cont(@, 0.5)", 4)} AS median, {rsql("quantile_cont(@, 0.75)", 4)} AS q3 FROM lineitem"""))
def i02(spark, sf_dir):
    return d.describe(table(spark, sf_dir, "lineitem"), list(NUMS)).select(
        "metric", "n", "lo", "hi",
        *[rd(c, 4).alias(c) for c in ("mean", "sd", "q1", "median", "q3")],
    )


@query("i03_five_numbers", f"""
SELECT min(o_totalprice) AS lo, {rsql("quantile_cont(o_totalprice, 0.25)", 4)} AS q1,
       {rsql("quantile_cont(o_totalprice, 0.5)", 4)} AS median, {rsql("avg(o_totalprice)", 4)} AS mean,
       {rsql("quantile_cont(o_totalprice, 0.75)", 4)} AS q3, max(o_totalprice) AS hi FROM orders""")
def i03(spark, sf_dir):
    return d.describe(table(spark, sf_dir, "orders"), ["o_totalprice"]).select(
        "lo", "hi", *[rd(c, 4).alias(c) for c in ("q1", "median", "mean", "q3")]
    )


@query("i04_skew_kurtosis", f"""
SELECT 'value' AS metric, count(value) AS n, {rsql("skewness(value)", 4)} AS skewness,
       {rsql("kurtosis(value)", 4)} AS kurtosis, CASE WHEN abs(skewness(value)) < 0.5
       THEN 'approximately normal (symmetric)' WHEN skewness(value) > 0 THEN 'right-skewed (positive tail)'
       ELSE 'left-skewed (negative tail)' END AS distribution FROM events""")
def i04(spark, sf_dir):
    return d.shape(table(spark, sf_dir, "events"), ["value"]).select(
        "metric", "n", rd("skewness", 4).alias("skewness"), rd("kurtosis", 4).alias("kurtosis"),
        "distribution",
    )


@query("i05_second_skewness", f"""
SELECT 'value' AS metric, {rsql("3 * (avg(value) - median(value)) / stddev(value)", 4)} AS skew2 FROM events""")
def i05(spark, sf_dir):
    return d.second_skewness(table(spark, sf_dir, "events"), ["value"]).select(
        "metric", rd("skew2", 4).alias("skew2")
    )


@query("i06_correlation_matrix", f"WITH {SALES} " + " UNION ALL ".join(
    f"""SELECT '{a}' AS a, '{b}' AS b, {rsql(f'corr("{a}", "{b}")', 4)} AS r FROM weekly"""
    for a in ("Weekly_Sales", "Temperature", "Size", "CPI")
    for b in ("Weekly_Sales", "Temperature", "Size", "CPI")))
def i06(spark, sf_dir):
    return d.correlations(
        weekly(spark, sf_dir), ["Weekly_Sales", "Temperature", "Size", "CPI"]
    ).withColumn("r", rd("r", 4))


@query("i07_correlation_with_class", f"WITH {TRANSACTIONS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {rsql(f'corr("{c}", "Class")', 6)} AS r FROM tx"""
    for c in ("V3", "V12", "V14", "Amount", "Time")))
def i07(spark, sf_dir):
    tx = transactions(spark, sf_dir).withColumn("Class", F.col("Class").cast("double"))
    return d.correlation_with(tx, ["V3", "V12", "V14", "Amount", "Time"], "Class").withColumn(
        "r", rd("r", 6)
    )


@query("i08_histogram", f"""WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT event_type, least(floor((value - lo) / ((hi - lo) / 60)), 59) AS bin FROM events, e),
c AS (SELECT event_type, CAST(bin AS INTEGER) AS bin, count(*) AS n FROM b GROUP BY 1, 2),
g AS (SELECT event_type, CAST(unnest(range(60)) AS INTEGER) AS bin FROM (SELECT DISTINCT event_type FROM events))
SELECT g.event_type, g.bin, coalesce(c.n, 0) AS n,
  {rsql("lo + g.bin * ((hi - lo) / 60)", 5)} AS left_edge,
  {rsql("coalesce(c.n, 0) / (sum(coalesce(c.n, 0)) OVER (PARTITION BY g.event_type) * ((hi - lo) / 60))", 6)} AS density
FROM g LEFT JOIN c ON g.event_type = c.event_type AND g.bin = c.bin, e""")
def i08(spark, sf_dir):
    return d.histogram(table(spark, sf_dir, "events"), "value", 60, by="event_type").select(
        "event_type", "bin", "n", rd("left_edge", 5).alias("left_edge"), rd("density", 6).alias("density")
    )


@query("i09_kde", f"""WITH s AS (
SELECT count(*) AS n, stddev(value) * pow(count(*), -0.2) AS h, min(value) AS lo, max(value) AS hi FROM events),
v AS (SELECT value, count(*) AS w FROM events GROUP BY 1),
g AS (SELECT i, lo - 0.5 * (hi - lo) + i * (2 * (hi - lo) / 999) AS x, n, h FROM s, (SELECT unnest(range(1000)) AS i))
SELECT CAST(i AS INTEGER) AS i, {rsql("max(x)", 4)} AS x,
       {rsql("sum(w * exp(-0.5 * ((x - value) / h) * ((x - value) / h))) / (max(n) * max(h) * sqrt(2 * pi()))", 7)} AS density
FROM g, v GROUP BY 1""")
def i09(spark, sf_dir):
    return d.kde(table(spark, sf_dir, "events"), "value").select(
        "i", rd("x", 4).alias("x"), rd("density", 7).alias("density")
    )


@query("i10_box_stats", f"""WITH q AS (
SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
       quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
SELECT e.event_type, {rsql("max(q1)", 4)} AS q1, {rsql("max(median)", 4)} AS median, {rsql("max(q3)", 4)} AS q3,
  min(value) FILTER (value >= q1 - 1.5 * (q3 - q1)) AS whisker_lo,
  max(value) FILTER (value <= q3 + 1.5 * (q3 - q1)) AS whisker_hi,
  count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers
FROM events e JOIN q ON e.event_type = q.event_type GROUP BY 1""")
def i10(spark, sf_dir):
    return d.box_stats(table(spark, sf_dir, "events"), "value", "event_type").select(
        "event_type", *[rd(c, 4).alias(c) for c in ("q1", "median", "q3")],
        "whisker_lo", "whisker_hi", "outliers",
    )


@query("i11_shares", f"""WITH {RETAIL}
SELECT "Payment", count(*) AS n, {rsql("count(*) * 100.0 / sum(count(*)) OVER ()", 1)} AS pct FROM retail GROUP BY 1""")
def i11(spark, sf_dir):
    counts = retail(spark, sf_dir).groupBy("Payment").agg(F.count("*").alias("n"))
    return counts.withColumn("pct", rd(d.share(F.col("n"), overall("n")), 1))


@query("i12_mean_vs_overall", f"""WITH {RETAIL}
SELECT CASE WHEN length("Product_line") > 5 THEN substr("Product_line", 1, 5) || '.' ELSE "Product_line" END AS line,
       {rsql('avg("Rating")', 4)} AS mean, {rsql('(SELECT avg("Rating") FROM retail)', 4)} AS overall
FROM retail GROUP BY "Product_line" """)
def i12(spark, sf_dir):
    """Group means against the mean of all rows, both from the same grouped sums."""
    per = retail(spark, sf_dir).groupBy("Product_line").agg(
        F.sum("Rating").alias("s"), F.count("Rating").alias("n")
    )
    whole = Window.partitionBy()
    return per.select(
        shorten("Product_line", 5).alias("line"), rd(F.col("s") / F.col("n"), 4).alias("mean"),
        rd(F.sum("s").over(whole) / F.sum("n").over(whole), 4).alias("overall"),
    )


@query("i13_active_promotions", f"""WITH {SALES}
SELECT "Row", 'MarkDown1' AS promo, "MarkDown1" AS amount, "Weekly_Sales" FROM weekly WHERE "MarkDown1" > 0
UNION ALL SELECT "Row", 'MarkDown2', "MarkDown2", "Weekly_Sales" FROM weekly WHERE "MarkDown2" > 0""")
def i13(spark, sf_dir):
    return weekly(spark, sf_dir).unpivot(
        ["Row", "Weekly_Sales"], ["MarkDown1", "MarkDown2"], "promo", "amount"
    ).filter("amount > 0")


@query("i14_mean_interval", f"""WITH {SHOP}, s AS (
SELECT "Category", count(*) AS n, avg("TotalAmount") AS m, stddev("TotalAmount") AS sd,
       stddev("TotalAmount") / sqrt(count(*)) AS se FROM shop WHERE "OrderStatus" = 'F' GROUP BY 1)
SELECT "Category", n, {rsql("m", 2)} AS mean, {rsql("sd", 2)} AS sd, {rsql("se", 4)} AS se,
       {rsql("m - 1.96 * se", 4)} AS lo, {rsql("m + 1.96 * se", 4)} AS hi,
       {rsql('''(SELECT avg("TotalAmount") FROM shop WHERE "OrderStatus" = 'F')''', 4)} AS grand_mean FROM s""")
def i14(spark, sf_dir):
    done = shop(spark, sf_dir).filter(F.col("OrderStatus") == "F")
    return d.mean_interval(done, "Category", "TotalAmount").select(
        "Category", "n", rd("mean", 2).alias("mean"), rd("sd", 2).alias("sd"),
        *[rd(c, 4).alias(c) for c in ("se", "lo", "hi", "grand_mean")],
    )
