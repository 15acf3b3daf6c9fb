"""Aggregation jobs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathomkit.functions.scalars import rd
from fathomkit.functions.scoring import NORMAL, score_transactions
from fathomkit.operators import grouping as g
from fathomkit.operators.ordered import quantiles
from fathomkit.plans.inputs import (
    LINES, RETAIL, SALES, SCORED, SHOP, STOPS, TRANSACTIONS,
    lines, retail, sales, shop, stops, table, transactions,
)
from fathomkit.plans.joining import weekly
from fathomkit.plans.registry import query, rsql

STATUSES = ["F", "O", "P"]
PRODUCT_LINES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def msum(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


@query("d01_class_share", f"""WITH {TRANSACTIONS}
SELECT "Class", count(*) AS n, {rsql('count(*) * 100.0 / sum(count(*)) OVER ()', 4)} AS pct
FROM tx GROUP BY "Class" """)
def d01(spark, sf_dir):
    return g.class_share(transactions(spark, sf_dir), "Class").orderBy("Class")


@query("d02_group_moments", f"""
SELECT l_returnflag AS flag, {rsql("avg(l_extendedprice)", 4)} AS mean, {rsql("stddev(l_extendedprice)", 4)} AS sd,
       min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
       {rsql("quantile_cont(l_extendedprice, 0.5)", 4)} AS median FROM lineitem GROUP BY 1""")
def d02(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "flag")
    price = "l_extendedprice"
    moments = li.groupBy("flag").agg(
        rd(F.avg(price), 4).alias("mean"), rd(F.stddev(price), 4).alias("sd"),
        F.min(price).alias("lo"), F.max(price).alias("hi"),
    )
    median = quantiles(li, [price], [0.5], by=["flag"]).select("flag", rd("p50", 4).alias("median"))
    return moments.join(median, "flag")


@query("d03_group_revenue", f"""WITH {SHOP}
SELECT "Category", count(*) AS orders, {msum('"TotalAmount"')} AS revenue,
       {rsql('avg("TotalAmount")', 4)} AS avg_order FROM shop GROUP BY 1""")
def d03(spark, sf_dir):
    return shop(spark, sf_dir).groupBy("Category").agg(
        F.count("*").alias("orders"), g.money("TotalAmount").alias("revenue"),
        rd(F.avg("TotalAmount"), 4).alias("avg_order"),
    ).orderBy(F.col("revenue").desc(), "Category")


@query("d04_mean_per_level", f"""
SELECT l_discount AS discount, count(*) AS orders, {rsql("avg(l_extendedprice)", 2)} AS avg_order
FROM lineitem GROUP BY 1""")
def d04(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_discount").alias("discount")).agg(
        F.count("*").alias("orders"), rd(F.avg("l_extendedprice"), 2).alias("avg_order")
    )


@query("d05_status_share", f"""
SELECT o_orderstatus AS status, count(*) AS n, {rsql("count(*) * 100.0 / sum(count(*)) OVER ()", 1)} AS pct,
       {msum("o_totalprice")} AS revenue FROM orders GROUP BY 1""")
def d05(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("n"), g.money("o_totalprice").alias("revenue")
    ).withColumn("pct", rd(F.col("n") * 100.0 / g.overall("n"), 1)).orderBy(F.col("n").desc())


@query("d06_value_counts", f"""WITH {STOPS}
SELECT initiated_text, count(*) AS n, {rsql("count(*) * 100.0 / sum(count(*)) OVER ()", 1)} AS pct
FROM stops WHERE initiated_text IS NOT NULL GROUP BY 1""")
def d06(spark, sf_dir):
    return g.value_counts(stops(spark, sf_dir), "initiated_text")


@query("d07_three_key_count", f"""WITH {SCORED}
SELECT "RuleFlag", "AlertLevel", "Class", count(*) AS n FROM scored GROUP BY ALL""")
def d07(spark, sf_dir):
    return score_transactions(transactions(spark, sf_dir)).groupBy(
        "RuleFlag", "AlertLevel", "Class"
    ).agg(F.count("*").alias("n")).orderBy("RuleFlag", "Class")


@query("d08_rounded_stats", f"""WITH {SCORED}
SELECT "RuleFlag", count("Amount") AS n, {rsql('avg("Amount")', 2)} AS mean_amount,
       {rsql('min("Amount")', 2)} AS min_amount, {rsql('max("Amount")', 2)} AS max_amount
FROM scored GROUP BY 1""")
def d08(spark, sf_dir):
    return score_transactions(transactions(spark, sf_dir)).groupBy("RuleFlag").agg(
        F.count("Amount").alias("n"), rd(F.avg("Amount"), 2).alias("mean_amount"),
        rd(F.min("Amount"), 2).alias("min_amount"), rd(F.max("Amount"), 2).alias("max_amount"),
    ).orderBy("RuleFlag")


@query("d09_rule_precision", f"""WITH {SCORED}, c AS (
SELECT count(*) AS total, count(*) FILTER ("RuleFlag" <> 'NORMAL') AS flagged,
       count(*) FILTER ("RuleFlag" <> 'NORMAL' AND "Class" = 1) AS hits FROM scored)
SELECT total, flagged, hits, {rsql("flagged * 100.0 / total", 1)} AS flagged_pct,
       {rsql("hits * 100.0 / nullif(flagged, 0)", 1)} AS precision_pct FROM c""")
def d09(spark, sf_dir):
    return g.rule_precision(
        score_transactions(transactions(spark, sf_dir)), "RuleFlag", NORMAL, "Class"
    )


@query("d10_group_rate", f"""WITH {STOPS}
SELECT boro_text AS borough, {rsql("avg(CASE WHEN arrested_flag = 'Y' THEN 1 ELSE 0 END)", 6)} AS rate,
       count(*) AS n FROM stops GROUP BY 1""")
def d10(spark, sf_dir):
    y = stops(spark, sf_dir).select(
        F.col("boro_text").alias("borough"), (F.col("arrested_flag") == "Y").cast("int").alias("y")
    )
    return g.group_rate(y, "borough", "y").withColumn("rate", rd("rate", 6))


@query("d11_class_mean_gap", f"""WITH {TRANSACTIONS}, m AS (
""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, avg("{c}") FILTER ("Class" = 1) AS a, avg("{c}") FILTER ("Class" = 0) AS b FROM tx"""
    for c in ("V3", "V12", "V14", "Amount", "Time")) + f""")
SELECT feature, {rsql("a", 4)} AS mean_1, {rsql("b", 4)} AS mean_0, {rsql("abs(a - b)", 4)} AS abs_diff FROM m""")
def d11(spark, sf_dir):
    gaps = g.class_mean_gap(
        transactions(spark, sf_dir), ["V3", "V12", "V14", "Amount", "Time"], "Class"
    )
    return gaps.select("feature", *[rd(c, 4).alias(c) for c in ("mean_1", "mean_0", "abs_diff")])


def _status_rates(spark, sf_dir):
    return shop(spark, sf_dir).groupBy("Category").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("OrderStatus") == "F").alias("returned"),
        F.count_if(F.col("OrderStatus") == "P").alias("cancelled"),
    ).select(
        "*", rd(F.col("returned") * 100.0 / F.col("total"), 4).alias("ret_rate"),
        rd(F.col("cancelled") * 100.0 / F.col("total"), 4).alias("can_rate"),
    )


_RATES = f"""{SHOP}, rates AS (
SELECT "Category", count(*) AS total, count(*) FILTER ("OrderStatus" = 'F') AS returned,
       count(*) FILTER ("OrderStatus" = 'P') AS cancelled,
       {rsql('''count(*) FILTER ("OrderStatus" = 'F') * 100.0 / count(*)''', 4)} AS ret_rate,
       {rsql('''count(*) FILTER ("OrderStatus" = 'P') * 100.0 / count(*)''', 4)} AS can_rate
FROM shop GROUP BY 1)"""


@query("d12_conditional_rates", f"WITH {_RATES} SELECT * FROM rates")
def d12(spark, sf_dir):
    return _status_rates(spark, sf_dir)


@query("d13_pivot_sum", f"""WITH {RETAIL}
SELECT "Product_line", """ + ", ".join(
    f"""coalesce({msum('"Total"')} FILTER ("Customer_type" = '{s}'), 0.0) AS "{s}" """.replace(
        f"""{msum('"Total"')} FILTER ("Customer_type" = '{s}')""",
        f"""CAST(sum(CAST("Total" AS DECIMAL(18,2))) FILTER ("Customer_type" = '{s}') AS DOUBLE)""")
    for s in STATUSES) + """ FROM retail GROUP BY 1""")
def d13(spark, sf_dir):
    return g.pivot_sum(retail(spark, sf_dir), ["Product_line"], "Customer_type", STATUSES, "Total")


@query("d14_wide_to_long", f"""WITH {_RATES}
SELECT "Category", 'Return Rate (%)' AS "Metric", ret_rate AS "Rate" FROM rates
UNION ALL SELECT "Category", 'Cancellation Rate (%)', can_rate FROM rates""")
def d14(spark, sf_dir):
    long = _status_rates(spark, sf_dir).unpivot(
        ["Category"], ["ret_rate", "can_rate"], "Metric", "Rate"
    )
    label = F.when(F.col("Metric") == "ret_rate", "Return Rate (%)").when(
        F.col("Metric") == "can_rate", "Cancellation Rate (%)"
    ).otherwise(F.col("Metric"))
    return long.withColumn("Metric", label)


@query("d15_contingency", f"""WITH {SHOP}, g AS (
SELECT a."Category", b."OrderStatus" FROM (SELECT DISTINCT "Category" FROM shop) a,
       (SELECT DISTINCT "OrderStatus" FROM shop) b),
c AS (SELECT g.*, count(s."Category") AS n FROM g LEFT JOIN shop s
      ON g."Category" = s."Category" AND g."OrderStatus" = s."OrderStatus" GROUP BY ALL)
SELECT *, {rsql('n * 100.0 / sum(n) OVER (PARTITION BY "Category")', 2)} AS row_pct FROM c""")
def d15(spark, sf_dir):
    return g.contingency(shop(spark, sf_dir), "Category", "OrderStatus").select(
        "Category", "OrderStatus", "n", rd(F.col("n") * 100.0 / F.col("row_n"), 2).alias("row_pct")
    )


@query("d16_month_end_resample", f"""WITH o AS (
SELECT last_day(CAST(o_orderdate AS DATE)) AS m, o_totalprice AS v FROM orders),
g AS (SELECT last_day(CAST(unnest(generate_series((SELECT date_trunc('month', min(m)) - INTERVAL 2 MONTH FROM o),
      (SELECT date_trunc('month', max(m)) + INTERVAL 2 MONTH FROM o), INTERVAL 1 MONTH)) AS DATE)) AS m)
SELECT strftime(g.m, '%Y-%m-%d') AS month_end, coalesce({msum("v")}, 0.0) AS total
FROM g LEFT JOIN o ON g.m = o.m GROUP BY 1""")
def d16(spark, sf_dir):
    """The calendar is two months wider than the books on either side; those months must come out as 0."""
    orders = table(spark, sf_dir, "orders")
    return g.month_end_totals(orders, "o_orderdate", "o_totalprice", margin=2).withColumn(
        "month_end", F.date_format("month_end", "yyyy-MM-dd")
    )


@query("d17_month_period", f"""WITH {RETAIL}
SELECT strftime("Date", '%Y-%m') AS period, coalesce("Branch", 'ALL') AS branch, {msum('"Total"')} AS total
FROM retail GROUP BY GROUPING SETS ((strftime("Date", '%Y-%m'), "Branch"), (strftime("Date", '%Y-%m')))""")
def d17(spark, sf_dir):
    """Per branch and for all branches; the second table is summed from the first."""
    month = F.date_format(F.date_trunc("month", F.col("Date").cast("timestamp")), "yyyy-MM")
    per = retail(spark, sf_dir).groupBy(month.alias("period"), F.col("Branch").alias("branch")).agg(
        F.sum(F.col("Total").cast("decimal(18,2)")).alias("t")
    )
    both = F.explode(F.array(F.col("branch"), F.lit("ALL"))).alias("branch")
    return per.select("period", both, "t").groupBy("period", "branch").agg(
        F.sum("t").cast("double").alias("total")
    )


@query("d18_distinct_counts", """
SELECT count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderpriority) AS payments,
       (SELECT string_agg(s, ', ' ORDER BY s) FROM (SELECT DISTINCT o_orderstatus AS s FROM orders)) AS statuses
FROM orders""")
def d18(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.agg(
        F.count_distinct("o_custkey").alias("customers"),
        F.count_distinct("o_orderpriority").alias("payments"),
        F.array_join(F.sort_array(F.collect_set("o_orderstatus")), ", ").alias("statuses"),
    )


@query("d19_duplicate_rows", """
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (
  SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)""")
def d19(spark, sf_dir):
    return g.duplicate_rows(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    )


@query("d20_validation_summary", f"""WITH {SALES}, s AS (
SELECT count(*) AS n, CAST(sum(("Type" IS NULL)::INT + ("Size" IS NULL)::INT + ("CPI" IS NULL)::INT) AS BIGINT) AS nulls,
  min("Weekly_Sales") AS lo, max("Weekly_Sales") AS hi, {rsql('avg("Weekly_Sales")', 2)} AS mean,
  strftime(min("Date"), '%Y-%m-%d') AS first_day, strftime(max("Date"), '%Y-%m-%d') AS last_day,
  count(DISTINCT "Store") AS stores, count(DISTINCT "Dept") AS depts FROM weekly) SELECT * FROM s""")
def d20(spark, sf_dir):
    w = weekly(spark, sf_dir)
    gaps = sum((F.col(c).isNull().cast("int") for c in ("Type", "Size", "CPI")), F.lit(0))
    return w.agg(
        F.count("*").alias("n"), F.sum(gaps).alias("nulls"),
        F.min("Weekly_Sales").alias("lo"), F.max("Weekly_Sales").alias("hi"),
        rd(F.avg("Weekly_Sales"), 2).alias("mean"),
        F.date_format(F.min("Date"), "yyyy-MM-dd").alias("first_day"),
        F.date_format(F.max("Date"), "yyyy-MM-dd").alias("last_day"),
        F.count_distinct("Store").alias("stores"), F.count_distinct("Dept").alias("depts"),
    )


@query("d21_imbalance_ratio", f"""WITH {TRANSACTIONS}
SELECT CAST(floor(count(*) FILTER ("Class" = 0) / count(*) FILTER ("Class" = 1)) AS BIGINT) AS ratio FROM tx""")
def d21(spark, sf_dir):
    return transactions(spark, sf_dir).agg(
        F.floor(F.try_divide(
            F.count_if(F.col("Class") == 0), F.count_if(F.col("Class") == 1)
        )).alias("ratio")
    )


@query("d22_holiday_weeks", f"""WITH {SALES}
SELECT count(DISTINCT weekofyear("Date")) AS holiday_weeks FROM sales WHERE "IsHoliday" """)
def d22(spark, sf_dir):
    return sales(spark, sf_dir).filter("IsHoliday").agg(
        F.count_distinct(F.weekofyear("Date")).alias("holiday_weeks")
    )
