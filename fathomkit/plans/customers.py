"""Customer and warehouse jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomkit.functions.scalars import rd
from fathomkit.operators import customers as c
from fathomkit.plans.inputs import SHOP, shop, table
from fathomkit.plans.registry import query, rsql
from fathomkit.session import fresh_path, hold
from fathomkit.sources.files import read_parquet, write_parquet

_RFM = """
rfm AS (SELECT o_custkey AS customer, date_diff('day', max(o_orderdate), (SELECT max(o_orderdate) FROM orders)) AS recency,
  count(*) AS frequency, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS monetary FROM orders GROUP BY 1)"""


def _rfm(spark, sf_dir):
    return c.rfm(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_totalprice")


@query("p01_rfm_scores", f"""WITH {_RFM}
SELECT *, CAST(ntile(5) OVER (ORDER BY recency DESC, customer) AS INTEGER) AS r,
  CAST(ntile(5) OVER (ORDER BY frequency, customer) AS INTEGER) AS f,
  CAST(ntile(5) OVER (ORDER BY monetary, customer) AS INTEGER) AS m FROM rfm""")
def p01(spark, sf_dir):
    return c.rfm_scores(_rfm(spark, sf_dir))


@query("p02_revenue_concentration", f"""WITH {_RFM}, t AS (
SELECT CAST(ntile(10) OVER (ORDER BY monetary DESC, customer) AS INTEGER) AS tile, monetary FROM rfm),
g AS (SELECT tile, count(*) AS customers, CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM t GROUP BY 1)
SELECT *, {rsql("sum(revenue) OVER (ORDER BY tile) * 100 / sum(revenue) OVER ()", 4)} AS cum_share FROM g""")
def p02(spark, sf_dir):
    return c.concentration(_rfm(spark, sf_dir)).withColumn("cum_share", rd("cum_share", 4))


@query("p03_customer_segments")
def p03(spark, sf_dir):
    return c.segments(_rfm(spark, sf_dir))


@query("p03_segment_sums", f"""WITH {_RFM}
SELECT 4 AS segments, count(*) AS customers, CAST(sum(frequency) AS BIGINT) AS orders, {rsql("sum(monetary) / 1e6", 4)} AS millions FROM rfm""")
def p03_sums(spark, sf_dir):
    """Four segments hold every customer once, with all orders and revenue."""
    made = c.segments(_rfm(spark, sf_dir))
    return made.agg(
        F.count_distinct("segment").cast("int").alias("segments"), F.count("*").alias("customers"),
        F.sum("frequency").cast("long").alias("orders"), rd(F.sum("monetary") / 1e6, 4).alias("millions"))


@query("p04_churn_labels", """WITH x AS (SELECT max(o_orderdate) - INTERVAL 365 DAY AS cut FROM orders),
b AS (SELECT o_custkey AS customer, count(*) AS frequency FROM orders, x WHERE o_orderdate <= cut GROUP BY 1)
SELECT b.customer, b.frequency, CASE WHEN EXISTS (SELECT 1 FROM orders o, x WHERE o.o_custkey = b.customer AND o.o_orderdate > cut)
  THEN 0 ELSE 1 END AS churned FROM b""")
def p04(spark, sf_dir):
    return c.churn_labels(
        table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_totalprice"
    ).select("customer", "frequency", "churned")


@query("p04_churn_model")
def p04_model(spark, sf_dir):
    return c.churn_model(c.churn_labels(
        table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_totalprice"
    ))


@query("p05_value_tiers", f"""WITH {_RFM}
SELECT customer, monetary, CAST(ntile(5) OVER (ORDER BY monetary DESC, customer) AS INTEGER) AS tier FROM rfm""")
def p05(spark, sf_dir):
    base = hold(_rfm(spark, sf_dir).select("customer", "monetary"))
    return c.scored_tile(base, "monetary", "customer", "tier", descending=True)


@query("p06_anomaly_flags", """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
FROM events GROUP BY 1)
SELECT event_id, e.event_type, value, value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) AS anomaly
FROM events e JOIN q ON e.event_type = q.event_type""")
def p06(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return c.outlier_flags(rows, "event_type", "value")


@query("p07_star_schema", f"""WITH {SHOP}
SELECT o_orderkey, "TotalAmount", "Category", "Country", "PaymentMethod", "OrderStatus" FROM shop""")
def p07(spark, sf_dir):
    """Facts with surrogate keys, written by status, then read back through the dimensions."""
    rows = hold(shop(spark, sf_dir))
    market, method = ["Category", "Country"], ["PaymentMethod"]
    dim_market = hold(c.dimension(rows, market, "market_key"))
    dim_method = hold(c.dimension(rows, method, "method_key"))
    facts = c.with_key(c.with_key(rows, dim_market, market, "market_key"), dim_method, method, "method_key")
    path = write_parquet(
        facts.select("o_orderkey", "TotalAmount", "market_key", "method_key", "OrderStatus"),
        fresh_path(spark, "facts"), ["OrderStatus"],
    )
    return read_parquet(spark, path).join(dim_market, "market_key").join(dim_method, "method_key").select(
        "o_orderkey", "TotalAmount", "Category", "Country", "PaymentMethod", "OrderStatus"
    )


@query("p08_incremental_load", f"""
SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS "rows", CAST(0 AS BIGINT) AS repeated,
  count(*) FILTER (o_orderkey % 7 = 0) AS null_o_totalprice FROM orders GROUP BY 1""")
def p08(spark, sf_dir):
    """A first load without prices, then a delivery that replaces every month it brings."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("period"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("o_totalprice"),
    )
    path = fresh_path(spark, "orders-by-month")
    c.load_partitions(orders.withColumn("o_totalprice", F.lit(None).cast("double")), path, "period")
    c.load_partitions(orders, path, "period")
    loaded = spark.read.schema("o_orderkey bigint, o_totalprice double, period string").parquet(path)
    return c.quality_report(loaded, "period", "o_orderkey", ["o_totalprice"])
