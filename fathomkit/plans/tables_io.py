"""Scans and writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomkit.functions.scoring import score_transactions
from fathomkit.plans.inputs import SCORED, table, transactions
from fathomkit.plans.registry import query, rsql
from fathomkit.session import fresh_path
from fathomkit.sources.files import (
    read_csv, read_json, read_parquet, write_csv, write_json, write_parquet,
)

ORDERS_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate string, o_orderpriority string"
)


def _orders_csv(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return write_csv(text, fresh_path(spark, "orders-csv"))


@query("a01_csv_scan", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders""")
def a01(spark, sf_dir):
    return read_csv(spark, _orders_csv(spark, sf_dir), ORDERS_SCHEMA)


@query("a02_pruned_scan", "SELECT o_custkey, o_totalprice FROM orders")
def a02(spark, sf_dir):
    return read_csv(
        spark, _orders_csv(spark, sf_dir), ORDERS_SCHEMA, ["o_custkey", "o_totalprice"]
    )


@query("a03_parquet_scan",
       "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_quantity >= 25")
def a03(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").filter("l_quantity >= 25").select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


@query("a04_parquet_write", f"""WITH {SCORED}
SELECT transaction_id, "Amount", "RuleFlag", "AlertLevel", "Class" FROM scored""")
def a04(spark, sf_dir):
    """Write twice to one path: the second write replaces the stale first."""
    scored = score_transactions(transactions(spark, sf_dir)).select(
        "transaction_id", "Amount", "RuleFlag", "AlertLevel", "Class"
    )
    path = fresh_path(spark, "scored")
    write_parquet(scored.filter("Class = 1"), path)
    return read_parquet(spark, write_parquet(scored, path))


@query("a05_csv_write", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def a05(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = write_csv(customer, fresh_path(spark, "customer-csv"))
    return read_csv(spark, path, customer.schema)


@query("a06_json_write", f"""
SELECT o_orderstatus AS status, count(*) AS n,
       {rsql("avg(o_totalprice)", 4)} AS mean_total,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY o_orderstatus""")
def a06(spark, sf_dir):
    summary = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("n"),
        F.round(F.round(F.avg("o_totalprice"), 9), 4).alias("mean_total"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
    )
    path = write_json(summary, fresh_path(spark, "summary-json"))
    return read_json(spark, path, summary.schema)
