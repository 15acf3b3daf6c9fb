"""Sort, limit, top-k, sampling and set jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from fathomkit.functions.scalars import rd
from fathomkit.operators import sampling as s
from fathomkit.operators.describe import moments
from fathomkit.plans.inputs import SALES, TRANSACTIONS, sales, table, transactions
from fathomkit.plans.registry import query, rsql

KEYS = ["transaction_id", "l_linenumber", "l_partkey", "l_suppkey"]


@query("f01_sort", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def f01(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_totalprice"
    ).orderBy(F.col("o_orderpriority"), F.col("o_totalprice").desc(), "o_orderkey")


@query("f02_top_groups", f"""WITH {SALES}, t AS (
SELECT "Store", sum(CAST("Weekly_Sales" AS DECIMAL(18,2))) AS total FROM sales GROUP BY 1)
SELECT "Store", CAST(total AS DOUBLE) AS total FROM t ORDER BY t.total DESC, "Store" LIMIT 10""")
def f02(spark, sf_dir):
    return s.top_groups(sales(spark, sf_dir), "Store", "Weekly_Sales", 10)


@query("f03_top_by_abs", """
SELECT c_custkey, c_acctbal - 4500.0 AS gap FROM customer ORDER BY abs(c_acctbal - 4500.0) DESC, c_custkey LIMIT 15""")
def f03(spark, sf_dir):
    gaps = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_acctbal") - 4500.0).alias("gap")
    )
    return s.top_by_abs(gaps, "gap", ["c_custkey"], 15)


@query("f04_first_rows", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 2000""")
def f04(spark, sf_dir):
    return s.first_rows(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
        ["o_orderkey"], 2000,
    )


@query("f05_bernoulli_sample")
def f05(spark, sf_dir):
    return s.bernoulli(
        transactions(spark, sf_dir).select(*KEYS, "Amount", "Class"), 0.1, KEYS, seed=42
    )


@query("f05_sample_invariants", f"""WITH {TRANSACTIONS}
SELECT count(*) AS n, TRUE AS near_a_tenth, TRUE AS repeats, 0 AS foreign_rows FROM tx""")
def f05_invariants(spark, sf_dir):
    """Drawn and left rows make up the table, a tenth is drawn, a second draw is the same, nothing else is drawn."""
    rows = transactions(spark, sf_dir).select(*KEYS)
    drawn, again = (s.bernoulli(r, 0.1, KEYS, seed=42).withColumn("drawn", F.lit(1)) for r in (rows, rows.repartition(7)))
    counts = rows.groupBy(*KEYS).agg(F.count("*").alias("rows")).join(
        drawn.groupBy(*KEYS).agg(F.sum("drawn").alias("one")), KEYS, "full").join(
        again.groupBy(*KEYS).agg(F.sum("drawn").alias("two")), KEYS, "full")
    return counts.agg(
        F.sum("rows").alias("n"), (F.sum("one") / F.sum("rows")).between(0.08, 0.12).alias("near_a_tenth"),
        F.bool_and(F.col("one").eqNullSafe(F.col("two"))).alias("repeats"),
        F.count_if(F.col("rows").isNull() | (F.col("one") > F.col("rows"))).cast("int").alias("foreign_rows"))


@query("f06_stratified_split")
def f06(spark, sf_dir):
    return s.stratified_split(transactions(spark, sf_dir), "Class", KEYS).select(
        *KEYS, "Class", "split"
    )


@query("f06_split_invariants", f"""WITH {TRANSACTIONS}
SELECT "Class", count(*) AS n, TRUE AS near_80_20 FROM tx GROUP BY 1""")
def f06_invariants(spark, sf_dir):
    """Both parts together hold every row of a class, four fifths of it in the training part."""
    marked = s.stratified_split(transactions(spark, sf_dir), "Class", KEYS)
    share = F.avg((F.col("split") == "train").cast("int"))
    return marked.groupBy("Class").agg(
        F.count_if(F.col("split").isin("train", "test")).alias("n"), share.between(0.75, 0.85).alias("near_80_20")
    )


@query("f08_sample_invariants", """
SELECT least(count(*), 500) AS n, least(count(*), 500) AS different FROM events""")
def f08_invariants(spark, sf_dir):
    """Exactly 500 rows (all of them if there are fewer), none drawn twice."""
    drawn = s.sample_exactly(table(spark, sf_dir, "events").select("event_id"), 500, ["event_id"])
    return drawn.agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("different"))


@query("f07_shuffled_rows", "SELECT event_id, user_id FROM events")
def f07(spark, sf_dir):
    return s.shuffled(table(spark, sf_dir, "events").select("event_id", "user_id"), ["event_id"])


@query("f08_sample_exactly")
def f08(spark, sf_dir):
    return s.sample_exactly(
        table(spark, sf_dir, "events").select("event_id", "value"), 500, ["event_id"]
    )


@query("g01_union_all", f"""
SELECT l_returnflag AS part, l_orderkey, l_linenumber FROM lineitem""")
def g01(spark, sf_dir):
    """Split by flag, then put back together with duplicates kept."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("part"), "l_orderkey", "l_linenumber"
    )
    return reduce(
        lambda a, b: a.unionByName(b), [li.filter(F.col("part") == flag) for flag in "ANR"]
    )


@query("g02_set_union", """
SELECT o_custkey AS k, o_orderstatus AS v FROM orders UNION
SELECT o_custkey, o_orderpriority FROM orders""")
def g02(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    a = o.select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("v"))
    b = o.select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("v"))
    return a.union(b).distinct()


@query("g03_select_distinct", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def g03(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct()


@query("g04_bind_by_name", f"""WITH {TRANSACTIONS}
""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS metric, {rsql(f'avg("{c}") FILTER ("Class" = 1)', 4)} AS mean_1,
        {rsql(f'avg("{c}") FILTER ("Class" = 0)', 4)} AS mean_0 FROM tx""" for c in ("Amount", "V3", "V14")))
def g04(spark, sf_dir):
    """Two summaries side by side, matched on the feature name and never on position."""
    tx = transactions(spark, sf_dir)
    a, b = (
        moments(tx.filter(F.col("Class") == k), ["Amount", "V3", "V14"]).select(
            "metric", rd("mean", 4).alias(f"mean_{k}")
        ) for k in (1, 0)
    )
    return a.join(b, "metric")
