"""Equi-joins of facts and dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomkit.functions.scalars import rd
from fathomkit.operators.joins import left_join
from fathomkit.plans.inputs import SALES, features, sales, stores
from fathomkit.plans.registry import query, rsql


def weekly(spark, sf_dir):
    """Sales with their store and the week's features, every sale kept."""
    with_store = left_join(sales(spark, sf_dir), stores(spark, sf_dir), ["Store"])
    return left_join(
        with_store, features(spark, sf_dir), ["Store", "Date", "IsHoliday"], null_safe=["IsHoliday"]
    )


@query("c01_left_join_dimension", f"""WITH {SALES}
SELECT s."Row", s."Store", t."Type", t."Size" FROM sales s LEFT JOIN stores t ON s."Store" = t."Store" """)
def c01(spark, sf_dir):
    return left_join(sales(spark, sf_dir), stores(spark, sf_dir), ["Store"]).select(
        "Row", "Store", "Type", "Size"
    )


@query("c02_left_join_composite", f"""WITH {SALES}
SELECT "Row", "Store", {rsql('"Temperature"', 4)} AS temperature, "MarkDown1" AS md1, "CPI" AS cpi
FROM weekly""")
def c02(spark, sf_dir):
    return weekly(spark, sf_dir).select(
        "Row", "Store", rd("Temperature", 4).alias("temperature"),
        F.col("MarkDown1").alias("md1"), F.col("CPI").alias("cpi"),
    )
