"""Customer value, churn and warehouse loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomkit.functions.scalars import ratio
from fathomkit.operators.grouping import money
from fathomkit.operators.learn import assemble, standardise
from fathomkit.operators.ordered import global_rank, quantiles, running_totals, tile_of
from fathomkit.session import hold

RFM = ["recency", "frequency", "monetary"]


def rfm(orders: DataFrame, customer: str, day: str, amount: str) -> DataFrame:
    """Days since the last order, number of orders and revenue per customer."""
    last = orders.agg(F.max(day)).scalar()
    return orders.groupBy(F.col(customer).alias("customer")).agg(
        F.max(day).alias("_last"), F.count("*").alias("frequency"), money(amount).alias("monetary")
    ).select(
        "customer", F.datediff(last, F.col("_last")).alias("recency"), "frequency", "monetary"
    )


def scored_tile(df: DataFrame, value: str, key: str, out: str, tiles: int = 5, descending: bool = False) -> DataFrame:
    """Quantile group 1..tiles by global rank; ties are broken by the key."""
    ranked = global_rank(df, value, key, descending=descending, out="_rank")
    return ranked.withColumn(out, tile_of(F.col("_rank"), F.col("total"), tiles)).drop("_rank", "total")


def rfm_scores(base: DataFrame) -> DataFrame:
    """Scores 1..5 per dimension, 5 for the most recent, most frequent, highest paying."""
    out = hold(base)
    for value, score, down in (("recency", "r", True), ("frequency", "f", False), ("monetary", "m", False)):
        out = scored_tile(out, value, "customer", score, descending=down)
    return out


def concentration(base: DataFrame, tiles: int = 10) -> DataFrame:
    """Share of revenue held by each tenth of the customers, the best first."""
    base = hold(base)
    tiled = scored_tile(base, "monetary", "customer", "tile", tiles, descending=True)
    per = tiled.groupBy("tile").agg(F.count("*").alias("customers"), money("monetary").alias("revenue"))
    upto = Window.partitionBy().orderBy("tile").rowsBetween(Window.unboundedPreceding, 0)
    return per.withColumn(
        "cum_share", ratio(F.sum("revenue").over(upto) * 100, F.sum("revenue").over(Window.partitionBy()))
    )


def segments(base: DataFrame, k: int = 4, seed: int = 42) -> DataFrame:
    """k-means segments on standardised recency, frequency and revenue."""
    scaled = assemble(standardise(hold(base), RFM), [f"{c}_scaled" for c in RFM])
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="segment").fit(scaled)
    return model.transform(scaled).select("customer", *RFM, "segment")


def churn_labels(orders: DataFrame, customer: str, day: str, amount: str, horizon: int = 365) -> DataFrame:
    """RFM before a cut-off, and whether the customer stayed away for ``horizon`` days after."""
    cut = orders.agg(F.date_sub(F.max(day), horizon).alias("c")).scalar()
    marked = orders.withColumn("_cut", cut)
    before = rfm(marked.filter(F.col(day) <= F.col("_cut")), customer, day, amount)
    after = marked.filter(F.col(day) > F.col("_cut")).select(F.col(customer).alias("customer")).distinct()
    return before.join(after.withColumn("_back", F.lit(1)), "customer", "left").select(
        "customer", *RFM, F.col("_back").isNull().cast("int").alias("churned")
    )


def churn_model(labelled: DataFrame) -> DataFrame:
    """Churn probability per customer from a logistic regression on standardised RFM."""
    scaled = assemble(standardise(hold(labelled), RFM), [f"{c}_scaled" for c in RFM])
    model = LogisticRegression(labelCol="churned", regParam=0.01).fit(scaled)
    from pyspark.ml.functions import vector_to_array

    return model.transform(scaled).select(
        "customer", "churned", vector_to_array("probability")[1].alias("risk")
    )


def outlier_flags(df: DataFrame, group: str, value: str, width: float = 1.5) -> DataFrame:
    """Rows beyond the quartiles of their group by more than ``width`` IQR."""
    q = quantiles(df, [value], [0.25, 0.75], by=[group], names=["q1", "q3"]).select(group, "q1", "q3")
    spread = F.col("q3") - F.col("q1")
    odd = (F.col(value) < F.col("q1") - width * spread) | (F.col(value) > F.col("q3") + width * spread)
    return df.join(hold(q), group).withColumn("anomaly", odd).drop("q1", "q3")


def dimension(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Distinct members with a dense surrogate key in the order of a hash of the member.

    Members are few against the facts but unbounded, so the numbering is distributed.
    """
    members = df.select(*columns).distinct().withColumn(
        "_h", F.pmod(F.xxhash64(*columns), F.lit(1 << 52)).cast("double")
    )
    numbered = running_totals(members.withColumn("_one", F.lit(1)), ["_h", *columns], ["_one"])
    return numbered.select(F.col("cum__one").alias(key), *columns)


def with_key(facts: DataFrame, dim: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Replace the natural columns by the surrogate key; nulls match nulls."""
    on = F.lit(True)
    for c in columns:
        on = on & F.col(f"f.{c}").eqNullSafe(F.col(f"d.{c}"))
    keep = [F.col(f"f.{c}").alias(c) for c in facts.columns if c not in columns]
    return facts.alias("f").join(dim.alias("d"), on).select(*keep, F.col(f"d.{key}").alias(key))


def load_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Write a delivery; only the partitions it contains are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def quality_report(df: DataFrame, partition: str, key: str, checked: Sequence[str]) -> DataFrame:
    """Rows, repeated keys and missing values per partition."""
    per_key = df.groupBy(partition, key).agg(
        F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in checked]
    )
    return per_key.groupBy(partition).agg(
        F.sum("_n").alias("rows"), F.sum(F.col("_n") - 1).alias("repeated"),
        *[F.sum(f"_{c}").alias(f"null_{c}") for c in checked],
    )
