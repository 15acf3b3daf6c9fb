"""First-match rule scoring, the same code for batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NORMAL = "NORMAL"


def rules(v_limit: float, micro_amount: float) -> list[tuple[str, str, Column]]:
    """(flag, alert level, condition) in the order they are tried.

    Fixed values: the names, and by default a limit of 10 on |V14| and |V12| and amounts below 1.
    """
    return [
        ("HIGH_V14", "HIGH", F.abs("V14") > v_limit),
        ("HIGH_V12", "HIGH", F.abs("V12") > v_limit),
        ("MICRO_AMOUNT", "MEDIUM", F.col("Amount") < micro_amount),
    ]


def score_transactions(
    df: DataFrame, v_limit: float = 10.0, micro_amount: float = 1.0
) -> DataFrame:
    """Add ``RuleFlag`` and ``AlertLevel`` of the first rule that fires."""
    hit = None
    for flag, level, fires in rules(v_limit, micro_amount):
        outcome = F.struct(F.lit(flag).alias("f"), F.lit(level).alias("l"))
        hit = (F if hit is None else hit).when(fires, outcome)
    hit = hit.otherwise(F.struct(F.lit(NORMAL).alias("f"), F.lit(NORMAL).alias("l")))
    return df.select("*", hit["f"].alias("RuleFlag"), hit["l"].alias("AlertLevel"))


def alerts(scored: DataFrame) -> DataFrame:
    """Rows that need attention, cut down to what an analyst reads."""
    return scored.filter(F.col("RuleFlag") != NORMAL).select(
        "transaction_id", "timestamp", "Amount", "RuleFlag", "AlertLevel", "Class"
    )
