"""Equi-joins with the null rules of their sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = ()
) -> DataFrame:
    """Left join on ``keys``; for the ``null_safe`` ones a null matches a null.

    Both kinds are equality keys to Spark, so the join stays a hash or sort-merge join, and
    adaptive execution may broadcast a side that turns out small or split a skewed one.
    """
    on = F.lit(True)
    for k in keys:
        a, b = F.col(f"l.{k}"), F.col(f"r.{k}")
        on = on & (a.eqNullSafe(b) if k in null_safe else a == b)
    extra = [F.col(f"r.{c}").alias(c) for c in right.columns if c not in keys]
    return left.alias("l").join(right.alias("r"), on, "left").select(
        *[F.col(f"l.{c}").alias(c) for c in left.columns], *extra
    )


def compatible_left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], shared: str
) -> DataFrame:
    """Left join where ``shared`` may be unbound (null) on the left: null fits any value.

    Bound and unbound rows are joined apart, each on plain equality keys, which keeps both
    joins hash joins; the shared column takes the right side's value where it was unbound.
    """
    extra = [c for c in right.columns if c not in keys and c != shared]
    bound = left.filter(F.col(shared).isNotNull())
    unbound = left.filter(F.col(shared).isNull()).drop(shared)
    a = left_join(bound, right, [*keys, shared])
    b = left_join(unbound, right, list(keys))
    cols = [*left.columns, *extra]
    return a.select(*cols).unionByName(b.select(*cols))
