"""Where the query modules put their jobs and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    """Register a job; ``sql`` is its equivalent over the same tables."""

    def add(job: Job) -> Job:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = job
        if sql is not None:
            ORACLES[name] = sql
        return job

    return add


def rsql(expr: str, digits: int) -> str:
    """SQL twin of ``functions.scalars.rd``."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38,9)), {digits}) AS DOUBLE)"
