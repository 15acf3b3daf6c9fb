"""Every job with an SQL twin must give the same rows, and no plan may pair all rows."""

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from __spark_entry__ import entry, oracle_sql, queries
from tests.check import compare, duck, rows_of

JOBS, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(name, spark, con, sf, monkeypatch):
    plans, write = [], DataFrameWriter.parquet

    def noted(self, *args, **kwargs):  # tables that are written on the way count as well
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)

    def job(s, d):
        df = JOBS[name](s, d)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    want, got = compare(spark, con, job, SQL[name], sf)
    assert got[0] == want[0]
    assert got[1] == want[1]
    for plan in plans:
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_every_oracle_has_a_job():
    assert set(SQL) <= set(JOBS)


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.columns == ["RuleFlag", "AlertLevel", "Class", "n"]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()])[1]


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = JOBS["a03_parquet_scan"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,25.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double>" in plan
