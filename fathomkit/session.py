"""Session defaults and the shared folder that jobs may write to."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

def build_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Local session for tests and benchmarks; a cluster passes its own."""
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        **extra,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("fathomkit")
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only where the cluster names none (tests, local mode) a folder is made here.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        named = tempfile.mkdtemp(prefix="fathomkit-")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


_scopes: list[list[str]] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    path = f"{shared_dir(spark)}/fathomkit/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is held inside is deleted at the end; results that are to stay must be written out before."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def hold(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back: lineage is cut, nothing recomputes.

    A table survives the loss of executors, and its known size lets Spark plan the joins.
    """
    path = fresh_path(df.sparkSession, "held")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def held_for(df: DataFrame) -> Iterator[DataFrame]:
    """``hold`` whose files are deleted at the end of the block."""
    path = fresh_path(df.sparkSession, "held")
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
