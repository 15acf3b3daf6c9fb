"""Where the modules of this subpackage register their queries and the SQL that checks them."""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomkit.session import hold

SCORED_ROWS = 1_000
SAMPLE_CHARS = 40_000_000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a job of this subpackage; ``sql`` is its equivalent over the same tables."""

    def add(job):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = job
        if sql is not None:
            ORACLES[name] = sql
        return job

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_sample(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows with the smallest hash of doc_id, or all if there are fewer; give it narrow rows.

    Rows are first thinned by the hash to little more than ``n``, so that what meets in one task does not follow the
    input.
    """
    total = rows.count()
    share = min(1.0, (n + 10 * n ** 0.5) / max(total, 1))
    few = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < F.lit(math.ceil(share * (1 << 40))))
    return few.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def sampled_texts(docs: DataFrame, ids: DataFrame, most_chars: int = SAMPLE_CHARS) -> DataFrame:
    """One row of ``docs`` (doc_id, text and others) for each of the few ``ids``, so that an id on many rows brings one
    of its texts (the one with the smallest hash), and at most ``most_chars`` characters in all.

    Whole texts only: those beyond a fiftieth of ``most_chars`` take no part, of the others as many as fit by hash of id.
    """
    rows = docs.join(F.broadcast(hold(ids)), "doc_id")
    rest = [c for c in rows.columns if c != "doc_id"]
    one = rows.groupBy("doc_id").agg(F.min_by(F.struct(*rest), F.xxhash64(*rest)).alias("row")).select("doc_id", "row.*")
    size = F.coalesce(F.length("text"), F.lit(0))
    fitting = hold(one.withColumn("size", size).where(F.col("size") <= most_chars // 50))
    so_far = F.sum("size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    return fitting.withColumn("so_far", so_far).where(F.col("so_far") <= most_chars).select("doc_id", *rest)


def every(df: DataFrame) -> list:
    """All columns of ``df``, whatever their names hold."""
    return [F.col(f"`{c}`") for c in df.columns]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer by as many underscores as it takes to be none of the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_scored_text(docs: DataFrame, name: str, kind: T.DataType, make) -> DataFrame:
    """``docs`` with a further column: ``make()`` is called in each task, its result on the texts of ``SCORED_ROWS`` rows
    at a time (null as empty), and gives an Arrow array."""
    place = docs.columns.index("text")
    plain = [f"c{i}" for i in range(len(docs.columns))]  # Spark's Arrow functions take no names with dots
    fields = [T.StructField(c, f.dataType) for c, f in zip(plain, docs.schema)]

    def run(batches):
        score = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SCORED_ROWS):
                part = batch.slice(at, SCORED_ROWS)
                texts = [t or "" for t in part.column(place).cast(pa.string()).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, score(texts)], names=[*plain, "more"])

    out = docs.toDF(*plain).mapInArrow(run, T.StructType([*fields, T.StructField("more", kind)]))
    return out.toDF(*docs.columns, name)
