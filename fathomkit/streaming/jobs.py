"""Structured Streaming jobs; scoring and parsing are the functions the batch jobs use."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fathomkit.session import fresh_path

FILE_LINES = 500_000  # messages in a file

# --- sources -----------------------------------------------------------------------------
def read_lines(
    spark: SparkSession, fmt: str = "text", options: Mapping[str, str] | None = None, path: str | None = None
) -> DataFrame:
    """Stream with one ``value`` string per message; a broker is another ``fmt`` and options."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    raw = reader.load(path) if path else reader.load()
    return raw.select(F.col("value").cast("string").alias("value"))


def write_lines(messages: DataFrame, path: str) -> None:
    """Add messages to the files that ``read_lines`` reads, compressed; one file is read by one task, so it has at most
    ``FILE_LINES`` messages."""
    messages.write.mode("append").option("maxRecordsPerFile", FILE_LINES).text(path, compression="snappy")


def parse_json(raw: DataFrame, schema: str) -> DataFrame:
    return raw.select(F.from_json("value", schema).alias("d")).select("d.*")


def parse_csv(raw: DataFrame, schema: str, time: str = "timestamp") -> DataFrame:
    rows = raw.select(F.from_csv("value", schema).alias("d")).select("d.*")
    return rows.withColumn(time, F.to_timestamp(time))


def json_message(columns: Sequence[str]):
    return F.to_json(F.struct(*columns)).alias("value")


# --- transformations ---------------------------------------------------------------------
def above(df: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """Rows in which every listed column exceeds its limit."""
    return df.filter(reduce(and_, (F.col(c) > limit for c, limit in limits.items())))


def watermarked(df: DataFrame, time: str = "timestamp", delay: str = "5 minutes") -> DataFrame:
    return df.withWatermark(time, delay)


def windowed(
    df: DataFrame, measures: Sequence[Column], width: str, slide: str | None = None, time: str = "timestamp",
    by: Sequence[str] = (),
) -> DataFrame:
    """The given aggregates per time window (and key); windows slide if ``slide`` is given."""
    return df.groupBy(F.window(time, width, slide), *by).agg(*measures)


def flat_window(df: DataFrame) -> DataFrame:
    """Window bounds as plain columns, which every file format can hold."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


# --- sinks -------------------------------------------------------------------------------
def to_files(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", every: str | None = None
) -> StreamingQuery:
    """Append to files; ``every`` sets a processing-time trigger, else what is there is drained. Text is compressed."""
    writer = df.writeStream.outputMode("append").format(fmt).option("path", path).option(
        "checkpointLocation", checkpoint
    )
    if fmt == "csv":
        writer = writer.option("header", True).option("compression", "gzip")
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def to_latest(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Complete result as a table: each batch writes the whole result to a folder of its own, by batch number, so a
    batch that is repeated after a failure replaces itself. ``latest`` reads the last one."""

    def replace(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return df.writeStream.outputMode("complete").foreachBatch(replace).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start()


def latest(spark: SparkSession, path: str) -> DataFrame:
    """What ``to_latest`` wrote last."""
    batches = spark.read.parquet(path)
    return batches.filter(F.col("batch") == batches.agg(F.max("batch")).scalar()).drop("batch")


def drain(*queries: StreamingQuery) -> None:
    """Wait for draining queries; a failure of any of them stops the others and is raised."""
    try:
        for q in queries:
            q.awaitTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def drained(df: DataFrame, label: str, fmt: str = "parquet") -> DataFrame:
    """Run a stream over what its source holds now and read its sink back."""
    spark = df.sparkSession
    path, checkpoint = fresh_path(spark, label), fresh_path(spark, f"{label}-checkpoint")
    drain(to_files(df, path, checkpoint, fmt))
    reader = spark.read.schema(df.schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def await_any(spark: SparkSession, timeout: float | None = None) -> bool:
    """Block until one of the running queries ends (long-running deployments)."""
    spark.streams.resetTerminated()
    return bool(spark.streams.awaitAnyTermination(timeout)) if timeout else bool(
        spark.streams.awaitAnyTermination()
    )
