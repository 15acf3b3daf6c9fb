import glob

import pytest
from pyspark.sql import functions as F

from fathomkit.functions.scoring import alerts, score_transactions
from fathomkit.session import fresh_path
from fathomkit.streaming import jobs as st

TX_SCHEMA = (
    "transaction_id bigint, timestamp string, Time double, Amount double, Class int, V3 double, V12 double, V14 double"
)
READING = "timestamp string, event_id bigint, temperature double, humidity double, eco2 int, pm2_5 double, fire_alarm int"
TX = [
    (1, "t", 0.0, 5.0, 0, 0.0, 0.0, -10.5), (2, "t", 1.0, 5.0, 0, 0.0, 11.0, 0.0),
    (3, "t", 2.0, 0.5, 1, 0.0, 0.0, 10.0), (4, "t", 3.0, 1.0, 0, 0.0, -10.0, 0.0), (5, "t", 4.0, 0.2, 1, 0.0, 12.0, 12.0),
]


def test_scoring_is_first_match_in_stream_and_batch(spark):
    df = spark.createDataFrame(TX, TX_SCHEMA)
    want = {1: "HIGH_V14", 2: "HIGH_V12", 3: "MICRO_AMOUNT", 4: "NORMAL", 5: "HIGH_V14"}
    batch = score_transactions(df)
    assert {r["transaction_id"]: r["RuleFlag"] for r in batch.collect()} == want
    inbox = fresh_path(spark, "inbox")
    df.select(st.json_message(df.columns)).write.text(inbox)
    stream = score_transactions(st.parse_json(st.read_lines(spark, path=inbox), TX_SCHEMA))
    assert stream.isStreaming
    got = st.drained(alerts(stream), "alerts")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in alerts(batch).collect()}


def test_unreadable_messages_become_nulls(spark):
    inbox = fresh_path(spark, "inbox")
    spark.createDataFrame([("not json",), ('{"transaction_id": 7}',)], "value string").write.text(inbox)
    got = st.drained(st.parse_json(st.read_lines(spark, path=inbox), TX_SCHEMA), "parsed")
    assert sorted(str(r["transaction_id"]) for r in got.collect()) == ["7", "None"]


def test_a_restarted_job_goes_on_where_it_stopped(spark):
    inbox, out, mark = (fresh_path(spark, n) for n in ("inbox", "out", "mark"))
    for k in range(3):
        spark.createDataFrame([(f"2024-01-01 00:0{k}:00,{k},20,1,1,1,{k % 2}",)], "value string").write.mode("append").text(inbox)
        rows = st.parse_csv(st.read_lines(spark, path=inbox), READING)
        st.drain(st.to_files(rows.filter("fire_alarm = 1"), out, mark, "csv"))
    got = spark.read.schema(rows.schema).option("header", True).csv(out)
    assert [r["event_id"] for r in got.collect()] == [1]


def test_a_failing_query_is_raised(spark):
    inbox = fresh_path(spark, "inbox")
    spark.createDataFrame([("a",)], "value string").write.text(inbox)
    broken = st.read_lines(spark, path=inbox).select(F.raise_error(F.lit("boom")).cast("string").alias("v"))
    with pytest.raises(Exception, match="boom"):
        st.drained(broken, "broken")


def test_await_any_returns_when_a_query_ends(spark):
    inbox = fresh_path(spark, "inbox")
    spark.createDataFrame([("a",)], "value string").write.text(inbox)
    q = st.to_files(st.read_lines(spark, path=inbox), fresh_path(spark, "o"), fresh_path(spark, "c"))
    q.awaitTermination()
    st.await_any(spark, timeout=1)
    assert not q.isActive


def test_messages_and_csv_sinks_are_compressed(spark, monkeypatch):
    """Text takes much of what a job writes; a message file has few enough lines for one task."""
    monkeypatch.setattr(st, "FILE_LINES", 1_000)
    inbox, out = fresh_path(spark, "inbox"), fresh_path(spark, "sink")
    st.write_lines(spark.range(5_000).coalesce(1).select(F.format_string('{"a": %d}', "id").alias("value")), inbox)
    assert len(glob.glob(f"{inbox}/part-*.txt.snappy")) == 5
    rows = st.parse_json(st.read_lines(spark, path=inbox), "a bigint")
    st.drain(st.to_files(rows, out, fresh_path(spark, "sink-checkpoint"), "csv"))
    assert glob.glob(f"{out}/part-*.csv.gz") and not glob.glob(f"{out}/part-*.csv")
    assert sorted(r.a for r in spark.read.schema("a bigint").option("header", True).csv(out).collect()) == list(range(5_000))
