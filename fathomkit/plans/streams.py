"""Streaming jobs, each checked against the batch answer.

The messages are written from the tables by Spark, then streamed to a file sink and read
back, the way a broker-fed job would run.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomkit.functions.scalars import rd
from fathomkit.functions.scoring import alerts, score_transactions
from fathomkit.plans.inputs import SCORED, SENSORS, TRANSACTIONS, sensors, transactions
from fathomkit.plans.registry import query, rsql
from fathomkit.session import fresh_path
from fathomkit.streaming import jobs as st

AT = "yyyy-MM-dd HH:mm:ss"

# The message formats. A transaction has 28 components V1 to V28.
COMPONENTS = [f"V{i}" for i in range(1, 29)]
TRANSACTION_SCHEMA = "transaction_id bigint, timestamp string, Time double, " + "".join(
    f"{c} double, " for c in COMPONENTS) + "Amount double, Class int"
TX_COLUMNS = ["transaction_id", "timestamp", "Time", *COMPONENTS, "Amount", "Class"]
SENSOR_SCHEMA = (
    "timestamp string, temperature double, humidity double, tvoc int, eco2 int, raw_h2 int, raw_ethanol int, "
    "pressure double, pm1_0 double, pm2_5 double, nc0_5 double, nc1_0 double, nc2_5 double, cnt int, fire_alarm int, "
    "event_id bigint"
)
CSV_COLUMNS = [field.split()[0] for field in SENSOR_SCHEMA.split(", ")[1:]]
WHOLE = {field.split()[0] for field in SENSOR_SCHEMA.split(", ") if field.endswith(" int")}

# The columns of the two window reports (name, aggregate, column, digits) and the limits of high risk.
SUMMARY = [
    ("record_count", "count", "*", None), ("avg_temperature", "avg", "temperature", 2),
    ("avg_humidity", "avg", "humidity", 2), ("avg_pm2_5", "avg", "pm2_5", 2), ("avg_eco2", "avg", "eco2", 2),
    ("max_temperature", "max", "temperature", 2), ("min_temperature", "min", "temperature", 2),
    ("fire_alarm_count", "sum", "fire_alarm", None),
]
RATE = [
    ("total_records", "count", "*", None), ("fire_alarms", "sum", "fire_alarm", None),
    ("alarm_rate", "avg", "fire_alarm", 4), ("avg_temp", "avg", "temperature", 2), ("avg_pm2_5", "avg", "pm2_5", 2),
]
RISK = {"temperature": 50, "eco2": 50, "pm2_5": 50}
FIRE_COLUMNS = ["timestamp", "temperature", "humidity", "pm2_5", "eco2", "tvoc", "fire_alarm", "event_id"]


def measures(report):
    """The aggregates of a report as columns."""
    plain = [(name, getattr(F, how)(column), digits) for name, how, column, digits in report]
    return [(c if digits is None else rd(c, digits)).alias(name) for name, c, digits in plain]


def measures_sql(report):
    """The same in SQL."""
    parts = []
    for name, how, column, digits in report:
        call = f"{how}({column})"
        parts.append(f"{f'CAST({call} AS BIGINT)' if digits is None else rsql(call, digits)} AS {name}")
    return ", ".join(parts)


def wide_transactions(spark, sf_dir):
    """Transactions with all components; those without a rule of their own follow from the part key."""
    tx = transactions(spark, sf_dir)
    more = [((F.col("l_partkey") * i % 97 - 48) / 16.0).alias(f"V{i}") for i in _DERIVED]
    return tx.select("*", *more)


_DERIVED = [i for i in range(1, 29) if i not in (3, 12, 14)]
WIDE = f"""{TRANSACTIONS}, wide AS (SELECT *, {", ".join(f'(l_partkey * {i} % 97 - 48) / 16.0 AS "V{i}"' for i in _DERIVED)} FROM tx)"""


def _json_messages(spark, sf_dir):
    path = fresh_path(spark, "messages")
    st.write_lines(wide_transactions(spark, sf_dir).select(st.json_message(TX_COLUMNS)), path)
    return st.parse_json(st.read_lines(spark, path=path), TRANSACTION_SCHEMA)


def _line():
    return F.concat_ws(
        ",", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        *[F.col(c).cast("int" if c in WHOLE else "string").cast("string") for c in CSV_COLUMNS],
    ).alias("value")


def _sensor_stream(spark, sf_dir):
    path = fresh_path(spark, "readings")
    st.write_lines(sensors(spark, sf_dir).select(_line()), path)
    return st.parse_csv(st.read_lines(spark, path=path), SENSOR_SCHEMA)


def _bounds(df):
    return df.withColumns({c: F.date_format(c, AT) for c in ("window_start", "window_end")})


_TX = ", ".join(f'"{c}"' for c in TX_COLUMNS)
_STAMP = "strftime(ts, '%Y-%m-%d %H:%M:%S') AS \"timestamp\""


def _readings_sql(columns):
    return ", ".join(_STAMP if c == "timestamp" else f"CAST({c} AS INTEGER) AS {c}" if c in WHOLE else c for c in columns)


def _stamped(df):
    return df.withColumn("timestamp", F.date_format("timestamp", AT))


@query("n01_json_stream", f"WITH {WIDE} SELECT {_TX} FROM wide")
def n01(spark, sf_dir):
    return st.drained(_json_messages(spark, sf_dir), "parsed")


@query("n02_csv_stream", f"""WITH {SENSORS} SELECT {_readings_sql(["timestamp", *CSV_COLUMNS])} FROM sensors""")
def n02(spark, sf_dir):
    return _stamped(st.drained(_sensor_stream(spark, sf_dir), "readings-out"))


@query("n03_scored_stream", f"""WITH {SCORED} SELECT transaction_id, "Amount", "RuleFlag", "AlertLevel", "Class" FROM scored""")
def n03(spark, sf_dir):
    return st.drained(score_transactions(_json_messages(spark, sf_dir)), "scored").select(
        "transaction_id", "Amount", "RuleFlag", "AlertLevel", "Class"
    )


@query("n04_alert_stream", f"""WITH {SCORED}
SELECT transaction_id, "timestamp", "Amount", "RuleFlag", "AlertLevel", "Class" FROM scored WHERE "RuleFlag" <> 'NORMAL'""")
def n04(spark, sf_dir):
    return st.drained(alerts(score_transactions(_json_messages(spark, sf_dir))), "alerts")


@query("n05_audit_stream", f"""WITH {SCORED}, wide AS (
SELECT *, {", ".join(f'(l_partkey * {i} % 97 - 48) / 16.0 AS "V{i}"' for i in _DERIVED)} FROM scored)
SELECT {_TX}, "RuleFlag", "AlertLevel" FROM wide""")
def n05(spark, sf_dir):
    return st.drained(score_transactions(_json_messages(spark, sf_dir)), "audit", "csv")


@query("n06_watermark_drops_late", f"""WITH {SENSORS}, m AS (SELECT max(ts) AS t FROM sensors WHERE event_id % 10 <> 3),
k AS (SELECT s.*, event_id % 10 = 3 AND ts < t - INTERVAL 1 DAY AS late FROM sensors s, m)
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS total_records,
       CAST(sum(fire_alarm) AS BIGINT) AS fire_alarms FROM k, m WHERE NOT late
GROUP BY 1, time_bucket(INTERVAL 1 HOUR, ts)
HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM sensors) - INTERVAL 5 MINUTE""")
def n06(spark, sf_dir):
    """Two deliveries to one checkpointed job; what comes a day late in the second is dropped."""
    inbox, out = fresh_path(spark, "inbox"), fresh_path(spark, "hourly")
    checkpoint = fresh_path(spark, "hourly-checkpoint")
    newest = sensors(spark, sf_dir).filter("event_id % 10 <> 3").agg(F.max("ts")).scalar()
    tagged = sensors(spark, sf_dir).withColumn(
        "late", (F.col("event_id") % 10 == 3) & (F.col("ts") < newest - F.expr("interval 1 day"))
    )
    for late in (False, True):
        st.write_lines(tagged.filter(F.col("late") == late).select(_line()), inbox)
        rows = st.watermarked(st.parse_csv(st.read_lines(spark, path=inbox), SENSOR_SCHEMA))
        st.drain(st.to_files(
            st.flat_window(st.windowed(rows, measures(RATE), "1 hour")), out, checkpoint
        ))
    return spark.read.parquet(out).select(
        F.date_format("window_start", AT).alias("window_start"), "total_records", "fire_alarms"
    )


_SUMMARY = f"""{SENSORS}, w AS (
SELECT time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE * i AS a, sensors.* FROM sensors, (SELECT unnest([0, 1]) AS i)),
win AS (SELECT strftime(a, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(a + INTERVAL 10 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
  {measures_sql(SUMMARY)},
  a + INTERVAL 10 MINUTE AS closes FROM w GROUP BY a)"""
_CLOSED = "closes <= (SELECT max(ts) FROM sensors) - INTERVAL 5 MINUTE"


def _summary(spark, sf_dir):
    rows = st.watermarked(_sensor_stream(spark, sf_dir))
    return st.flat_window(st.windowed(rows, measures(SUMMARY), "10 minutes", "5 minutes"))


@query("n07_sliding_windows", f"WITH {_SUMMARY} SELECT * EXCLUDE (closes) FROM win WHERE {_CLOSED}")
def n07(spark, sf_dir):
    return _bounds(st.drained(_summary(spark, sf_dir), "summary"))


_RATE = f"""{SENSORS}, win AS (SELECT strftime(time_bucket(INTERVAL 1 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
  {measures_sql(RATE)}, time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS closes
  FROM sensors GROUP BY time_bucket(INTERVAL 1 MINUTE, ts))"""


@query("n08_tumbling_windows", f"WITH {_RATE} SELECT * EXCLUDE (closes) FROM win WHERE {_CLOSED}")
def n08(spark, sf_dir):
    rows = st.watermarked(_sensor_stream(spark, sf_dir))
    return _bounds(st.drained(st.flat_window(st.windowed(rows, measures(RATE), "1 minute")), "rate"))


_RISKY = " AND ".join(f"{c} > {limit}" for c, limit in RISK.items())


@query("n09_fire_event_stream", f"""WITH {SENSORS} SELECT {_readings_sql(FIRE_COLUMNS)} FROM sensors WHERE fire_alarm = 1""")
def n09(spark, sf_dir):
    wanted = _sensor_stream(spark, sf_dir).filter("fire_alarm = 1").select(*FIRE_COLUMNS)
    return _stamped(st.drained(wanted, "fire", "csv"))


@query("n10_high_risk_stream", f"""WITH {SENSORS} SELECT {_readings_sql(FIRE_COLUMNS)}, 'HIGH' AS risk_level
FROM sensors WHERE {_RISKY}""")
def n10(spark, sf_dir):
    wanted = st.above(_sensor_stream(spark, sf_dir), RISK).select(*FIRE_COLUMNS, F.lit("HIGH").alias("risk_level"))
    return _stamped(st.drained(wanted, "risk", "csv"))


@query("n11_append_windows_csv", f"WITH {_SUMMARY} SELECT window_start, window_end, record_count, fire_alarm_count FROM win WHERE {_CLOSED}")
def n11(spark, sf_dir):
    return _bounds(st.drained(_summary(spark, sf_dir), "summary-csv", "csv")).select(
        "window_start", "window_end", "record_count", "fire_alarm_count"
    )


@query("n12_complete_windows", f"WITH {_SUMMARY} SELECT * EXCLUDE (closes) FROM win")
def n12(spark, sf_dir):
    path = fresh_path(spark, "summary-latest")
    st.drain(st.to_latest(_summary(spark, sf_dir), path, fresh_path(spark, "summary-checkpoint")))
    return _bounds(st.latest(spark, path))


@query("n13_concurrent_queries", f"""WITH {SENSORS}, w AS (SELECT DISTINCT time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS closes FROM sensors)
SELECT 'fire' AS sink, count(*) AS n FROM sensors WHERE fire_alarm = 1
UNION ALL SELECT 'risk', count(*) FROM sensors WHERE temperature > 50 AND eco2 > 50 AND pm2_5 > 50
UNION ALL SELECT 'rate', count(*) FROM w WHERE {_CLOSED}""")
def n13(spark, sf_dir):
    rows = _sensor_stream(spark, sf_dir)
    made = {
        "fire": rows.filter("fire_alarm = 1"),
        "risk": st.above(rows, RISK),
        "rate": st.flat_window(st.windowed(st.watermarked(rows), measures(RATE), "1 minute")),
    }
    paths = {k: fresh_path(spark, k) for k in made}
    st.drain(*[
        st.to_files(df, paths[k], fresh_path(spark, f"{k}-checkpoint")) for k, df in made.items()
    ])
    counts = [
        spark.read.schema(df.schema).parquet(paths[k]).agg(F.count("*").alias("n")).select(
            F.lit(k).alias("sink"), "n"
        ) for k, df in made.items()
    ]
    return counts[0].union(counts[1]).union(counts[2])
