"""Projection, filter and cleaning jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomkit.functions.scalars import (
    CRIME_GROUPS, RACE_GROUPS, bucket_recode, month_number, rd, recode, season, to_number, yes_flag,
)
from fathomkit.functions.scoring import score_transactions
from fathomkit.operators import clean
from fathomkit.plans.inputs import (
    SALES, SCORED, SENSORS, STOP_FLAGS, STOPS, features, sales, sensors, stops, table, transactions,
)
from fathomkit.plans.joining import weekly
from fathomkit.plans.registry import query, rsql
from fathomkit.session import hold

CLEAN_STOPS = STOPS + "," + """
nulled AS (SELECT stop_id, """ + ", ".join(
    f"CASE WHEN {c} IN ('(null)', '#N/A', '') THEN NULL ELSE {c} END AS {c}"
    for c in ("month_text", "arrested_flag", "frisked_flag", "weapon_flag", "crime_text",
              "race_text", "sex_text", "age_text", "boro_text", "precinct_text", "initiated_text", *STOP_FLAGS)
) + " FROM stops)"


@query("b01_compare_filter", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000""")
def b01(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter(
        (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)
    ).select("o_orderkey", "o_totalprice")


@query("b02_member_filter", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def b02(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    ).select("o_orderkey", "o_orderpriority")


@query("b03_range_filter",
       "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 30")
def b03(spark, sf_dir):
    return table(spark, sf_dir, "part").filter(F.col("p_size").between(10, 30)).select(
        "p_partkey", "p_size"
    )


@query("b04_high_risk_filter", f"""WITH {SENSORS}
SELECT event_id, temperature, eco2, pm2_5, 'HIGH' AS risk_level FROM sensors
WHERE temperature > 50 AND eco2 > 50 AND pm2_5 > 50""")
def b04(spark, sf_dir):
    from fathomkit.streaming.jobs import above

    return above(sensors(spark, sf_dir), {"temperature": 50, "eco2": 50, "pm2_5": 50}).select(
        "event_id", "temperature", "eco2", "pm2_5", F.lit("HIGH").alias("risk_level")
    )


@query("b05_drop_null_keys", f"""WITH {CLEAN_STOPS}
SELECT stop_id, month_text, crime_text FROM nulled
WHERE month_text IS NOT NULL AND crime_text IS NOT NULL""")
def b05(spark, sf_dir):
    return clean.clean_sentinels(stops(spark, sf_dir)).dropna(
        subset=["month_text", "crime_text"]
    ).select("stop_id", "month_text", "crime_text")


@query("b06_sentinels_to_null", f"WITH {CLEAN_STOPS} SELECT * FROM nulled")
def b06(spark, sf_dir):
    return clean.clean_sentinels(stops(spark, sf_dir))


@query("b07_yes_flags", f"""WITH {CLEAN_STOPS}
SELECT stop_id, CASE WHEN arrested_flag = 'Y' THEN 1 ELSE 0 END AS y,
       CASE WHEN frisked_flag = 'Y' THEN 1 ELSE 0 END AS frisked_bin,
       CASE WHEN weapon_flag = 'Y' THEN 1 ELSE 0 END AS weapon_found_bin,
       CASE WHEN sex_text = 'MALE' THEN 1 ELSE 0 END AS male_bin FROM nulled""")
def b07(spark, sf_dir):
    return clean.clean_sentinels(stops(spark, sf_dir)).select(
        "stop_id", yes_flag("arrested_flag").alias("y"),
        yes_flag("frisked_flag").alias("frisked_bin"),
        yes_flag("weapon_flag").alias("weapon_found_bin"),
        yes_flag("sex_text", "MALE").alias("male_bin"),
    )


@query("b08_coercing_cast", f"""WITH {STOPS}
SELECT stop_id, TRY_CAST(age_text AS DOUBLE) AS age_num FROM stops""")
def b08(spark, sf_dir):
    return stops(spark, sf_dir).select("stop_id", to_number("age_text").alias("age_num"))


@query("b09_recode_default", f"""WITH {STOPS}
SELECT stop_id, CASE race_text WHEN 'BLACK' THEN 'Black' WHEN 'WHITE HISPANIC' THEN 'White Hispanic'
       WHEN 'BLACK HISPANIC' THEN 'Black Hispanic' WHEN 'WHITE' THEN 'White' ELSE 'Other' END AS race_grp
FROM stops""")
def b09(spark, sf_dir):
    return stops(spark, sf_dir).select("stop_id", recode("race_text", RACE_GROUPS).alias("race_grp"))


@query("b10_bucket_recode", f"""WITH {STOPS}
SELECT stop_id, CASE WHEN crime_text IN ('CPW', 'POSSESSION OF WEAPON') THEN 'Weapon'
  WHEN crime_text IN ('ROBBERY', 'BURGLARY', 'GRAND LARCENY AUTO', 'GRAND LARCENY', 'PETIT LARCENY')
    THEN 'Property/Theft'
  WHEN crime_text IN ('ASSAULT', 'CRIMINAL MISCHIEF') THEN 'Violence'
  WHEN crime_text = 'CRIMINAL TRESPASS' THEN 'Trespass' ELSE 'Other' END AS crime_grp FROM stops""")
def b10(spark, sf_dir):
    return stops(spark, sf_dir).select(
        "stop_id", bucket_recode("crime_text", CRIME_GROUPS).alias("crime_grp")
    )


@query("b11_month_season", f"""WITH {STOPS}, m AS (
SELECT stop_id, list_position(['January','February','March','April','May','June','July','August',
  'September','October','November','December'], month_text) AS month_num FROM stops)
SELECT stop_id, month_num, CASE WHEN month_num IN (12,1,2) THEN 'Winter'
  WHEN month_num IN (3,4,5) THEN 'Spring' WHEN month_num IN (6,7,8) THEN 'Summer'
  ELSE 'Autumn' END AS season FROM m WHERE month_num IS NOT NULL AND month_num > 0""")
def b11(spark, sf_dir):
    return (
        stops(spark, sf_dir)
        .select("stop_id", month_number("month_text").alias("month_num"))
        .filter("month_num IS NOT NULL")
        .withColumn("season", season("month_num"))
    )


@query("b12_rule_scoring", f"""WITH {SCORED}
SELECT transaction_id, l_linenumber, "Amount", "RuleFlag", "AlertLevel" FROM scored""")
def b12(spark, sf_dir):
    return score_transactions(transactions(spark, sf_dir)).select(
        "transaction_id", "l_linenumber", "Amount", "RuleFlag", "AlertLevel"
    )


@query("b13_fill_zero", f"""WITH {SALES}
SELECT "Store", strftime("Date", '%Y-%m-%d') AS d, coalesce("MarkDown1", 0.0) AS md1,
       coalesce("MarkDown2", 0.0) AS md2 FROM features""")
def b13(spark, sf_dir):
    return features(spark, sf_dir).fillna(0.0, ["MarkDown1", "MarkDown2"]).select(
        "Store", F.date_format("Date", "yyyy-MM-dd").alias("d"),
        F.col("MarkDown1").alias("md1"), F.col("MarkDown2").alias("md2"),
    )


@query("b14_fill_median", f"""WITH {SALES}
SELECT "Row", {rsql('coalesce("CPI", (SELECT quantile_cont("CPI", 0.5) FROM weekly))', 4)} AS cpi
FROM weekly""")
def b14(spark, sf_dir):
    joined = hold(weekly(spark, sf_dir).select("Row", "CPI"))
    return clean.fill_median(joined, ["CPI"]).select("Row", rd("CPI", 4).alias("cpi"))


@query("b15_null_exactly_k", f"""WITH {SALES},
med AS (SELECT count(*) AS n FROM sales)
SELECT n AS "rows", 500 AS nulls, n - 500 AS kept_equal FROM med""")
def b15(spark, sf_dir):
    """Counts that hold for any choice of rows: exactly 500 nulls, all others unchanged."""
    base = sales(spark, sf_dir).select("Row", "Weekly_Sales")
    holed = clean.null_exactly(base, "Weekly_Sales", ["Row"], 500)
    both = base.withColumnRenamed("Weekly_Sales", "before").join(holed, "Row")
    return both.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("Weekly_Sales").isNull()).cast("int").alias("nulls"),
        F.count_if(F.col("Weekly_Sales") == F.col("before")).alias("kept_equal"),
    )


_CAPS = """
c AS (SELECT value AS v FROM events),
q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM c),
k AS (SELECT v, q1 - {w} * (q3 - q1) AS lo, q3 + {w} * (q3 - q1) AS hi FROM c, q)
"""


@query("b16_cap_outliers", f"""WITH {_CAPS.format(w=3.0)}
SELECT count(*) AS "rows", CAST(sum(CASE WHEN v < lo OR v > hi THEN 1 ELSE 0 END) AS BIGINT) AS capped,
       {rsql("max(greatest(least(v, hi), lo))", 3)} AS max_v,
       {rsql("avg(greatest(least(v, hi), lo))", 3)} AS mean_v FROM k""")
def b16(spark, sf_dir):
    base = table(spark, sf_dir, "events").select(F.col("value").alias("v"))
    return clean.cap_outliers(base, ["v"]).agg(
        F.count("*").alias("rows"), F.sum("v_capped").alias("capped"),
        rd(F.max("v"), 3).alias("max_v"), rd(F.avg("v"), 3).alias("mean_v"),
    )


@query("b17_dummies", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS status_o,
       CASE WHEN o_orderstatus = 'P' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS status_p FROM orders""")
def b17(spark, sf_dir):
    return clean.dummies(
        table(spark, sf_dir, "orders"),
        {"status_o": ("o_orderstatus", "O"), "status_p": ("o_orderstatus", "P")},
    ).select("o_orderkey", "status_o", "status_p")


@query("b18_project_rename", """
SELECT c_custkey AS customer_id, c_mktsegment AS segment, c_acctbal AS balance FROM customer""")
def b18(spark, sf_dir):
    return table(spark, sf_dir, "customer").withColumnsRenamed(
        {"c_custkey": "customer_id", "c_mktsegment": "segment", "c_acctbal": "balance"}
    ).select("customer_id", "segment", "balance")


@query("b19_null_counts", f"""WITH {SALES}
""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS nulls FROM weekly"""
    for c in ("Row", "IsHoliday", "Type", "Size", "Temperature", "MarkDown1", "MarkDown2", "CPI")))
def b19(spark, sf_dir):
    return clean.null_counts(weekly(spark, sf_dir).select(
        "Row", "IsHoliday", "Type", "Size", "Temperature", "MarkDown1", "MarkDown2", "CPI"
    ))


@query("b20_shape_report", f"""WITH {CLEAN_STOPS}
""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS "type", count({c}) AS non_null, count(*) AS "rows" FROM nulled"""
    for c, t in (("stop_id", "bigint"), ("month_text", "string"), ("crime_text", "string"),
                 ("age_text", "string"))))
def b20(spark, sf_dir):
    return clean.shape_report(clean.clean_sentinels(stops(spark, sf_dir)).select(
        "stop_id", "month_text", "crime_text", "age_text"
    ))
