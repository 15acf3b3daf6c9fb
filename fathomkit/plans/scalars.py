"""Scalar function jobs (H01-H21; the triple filters H15, H16 live with the triples)."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fathomkit.functions import scalars as sc
from fathomkit.functions.scalars import rd
from fathomkit.plans.inputs import SENSORS, STOPS, TRANSACTIONS, sensors, stops, table, transactions
from fathomkit.plans.registry import query, rsql


@query("h01_arithmetic", f"""
SELECT l_orderkey, l_linenumber, {rsql("l_extendedprice * (1 - l_discount) * (1 + l_tax)", 4)} AS charge,
       abs(l_quantity - 25) AS gap, {rsql("l_tax / (l_discount + 1e-10)", 4)} AS safe_ratio,
       l_tax / nullif(l_discount, 0) AS null_ratio FROM lineitem""")
def h01(spark, sf_dir):
    price, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", rd(price * (1 - disc) * (1 + tax), 4).alias("charge"),
        F.abs(F.col("l_quantity") - 25).alias("gap"), rd(tax / (disc + 1e-10), 4).alias("safe_ratio"),
        sc.ratio(tax, disc).alias("null_ratio"),
    )


@query("h02_exponentials", f"""WITH e AS (SELECT c_custkey, c_acctbal / 1000.0 AS x FROM customer)
SELECT c_custkey, {rsql("exp(x)", 5)} AS odds, {rsql("1 / (1 + exp(-x))", 7)} AS p,
       {rsql("greatest(x, 0) + ln(1 + exp(-abs(x)))", 7)} AS softplus,
       {rsql("(CASE WHEN c_custkey % 2 = 1 THEN x ELSE 0 END) - (greatest(x, 0) + ln(1 + exp(-abs(x))))", 7)} AS loglik FROM e""")
def h02(spark, sf_dir):
    x = F.col("x")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_acctbal") / 1000.0).alias("x")
    ).select(
        "c_custkey", rd(F.exp(x), 5).alias("odds"), rd(sc.expit(x), 7).alias("p"),
        rd(sc.softplus(x), 7).alias("softplus"),
        rd(sc.bernoulli_loglik(F.col("c_custkey") % 2, x), 7).alias("loglik"),
    )


@query("h03_standard_error", f"""
SELECT p_brand, {rsql("stddev(p_size) / sqrt(count(*))", 6)} AS se,
       {rsql("avg(p_size) - 1.96 * stddev(p_size) / sqrt(count(*))", 6)} AS lo,
       {rsql("avg(p_size) + 1.96 * stddev(p_size) / sqrt(count(*))", 6)} AS hi FROM part GROUP BY 1""")
def h03(spark, sf_dir):
    se = F.stddev("p_size") / F.sqrt(F.count("*"))
    mean = F.avg("p_size")
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(
        rd(se, 6).alias("se"), rd(mean - 1.96 * se, 6).alias("lo"), rd(mean + 1.96 * se, 6).alias("hi")
    )


@query("h04_time_bucket", f"""WITH {TRANSACTIONS}
SELECT {rsql('"Time" / 3600', 1)} AS hour_tenth, "Class", count(*) AS n FROM tx GROUP BY 1, 2""")
def h04(spark, sf_dir):
    return transactions(spark, sf_dir).groupBy(
        rd(F.col("Time") / 3600, 1).alias("hour_tenth"), "Class"
    ).agg(F.count("*").alias("n"))


@query("h05_date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
       strftime(o_orderdate, '%b') AS abbr FROM orders""")
def h05(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"),
        F.date_format("o_orderdate", "MMM").alias("abbr"),
    )


@query("h06_week_and_format", """
SELECT CAST(weekofyear(o_orderdate) AS INTEGER) AS week, strftime(min(o_orderdate), '%m/%d/%Y') AS first_day,
       strftime(max(o_orderdate), '%m/%d/%Y') AS last_day FROM orders GROUP BY 1""")
def h06(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.weekofyear("o_orderdate").alias("week")).agg(
        F.date_format(F.min("o_orderdate"), "MM/dd/yyyy").alias("first_day"),
        F.date_format(F.max("o_orderdate"), "MM/dd/yyyy").alias("last_day"),
    )


@query("h07_day_first_parse", """
SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS parsed FROM orders""")
def h07(spark, sf_dir):
    """Dates written d/m/y, every 17th key with a month that does not exist."""
    text = F.when(F.col("o_orderkey") % 17 == 0, "1/13/2022").otherwise(
        F.date_format("o_orderdate", "d/M/yyyy")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("t")).select(
        "o_orderkey", F.date_format(sc.day_first_date(F.col("t")), "yyyy-MM-dd").alias("parsed")
    )


@query("h08_swapped_dates", """
SELECT o_orderkey, strftime(CASE WHEN day(o_orderdate) <= 12
         THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate))
         ELSE CAST(o_orderdate AS DATE) END, '%Y-%m-%d') AS repaired,
       strftime(o_orderdate, '%Y-%m-%d') AS from_text FROM orders""")
def h08(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    text = F.date_format("o_orderdate", "M/d/yyyy")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(sc.swap_day_month(d), "yyyy-MM-dd").alias("repaired"),
        F.date_format(sc.month_first_date(text), "yyyy-MM-dd").alias("from_text"),
    )


@query("h09_clock_text", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'noon' ELSE strftime(ts, '%H:%M') END AS clock FROM events""")
def h09(spark, sf_dir):
    """Three spellings of a time of day; the unreadable one is kept as it is."""
    text = (
        F.when(F.col("event_id") % 5 == 0, "noon")
        .when(F.col("event_id") % 2 == 0, F.date_format("ts", "h:mm:ss a"))
        .otherwise(F.date_format("ts", "H:mm:ss"))
    )
    return table(spark, sf_dir, "events").select("event_id", sc.clock_text(text).alias("clock"))


@query("h10_contains_flag", f"""WITH {STOPS}
SELECT stop_id, CASE WHEN coalesce(contains(initiated_text, 'Self'), FALSE) THEN 1 ELSE 0 END AS self_init FROM stops""")
def h10(spark, sf_dir):
    return stops(spark, sf_dir).select("stop_id", sc.contains_flag("initiated_text", "Self").alias("self_init"))


@query("h11_lower_contains", """
SELECT doc_id FROM documents WHERE contains(lower(text), 'the ') OR contains(lower(text), 'license')""")
def h11(spark, sf_dir):
    t = F.lower("text")
    return table(spark, sf_dir, "documents").filter(
        F.contains(t, F.lit("the ")) | F.contains(t, F.lit("license"))
    ).select("doc_id")


@query("h12_title_case", """
WITH n AS (SELECT r_name FROM region UNION SELECT p_name FROM part)
SELECT r_name, array_to_string(list_transform(string_split(r_name, ' '),
       lambda w: upper(w[1]) || lower(w[2:])), ' ') AS titled FROM n""")
def h12(spark, sf_dir):
    names = table(spark, sf_dir, "region").select("r_name").union(
        table(spark, sf_dir, "part").select("p_name")
    ).distinct()
    return names.select("r_name", F.initcap("r_name").alias("titled"))


@query("h13_label_replace", """
SELECT c_custkey, replace(c_name, 'Customer#', 'Cust: ') AS label FROM customer""")
def h13(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.regexp_replace("c_name", "Customer#", "Cust: ").alias("label")
    )


@query("h14_shorten", """
SELECT p_partkey, CASE WHEN length(p_name) > 8 THEN substr(p_name, 1, 8) || '.' ELSE p_name END AS short FROM part""")
def h14(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", sc.shorten("p_name", 8).alias("short"))


@query("h17_parse_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def h17(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k int").alias("d")
    ).select("event_id", "d.*")


@query("h18_row_to_json", """
SELECT event_id, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS message
FROM events""")
def h18(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.to_json(F.struct("event_id", "user_id", "event_type")).alias("message")
    )


@query("h19_parse_csv_text", f"""WITH {SENSORS}
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, temperature, eco2 FROM sensors""")
def h19(spark, sf_dir):
    line = F.concat_ws(
        ",", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.col("temperature").cast("string"), F.col("eco2").cast("string"),
    )
    return sensors(spark, sf_dir).select(
        F.from_csv(line, "event_id bigint, at string, temperature double, eco2 int").alias("d")
    ).select("d.*").withColumn("at", F.date_format(F.to_timestamp("at"), "yyyy-MM-dd HH:mm:ss"))


@query("h20_threshold_label", """
SELECT o_orderkey, CASE WHEN o_totalprice >= 400000 THEN 'Large' WHEN o_totalprice >= 150000 THEN 'Medium'
       ELSE 'Small' END AS size FROM orders""")
def h20(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        sc.threshold_label(F.col("o_totalprice"), [(400000, "Large"), (150000, "Medium")], "Small").alias("size"),
    )


@query("h21_vector_element", "SELECT l_orderkey, l_linenumber, l_discount AS second FROM lineitem")
def h21(spark, sf_dir):
    packed = VectorAssembler(
        inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="v", handleInvalid="skip"
    ).transform(table(spark, sf_dir, "lineitem"))
    return packed.select("l_orderkey", "l_linenumber", vector_to_array("v")[1].alias("second"))
