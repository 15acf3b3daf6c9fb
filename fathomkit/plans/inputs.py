"""The datasets the jobs read, derived from the given tables, each with its SQL twin.

Nothing here is sampled: every view covers all rows of the tables it reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomkit.functions.scalars import MONTHS, recode
from fathomkit.sources.files import read_parquet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


# --- card transactions -------------------------------------------------------------------
TRANSACTIONS = """
tx AS (
  SELECT l_orderkey AS transaction_id, l_partkey, l_suppkey, l_linenumber,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS "timestamp",
         CAST(epoch(l_shipdate) - (SELECT min(epoch(l_shipdate)) FROM lineitem) AS DOUBLE) AS "Time",
         l_extendedprice / 1000.0 AS "Amount",
         (l_quantity - 25.5) / 2.25 AS "V14", (l_discount - 0.05) * 220.0 AS "V12", l_tax AS "V3",
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS "Class"
  FROM lineitem)
"""


def wall_seconds(c: str) -> Column:
    """Seconds on the wall clock of a zone-less timestamp, whatever the session's time zone."""
    return F.unix_date(F.col(c).cast("date")).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    seconds = wall_seconds("l_shipdate")
    first = li.agg(F.min(seconds).alias("t"))
    return li.select(
        F.col("l_orderkey").alias("transaction_id"),
        "l_partkey", "l_suppkey", "l_linenumber",
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        (seconds - first.scalar()).cast("double").alias("Time"),
        (F.col("l_extendedprice") / 1000.0).alias("Amount"),
        ((F.col("l_quantity") - 25.5) / 2.25).alias("V14"),
        ((F.col("l_discount") - 0.05) * 220.0).alias("V12"),
        F.col("l_tax").alias("V3"),
        (F.col("l_returnflag") == "R").cast("int").alias("Class"),
    )


SCORED = TRANSACTIONS + """,
flagged AS (
  SELECT *, CASE WHEN abs("V14") > 10 THEN 'HIGH_V14' WHEN abs("V12") > 10 THEN 'HIGH_V12'
                 WHEN "Amount" < 1 THEN 'MICRO_AMOUNT' ELSE 'NORMAL' END AS "RuleFlag" FROM tx),
scored AS (
  SELECT *, CASE WHEN "RuleFlag" IN ('HIGH_V14', 'HIGH_V12') THEN 'HIGH'
                 WHEN "RuleFlag" = 'MICRO_AMOUNT' THEN 'MEDIUM' ELSE 'NORMAL' END AS "AlertLevel"
  FROM flagged)
"""

# --- shop orders -------------------------------------------------------------------------
SHOP = """
shop AS (
  SELECT o_orderkey, o_custkey, o_orderdate AS "OrderDate", o_totalprice AS "TotalAmount",
         c_mktsegment AS "Category", n_name AS "Country", r_name AS "Region",
         o_orderstatus AS "OrderStatus", o_orderpriority AS "PaymentMethod"
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


def shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .join(region, F.col("n_regionkey") == region.r_regionkey)
        .select(
            "o_orderkey", "o_custkey",
            F.col("o_orderdate").alias("OrderDate"),
            F.col("o_totalprice").alias("TotalAmount"),
            F.col("c_mktsegment").alias("Category"),
            F.col("n_name").alias("Country"),
            F.col("r_name").alias("Region"),
            F.col("o_orderstatus").alias("OrderStatus"),
            F.col("o_orderpriority").alias("PaymentMethod"),
        )
    )


# --- order lines for the regression ------------------------------------------------------
LINES = """
lines AS (
  SELECT l_orderkey, l_extendedprice AS "TotalAmount", l_discount AS "Discount",
         l_quantity AS "Quantity", l_extendedprice / l_quantity AS "UnitPrice",
         p_type AS "Category", l_returnflag AS "Flag", l_linestatus AS "OrderStatus"
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_extendedprice").alias("TotalAmount"),
        F.col("l_discount").alias("Discount"),
        F.col("l_quantity").alias("Quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("UnitPrice"),
        F.col("p_type").alias("Category"),
        F.col("l_returnflag").alias("Flag"),
        F.col("l_linestatus").alias("OrderStatus"),
    )


# --- orders with thirty features and a rare class ----------------------------------------
WIDE_NUMBERS = ["total_price", "n_lines", "quantity", "mean_discount", "max_discount", "mean_tax"]
WIDE_PARTS = [f"e{i}" for i in range(24)]
WIDE_FEATURES = WIDE_NUMBERS + WIDE_PARTS

# Large orders with a deep discount are mostly rare, but for one kind of vector, and a part of what lies near them is
# too; which part depends on the key and not on the features, so no model can be perfect.
RARE_ORDER = (
    "(quantity >= 220 AND max_discount >= 0.09 AND kind <> 2 AND o_orderkey % 10 <> 3) OR "
    "(quantity >= 180 AND mean_discount >= 0.06 AND o_orderkey % 12 = 5)"
)
WIDE = f"""
sums AS (
  SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS quantity, max(l_discount) AS max_discount,
         CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_discount,
         CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_tax
  FROM lineitem GROUP BY 1),
wide AS (
  SELECT o_orderkey, o_totalprice AS total_price, n_lines, quantity, mean_discount, max_discount, mean_tax,
         {", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(24))},
         CAST(({RARE_ORDER.replace("kind", "embeddings.label")}) AS INT) AS label
  FROM orders JOIN sums ON l_orderkey = o_orderkey
  JOIN embeddings ON vec_id = o_custkey % (SELECT max(vec_id) + 1 FROM embeddings))
"""


def wide_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with sums over its lines and the vector of its customer."""
    money, n = "decimal(18,2)", F.count("*")
    sums = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        n.cast("double").alias("n_lines"), F.sum("l_quantity").alias("quantity"),
        F.max("l_discount").alias("max_discount"),
        (F.sum(F.col("l_discount").cast(money)).cast("double") / n).alias("mean_discount"),
        (F.sum(F.col("l_tax").cast(money)).cast("double") / n).alias("mean_tax"),
    )
    vectors = table(spark, sf_dir, "embeddings")
    many = vectors.agg((F.max("vec_id") + 1).alias("n")).scalar()
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("total_price"), (F.col("o_custkey") % many).alias("vec_id"))
    parts = vectors.select(
        "vec_id", F.col("label").alias("kind"),
        *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(WIDE_PARTS)])
    return orders.join(sums, "o_orderkey").join(parts, "vec_id").select(
        "o_orderkey", *WIDE_FEATURES, F.expr(f"CAST({RARE_ORDER} AS INT)").alias("label"))


# --- weekly sales of stores --------------------------------------------------------------
SALES = """
sales AS (
  SELECT o_orderkey AS "Row", o_custkey AS "Store", o_orderkey % 90 AS "Dept",
         o_orderdate AS "Date", o_totalprice AS "Weekly_Sales",
         CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE month(o_orderdate) = 12 END AS "IsHoliday"
  FROM orders),
stores AS (
  SELECT c_custkey AS "Store", c_mktsegment AS "Type", c_acctbal AS "Size"
  FROM customer),
features AS (
  SELECT "Store", "Date", "IsHoliday",
         CAST(sum(CAST("Weekly_Sales" AS DECIMAL(18,2))) AS DOUBLE) / 10000.0 AS "Temperature",
         CASE WHEN "Store" % 3 = 0 THEN NULL ELSE CAST(count(*) * 10 AS DOUBLE) END AS "MarkDown1",
         CASE WHEN "Store" % 5 <> 0 THEN NULL ELSE CAST(min("Dept") AS DOUBLE) END AS "MarkDown2",
         CASE WHEN min("Row") % 4 <> 0 THEN NULL ELSE CAST(min("Dept") + 100 AS DOUBLE) END AS "CPI"
  FROM sales GROUP BY "Store", "Date", "IsHoliday"),
weekly AS (
  SELECT s.*, t."Type", t."Size", f."Temperature", f."MarkDown1", f."MarkDown2", f."CPI"
  FROM sales s LEFT JOIN stores t ON s."Store" = t."Store"
  LEFT JOIN features f ON s."Store" = f."Store" AND s."Date" = f."Date"
       AND s."IsHoliday" IS NOT DISTINCT FROM f."IsHoliday")
"""


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Row"),
        F.col("o_custkey").alias("Store"),
        (F.col("o_orderkey") % 90).alias("Dept"),
        F.col("o_orderdate").alias("Date"),
        F.col("o_totalprice").alias("Weekly_Sales"),
        F.when(F.col("o_custkey") % 50 != 0, F.month("o_orderdate") == 12).alias("IsHoliday"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Store"),
        F.col("c_mktsegment").alias("Type"),
        F.col("c_acctbal").alias("Size"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir).groupBy("Store", "Date", "IsHoliday").agg(
        (F.sum(F.col("Weekly_Sales").cast("decimal(18,2)")).cast("double") / 10000.0).alias(
            "Temperature"
        ),
        F.when(F.col("Store") % 3 != 0, (F.count("*") * 10).cast("double")).alias("MarkDown1"),
        F.when(F.col("Store") % 5 == 0, F.min("Dept").cast("double")).alias("MarkDown2"),
        F.when(F.min("Row") % 4 == 0, (F.min("Dept") + 100).cast("double")).alias("CPI"),
    )


# --- retail store ------------------------------------------------------------------------
RETAIL = """
retail AS (
  SELECT o_orderdate AS "Date", l_linestatus AS "Branch", o_orderstatus AS "Customer_type",
         l_returnflag AS "Gender", p_type AS "Product_line", o_orderpriority AS "Payment",
         l_extendedprice AS "Total", l_quantity AS "Quantity", l_tax AS "Tax",
         p_retailprice AS "Unit_price", (l_partkey % 70) / 10.0 + 3 AS "Rating"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
"""


def retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    return (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .join(part, li.l_partkey == part.p_partkey)
        .select(
            F.col("o_orderdate").alias("Date"),
            F.col("l_linestatus").alias("Branch"),
            F.col("o_orderstatus").alias("Customer_type"),
            F.col("l_returnflag").alias("Gender"),
            F.col("p_type").alias("Product_line"),
            F.col("o_orderpriority").alias("Payment"),
            F.col("l_extendedprice").alias("Total"),
            F.col("l_quantity").alias("Quantity"),
            F.col("l_tax").alias("Tax"),
            F.col("p_retailprice").alias("Unit_price"),
            ((F.col("l_partkey") % 70) / 10.0 + 3).alias("Rating"),
        )
    )


# --- stop records, all text, with sentinels ----------------------------------------------
_MONTH_SQL = "[" + ", ".join(f"'{m}'" for m in MONTHS) + "]"
# Further flags of a stop follow from its key: name -> (modulus, remainder).
STOP_FLAGS = {"searched_flag": (4, 1), "firearm_flag": (11, 5), "violent_flag": (5, 2), "known_flag": (17, 3)}
# The borough that stands for a region.
BOROUGHS = {"AFRICA": "BRONX", "AMERICA": "BROOKLYN", "ASIA": "MANHATTAN", "EUROPE": "QUEENS",
            "MIDDLE EAST": "STATEN ISLAND"}
_BORO_SQL = "CASE r_name " + " ".join(f"WHEN '{r}' THEN '{b}'" for r, b in BOROUGHS.items()) + " END"
STOPS = f"""
stops AS (
  SELECT o_orderkey AS stop_id,
         CASE WHEN o_orderkey % 211 = 0 THEN '(null)' ELSE {_MONTH_SQL}[month(o_orderdate)] END AS month_text,
         CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' ELSE '(null)' END AS arrested_flag,
         CASE WHEN o_totalprice > 250000 THEN 'Y' ELSE 'N' END AS frisked_flag,
         CASE WHEN o_orderkey % 3 = 0 THEN 'Y' WHEN o_orderkey % 3 = 1 THEN 'N' ELSE '' END AS weapon_flag,
         ['CPW', 'ROBBERY', 'ASSAULT', 'CRIMINAL TRESPASS', 'OTHER', 'PETIT LARCENY', '#N/A'][1 + o_orderkey % 7] AS crime_text,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'BLACK' WHEN 'BUILDING' THEN 'WHITE HISPANIC'
              WHEN 'FURNITURE' THEN 'BLACK HISPANIC' WHEN 'HOUSEHOLD' THEN 'WHITE' ELSE 'ASIAN' END AS race_text,
         CASE WHEN o_orderkey % 2 = 0 THEN 'MALE' ELSE 'FEMALE' END AS sex_text,
         CASE WHEN o_orderkey % 29 = 0 THEN 'unknown' WHEN o_orderkey % 31 = 0 THEN '(null)'
              ELSE CAST(5 + (o_orderkey * 13) % 90 AS VARCHAR) END AS age_text,
         {_BORO_SQL} AS boro_text, {", ".join(
             f"CASE WHEN o_orderkey % {m} = {r} THEN 'Y' ELSE 'N' END AS {c}" for c, (m, r) in STOP_FLAGS.items())},
         CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE CAST(c_nationkey + 1 AS VARCHAR) END AS precinct_text,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'Based on Self Initiated'
              WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'Based on Radio Run' END AS initiated_text
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key = F.col("o_orderkey")
    crimes = ["CPW", "ROBBERY", "ASSAULT", "CRIMINAL TRESPASS", "OTHER", "PETIT LARCENY", "#N/A"]
    segment = F.col("c_mktsegment")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .join(region, F.col("n_regionkey") == region.r_regionkey)
        .select(
            key.alias("stop_id"),
            F.when(key % 211 == 0, "(null)").otherwise(
                F.element_at(F.array(*map(F.lit, MONTHS)), F.month("o_orderdate"))
            ).alias("month_text"),
            F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") == "O", "N")
            .otherwise("(null)").alias("arrested_flag"),
            F.when(F.col("o_totalprice") > 250000, "Y").otherwise("N").alias("frisked_flag"),
            F.when(key % 3 == 0, "Y").when(key % 3 == 1, "N").otherwise("").alias("weapon_flag"),
            F.element_at(F.array(*map(F.lit, crimes)), (key % 7 + 1).cast("int")).alias("crime_text"),
            F.when(segment == "AUTOMOBILE", "BLACK").when(segment == "BUILDING", "WHITE HISPANIC")
            .when(segment == "FURNITURE", "BLACK HISPANIC").when(segment == "HOUSEHOLD", "WHITE")
            .otherwise("ASIAN").alias("race_text"),
            F.when(key % 2 == 0, "MALE").otherwise("FEMALE").alias("sex_text"),
            F.when(key % 29 == 0, "unknown").when(key % 31 == 0, "(null)")
            .otherwise((key * 13 % 90 + 5).cast("string")).alias("age_text"),
            recode("r_name", BOROUGHS, default=None).alias("boro_text"),
            *[F.when(key % m == r, "Y").otherwise("N").alias(c) for c, (m, r) in STOP_FLAGS.items()],
            F.when(key % 97 == 0, "").otherwise((F.col("c_nationkey") + 1).cast("string"))
            .alias("precinct_text"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "Based on Self Initiated")
            .when(F.col("o_orderpriority") != "5-LOW", "Based on Radio Run")
            .alias("initiated_text"),
        )
    )


# --- sensor readings ---------------------------------------------------------------------
# Readings that the events do not have follow from their keys: name -> (key, modulus, divisor).
DERIVED_READINGS = {
    "tvoc": ("event_id", 600, 1), "raw_h2": ("user_id", 140, 1), "raw_ethanol": ("event_id", 190, 1),
    "pressure": ("user_id", 90, 10), "pm1_0": ("event_id", 40, 4), "nc0_5": ("event_id", 130, 8),
    "nc1_0": ("event_id", 110, 8), "nc2_5": ("event_id", 70, 8), "cnt": ("event_id", 24994, 1),
}

SENSORS = f"""
sensors AS (
  SELECT event_id, ts, value AS temperature,
         CAST(user_id % 100 AS DOUBLE) / 2 AS humidity,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS eco2,
         CAST(event_id % 80 AS DOUBLE) AS pm2_5,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS fire_alarm,
         {", ".join(f"CAST({k} % {m} AS DOUBLE) / {d} AS {c}" for c, (k, m, d) in DERIVED_READINGS.items())}
  FROM events)
"""


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "ts",
        F.col("value").alias("temperature"),
        ((F.col("user_id") % 100).cast("double") / 2).alias("humidity"),
        F.get_json_object("props", "$.k").cast("int").alias("eco2"),
        (F.col("event_id") % 80).cast("double").alias("pm2_5"),
        (F.col("event_type") == "error").cast("int").alias("fire_alarm"),
        *[((F.col(k) % m).cast("double") / d).alias(c) for c, (k, m, d) in DERIVED_READINGS.items()],
    )
