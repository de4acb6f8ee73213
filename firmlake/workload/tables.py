"""The pipeline's input tables, derived row by row from the generic test tables, in Spark and as SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlake.functions import calendar as cal
from firmlake.registry import INTERFACES, interface_registry

KEYS = [row[0] for row in INTERFACES]
MONTHLY_KEYS = [row[0] for row in INTERFACES if row[3] == "monthly"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(orders: DataFrame) -> DataFrame:
    """Orders dealt evenly to all tasks: their file is small and would be read by a few, while payloads and pages multiply its rows."""
    return orders.repartition("o_orderkey", "o_custkey", "o_orderdate")


def quoted(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def sql_key(date: str) -> str:
    return f"strftime({date}, '%Y%m%d')"


def sql_monthly(date: str) -> str:
    """Day 4 of this month, or of the last one before the 5th."""
    back = f"CASE WHEN day({date}) >= 5 THEN 0 ELSE 1 END"
    return sql_key(f"(date_trunc('month', {date}) - to_months({back}) + INTERVAL 3 DAY)")


def sql_half_year(date: str) -> str:
    return (
        f"CASE WHEN month({date}) >= 7 THEN year({date}) || '0704' ELSE year({date}) || '0104' END"
    )


# --- call records: one per event --------------------------------------------------------------------------------------

# on every seventh day the calls of a daily and of a monthly interface went through another one
INTERFACE = "CASE WHEN day(ts) % 7 = 3 AND picked IN ('822', '973') THEN '1114' ELSE picked END"
# these rows sit in the partition of the monthly batch, whatever their interface
MISPLACED = "event_id % 17 = 0"

# on every sixth day nothing fails but in the expected way
STATUS = """CASE WHEN event_type <> 'error' THEN 0
    WHEN k % 3 = 0 OR day(ts) % 6 = 1 THEN CASE WHEN interface_key = 'P51060' THEN 1021 ELSE 300000 END
    WHEN k % 3 = 1 THEN CASE WHEN interface_key = 'P51060' THEN 1006 ELSE 300006 END
    ELSE -1 END"""
OUTPUT = """CASE WHEN status_code = 0 THEN concat('{"error_code":0,"reason":"ok","result":{"total":', k * 60, '}}')
    WHEN k % 3 = 2 THEN concat('{"error_type":"HTTP_EXCEPTION","msg":"timeout ', k, '"}')
    WHEN k % 6 = 1 THEN concat('{"reason":"code ', k, '","msg":"hidden"}')
    WHEN k % 6 = 4 THEN '{"reason":"","msg":"hidden"}'
    ELSE 'broken' END"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    keys = F.array(*[F.lit(k) for k in KEYS])
    picked = events.withColumn("picked", F.element_at(keys, (F.col("event_id") % len(KEYS) + 1).cast("int")))
    keyed = picked.withColumn("interface_key", F.expr(INTERFACE))
    monthly = F.col("interface_key").isin(MONTHLY_KEYS) | F.expr(MISPLACED)
    frequency = F.when(monthly, F.lit("monthly")).otherwise(F.lit("daily"))
    return (
        keyed.withColumn("status_code", F.expr(STATUS))
        .withColumn("output_result", F.expr(OUTPUT))
        .select(
            F.col("event_id").alias("id"),
            "interface_key",
            F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("input_param"),
            "status_code",
            "output_result",
            F.col("ts").alias("create_time"),
            "k",
            cal.run_partition(F.to_date("ts"), frequency).alias("dt"),
        )
    )


SQL_RECORDS = f"""
keyed AS (
  SELECT *, CAST(props->>'$.k' AS INTEGER) AS k, {INTERFACE} AS interface_key
  FROM (SELECT *, ([{quoted(KEYS)}])[event_id % {len(KEYS)} + 1] AS picked FROM events) e),
coded AS (SELECT *, {STATUS} AS status_code FROM keyed),
records AS (
  SELECT event_id AS id, interface_key, 'Customer#' || lpad(user_id::VARCHAR, 9, '0') AS input_param, status_code,
    {OUTPUT} AS output_result, ts AS create_time, k,
    CASE WHEN interface_key IN ({quoted(MONTHLY_KEYS)}) OR {MISPLACED} THEN {sql_monthly('ts')}
         ELSE {sql_key("(ts - INTERVAL 1 DAY)")} END AS dt
  FROM coded)"""

# --- customers --------------------------------------------------------------------------------------------------------

CUSTOMER_COLUMNS = [
    "c_name AS name",
    "CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'BUILDING') THEN '是' ELSE '否' END AS is_prepaid",
    "CASE WHEN c_custkey % 10 = 0 THEN '是' ELSE '否' END AS is_new_customer",
    "CASE WHEN c_custkey % 4 = 0 THEN '是' ELSE '否' END AS in_monthly_batch",
    "c_custkey",
    "c_nationkey",
    "c_mktsegment",
]
SQL_CUSTOMERS = f"customers AS (SELECT {', '.join(CUSTOMER_COLUMNS)} FROM customer)"
# customers of one segment are listed a second time as post-paid, those of another without a class
SQL_LISTINGS = f"""{SQL_CUSTOMERS},
listings AS (SELECT name, is_prepaid FROM customers
  UNION ALL SELECT name, '否' FROM customers WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT name, NULL FROM customers WHERE c_mktsegment = 'MACHINERY')"""


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*CUSTOMER_COLUMNS)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = customers(spark, sf_dir)
    flags = F.array_compact(
        F.array(
            F.struct(F.col("is_prepaid")),
            F.when(F.col("c_mktsegment") == "BUILDING", F.struct(F.lit("否").alias("is_prepaid"))),
            F.when(F.col("c_mktsegment") == "MACHINERY", F.struct(F.lit(None).cast("string").alias("is_prepaid"))),
        )
    )
    return base.select("name", F.explode(flags).alias("f")).select("name", "f.is_prepaid")


# the customers of each day; a ninth of them is listed in the other class that day, and some days have no partition
LISTED_DAYS = [d for d in range(31) if d % 10 != 7]
DAY_DT = "CASE day WHEN 0 THEN '20231231' ELSE concat('202401', lpad(cast(day AS {text}), 2, '0')) END"
DAY_CLASS = "CASE WHEN (c_custkey + day) % 9 = 0 THEN CASE is_prepaid WHEN '是' THEN '否' WHEN '否' THEN '是' END ELSE is_prepaid END"
SQL_DATED_LISTINGS = f"""dated_listings AS (SELECT name, {DAY_CLASS} AS is_prepaid, {DAY_DT.format(text='VARCHAR')} AS dt
  FROM (SELECT l.name, l.is_prepaid, c_custkey, unnest({LISTED_DAYS}) AS day FROM listings l JOIN customers c ON l.name = c.name))"""


def dated_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = listings(spark, sf_dir).withColumn("c_custkey", F.substring_index("name", "#", -1).cast("int"))
    daily = named.withColumn("day", F.explode(F.array(*[F.lit(d) for d in LISTED_DAYS])))
    return daily.selectExpr("name", f"{DAY_CLASS} AS is_prepaid", f"{DAY_DT.format(text='string')} AS dt")


SQL_WHITE = "white AS (SELECT name AS company_name FROM customers WHERE c_nationkey IN (3, 7))"


def white(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).where(F.col("c_nationkey").isin(3, 7)).select(F.col("name").alias("company_name"))


# --- profiles: one per order ------------------------------------------------------------------------------------------

PROFILE_COLUMNS = [
    "o_orderkey AS api_record_id",
    "{name} AS company_name",
    "o_orderpriority AS company_org_type",
    "CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS update_time",
    "CASE WHEN o_orderkey % 6 = 0 THEN 'hk' WHEN o_orderkey % 6 = 1 THEN 'tw' ELSE 'gd' END AS province_short",
    "CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 <> 1 THEN concat('SC', o_orderkey) END AS social_credit_code",
    "o_orderdate AS data_create_time",
    "CASE o_orderstatus WHEN 'F' THEN '20240101' WHEN 'O' THEN '20240102' ELSE '20240103' END AS dt",
]
SPARK_NAME = "concat('Customer#', lpad(cast(o_custkey AS string), 9, '0'))"
SQL_NAME = "'Customer#' || lpad(o_custkey::VARCHAR, 9, '0')"


def filled(columns: list[str], **parts: str) -> list[str]:
    return [c.format(**parts) for c in columns]


SQL_PROFILES = f"profiles AS (SELECT {', '.join(filled(PROFILE_COLUMNS, name=SQL_NAME))} FROM orders)"


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*filled(PROFILE_COLUMNS, name=SPARK_NAME))


# --- accounts: one per order, with a date per order status ------------------------------------------------------------

ACCOUNT_COLUMNS = [
    "concat('  ', {name}, ' ') AS accountName",
    "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Y419' WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS new_ord_payment_new_code",
    "cast(o_custkey % 25 AS {text}) AS new_accountgroup_id",
    "CASE o_orderkey % 5 WHEN 0 THEN true WHEN 1 THEN NULL ELSE false END AS new_isclosed",
    "CASE o_orderkey % 7 WHEN 0 THEN 'X1' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE concat(' ', o_custkey) END AS new_sapcode",
    "CASE o_orderkey % 9 WHEN 0 THEN true WHEN 1 THEN NULL ELSE false END AS new_dispensercustomer",
    "CASE o_orderstatus WHEN 'F' THEN '20240101' WHEN 'O' THEN '20240102' ELSE '20240103' END AS dt",
]
GROUP_COLUMNS = [
    "cast(n_nationkey AS {text}) AS new_accountgroupid",
    "CASE n_regionkey WHEN 0 THEN 'Y001-Sold-to party' WHEN 1 THEN 'Y003-Payer' ELSE 'Y002-Ship-to party' END AS new_name",
]
ACCOUNT_DATES = ["20240101", "20240102", "20240103"]
SQL_ACCOUNTS = f"""
accounts AS (SELECT {', '.join(filled(ACCOUNT_COLUMNS, name=SQL_NAME, text='VARCHAR'))} FROM orders),
account_groups AS (SELECT {', '.join(filled(GROUP_COLUMNS, text='VARCHAR'))}, unnest([{quoted(ACCOUNT_DATES)}]) AS dt FROM nation)"""


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*filled(ACCOUNT_COLUMNS, name=SPARK_NAME, text="string"))


def account_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").selectExpr(*filled(GROUP_COLUMNS, text="string"))
    return nation.withColumn("dt", F.explode(F.array(*[F.lit(d) for d in ACCOUNT_DATES])))


# --- file manifest: one load per event; file listing: one file per customer -------------------------------------------

MANIFEST_COLUMNS = [
    "concat('book_', user_id, '.accdb') AS filename",
    "md5(props) AS md5",
    "ts AS processed_at",
    "CASE WHEN event_type = 'error' THEN '' ELSE 'Order Lines, items#A,, Stock (EU) ' END AS table_names",
    "CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'error' THEN '' "
    "WHEN event_id % 3 = 0 THEN concat('{{\"lines\":', {k}, ',\"items\":', event_id % 50, '}}') "
    "ELSE concat('{{\"lines\":', {k}, ',\"stock\":', CASE WHEN event_id % 7 = 3 THEN '\"err\"' ELSE concat(event_id % 7) END, '}}') END AS table_counts",
    "CASE WHEN event_type = 'error' THEN concat('failed: no ', event_id) ELSE 'success' END AS status",
    "event_id",
]
LISTING_COLUMNS = [
    "CASE WHEN c_custkey % 2 = 0 THEN concat('book_', c_custkey, '.accdb') "
    "ELSE concat('book_', 20230100 + c_custkey % 28 + 1, '_', c_custkey, '.accdb') END AS filename",
    "md5(concat('{{\"k\": ', c_custkey % 100, '}}')) AS md5",
    "1700000000000 + c_custkey * 7919777 % 40000000000 AS modified_ms",
]
SQL_MANIFEST = f"""manifest AS (SELECT {', '.join(filled(MANIFEST_COLUMNS, k="(props->>'$.k')"))} FROM events)"""
SQL_LISTING = f"listing AS (SELECT {', '.join(filled(LISTING_COLUMNS))} FROM customer)"


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*filled(MANIFEST_COLUMNS, k="get_json_object(props, '$.k')"))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*filled(LISTING_COLUMNS))


# --- registry ---------------------------------------------------------------------------------------------------------


def registry(spark: SparkSession) -> DataFrame:
    return interface_registry(spark)


def _sql_row(row: tuple) -> str:
    key, name, provider, cfg, post, pre, charge, codes, paged, relation, source, exclude, half, reported, *_ = row
    return (
        f"('{key}', '{name}', '{provider}', '{cfg}', '{post}', '{pre}', {charge}, {codes}, {paged}, '{relation}', "
        f"'{source}', {exclude}, {half}, {reported})"
    )


SQL_REGISTRY = f"""registry AS (SELECT * FROM (VALUES {', '.join(_sql_row(r) for r in INTERFACES)})
  AS r(interface_key, interface_name, provider, frequency, post_paid_frequency, prepaid_frequency, charge_per_query,
       normal_codes, paged, relation, in_scope_from, exclude_listed, half_year_prepaid, reported))"""
