"""Queries for the scalar, list and name functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlake.functions import calendar as cal
from firmlake.functions import names
from firmlake.functions import values as v
from firmlake.operators.profile import column_profile
from firmlake.sources.files import exploded_counts, listed_tables
from firmlake.workload.interfaces import EXPECTED, token
from firmlake.workload.tables import (
    SQL_ACCOUNTS,
    SQL_MANIFEST,
    SQL_PROFILES,
    SQL_RECORDS,
    accounts,
    manifest,
    profiles,
    records,
    table,
)

EPOCHS = """CASE o_orderkey % 9 WHEN 0 THEN '0' WHEN 1 THEN '""' WHEN 2 THEN '"0"'
  WHEN 3 THEN cast(o_orderkey * 86400 AS {text}) WHEN 4 THEN cast((o_orderkey + 20000) * 86400000 + 999 AS {text})
  WHEN 5 THEN concat('"', o_orderkey * 60, '"') WHEN 6 THEN '253402214400' WHEN 7 THEN cast(-70000000000 - o_orderkey AS {text})
  ELSE '"soon"' END"""
RENAMES = {"SmallRing": "ring_name", "RedWidget": "widget_name"}


def epoch_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.try_parse_json(F.expr(EPOCHS.format(text="string")))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.unix_timestamp(v.epoch_to_timestamp(value)).alias("seconds")
    )


def null_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.try_parse_json(F.expr(token("l_partkey", 0))).alias("value")
    )
    value = F.col("value")
    return cases.select(
        "l_orderkey", "l_linenumber",
        v.null_if_empty(value).alias("null_if_empty"),
        v.null_if_falsy(value).alias("null_if_falsy"),
        v.blank_to_null(v.text(value)).alias("blank_to_null"),
        v.money(v.text(value)).cast("string").alias("money"),
    )


def name_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    camel = F.regexp_replace(F.initcap("p_name"), " ", "")
    spaced = F.concat(F.lit(" "), F.col("p_name"), F.lit("; ("), F.col("p_brand"), F.lit(")"), F.col("p_type"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        names.camel_to_snake(camel).alias("snake"),
        names.target_name(camel, RENAMES).alias("target"),
        names.clean_table_name(spaced).alias("table_name"),
        names.clean_column_name(spaced).alias("column_name"),
    )


def clean_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "part").toDF("p key", "name", "p  key", "p=(key)", "size;", "price/unit")
    return names.clean_columns(raw)


def stringify(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("empty", F.lit(None).cast("date"))
    return names.stringify(orders, ["empty"])


def json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


def failure_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("id", v.failure_reason(F.col("output_result")).alias("reason"))


def account_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = accounts(spark, sf_dir).where(
        v.digits_only(F.col("new_sapcode")) & v.not_set(F.col("new_isclosed")) & v.not_set(F.col("new_dispensercustomer"))
    )
    return usable.select(
        F.trim("accountName").alias("name"),
        v.yes_no(F.col("new_ord_payment_new_code") == "Y419").alias("is_prepaid"),
        F.coalesce(F.col("new_ord_payment_new_code").contains("HIGH"), F.lit(False)).alias("is_high"),
        cal.previous_key(F.col("dt")).alias("previous_dt"),
    )


def time_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles(spark, sf_dir).select(
        "api_record_id", F.date_format("update_time", "yyyy-MM-dd HH:mm:ss").alias("update_time")
    )


def table_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = listed_tables(manifest(spark, sf_dir), ["filename"])
    return listed.groupBy("filename", "table_name", "target_name").agg(F.count("*").alias("loads"))


def count_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = exploded_counts(manifest(spark, sf_dir), ["filename"])
    per_file = counts.groupBy("filename", "table_name").agg(
        F.count("*").alias("loads"), F.count("row_count").alias("counted"), F.sum("row_count").alias("row_count")
    )
    as_json = v.counts_to_json(F.create_map("table_name", "row_count"))
    return per_file.withColumn("as_json", as_json)


def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_profile(profiles(spark, sf_dir))


PROFILED = [
    "api_record_id", "company_name", "company_org_type", "update_time", "province_short", "social_credit_code",
    "data_create_time", "dt",
]

QUERIES = {
    "epoch_to_ts": epoch_to_ts,
    "null_rules": null_rules,
    "name_rules": name_rules,
    "clean_columns": clean_columns,
    "stringify": stringify,
    "json_paths": json_paths,
    "failure_reasons": failure_reasons,
    "account_flags": account_flags,
    "time_text": time_text,
    "table_lists": table_lists,
    "count_maps": count_maps,
    "column_profile": profile_columns,
}

_case = {rule: EXPECTED[rule].format(s="l_partkey", j=0) for rule in ("null_if_empty", "blank_to_null", "money")}
_spaced = "' ' || p_name || '; (' || p_brand || ')' || p_type"
_camel = "array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), '')"
_snake = f"lower(regexp_replace(regexp_replace({_camel}, '([A-Z])', '_\\1', 'g'), '^_', ''))"

ORACLE = {
    "epoch_to_ts": """SELECT o_orderkey, CASE o_orderkey % 9 WHEN 2 THEN 0
  WHEN 3 THEN CASE WHEN o_orderkey = 0 THEN NULL ELSE CASE WHEN o_orderkey * 86400 >= 10000000000 THEN o_orderkey * 86400 // 1000 ELSE o_orderkey * 86400 END END
  WHEN 4 THEN CASE WHEN (o_orderkey + 20000) * 86400000 + 999 >= 10000000000 THEN (o_orderkey + 20000) * 86400 ELSE (o_orderkey + 20000) * 86400000 + 999 END
  WHEN 5 THEN o_orderkey * 60 WHEN 6 THEN 253402214 WHEN 7 THEN CASE WHEN -70000000000 - o_orderkey >= -62135596800 THEN -70000000000 - o_orderkey END END::BIGINT AS seconds
FROM orders""",
    "null_rules": f"""SELECT l_orderkey, l_linenumber, {_case['null_if_empty']} AS null_if_empty,
  {_case['null_if_empty']} AS null_if_falsy, {_case['blank_to_null']} AS blank_to_null, {_case['money']} AS money
FROM lineitem""",
    "name_rules": f"""SELECT p_partkey, {_snake} AS snake,
  CASE {_camel} {' '.join(f"WHEN '{k}' THEN '{t}'" for k, t in RENAMES.items())} ELSE {_snake} END AS target,
  trim(regexp_replace(regexp_replace(lower({_spaced}), '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), '_') AS table_name,
  trim(regexp_replace(regexp_replace({_spaced}, '[ ,;{{}}()\\n\\t=/#]', '_', 'g'), '_+', '_', 'g'), '_') AS column_name
FROM part""",
    "clean_columns": """SELECT p_partkey AS p_key, p_name AS name, p_brand AS p_key_2, p_type AS p_key_3,
  p_size AS size, p_retailprice AS price_unit FROM part""",
    "stringify": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate::VARCHAR AS o_orderdate,
  o_orderpriority, '' AS empty FROM orders""",
    "json_paths": "SELECT event_id, props->>'$.k' AS k FROM events",
    "failure_reasons": f"""WITH {SQL_RECORDS}
SELECT id, CASE WHEN status_code = 0 THEN 'ok' WHEN k % 3 = 2 THEN 'timeout ' || k WHEN k % 6 = 1 THEN 'code ' || k END AS reason
FROM records""",
    "account_flags": f"""WITH {SQL_ACCOUNTS}
SELECT trim(accountName) AS name, CASE WHEN new_ord_payment_new_code = 'Y419' THEN '是' ELSE '否' END AS is_prepaid,
  coalesce(new_ord_payment_new_code LIKE '%HIGH%', false) AS is_high,
  strftime(strptime(dt, '%Y%m%d') - INTERVAL 1 DAY, '%Y%m%d') AS previous_dt
FROM accounts WHERE regexp_matches(trim(new_sapcode), '^[0-9]+$') AND coalesce(new_isclosed, false) <> true
  AND coalesce(new_dispensercustomer, false) <> true""",
    "time_text": f"""WITH {SQL_PROFILES}
SELECT api_record_id, strftime(update_time, '%Y-%m-%d %H:%M:%S') AS update_time FROM profiles""",
    "table_lists": f"""WITH {SQL_MANIFEST},
listed AS (SELECT filename, trim(unnest(string_split(table_names, ','))) AS table_name FROM manifest)
SELECT filename, table_name, 'manual_' || trim(regexp_replace(regexp_replace(lower(table_name), '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), '_') AS target_name,
  count(*) AS loads FROM listed WHERE table_name <> '' GROUP BY ALL""",
    "count_maps": f"""WITH {SQL_MANIFEST},
loads AS (SELECT filename, event_id, unnest(['lines', 'items', 'stock']) AS table_name, table_counts FROM manifest
  WHERE table_counts <> ''),
counts AS (SELECT filename, table_name, try_cast(table_counts->>('$.' || table_name) AS BIGINT) AS row_count FROM loads
  WHERE contains(table_counts, '"' || table_name || '"')),
summed AS (SELECT filename, table_name, count(*) AS loads, count(row_count) AS counted, sum(row_count)::BIGINT AS row_count
  FROM counts GROUP BY ALL)
SELECT *, '{{"' || table_name || '":' || coalesce(row_count::VARCHAR, 'null') || '}}' AS as_json FROM summed""",
    "column_profile": f"WITH {SQL_PROFILES}\n" + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count({c}) AS filled, count(*) - count({c}) AS empty FROM profiles"
        for c in PROFILED
    ),
}
