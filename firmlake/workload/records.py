"""Queries for scans, table writes, ids, record resolution and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmlake.operators import decode, ids, latest, quality, responses
from firmlake.plans import parsing
from firmlake.registry import RESPONSE_CODES, code_meanings, response_codes
from firmlake.session import scratch_path
from firmlake.sources import files, storage, tables
from firmlake.workload.tables import (
    ACCOUNT_DATES,
    SQL_CUSTOMERS,
    SQL_PROFILES,
    SQL_RECORDS,
    SQL_REGISTRY,
    customers,
    profiles,
    records,
    registry,
    spread,
    table,
)

LOG = ["id", "interface_key", "input_param", "status_code", "create_time", "dt"]


def text_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


def summary(df: DataFrame, **labels: str) -> DataFrame:
    """Size and fingerprint of a log, for comparing whole tables by a few numbers."""
    counted = df.groupBy("dt").agg(F.count("*").alias("row_count"), F.sum("id").alias("id_sum"), F.sum("status_code").alias("status_sum"))
    return counted.select(*[F.lit(v).alias(k) for k, v in labels.items()], "*")


SQL_SUMMARY = "dt, count(*) AS row_count, sum(id)::BIGINT AS id_sum, sum(status_code)::BIGINT AS status_sum"

# --- newest records ---------------------------------------------------------------------------------------------------


def latest_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest.latest_success(records(spark, sf_dir), ["interface_key", "input_param"])
    return newest.select("id", "interface_key", "input_param", "dt")


def latest_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ties on the newest time are kept: times are cut to the day here, so most keys have some."""
    coarse = records(spark, sf_dir).withColumn("create_time", F.date_trunc("day", "create_time"))
    return latest.latest_success(coarse).select("id", "interface_key", "input_param", "dt")


def latest_sieved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with older records left out ahead of the join."""
    coarse = records(spark, sf_dir).withColumn("create_time", F.date_trunc("day", "create_time"))
    return latest.latest_success(coarse, sieve_bits=27).select("id", "interface_key", "input_param", "dt")


def newest_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("update_time").desc_nulls_last(), F.col("api_record_id").desc()]
    return latest.first_per(profiles(spark, sf_dir), ["company_name"], order, 3).select("api_record_id", "company_name", "dt")


# --- scans ------------------------------------------------------------------------------------------------------------


def partition_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan forms over a log written by date."""
    path = scratch_path(spark, "log")
    tables.overwrite_partitions(records(spark, sf_dir).select(*LOG), path)
    log = tables.read_table(spark, path, records(spark, sf_dir).select(*LOG).schema)
    scans = {
        "one": tables.scan(log, "20240116"),
        "latest": tables.scan_newest(spark, path, log.schema),
        "set": tables.scan(log, "20240104", "20240115"),
        "before": tables.scan_before(log, "20240110"),
        "window": tables.created_between(log, "2024-01-16 00:00:00", "2024-01-17 00:00:00"),
    }
    result = None
    for form, df in scans.items():
        one = summary(df, form=form)
        result = one if result is None else result.unionByName(one)
    return result


# --- writes -----------------------------------------------------------------------------------------------------------


def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run replaces the partitions it brings and leaves the others."""
    path = scratch_path(spark, "log")
    log = records(spark, sf_dir).select(*LOG)
    tables.overwrite_partitions(log, path)
    tables.overwrite_partitions(log.where("dt >= '20240115'").withColumn("id", F.col("id") + 1000000), path)
    return summary(tables.read_table(spark, path, log.schema))


def split_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shared log split into one folder per interface and date: successes, and failures where they are kept."""
    names_only = registry(spark).select("interface_key", "interface_name")
    shared = records(spark, sf_dir).select(*LOG).join(F.broadcast(names_only), "interface_key").drop("interface_key", "dt")
    path = scratch_path(spark, "split")
    tables.split_log(tables.migrate_log(shared, names_only, "20240601"), path)
    log = spark.read.schema("id BIGINT, status_code INT, interface_key STRING, dt STRING").parquet(path)
    return log.groupBy("interface_key", "dt").agg(F.count("*").alias("row_count"), F.sum("status_code").alias("status_sum"))


def snapshot_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full rebuild replaces rows and columns alike; a column an old snapshot lacks is added on reading."""
    path = scratch_path(spark, "snapshot")
    listed = customers(spark, sf_dir)
    tables.rebuild_snapshot(listed.select("name", "is_prepaid"), path)
    tables.rebuild_snapshot(listed.select("name", F.col("c_nationkey").alias("nation")), path)
    return tables.add_missing_column(tables.add_missing_column(spark.read.parquet(path), "nation", "int"), "table_counts", "string")


def replace_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of some companies replaced inside one partition; companies without new rows disappear from it."""
    path = scratch_path(spark, "parsed")
    old = profiles(spark, sf_dir).select("api_record_id", "company_name", "dt")
    tables.overwrite_partitions(old, path)
    keys = customers(spark, sf_dir).where("is_prepaid = '是'").select(F.col("name").alias("company_name"))
    new = customers(spark, sf_dir).where("is_prepaid = '是' AND is_new_customer = '是'").select(
        (-F.col("c_custkey")).alias("api_record_id"), F.col("name").alias("company_name")
    )
    tables.replace_in_partition(spark, path, "20240102", new, keys, "company_name")
    return tables.read_table(spark, path, old.schema)


def replace_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New calls take the place of earlier ones of the same company, date and interface, with ids above all others."""
    log = records(spark, sf_dir).select(*LOG)
    new = log.where("status_code <> 0").withColumn("status_code", F.lit(0))
    numbered = ids.continue_ids(new.withColumn("first_id", F.col("id")), log, [F.col("first_id")])
    return tables.replace_records(log, numbered.select(*LOG)).drop("create_time")


def restamp_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of prepaid customers copied into an older partition; what is there stays."""
    path = scratch_path(spark, "parsed")
    old = profiles(spark, sf_dir).select("api_record_id", "company_name", "data_create_time", "dt")
    tables.overwrite_partitions(old, path)
    keys = customers(spark, sf_dir).where("is_prepaid = '是'").select("name")
    tables.append(tables.restamp(old, keys, "20240103", "20240101"), path)
    return text_time(tables.read_table(spark, path, old.schema), "data_create_time")


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New values by key, other columns kept, unknown keys added."""
    old = customers(spark, sf_dir).select("name", "is_prepaid", "c_nationkey")
    fresh = table(spark, sf_dir, "customer").selectExpr(
        "CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE concat(c_name, '-b') END AS name", "'new' AS is_prepaid"
    )
    return tables.upsert(old, fresh, "name")


CONFORMED = T.StructType(
    [
        T.StructField("c_custkey", T.IntegerType()),
        T.StructField("c_name", T.LongType()),
        T.StructField("c_acctbal", T.DecimalType(24, 4)),
        T.StructField("dt", T.StringType()),
    ]
)


def conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = tables.conform(table(spark, sf_dir, "customer"), CONFORMED)
    return fitted.withColumn("c_acctbal", F.col("c_acctbal").cast("string"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export of one date as CSV, read back as text; an export without rows leaves no folder."""
    path = scratch_path(spark, "csv")
    chosen = profiles(spark, sf_dir).select("api_record_id", "company_name", "update_time", "dt")
    files.export_csv(chosen, path, "20240102")
    skipped = files.export_csv(chosen, scratch_path(spark, "csv"), "19990101")
    return spark.read.csv(path, header=True).withColumn("wrote_nothing", F.lit(not skipped))


# --- ids --------------------------------------------------------------------------------------------------------------


def continue_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids above those of a stored log, whose footers name the highest."""
    path = scratch_path(spark, "log")
    tables.overwrite_partitions(records(spark, sf_dir).select(*LOG), path)
    new = customers(spark, sf_dir).select("name", F.lit(0).alias("id"))
    return ids.continue_ids(new, storage.highest_id(spark, path), [F.col("name")])


def max_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = records(spark, sf_dir)
    return log.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("max_id"), F.max("dt").alias("max_dt"))


# --- responses --------------------------------------------------------------------------------------------------------

CALL_TOTAL = "o_orderkey % 150"
PAGE_ERROR = "CASE WHEN (o_orderkey + page_num * 3) % 11 = 0 THEN 300004 ELSE 0 END"


def merge_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", f"cast({CALL_TOTAL} AS int) AS total",
        f"explode(sequence(1, cast(ceil({CALL_TOTAL} / 20.0) AS int) + 1)) AS page_num",
    )
    item = "transform(sequence(0, cast((o_orderkey + page_num) % 3 AS int)), x -> concat(o_orderkey, '-', page_num, '-', x))"
    pages = calls.selectExpr("*", f"{PAGE_ERROR} AS error_code", f"{item} AS items", "2 AS at")
    older = pages.where("(o_orderkey + page_num) % 4 = 0").withColumns({"at": F.lit(1), "error_code": F.lit(9), "items": F.array(F.lit("old"))})
    return responses.merge_pages(pages.union(older), ["o_orderkey"], [F.col("at").desc()]).withColumn("items", F.array_join("items", ","))


# responses of the pages of a call: fields of a tax item in text, number and missing form
PAGE_ITEM = """concat('{"taxIdNumber":"t', o_orderkey, '-', page_num, '-', x, '","ownTaxAmount":', x, CASE WHEN x % 2 = 0 THEN ',"name":"n ] [ x"' ELSE '' END, '}')"""
PAGE_PAYLOAD = f"""CASE WHEN o_orderkey % 13 = 5 AND page_num = 2 THEN 'broken' WHEN {PAGE_ERROR} <> 0 THEN concat('{{"error_code":', {PAGE_ERROR}, ',"reason":"slow"}}')
  WHEN o_orderkey % 7 = 3 THEN '{{"error_code":0,"reason":"ok","result":null}}'
  ELSE concat('{{"reason":"o\\\\"k","result":{{"total":', total, ',"items":[', array_join(items, ','), ']}},"error_code":0}}') END"""


def merged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page responses merged into stored records and parsed as tax arrears."""
    calls = spread(table(spark, sf_dir, "orders")).selectExpr(
        "o_orderkey", f"cast({CALL_TOTAL} AS int) AS total",
        f"explode(sequence(1, cast(ceil({CALL_TOTAL} / 20.0) AS int) + 1)) AS page_num",
    )
    item = f"transform(sequence(0, cast((o_orderkey + page_num) % 3 AS int)), x -> {PAGE_ITEM})"
    pages = calls.selectExpr("*", f"{item} AS items").selectExpr("o_orderkey", "page_num", f"{PAGE_PAYLOAD} AS payload", "1 AS at")
    stored = responses.merge_responses(pages, ["o_orderkey"], [F.col("at").desc()])
    log = stored.where("status_code = 0").selectExpr("o_orderkey AS id", "concat('c', o_orderkey) AS input_param", "'20240101' AS dt", "output_result")
    rows = parsing.parse(log, "851")
    return rows.select("api_record_id", "company_name", "total", "tax_id_number", "own_tax_amount", "taxpayer_name")


ATTEMPT_CODE = "CASE (o_orderkey + attempt * 2) % 5 WHEN 0 THEN 0 WHEN 1 THEN 300000 WHEN 2 THEN -1 ELSE 300004 END"


def resolve_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tried = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "explode(sequence(1, cast(o_orderkey % 5 AS int) + 1)) AS attempt")
    log = tried.selectExpr("*", f"{ATTEMPT_CODE} AS code", "concat('p', o_orderkey, '-', attempt) AS payload")
    return responses.resolve_attempts(
        log, ["o_orderkey"], F.array(F.lit(300000)), F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 2 == 0
    )


def failure_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = records(spark, sf_dir).where("status_code <> 0")
    kind = F.when(F.col("k") % 3 == 2, F.lit("HTTP_EXCEPTION")).when(F.col("k") % 7 == 0, F.lit("OTHER_EXCEPTION"))
    message = F.concat(F.lit("no answer "), F.col("k").cast("string"))
    code, detail = responses.failure_record(kind, F.col("status_code"), message, F.col("output_result"))
    return failed.select("id", code.alias("status_code"), detail.alias("detail"))


def decode_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    provider = registry(spark).select("interface_key", "provider")
    counts = records(spark, sf_dir).groupBy("interface_key", "status_code").agg(F.count("*").alias("records"))
    coded = counts.join(F.broadcast(provider), "interface_key")
    codes = response_codes(spark).withColumnRenamed("code", "status_code")
    return decode.decode(coded, codes, ["provider", "status_code"], "status_code", "text").drop("provider")


def decode_enums(spark: SparkSession, sf_dir: str) -> DataFrame:
    risks = code_meanings(spark).where("dictionary = 'risk_category'").drop("dictionary")
    lines = table(spark, sf_dir, "lineitem").groupBy((F.col("l_linenumber") - 1).cast("string").alias("code")).agg(F.count("*").alias("lines"))
    return decode.decode(lines, risks, ["code"], "code", "text")


# --- checks -----------------------------------------------------------------------------------------------------------


def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("interface_key", "input_param").distinct().orderBy("interface_key", "input_param")


def parsed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an event as their record, in part under another date than the record's."""
    dates = F.array(*[F.lit(d) for d in ACCOUNT_DATES])
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("api_record_id"))
    return lines.withColumn("dt", F.element_at(dates, (F.col("api_record_id") % 3 + 1).cast("int")))


def trace_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "CASE o_orderstatus WHEN 'F' THEN '20240101' WHEN 'O' THEN '20240102' ELSE '20240103' END AS dt"
    )
    return quality.trace_ratio(parsed_rows(spark, sf_dir), log)


def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.partition_counts(records(spark, sf_dir))


def repeated_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_success(records(spark, sf_dir))


DECLARED = T.StructType(
    [
        T.StructField("api_record_id", T.LongType()),
        T.StructField("company_name", T.StringType()),
        T.StructField("update_time", T.TimestampType()),
        T.StructField("tax_number", T.StringType()),
        T.StructField("dt", T.StringType()),
    ]
)


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    actual = profiles(spark, sf_dir).select("api_record_id", "company_name", "update_time", "social_credit_code", "dt")
    return quality.schema_report(actual, DECLARED, ["dt"])


def stored_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by date, one whose ``dt`` is a plain column, and one that is not there, from folders and footers."""
    path = scratch_path(spark, "tables")
    actual = profiles(spark, sf_dir).select("api_record_id", "company_name", "update_time", "social_credit_code", "dt")
    tables.overwrite_partitions(actual, f"{path}/dated")
    tables.rebuild_snapshot(actual, f"{path}/flat")
    reports = [quality.stored_schema_report(spark, f"{path}/{t}", DECLARED).withColumn("table_name", F.lit(t)) for t in ("dated", "flat", "none")]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


def upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in place of a stored table, twice."""
    path = scratch_path(spark, "customers")
    tables.rebuild_snapshot(customers(spark, sf_dir).select("name", "is_prepaid", "c_nationkey"), path)
    fresh = table(spark, sf_dir, "customer").selectExpr(
        "CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE concat(c_name, '-b') END AS name", "'new' AS is_prepaid"
    )
    for _ in range(2):
        tables.upsert_into(spark, path, fresh, "name")
    return spark.read.parquet(path)


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sample_rows(records(spark, sf_dir).where("status_code = 0"), 5, ["create_time", "id"]).select("id", "input_param")


def name_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the list without any record."""
    named = customers(spark, sf_dir).select("name")
    return named.join(records(spark, sf_dir).select(F.col("input_param").alias("name")).distinct(), "name", "left_anti")


QUERIES = {
    "latest_success": latest_success,
    "latest_sieved": latest_sieved,
    "latest_by_day": latest_by_day,
    "newest_profiles": newest_profiles,
    "partition_scans": partition_scans,
    "partition_overwrite": partition_overwrite,
    "split_log": split_log,
    "snapshot_rebuild": snapshot_rebuild,
    "replace_key": replace_key,
    "replace_records": replace_records,
    "restamp_append": restamp_append,
    "upsert": upsert,
    "conform": conform,
    "csv_roundtrip": csv_roundtrip,
    "continue_ids": continue_ids,
    "max_ids": max_ids,
    "merge_pages": merge_pages,
    "merged_records": merged_records,
    "resolve_attempts": resolve_attempts,
    "failure_records": failure_records,
    "decode_codes": decode_codes,
    "decode_enums": decode_enums,
    "distinct_keys": distinct_keys,
    "trace_ratio": trace_ratio,
    "partition_counts": partition_counts,
    "repeated_success": repeated_success,
    "schema_report": schema_report,
    "stored_schema": stored_schema,
    "upsert_stored": upsert_stored,
    "sample_rows": sample_rows,
    "name_difference": name_difference,
}

_codes = "codes AS (SELECT * FROM (VALUES {}) AS c(provider, status_code, meaning))"
_status_date = "CASE o_orderstatus WHEN 'F' THEN '20240101' WHEN 'O' THEN '20240102' ELSE '20240103' END"


def _code_values() -> str:
    return ", ".join(f"('{p}', {c}, '{m}')" for p, codes in RESPONSE_CODES.items() for c, m in codes.items())


SQL_CODES = _codes.format(_code_values())

ORACLE = {
    "latest_success": f"""WITH {SQL_RECORDS},
newest AS (SELECT interface_key, input_param, max(create_time) AS create_time FROM records WHERE status_code = 0 GROUP BY ALL)
SELECT id, interface_key, input_param, dt FROM records JOIN newest USING (interface_key, input_param, create_time) WHERE status_code = 0""",
    "latest_by_day": f"""WITH {SQL_RECORDS}, coarse AS (SELECT *, date_trunc('day', create_time) AS day FROM records WHERE status_code = 0),
newest AS (SELECT interface_key, dt, input_param, max(day) AS day FROM coarse GROUP BY ALL)
SELECT id, interface_key, input_param, dt FROM coarse JOIN newest USING (interface_key, dt, input_param, day)""",
    "newest_profiles": f"""WITH {SQL_PROFILES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY company_name ORDER BY update_time DESC NULLS LAST, api_record_id DESC) AS rn FROM profiles)
SELECT api_record_id, company_name, dt FROM ranked WHERE rn <= 3""",
    "partition_scans": f"""WITH {SQL_RECORDS}
SELECT 'one' AS form, {SQL_SUMMARY} FROM records WHERE dt = '20240116' GROUP BY ALL
UNION ALL SELECT 'latest' AS form, {SQL_SUMMARY} FROM records WHERE dt = (SELECT max(dt) FROM records) GROUP BY ALL
UNION ALL SELECT 'set' AS form, {SQL_SUMMARY} FROM records WHERE dt IN ('20240104', '20240115') GROUP BY ALL
UNION ALL SELECT 'before' AS form, {SQL_SUMMARY} FROM records WHERE dt < '20240110' GROUP BY ALL
UNION ALL SELECT 'window' AS form, {SQL_SUMMARY} FROM records WHERE create_time >= '2024-01-16' AND create_time < '2024-01-17' GROUP BY ALL""",
    "partition_overwrite": f"""WITH {SQL_RECORDS}, rerun AS (SELECT CASE WHEN dt >= '20240115' THEN id + 1000000 ELSE id END AS id, status_code, dt FROM records)
SELECT {SQL_SUMMARY} FROM rerun GROUP BY ALL""",
    "split_log": f"""WITH {SQL_RECORDS}
SELECT interface_key, '20240601' AS dt, count(*) AS row_count, sum(status_code)::BIGINT AS status_sum FROM records
WHERE status_code = 0 OR interface_key = '1168' GROUP BY ALL""",
    "snapshot_rebuild": "SELECT c_name AS name, c_nationkey AS nation, NULL::VARCHAR AS table_counts FROM customer",
    "replace_key": f"""WITH {SQL_PROFILES}, {SQL_CUSTOMERS}
SELECT api_record_id, company_name, dt FROM profiles WHERE NOT (dt = '20240102' AND company_name IN (SELECT name FROM customers WHERE is_prepaid = '是'))
UNION ALL SELECT -c_custkey, name, '20240102' FROM customers WHERE is_prepaid = '是' AND is_new_customer = '是'""",
    "replace_records": f"""WITH {SQL_RECORDS},
fresh AS (SELECT (SELECT max(id) FROM records) + row_number() OVER (ORDER BY id) AS id, interface_key, input_param, 0 AS status_code, dt
  FROM records WHERE status_code <> 0)
SELECT id, interface_key, input_param, status_code, dt FROM records r WHERE NOT EXISTS (SELECT 1 FROM fresh f
  WHERE f.interface_key = r.interface_key AND f.dt = r.dt AND f.input_param = r.input_param)
UNION ALL SELECT id, interface_key, input_param, status_code, dt FROM fresh""",
    "restamp_append": f"""WITH {SQL_PROFILES}, {SQL_CUSTOMERS}, both_parts AS (
SELECT api_record_id, company_name, data_create_time, dt FROM profiles
UNION ALL SELECT api_record_id, company_name, data_create_time, '20240101' FROM profiles WHERE dt = '20240103'
  AND company_name IN (SELECT name FROM customers WHERE is_prepaid = '是'))
SELECT api_record_id, company_name, strftime(data_create_time, '%Y-%m-%d %H:%M:%S') AS data_create_time, dt FROM both_parts""",
    "upsert": f"""WITH {SQL_CUSTOMERS}
SELECT name, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE is_prepaid END AS is_prepaid, c_nationkey FROM customers
UNION ALL SELECT name || '-b', 'new', NULL FROM customers WHERE c_custkey % 3 <> 0""",
    "upsert_stored": f"""WITH {SQL_CUSTOMERS}
SELECT name, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE is_prepaid END AS is_prepaid, c_nationkey FROM customers
UNION ALL SELECT name || '-b', 'new', NULL FROM customers WHERE c_custkey % 3 <> 0""",
    "conform": """SELECT c_custkey::INTEGER AS c_custkey, NULL::BIGINT AS c_name,
  c_acctbal::DECIMAL(24,4)::VARCHAR AS c_acctbal, NULL::VARCHAR AS dt FROM customer""",
    "csv_roundtrip": f"""WITH {SQL_PROFILES}
SELECT api_record_id::VARCHAR AS api_record_id, company_name, strftime(update_time, '%Y-%m-%d %H:%M:%S') AS update_time, dt,
  true AS wrote_nothing FROM profiles WHERE dt = '20240102'""",
    "continue_ids": f"""WITH {SQL_CUSTOMERS}
SELECT name, (SELECT max(event_id) FROM events) + row_number() OVER (ORDER BY name) AS id FROM customers""",
    "max_ids": f"WITH {SQL_RECORDS} SELECT coalesce(max(id), -1) AS max_id, max(dt) AS max_dt FROM records",
    "merge_pages": f"""WITH calls AS (SELECT o_orderkey, ({CALL_TOTAL})::INTEGER AS total,
  unnest(range(1, ceil(({CALL_TOTAL}) / 20.0)::INTEGER + 2)) AS page_num FROM orders),
pages AS (SELECT *, {PAGE_ERROR} AS error_code FROM calls),
stops AS (SELECT o_orderkey, min(page_num) AS stop FROM pages WHERE error_code <> 0 GROUP BY ALL),
good AS (SELECT p.* FROM pages p LEFT JOIN stops s USING (o_orderkey)
  WHERE p.page_num <= greatest(1, ceil(total / 20.0)) AND (stop IS NULL OR p.page_num < stop)),
used AS (SELECT o_orderkey, count(*) AS pages_used FROM good GROUP BY ALL),
listed AS (SELECT o_orderkey, string_agg(o_orderkey || '-' || page_num || '-' || x, ',' ORDER BY page_num, x) AS items
  FROM good, unnest(range(0, (o_orderkey + page_num) % 3 + 1)) AS u(x) GROUP BY ALL)
SELECT p.o_orderkey, error_code AS status_code, total, coalesce(pages_used, 0)::INTEGER AS pages_used,
  CASE WHEN error_code = 0 THEN items END AS items
FROM pages p LEFT JOIN used USING (o_orderkey) LEFT JOIN listed USING (o_orderkey) WHERE page_num = 1""",
    "merged_records": f"""WITH calls AS (SELECT o_orderkey, ({CALL_TOTAL})::INTEGER AS total,
  unnest(range(1, ceil(({CALL_TOTAL}) / 20.0)::INTEGER + 2)) AS page_num FROM orders),
pages AS (SELECT *, CASE WHEN o_orderkey % 13 = 5 AND page_num = 2 THEN -1 ELSE {PAGE_ERROR} END AS error_code FROM calls),
stops AS (SELECT o_orderkey, min(page_num) AS stop FROM pages WHERE error_code <> 0 GROUP BY ALL)
SELECT o_orderkey AS api_record_id, 'c' || o_orderkey AS company_name, total, 't' || o_orderkey || '-' || page_num || '-' || x AS tax_id_number,
  CASE WHEN x > 0 THEN x::VARCHAR END AS own_tax_amount, CASE WHEN x % 2 = 0 THEN 'n ] [ x' END AS taxpayer_name
FROM pages p LEFT JOIN stops USING (o_orderkey), unnest(range(0, (o_orderkey + page_num) % 3 + 1)) AS u(x)
WHERE o_orderkey % 7 <> 3 AND page_num <= greatest(1, ceil(total / 20.0)) AND (stop IS NULL OR page_num < stop)""",
    "resolve_attempts": f"""WITH tried AS (SELECT o_orderkey, unnest(range(1, o_orderkey % 5 + 2)) AS attempt FROM orders),
log AS (SELECT *, {ATTEMPT_CODE} AS code FROM tried WHERE attempt = 1 OR o_orderkey % 3 <> 0),
ranked AS (SELECT *, CASE WHEN code = 0 OR (o_orderkey % 2 = 0 AND code = 300000) THEN attempt ELSE 100 - attempt END AS place FROM log),
final AS (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY place) = 1)
SELECT o_orderkey, attempt::INTEGER AS attempts, code AS status_code, 'p' || o_orderkey || '-' || attempt AS output_result,
  CASE WHEN code = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS outcome FROM final""",
    "failure_records": f"""WITH {SQL_RECORDS}
SELECT id, CASE WHEN k % 3 = 2 THEN -1 WHEN k % 7 = 0 THEN -2 ELSE status_code END AS status_code,
  CASE WHEN k % 3 = 2 THEN '{{"error_type":"HTTP_EXCEPTION","error_code":-1,"error_msg":"no answer ' || k || '"}}'
    WHEN k % 7 = 0 THEN '{{"error_type":"OTHER_EXCEPTION","error_code":-2,"error_msg":"no answer ' || k || '"}}'
    WHEN output_result = 'broken' THEN '{{"raw_error":"broken"}}' ELSE output_result END AS detail
FROM records WHERE status_code <> 0""",
    "decode_codes": f"""WITH {SQL_RECORDS}, {SQL_REGISTRY}, {SQL_CODES}
SELECT interface_key, r.status_code, count(*) AS records, coalesce(any_value(meaning), '未知错误码(' || r.status_code || ')') AS text
FROM records r JOIN registry USING (interface_key) LEFT JOIN codes c ON c.provider = registry.provider AND c.status_code = r.status_code
GROUP BY interface_key, r.status_code""",
    "decode_enums": """SELECT (l_linenumber - 1)::VARCHAR AS code, count(*) AS lines,
  CASE l_linenumber WHEN 1 THEN '预警提醒' WHEN 2 THEN '自身风险' WHEN 3 THEN '周边风险' WHEN 4 THEN '历史风险'
    ELSE '未知错误码(' || (l_linenumber - 1) || ')' END AS text FROM lineitem GROUP BY ALL""",
    "distinct_keys": f"WITH {SQL_RECORDS} SELECT DISTINCT interface_key, input_param FROM records",
    "trace_ratio": f"""WITH parsed AS (SELECT l_orderkey, ['20240101', '20240102', '20240103'][l_orderkey % 3 + 1] AS dt FROM lineitem),
linked AS (SELECT p.dt, o_orderkey IS NOT NULL AS known FROM parsed p LEFT JOIN orders ON l_orderkey = o_orderkey AND p.dt = {_status_date})
SELECT dt, count(*) AS parsed_rows, count(*) FILTER (WHERE known) AS linked_rows,
  count(*) FILTER (WHERE known)::DOUBLE / count(*) AS linked_share FROM linked GROUP BY ALL""",
    "partition_counts": f"""WITH {SQL_RECORDS}
SELECT dt, count(*) AS total, count(*) FILTER (WHERE status_code = 0) AS success, count(*) FILTER (WHERE status_code <> 0) AS failed
FROM records GROUP BY ALL""",
    "repeated_success": f"""WITH {SQL_RECORDS}
SELECT interface_key, dt, input_param, count(*) AS successes FROM records WHERE status_code = 0 GROUP BY ALL HAVING count(*) > 1""",
    "schema_report": f"""WITH {SQL_PROFILES}
SELECT 'api_record_id' AS column_name, 'bigint' AS declared_type, 'bigint' AS actual_type, 'ok' AS state, false AS is_partition, count(api_record_id) AS filled FROM profiles
UNION ALL SELECT 'company_name', 'string', 'string', 'ok', false, count(company_name) FROM profiles
UNION ALL SELECT 'update_time', 'timestamp', 'timestamp_ntz', 'type differs', false, count(update_time) FROM profiles
UNION ALL SELECT 'tax_number', 'string', NULL, 'missing', false, NULL
UNION ALL SELECT 'social_credit_code', NULL, 'string', 'unknown', false, count(social_credit_code) FROM profiles
UNION ALL SELECT 'dt', 'string', 'string', 'ok', true, count(dt) FROM profiles""",
    "stored_schema": f"""WITH {SQL_PROFILES}, states AS (
SELECT 'api_record_id' AS column_name, 'bigint' AS declared_type, 'bigint' AS actual_type, 'ok' AS state, false AS is_partition, count(api_record_id) AS filled FROM profiles
UNION ALL SELECT 'company_name', 'string', 'string', 'ok', false, count(company_name) FROM profiles
UNION ALL SELECT 'update_time', 'timestamp', 'timestamp_ntz', 'type differs', false, count(update_time) FROM profiles
UNION ALL SELECT 'tax_number', 'string', NULL, 'missing', false, NULL
UNION ALL SELECT 'social_credit_code', NULL, 'string', 'unknown', false, count(social_credit_code) FROM profiles
UNION ALL SELECT 'dt', 'string', 'string', 'ok', true, count(dt) FROM profiles)
SELECT *, 'ok' AS table_state, 'dated' AS table_name FROM states
UNION ALL SELECT * REPLACE (false AS is_partition), 'not by dt', 'flat' FROM states
UNION ALL SELECT * REPLACE (NULL AS actual_type, 'missing' AS state, false AS is_partition, NULL AS filled), 'missing', 'none' FROM states WHERE declared_type IS NOT NULL""",
    "sample_rows": f"WITH {SQL_RECORDS} SELECT id, input_param FROM records WHERE status_code = 0 ORDER BY create_time, id LIMIT 5",
    "name_difference": f"""WITH {SQL_RECORDS}, {SQL_CUSTOMERS} SELECT name FROM customers EXCEPT SELECT input_param FROM records""",
}
ORACLE["latest_sieved"] = ORACLE["latest_by_day"]
