"""Queries for uploaded files, their manifest and manual tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlake.operators.latest import ranked_per
from firmlake.operators.profile import table_counts
from firmlake.session import scratch_path
from firmlake.sources import files, storage
from firmlake.workload.tables import SQL_LISTING, SQL_MANIFEST, listing, manifest, table


def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.classify_files(listing(spark, sf_dir), manifest(spark, sf_dir)).select("filename", "state")


def forced_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.classify_files(listing(spark, sf_dir), manifest(spark, sf_dir), force=True).select("filename", "state")


def newest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.newest_file(listing(spark, sf_dir)).select("filename", "file_date")


def keep_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.keep_newest(listing(spark, sf_dir)).select("filename", "keep")


def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = table(spark, sf_dir, "events").selectExpr(
        "CASE WHEN event_id % 10 = 0 THEN concat('x', event_id) ELSE date_format(ts, 'yyyyMMdd') END AS dt"
    )
    return files.expired(folders.distinct(), F.lit(dt.date(2024, 2, 14)), 30)


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.load_report(manifest(spark, sf_dir)).withColumn("load_date", F.col("load_date").cast("string"))


def last_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.last_of_day(manifest(spark, sf_dir)).select("event_id", "filename", "status")


def previous_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.previous_load(manifest(spark, sf_dir)).select("event_id", "filename", "md5")


def count_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last two counted loads of every file side by side."""
    loads = files.counted_loads(manifest(spark, sf_dir)).select("filename", "processed_at", "event_id", "table_counts")
    order = [F.col("processed_at").desc(), F.col("event_id").desc()]
    last_two = files.exploded_counts(ranked_per(loads, ["filename"], order, 2), ["filename", "place"])
    return files.count_changes(last_two.where("place = 1"), last_two.where("place = 2"), ["filename"])


def load_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of one upload loaded under clean names: the manifest row, and what the second one holds."""
    uploads = {
        "Order Lines": table(spark, sf_dir, "lineitem").withColumnRenamed("l_tax", "l tax"),
        "part#A": table(spark, sf_dir, "part").withColumn("note", F.lit(None).cast("date")),
    }
    path = scratch_path(spark, "manual")
    log = files.load_file(spark, uploads, path, "book.accdb", "m1", dt.datetime(2024, 1, 17, 22))
    loaded = spark.read.parquet(f"{path}/manual_part_a").agg(F.count("*").alias("row_count"), F.max("note").alias("note"))
    return log.select("filename", "status", "table_names", "table_counts").unionByName(
        loaded.select(
            F.lit("manual_part_a").alias("filename"), F.concat(F.lit("["), "note", F.lit("]")).alias("status"),
            F.lit(None).cast("string").alias("table_names"), F.col("row_count").cast("string").alias("table_counts"),
        )
    )


def load_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads under different file names, a failed one, and the second day's report from what is stored."""
    path, tables = scratch_path(spark, "manual"), {n: table(spark, sf_dir, n) for n in ("lineitem", "part", "orders", "region")}
    first = {"Order Lines": tables["lineitem"], "part#A": tables["part"], "Old": tables["region"]}
    second = {"Order Lines": tables["lineitem"].where("l_orderkey % 2 = 0"), "part#A": tables["part"], "New T": tables["orders"]}
    log = files.load_file(spark, first, path, "book_1.accdb", "m1", dt.datetime(2024, 1, 16, 22))
    log = log.unionByName(files.load_file(spark, second, path, "book_2.accdb", "m2", dt.datetime(2024, 1, 17, 9)))
    clash = {"a b": tables["region"], "a_b": tables["region"]}
    log = log.unionByName(files.load_file(spark, clash, path, "bad.accdb", "m3", dt.datetime(2024, 1, 17, 10)))
    stored = storage.stored_counts(spark, path, ["manual_order_lines", "manual_part_a", "manual_new_t", "manual_old"])
    report = files.load_details(log, stored, dt.date(2024, 1, 17))
    return report.withColumn("status", F.substring_index("status", ":", 1))


def counted_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_counts({name: table(spark, sf_dir, name) for name in ("orders", "lineitem", "customer")})


QUERIES = {
    "changed_files": changed_files,
    "forced_files": forced_files,
    "newest_file": newest_file,
    "keep_newest": keep_newest,
    "retention": retention,
    "load_report": load_report,
    "last_of_day": last_of_day,
    "previous_load": previous_load,
    "count_changes": count_changes,
    "load_tables": load_tables,
    "load_details": load_details,
    "table_counts": counted_tables,
}

_file_date = "coalesce(nullif(regexp_extract(filename, '([0-9]{8})', 1), ''), strftime(make_timestamp(modified_ms * 1000), '%Y%m%d'))"
_count = "try_cast(table_counts->>('$.' || table_name) AS BIGINT)"
_has = "contains(table_counts, '\"' || table_name || '\"')"
_tables = "(VALUES ('lines'), ('items'), ('stock')) AS t(table_name)"

ORACLE = {
    "changed_files": f"""WITH {SQL_LISTING}, {SQL_MANIFEST}, loaded AS (SELECT filename, md5 AS loaded_md5,
  row_number() OVER (PARTITION BY filename ORDER BY processed_at DESC) AS rn FROM manifest WHERE status = 'success')
SELECT filename, CASE WHEN loaded_md5 IS NULL THEN 'new' WHEN loaded_md5 <> md5 THEN 'changed' ELSE 'unchanged' END AS state
FROM listing LEFT JOIN (SELECT * FROM loaded WHERE rn = 1) USING (filename)""",
    "forced_files": f"WITH {SQL_LISTING} SELECT filename, 'forced' AS state FROM listing",
    "newest_file": f"""WITH {SQL_LISTING}, dated AS (SELECT *, {_file_date} AS file_date FROM listing)
SELECT filename, file_date FROM dated ORDER BY file_date DESC, modified_ms DESC, filename DESC LIMIT 1""",
    "keep_newest": f"""WITH {SQL_LISTING}
SELECT filename, row_number() OVER (ORDER BY modified_ms DESC, filename DESC) <= 3 AS keep FROM listing""",
    "retention": """WITH folders AS (SELECT DISTINCT CASE WHEN event_id % 10 = 0 THEN 'x' || event_id ELSE strftime(ts, '%Y%m%d') END AS dt FROM events)
SELECT dt FROM folders WHERE regexp_matches(dt, '^[0-9]{8}$') AND dt < strftime(DATE '2024-02-14' - INTERVAL 30 DAY, '%Y%m%d')""",
    "load_report": f"""WITH {SQL_MANIFEST}, ranked AS (SELECT *, processed_at::DATE AS load_date,
  row_number() OVER (PARTITION BY processed_at::DATE, filename ORDER BY processed_at DESC, md5 DESC) AS rn FROM manifest),
last AS (SELECT * FROM ranked WHERE rn = 1),
counts AS (SELECT load_date, count(*) AS tables, sum({_count})::BIGINT AS row_count FROM last, {_tables}
  WHERE status = 'success' AND table_counts <> '' AND {_has} GROUP BY ALL),
found AS (SELECT load_date, count(*) AS files, count(*) FILTER (WHERE status <> 'success') AS failed_files FROM last GROUP BY ALL)
SELECT load_date::VARCHAR AS load_date, files, failed_files, coalesce(tables, 0) AS tables, coalesce(row_count, 0) AS row_count,
  failed_files > 0 AS need_alert FROM found LEFT JOIN counts USING (load_date)""",
    "last_of_day": f"""WITH {SQL_MANIFEST}
SELECT event_id, filename, status FROM manifest QUALIFY row_number() OVER (PARTITION BY processed_at::DATE, filename ORDER BY processed_at DESC, md5 DESC) = 1""",
    "previous_load": f"""WITH {SQL_MANIFEST}
SELECT event_id, filename, md5 FROM manifest WHERE status = 'success' AND table_counts <> ''
QUALIFY row_number() OVER (ORDER BY processed_at DESC, md5 DESC) = 2""",
    "count_changes": f"""WITH {SQL_MANIFEST}, ranked AS (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY processed_at DESC, event_id DESC) AS rn
  FROM manifest WHERE status = 'success' AND table_counts <> ''),
counts AS (SELECT filename, rn, table_name, {_count} AS row_count FROM ranked, {_tables} WHERE rn <= 2 AND {_has}),
sides AS (SELECT coalesce(n.filename, p.filename) AS filename, coalesce(n.table_name, p.table_name) AS table_name,
    p.row_count AS previous_rows, n.row_count AS current_rows, n.filename IS NULL AS gone, p.filename IS NULL AS fresh
  FROM (SELECT * FROM counts WHERE rn = 1) n FULL JOIN (SELECT * FROM counts WHERE rn = 2) p
    ON n.filename = p.filename AND n.table_name = p.table_name)
SELECT filename, table_name, previous_rows, current_rows, CASE WHEN fresh THEN '新增' WHEN gone THEN '移除'
  WHEN previous_rows IS NULL OR current_rows IS NULL THEN '类型异常' WHEN previous_rows = current_rows THEN '-'
  WHEN current_rows > previous_rows THEN '+' || (current_rows - previous_rows) ELSE (current_rows - previous_rows)::VARCHAR END AS change
FROM sides""",
    "load_tables": """SELECT 'book.accdb' AS filename, 'success' AS status, 'Order Lines,part#A' AS table_names,
  '{"Order Lines": ' || (SELECT count(*) FROM lineitem) || ', "part#A": ' || (SELECT count(*) FROM part) || '}' AS table_counts
UNION ALL SELECT 'manual_part_a', '[]', NULL, (SELECT count(*) FROM part)::VARCHAR""",
    "load_details": """WITH n AS (SELECT (SELECT count(*) FROM lineitem) AS lines, (SELECT count(*) FROM lineitem WHERE l_orderkey % 2 = 0) AS even,
  (SELECT count(*) FROM part) AS parts, (SELECT count(*) FROM orders) AS orders_, (SELECT count(*) FROM region) AS regions)
SELECT 'book_2.accdb' AS filename, 'success' AS status, 'Order Lines' AS table_name, 'manual_order_lines' AS target_name, lines AS previous_rows,
  '-' || format('{:,}', lines - even) AS change, even AS current_rows, false AS is_total FROM n
UNION ALL SELECT 'book_2.accdb', 'success', 'part#A', 'manual_part_a', parts, '-', parts, false FROM n
UNION ALL SELECT 'book_2.accdb', 'success', 'New T', 'manual_new_t', NULL, '新增', orders_, false FROM n
UNION ALL SELECT NULL, NULL, 'Old', NULL, regions, '移除', NULL, false FROM n
UNION ALL SELECT 'bad.accdb', 'failed', NULL, NULL, NULL, NULL, NULL, false FROM n
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, even + parts + orders_, true FROM n""",
    "table_counts": """WITH counts AS (SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
  UNION ALL SELECT 'customer', count(*) FROM customer)
SELECT coalesce(table_name, 'total') AS table_name, sum(n)::BIGINT AS row_count, grouping(table_name) = 1 AS is_total FROM counts GROUP BY ROLLUP (table_name)""",
}
