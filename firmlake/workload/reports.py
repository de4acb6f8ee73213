"""Queries for the call, billing and parse reports, for every business date of the log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlake.plans import reports
from firmlake.registry import response_codes
from firmlake.session import scratch_path
from firmlake.workload.records import SQL_CODES
from firmlake.workload.tables import (
    KEYS,
    SQL_DATED_LISTINGS,
    SQL_LISTINGS,
    SQL_RECORDS,
    SQL_REGISTRY,
    sql_key,
    sql_monthly,
    dated_listings,
    quoted,
    records,
    registry,
    table,
)


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.call_report(records(spark, sf_dir), dated_listings(spark, sf_dir), registry(spark))


def dated(df: DataFrame) -> DataFrame:
    return df.withColumn("report_date", F.col("report_date").cast("string"))


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(reports.status_counts(records(spark, sf_dir), registry(spark)))


def page_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of the paged interfaces with a limit of four pages, the other one without any."""
    settings = registry(spark).withColumn("page_limit", F.when(F.col("interface_key") == "851", 4))
    return dated(reports.page_limits(records(spark, sf_dir), settings))


def call_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(report(spark, sf_dir).drop("normal_codes", "prepaid_frequency"))


def call_report_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One business date, read from the partitions its runs write."""
    log = reports.day_records(records(spark, sf_dir), "2024-01-17", "2024-01-18", ["20240116", "20240104"])
    one = reports.call_report(log, dated_listings(spark, sf_dir), registry(spark))
    return dated(one.select("report_date", "interface_key", "has_data", "total", "call_count"))


def call_report_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(reports.call_totals(report(spark, sf_dir)))


def abnormal_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(reports.abnormal_examples(records(spark, sf_dir), registry(spark), response_codes(spark)))


def alert_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(reports.alert_decision(report(spark, sf_dir)))


def status_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(reports.status_labels(report(spark, sf_dir)))


def idle_interfaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(reports.idle_interfaces(report(spark, sf_dir)))


def normal_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(reports.normal_failures(report(spark, sf_dir), response_codes(spark)))


# parsed rows: one per line, spread over interfaces, dates and companies
PARSED = [
    "({keys})[{at}] AS interface_key",
    "concat('202401', lpad(cast(l_suppkey % 30 + 1 AS {text}), 2, '0')) AS dt",
    "concat('Customer#', lpad(cast(l_partkey % 200 AS {text}), 9, '0')) AS company_name",
]


def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [c.format(keys=f"array({quoted(KEYS)})", at="cast(l_orderkey % 13 AS int)", text="string") for c in PARSED]
    return table(spark, sf_dir, "lineitem").selectExpr(*columns)


def parsed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.parse_report(parsed_lines(spark, sf_dir), records(spark, sf_dir), dated_listings(spark, sf_dir), registry(spark))


def parse_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(parsed_report(spark, sf_dir))


def parse_report_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(reports.parse_totals(parsed_report(spark, sf_dir)))


def succeeded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = reports.succeeded_rows(parsed_lines(spark, sf_dir), records(spark, sf_dir))
    return done.groupBy("interface_key", "company_name").agg(F.count("*").alias("rows"))


def export_succeeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export of those rows, read back."""
    path = scratch_path(spark, "export")
    reports.export_succeeded(parsed_lines(spark, sf_dir), records(spark, sf_dir), path)
    return spark.read.csv(path, header=True, schema="interface_key STRING, dt STRING, company_name STRING")


QUERIES = {
    "export_succeeded": export_succeeded,
    "status_counts": status_counts,
    "page_limits": page_limits,
    "call_report": call_report,
    "call_report_day": call_report_day,
    "call_report_total": call_report_total,
    "abnormal_examples": abnormal_examples,
    "alert_decision": alert_decision,
    "status_labels": status_labels,
    "idle_interfaces": idle_interfaces,
    "normal_failures": normal_failures,
    "parse_report": parse_report,
    "parse_report_total": parse_report_total,
    "succeeded_rows": succeeded_rows,
}

_parsed = ", ".join(c.format(keys=f"[{quoted(KEYS)}]", at="l_orderkey % 13 + 1", text="VARCHAR") for c in PARSED)
_listed = "ceil(coalesce(try_cast(CASE WHEN output_result LIKE '{{%' THEN output_result->>'$.result.total' END AS INTEGER), 0) / 20.0)::BIGINT"
_pages = f"greatest(1, least({_listed}, 250))"
_label = "CASE {0} WHEN 'daily' THEN 'Daily' WHEN 'monthly' THEN 'Monthly' ELSE 'Half Year' END"
_frequency = f"'账期: ' || {_label.format('post_paid_frequency')} || ' / 预付: ' || {_label.format('prepaid_frequency')}"
_run_day = "CASE {0} WHEN 'daily' THEN true WHEN 'monthly' THEN day(report_date) = 5 ELSE day(report_date) = 5 AND month(report_date) IN (1, 7) END"

_own = f"CASE r.dt WHEN CASE frequency WHEN 'daily' THEN {sql_key('create_time - INTERVAL 1 DAY')} ELSE {sql_monthly('create_time')} END THEN true ELSE false END"

# a record counts where it sits in the partition of its own date; days without any are reported too
SQL_REPORT = f"""{SQL_RECORDS}, {SQL_REGISTRY}, {SQL_LISTINGS}, {SQL_DATED_LISTINGS},
called AS (SELECT r.*, create_time::DATE AS report_date, provider, charge_per_query,
    CASE WHEN paged THEN {_pages.format()} ELSE 1 END AS calls, list_contains(normal_codes, status_code) AS normal
  FROM records r JOIN registry USING (interface_key) WHERE reported AND {_own}),
outcomes AS (SELECT report_date, interface_key, sum(calls)::BIGINT AS total,
    sum(CASE WHEN status_code = 0 THEN calls ELSE 0 END)::BIGINT AS success,
    sum(CASE WHEN status_code <> 0 AND normal THEN calls ELSE 0 END)::BIGINT AS normal_failure,
    sum(CASE WHEN status_code <> 0 AND NOT normal THEN calls ELSE 0 END)::BIGINT AS abnormal_failure
  FROM called GROUP BY ALL),
classes AS (SELECT report_date, interface_key, sum(CASE WHEN is_prepaid = '否' THEN calls ELSE 0 END)::BIGINT AS non_prepaid_calls,
    sum(CASE WHEN is_prepaid = '是' THEN calls ELSE 0 END)::BIGINT AS prepaid_calls
  FROM called LEFT JOIN (SELECT DISTINCT name, is_prepaid, dt AS customer_dt FROM dated_listings) c
    ON input_param = name AND customer_dt = strftime(report_date - INTERVAL 1 DAY, '%Y%m%d') GROUP BY ALL),
report AS (SELECT report_date, interface_key, interface_name, provider, {_frequency} AS frequency, coalesce(total, 0) > 0 AS has_data,
    coalesce(total, 0) AS total, coalesce(success, 0) AS success, coalesce(normal_failure, 0) AS normal_failure,
    coalesce(abnormal_failure, 0) AS abnormal_failure,
    CASE WHEN charge_per_query THEN coalesce(total, 0) ELSE coalesce(success, 0) END AS call_count,
    coalesce(non_prepaid_calls, 0) AS non_prepaid_calls, coalesce(prepaid_calls, 0) AS prepaid_calls,
    {_run_day.format('post_paid_frequency')} AS non_prepaid_run_day, {_run_day.format('prepaid_frequency')} AS prepaid_run_day,
    prepaid_frequency, normal_codes
  FROM (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY))::DATE AS report_date
    FROM (SELECT min(create_time)::DATE AS first_day, max(create_time)::DATE AS last_day FROM records) span) CROSS JOIN (SELECT * FROM registry WHERE reported)
  LEFT JOIN outcomes USING (report_date, interface_key) LEFT JOIN classes USING (report_date, interface_key))"""
_sums = ", ".join(
    f"sum({m})::BIGINT AS {m}"
    for m in ("total", "success", "normal_failure", "abnormal_failure", "call_count", "non_prepaid_calls", "prepaid_calls")
)
_parse_sums = ", ".join(f"sum({m})::BIGINT AS {m}" for m in reports.PARSE_COUNTS)

# successes of a day in the day's own partition, and the rows parsed from them
SQL_PARSED = f"""{SQL_REPORT}, parsed AS (SELECT {_parsed} FROM lineitem),
ok AS (SELECT report_date, interface_key, dt, input_param FROM called WHERE status_code = 0),
successes AS (SELECT report_date, interface_key, count(*) AS success_count FROM ok GROUP BY ALL),
rows_found AS (SELECT report_date, interface_key, count(*) AS total, count(*) FILTER (WHERE is_prepaid = '是') AS prepaid,
    count(*) FILTER (WHERE is_prepaid = '否') AS non_prepaid,
    count(*) FILTER (WHERE is_prepaid IS NULL OR is_prepaid NOT IN ('是', '否')) AS uncategorized
  FROM (SELECT DISTINCT * FROM ok) s JOIN parsed p USING (interface_key, dt)
  LEFT JOIN (SELECT DISTINCT name, is_prepaid, dt AS customer_dt FROM dated_listings) c
    ON p.company_name = name AND customer_dt = strftime(report_date - INTERVAL 1 DAY, '%Y%m%d')
  WHERE p.company_name = input_param GROUP BY ALL),
parse_report AS (SELECT report_date, interface_key, CASE r.frequency WHEN 'daily' THEN {sql_key('report_date - INTERVAL 1 DAY')} ELSE {sql_monthly('report_date')} END AS dt,
    r.interface_name, report.frequency, relation,
    {', '.join(f"coalesce({t}.{c}, 0)::BIGINT AS {c}" for t, c in (("s", "success_count"), ("f", "total"), ("f", "prepaid"), ("f", "non_prepaid"), ("f", "uncategorized")))},
    coalesce(f.total, 0) > 0 AS has_data, CASE WHEN coalesce(f.total, 0) = 0 THEN '无数据' END AS note
  FROM report JOIN registry r USING (interface_key) LEFT JOIN successes s USING (report_date, interface_key) LEFT JOIN rows_found f USING (report_date, interface_key))"""

ORACLE = {
    "status_counts": f"""WITH {SQL_REPORT}
SELECT report_date::VARCHAR AS report_date, interface_key, status_code, count(*) AS records, sum(calls)::BIGINT AS calls FROM called GROUP BY ALL""",
    "page_limits": f"""WITH {SQL_REPORT}, paged AS (SELECT report_date, interface_key, CASE interface_key WHEN '851' THEN 4 END AS page_limit,
  greatest(1, {_listed.format()}) AS listed FROM called WHERE interface_key IN ('851', '1041'))
SELECT report_date::VARCHAR AS report_date, interface_key, page_limit, count(*) AS records, count(*) FILTER (WHERE listed > page_limit) AS records_cut,
  sum(listed)::BIGINT AS pages_listed, sum(CASE WHEN listed > page_limit THEN listed - page_limit ELSE 0 END)::BIGINT AS pages_lost FROM paged GROUP BY ALL""",
    "call_report": f"""WITH {SQL_REPORT}
SELECT * EXCLUDE (prepaid_frequency, normal_codes) REPLACE (report_date::VARCHAR AS report_date) FROM report""",
    "call_report_day": f"""WITH {SQL_REPORT}
SELECT report_date::VARCHAR AS report_date, interface_key, has_data, total, call_count FROM report WHERE report_date = DATE '2024-01-17'""",
    "call_report_total": f"""WITH {SQL_REPORT}
SELECT report_date::VARCHAR AS report_date, interface_key, {_sums}, grouping(interface_key)::TINYINT AS is_total
FROM report GROUP BY GROUPING SETS ((report_date, interface_key), (report_date))""",
    "abnormal_examples": f"""WITH {SQL_REPORT}, {SQL_CODES},
ranked AS (SELECT *, row_number() OVER (PARTITION BY report_date, interface_key, status_code ORDER BY id) AS rn,
    CASE WHEN k % 3 = 2 THEN 'timeout ' || k WHEN k % 6 = 1 THEN 'code ' || k END AS reason
  FROM called WHERE status_code <> 0 AND NOT normal),
reasoned AS (SELECT *, count(CASE WHEN rn <= 5 THEN reason END) OVER (PARTITION BY report_date, interface_key, status_code ORDER BY id) AS nth FROM ranked)
SELECT report_date::VARCHAR AS report_date, interface_key, r.status_code, count(*) AS records,
  coalesce(any_value(meaning), '未知错误码(' || r.status_code || ')') AS meaning,
  string_agg(CASE WHEN rn <= 10 THEN input_param END, ', ' ORDER BY id) AS companies,
  coalesce(string_agg(CASE WHEN rn <= 5 AND nth <= 3 THEN reason END, '; ' ORDER BY id), '') AS reasons,
  least(count(*), 10)::INTEGER AS companies_listed, count(*) > 10 AS is_sample
FROM reasoned r LEFT JOIN codes c ON c.provider = r.provider AND c.status_code = r.status_code
GROUP BY r.report_date, interface_key, r.status_code""",
    "alert_decision": f"""WITH {SQL_REPORT}, decided AS (
SELECT report_date::VARCHAR AS report_date, bool_or(abnormal_failure > 0) AS has_abnormal,
  bool_or((non_prepaid_run_day OR prepaid_run_day) AND NOT has_data) AS has_missing FROM report GROUP BY ALL)
SELECT *, has_abnormal OR has_missing AS need_alert FROM decided""",
    "status_labels": f"""WITH {SQL_REPORT}, missing AS (SELECT *, CASE WHEN total = 0 THEN CASE WHEN non_prepaid_run_day AND prepaid_run_day THEN '无数据-账期/预付'
  WHEN non_prepaid_run_day THEN '无数据-账期' WHEN prepaid_run_day THEN '无数据-预付' END END AS missing FROM report)
SELECT report_date::VARCHAR AS report_date, interface_key, CASE WHEN total > 0 THEN abnormal_failure > 0 ELSE missing IS NOT NULL END AS needs_attention, missing FROM missing""",
    "idle_interfaces": f"""WITH {SQL_REPORT}
SELECT report_date::VARCHAR AS report_date, interface_key, frequency || ', 月度跑批日为每月5号' ||
  CASE WHEN prepaid_frequency = 'half_year' THEN ', 半年度跑批日为1月和7月的5号' ELSE '' END AS note
FROM report WHERE total = 0 AND NOT non_prepaid_run_day AND NOT prepaid_run_day""",
    "normal_failures": f"""WITH {SQL_REPORT}
SELECT report_date::VARCHAR AS report_date, interface_key, normal_failure, CASE WHEN interface_key = 'P51060'
  THEN '1(【有效请求】请求无结果), 1021(未收录/无匹配结果(不在文档附录中,暂归为正常范围)), 2001(【无效请求】处理失败，请检查参数或稍后重试)'
  ELSE '300000(经查无结果)' END AS normal_codes FROM report WHERE normal_failure > 0""",
    "parse_report": f"""WITH {SQL_PARSED}
SELECT * REPLACE (report_date::VARCHAR AS report_date) FROM parse_report""",
    "parse_report_total": f"""WITH {SQL_PARSED}
SELECT report_date::VARCHAR AS report_date, interface_key, {_parse_sums}, count(*) FILTER (WHERE has_data) AS with_data, grouping(interface_key)::TINYINT AS is_total
FROM parse_report GROUP BY GROUPING SETS ((report_date, interface_key), (report_date))""",
    "export_succeeded": f"""WITH {SQL_RECORDS}, parsed AS (SELECT {_parsed} FROM lineitem)
SELECT interface_key, dt, company_name FROM parsed p
WHERE EXISTS (SELECT 1 FROM records r WHERE r.status_code = 0 AND r.interface_key = p.interface_key AND r.dt = p.dt AND r.input_param = p.company_name)""",
    "succeeded_rows": f"""WITH {SQL_RECORDS}, parsed AS (SELECT {_parsed} FROM lineitem)
SELECT interface_key, company_name, count(*) AS rows FROM parsed p
WHERE EXISTS (SELECT 1 FROM records r WHERE r.status_code = 0 AND r.interface_key = p.interface_key AND r.dt = p.dt AND r.input_param = p.company_name)
GROUP BY ALL""",
}
