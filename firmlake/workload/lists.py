"""Queries for scopes, derived lists and the batch calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlake.functions import calendar as cal
from firmlake.plans import lists, scopes
from firmlake.registry import INTERFACES
from firmlake.workload.tables import (
    MONTHLY_KEYS,
    SQL_ACCOUNTS,
    SQL_CUSTOMERS,
    SQL_PROFILES,
    SQL_RECORDS,
    SQL_WHITE,
    account_groups,
    accounts,
    customers,
    profiles,
    quoted,
    records,
    sql_half_year,
    sql_key,
    sql_monthly,
    table,
    white,
)

# a monthly batch day in a half-year month, one outside, and an ordinary day
DATES = ["2024-01-05", "2024-02-05", "2024-02-17"]
SQL_DATES = f"dated AS (SELECT *, unnest([{', '.join(f'DATE {d!r}' for d in DATES)}]) AS run_date FROM customers)"
SQL_POST_PAID_OR_NEW = "(is_prepaid = '否' OR (is_new_customer = '是' AND is_prepaid = '是'))"
SQL_NEW = "(is_new_customer = '是' AND in_monthly_batch = '否')"
SQL_DAILY = f"(day(run_date) = 5 OR {SQL_POST_PAID_OR_NEW})"
SQL_MONTHLY = f"(day(run_date) = 5 OR {SQL_NEW})"
SQL_HALF = f"CASE WHEN day(run_date) = 5 THEN month(run_date) IN (1, 7) OR {SQL_POST_PAID_OR_NEW} ELSE {SQL_NEW} END"
PLAN_DATE = dt.date(2024, 1, 17)
BATCH_DATE = dt.date(2024, 1, 5)
INITIAL_DATE = dt.date(2024, 2, 17)


def dated_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = F.array(*[F.lit(d).cast("date") for d in DATES])
    return customers(spark, sf_dir).withColumn("run_date", F.explode(dates))


def scope_query(rule):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wanted = rule(F.col("run_date"))
        return scopes.scope(dated_customers(spark, sf_dir), wanted, white(spark, sf_dir), ["run_date"]).select(
            F.col("run_date").cast("string").alias("run_date"), "name"
        )

    return run


def scope_sql(rule: str) -> str:
    return f"""WITH {SQL_CUSTOMERS}, {SQL_WHITE}, {SQL_DATES}
SELECT DISTINCT run_date::VARCHAR AS run_date, name FROM dated
WHERE name <> '' AND {rule} AND name NOT IN (SELECT company_name FROM white)"""


def scope_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scopes.scope(customers(spark, sf_dir))


def scope_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A given company against the white list of the whole customer table."""
    one = scopes.single_company(customers(spark, sf_dir), "Customer#000000000", white(spark, sf_dir))
    return one.unionByName(scopes.single_company(one, "Elsewhere Ltd", white(spark, sf_dir)))


def scope_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scope of a prepared list in its newest partition."""
    newest = profiles(spark, sf_dir).select("company_name", "dt")
    latest = newest.where(F.col("dt") == newest.select(F.max("dt")).scalar())
    return scopes.listed_scope(latest, white(spark, sf_dir)).orderBy("name")


def call_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scopes.call_plan(
        customers(spark, sf_dir), branch_names(spark, sf_dir), white(spark, sf_dir), records(spark, sf_dir), INTERFACES,
        F.lit(PLAN_DATE),
    )


def call_plan_targeted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A monthly batch day in a half-year month, with the branch interface run on the new customers."""
    listed = customers(spark, sf_dir)
    return scopes.call_plan(
        listed, branch_names(spark, sf_dir), white(spark, sf_dir), records(spark, sf_dir), INTERFACES, F.lit(BATCH_DATE),
        new_customers=listed.where("is_new_customer = '是'").select(F.col("name").alias("company_name")),
    )


def call_plan_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An initial load on a day whose monthly and half-year partitions differ."""
    return scopes.call_plan(
        customers(spark, sf_dir), branch_names(spark, sf_dir), white(spark, sf_dir), records(spark, sf_dir), INTERFACES,
        F.lit(INITIAL_DATE), initial=True,
    )


def open_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the log without any success."""
    log = records(spark, sf_dir)
    return scopes.without_success(log.select("interface_key", "dt", F.col("input_param").alias("name")).distinct(), log)


def branch_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles(spark, sf_dir).where(F.col("company_org_type").contains("HIGH")).select("company_name")


def supplementary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scopes.supplementary(customers(spark, sf_dir), profiles(spark, sf_dir), "20240102", white(spark, sf_dir))


def white_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lists.white_list(profiles(spark, sf_dir), "20240103", "api_record_id")
    return rows.withColumn("data_create_time", F.col("data_create_time").cast("string"))


def branch_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.branch_list(profiles(spark, sf_dir), customers(spark, sf_dir), "20240103", "20240101", mark="HIGH")


def new_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.new_customers(accounts(spark, sf_dir), account_groups(spark, sf_dir), "20240103", "20240102")


def customer_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = accounts(spark, sf_dir)
    return lists.customer_flags(
        customers(spark, sf_dir),
        known.where("dt = '20240101'").select(F.trim("accountName").alias("name")),
        known.where("dt = '20240103'").select(F.trim("accountName").alias("name")),
    )


BRANCH = "CASE c_custkey % 4 WHEN 0 THEN concat('甲', c_custkey, '公司乙分公司') WHEN 1 THEN concat('丙', c_custkey, '公司') ELSE c_name END"


def parent_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    branches = table(spark, sf_dir, "customer").selectExpr("c_custkey", f"{BRANCH} AS company_name")
    parents = profiles(spark, sf_dir).selectExpr(
        "api_record_id", "company_name", "dt",
        "CASE WHEN api_record_id % 3 > 0 THEN concat('P', api_record_id) END AS parent_company_name",
    )
    return lists.parent_company(branches, parents, "20240102")


def credit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = customers(spark, sf_dir).select(F.col("name").alias("company_name"))
    return lists.credit_code(companies, profiles(spark, sf_dir))


def batch_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    day = F.col("day")
    return days.select(
        day.cast("string").alias("day"),
        cal.last_monthly_batch(day).alias("monthly"),
        cal.last_half_year_batch(day).alias("half_year"),
        cal.last_half_year_batch(day, strict=True).alias("half_year_strict"),
        cal.run_partition(day, F.lit("daily")).alias("daily_partition"),
        cal.run_partition(day, F.lit("monthly"), F.lit(True)).alias("init_partition"),
        cal.is_run_day(day, F.lit("monthly")).alias("monthly_run_day"),
        cal.is_run_day(day, F.lit("half_year")).alias("half_year_run_day"),
    )


QUERIES = {
    "scope_daily": scope_query(scopes.daily_rule),
    "scope_monthly": scope_query(scopes.monthly_rule),
    "scope_half_year": scope_query(lambda d: scopes.monthly_rule(d, half_year_months=(1, 7))),
    "scope_all": scope_all,
    "scope_one": scope_one,
    "scope_listed": scope_listed,
    "call_plan": call_plan,
    "call_plan_targeted": call_plan_targeted,
    "call_plan_initial": call_plan_initial,
    "open_calls": open_calls,
    "supplementary": supplementary,
    "white_list": white_list,
    "branch_list": branch_list,
    "new_customers": new_customers,
    "customer_flags": customer_flags,
    "parent_company": parent_company,
    "credit_codes": credit_codes,
    "batch_calendar": batch_calendar,
}

_active = """SELECT trim(a.accountName) AS company_name, CASE WHEN a.new_ord_payment_new_code = 'Y419' THEN '是' ELSE '否' END AS is_prepaid, a.dt
  FROM accounts a SEMI JOIN (SELECT * FROM account_groups WHERE new_name IN ('Y001-Sold-to party', 'Y003-Payer')) g
    ON g.dt = a.dt AND g.new_accountgroupid = a.new_accountgroup_id
  WHERE regexp_full_match(trim(a.new_sapcode), '[0-9]+') AND a.new_dispensercustomer IS NOT TRUE AND a.new_isclosed IS NOT TRUE"""
_strict = "CASE WHEN day >= make_date(year(day), 7, 5) THEN year(day) || '0704' WHEN day >= make_date(year(day), 1, 5) THEN year(day) || '0104' ELSE (year(day) - 1) || '0704' END"


def plan_sql(date: dt.date, daily_dt: str, monthly_dt: str, branches: str, half_year_dt: str | None = None) -> str:
    """half_year_dt: partition of the half-year interface in an initial load."""
    registry = ", ".join(f"('{r[0]}', '{r[3]}', '{r[10]}', {r[12]})" for r in INTERFACES)
    return f"""WITH {SQL_CUSTOMERS}, {SQL_WHITE}, {SQL_PROFILES}, {SQL_RECORDS},
registry AS (SELECT * FROM (VALUES {registry}) AS r(interface_key, frequency, source, half_year)),
dated AS (SELECT *, DATE '{date}' AS run_date FROM customers),
wanted AS (
  SELECT interface_key, name FROM dated, registry WHERE source = 'customers' AND CASE WHEN {half_year_dt is not None} THEN true WHEN half_year THEN {SQL_HALF}
    WHEN frequency = 'daily' THEN {SQL_DAILY} ELSE {SQL_MONTHLY} END
  UNION SELECT interface_key, company_name FROM (SELECT company_name FROM {branches}) b, registry WHERE source = 'branches'),
placed AS (SELECT interface_key, name, CASE WHEN interface_key = 'P51060' THEN '{half_year_dt or monthly_dt}' WHEN interface_key IN ({quoted(MONTHLY_KEYS)}) THEN '{monthly_dt}' ELSE '{daily_dt}' END AS dt FROM wanted)
SELECT interface_key, dt, name FROM placed p WHERE name NOT IN (SELECT company_name FROM white)
  AND NOT EXISTS (SELECT 1 FROM records r WHERE r.status_code = 0 AND r.interface_key = p.interface_key AND r.dt = p.dt AND r.input_param = p.name)"""


ORACLE = {
    "scope_daily": scope_sql(SQL_DAILY),
    "scope_monthly": scope_sql(SQL_MONTHLY),
    "scope_half_year": scope_sql(SQL_HALF),
    "scope_all": f"WITH {SQL_CUSTOMERS} SELECT DISTINCT name FROM customers WHERE name <> ''",
    "scope_one": f"""WITH {SQL_CUSTOMERS}, {SQL_WHITE}
SELECT name FROM (VALUES ('Customer#000000000'), ('Elsewhere Ltd')) AS t(name) WHERE name NOT IN (SELECT company_name FROM white)""",
    "scope_listed": f"""WITH {SQL_CUSTOMERS}, {SQL_WHITE}, {SQL_PROFILES}
SELECT DISTINCT company_name AS name FROM profiles WHERE dt = (SELECT max(dt) FROM profiles)
  AND company_name NOT IN (SELECT company_name FROM white)""",
    "call_plan": plan_sql(PLAN_DATE, "20240116", "20240104", "profiles WHERE company_org_type LIKE '%HIGH%'"),
    "call_plan_targeted": plan_sql(
        BATCH_DATE, "20240104", "20240104", "(SELECT name AS company_name FROM customers WHERE is_new_customer = '是')"
    ),
    "call_plan_initial": plan_sql(INITIAL_DATE, "20240216", "20240204", "profiles WHERE company_org_type LIKE '%HIGH%'", "20240104"),
    "open_calls": f"""WITH {SQL_RECORDS}
SELECT interface_key, dt, input_param AS name FROM records EXCEPT SELECT interface_key, dt, input_param FROM records WHERE status_code = 0""",
    "supplementary": f"""WITH {SQL_CUSTOMERS}, {SQL_WHITE}, {SQL_PROFILES}
SELECT name FROM customers WHERE is_prepaid = '是' AND name NOT IN (SELECT company_name FROM white)
EXCEPT SELECT company_name FROM profiles WHERE dt = '20240102'""",
    "white_list": f"""WITH {SQL_PROFILES}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY company_name ORDER BY data_create_time DESC NULLS LAST, api_record_id DESC) AS rn
  FROM profiles WHERE dt < '20240103' AND province_short IN ('hk', 'tw'))
SELECT row_number() OVER (ORDER BY company_name) AS id, company_name, province_short, dt AS source_dt,
  data_create_time::VARCHAR AS data_create_time FROM ranked WHERE rn = 1""",
    "branch_list": f"""WITH {SQL_PROFILES}, {SQL_CUSTOMERS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY company_name ORDER BY update_time DESC NULLS LAST, api_record_id DESC) AS rn
  FROM profiles WHERE dt IN ('20240103', '20240101'))
SELECT row_number() OVER (ORDER BY name, is_prepaid) AS id, name AS company_name, is_prepaid, company_org_type,
  strftime(update_time, '%Y-%m-%d %H:%M:%S') AS update_time, r.dt AS source_dt, '20240103' AS dt
FROM ranked r JOIN customers ON company_name = name WHERE rn = 1 AND company_org_type LIKE '%HIGH%'""",
    "new_customers": f"""WITH {SQL_ACCOUNTS}, active AS ({_active}),
ranked AS (SELECT company_name, is_prepaid, row_number() OVER (PARTITION BY company_name ORDER BY is_prepaid) AS rn
  FROM active t WHERE dt = '20240103' AND NOT EXISTS (SELECT 1 FROM active y WHERE y.dt = '20240102' AND y.company_name = t.company_name))
SELECT row_number() OVER (ORDER BY company_name) AS id, company_name, is_prepaid, '20240103' AS dt FROM ranked WHERE rn = 1""",
    "customer_flags": f"""WITH {SQL_CUSTOMERS}, {SQL_ACCOUNTS}
SELECT name, is_prepaid,
  CASE WHEN EXISTS (SELECT 1 FROM accounts a WHERE a.dt = '20240101' AND trim(a.accountName) = name) THEN '否' ELSE '是' END AS is_new_customer,
  CASE WHEN EXISTS (SELECT 1 FROM accounts a WHERE a.dt = '20240103' AND trim(a.accountName) = name) THEN '是' ELSE '否' END AS in_monthly_batch
FROM customers""",
    "parent_company": f"""WITH {SQL_PROFILES}, branches AS (SELECT c_custkey, {BRANCH} AS company_name FROM customer),
parents AS (SELECT *, CASE WHEN api_record_id % 3 > 0 THEN 'P' || api_record_id END AS parent FROM profiles),
ranked AS (SELECT company_name, parent, row_number() OVER (PARTITION BY company_name ORDER BY dt DESC, api_record_id DESC) AS rn
  FROM parents WHERE dt >= '20240102' AND parent IS NOT NULL)
SELECT c_custkey, b.company_name, CASE WHEN c_custkey % 4 = 0 THEN '甲' || c_custkey || '公司' ELSE parent END AS parent_name,
  CASE WHEN c_custkey % 4 = 0 THEN 'name' WHEN parent IS NOT NULL THEN 'record' END AS found_by
FROM branches b LEFT JOIN ranked r ON b.company_name = r.company_name AND rn = 1""",
    "credit_codes": f"""WITH {SQL_CUSTOMERS}, {SQL_PROFILES},
ranked AS (SELECT company_name, social_credit_code, row_number() OVER (PARTITION BY company_name ORDER BY dt DESC, social_credit_code) AS rn
  FROM profiles WHERE social_credit_code <> '')
SELECT name AS company_name, social_credit_code FROM customers LEFT JOIN ranked ON name = company_name AND rn = 1""",
    "batch_calendar": f"""WITH days AS (SELECT DISTINCT o_orderdate::DATE AS day FROM orders)
SELECT day::VARCHAR AS day, {sql_monthly('day')} AS monthly, {sql_half_year('day')} AS half_year, {_strict} AS half_year_strict,
  {sql_key('day - INTERVAL 1 DAY')} AS daily_partition, {sql_half_year('day')} AS init_partition,
  day(day) = 5 AS monthly_run_day, day(day) = 5 AND month(day) IN (1, 7) AS half_year_run_day FROM days""",
}
