"""Which company is queried through which interface on a business date.

Customer flags live on one row per listing of a company; a company is in scope when any of its listings is. Everything
is grouped by company name once, so that lists, white list and call history meet on the same partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlake.functions import calendar as cal
from firmlake.functions.values import NO, YES
from firmlake.registry import HALF_YEAR_MONTHS, MONTHLY_DAY
from firmlake.schemas import company_column


def named(df: DataFrame, column: str = "name") -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.col(column) != ""))


def post_paid_or_new(prefix: str = "") -> Column:
    prepaid, new = F.col(f"{prefix}is_prepaid"), F.col(f"{prefix}is_new_customer")
    return (prepaid == NO) | ((new == YES) & (prepaid == YES))


def new_since_batch() -> Column:
    return (F.col("is_new_customer") == YES) & (F.col("in_monthly_batch") == NO)


def daily_rule(date: Column, monthly_day: int = MONTHLY_DAY) -> Column:
    """Everyone on the monthly batch day, else post-paid and new prepaid customers."""
    return cal.is_monthly_day(date, monthly_day) | post_paid_or_new()


def monthly_rule(date: Column, monthly_day: int = MONTHLY_DAY, half_year_months: Sequence[int] | None = None) -> Column:
    """Batch day: everyone, or the daily rule outside the half-year months. Other days: new since the last batch."""
    on_batch_day = F.lit(True) if half_year_months is None else F.month(date).isin(list(half_year_months)) | post_paid_or_new()
    return F.when(cal.is_monthly_day(date, monthly_day), on_batch_day).otherwise(new_since_batch())


def unlisted(scope: DataFrame, white_list: DataFrame | None, column: str = "name") -> DataFrame:
    """Scope without the white-listed companies; without a list nothing is filtered."""
    if white_list is None:
        return scope
    listed = named(white_list, "company_name").select(F.col("company_name").alias(column)).distinct()
    return scope.join(listed, column, "left_anti")


def scope(customers: DataFrame, rule: Column | None = None, white_list: DataFrame | None = None,
          keep: Sequence[str] = ()) -> DataFrame:
    """Names in scope, once each. No rule takes everyone (initial load, or an interface without a customer filter)."""
    chosen = named(customers) if rule is None else named(customers).where(rule)
    return unlisted(chosen.select(*keep, "name").distinct(), white_list)


def single_company(customers: DataFrame, company: str, white_list: DataFrame | None = None) -> DataFrame:
    """Scope of one given company, empty when it is white-listed."""
    one = customers.sparkSession.createDataFrame([(company,)], "name STRING")
    return unlisted(one, white_list)


def listed_scope(company_list: DataFrame, white_list: DataFrame | None = None) -> DataFrame:
    """Names of a prepared list: the branch list, or the new customers of a targeted run."""
    names = named(company_list, "company_name").select(F.col("company_name").alias("name")).distinct()
    return unlisted(names, white_list)


def without_success(plan: DataFrame, records: DataFrame) -> DataFrame:
    """Plan rows (``interface_key, dt, name``) whose company has no success in the partition they write."""
    done = records.where("status_code = 0").select("interface_key", "dt", F.col("input_param").alias("name")).distinct()
    return plan.join(done, ["interface_key", "dt", "name"], "left_anti")


def call_plan(
    customers: DataFrame,
    branches: DataFrame,
    white_list: DataFrame,
    records: DataFrame,
    registry: Sequence[tuple],
    date: Column,
    monthly_day: int = MONTHLY_DAY,
    half_year_months: Sequence[int] = HALF_YEAR_MONTHS,
    new_customers: DataFrame | None = None,
    initial: bool = False,
) -> DataFrame:
    """Open calls of a business date over all interfaces: ``interface_key, dt, name``.

    One row per company carries the rules it meets, its listing and the interfaces already called. The interfaces it
    still needs are exploded from that, so no pair is built that is thrown away later and everything shares the
    shuffle by name. With ``new_customers`` the branch interface runs targeted on those instead of the branch list. An
    ``initial`` load takes every customer, and interfaces with half-year months write the half-year partition.
    """
    rules = {
        "daily": daily_rule(date, monthly_day),
        "monthly": monthly_rule(date, monthly_day),
        "half_year": monthly_rule(date, monthly_day, half_year_months),
    }
    if initial:
        rules = {name: F.lit(True) for name in rules}
    by_name = named(customers).groupBy("name").agg(*[F.bool_or(r).alias(n) for n, r in rules.items()])
    listed = named(branches if new_customers is None else new_customers, "company_name")
    by_list = listed.select(F.col("company_name").alias("name")).distinct().withColumn("on_branch_list", F.lit(True))
    excluded = named(white_list, "company_name").select(F.col("company_name").alias("name")).distinct()
    run_dt = {f: cal.run_partition(date, F.lit(f), monthly_day=monthly_day) for f in ("daily", "monthly")}
    frequency = {row[0]: row[3] for row in registry}
    writes_to = F.create_map(*[part for f, key in run_dt.items() for part in (F.lit(f), key)])
    frequency_of = F.create_map(*[F.lit(part) for pair in frequency.items() for part in pair])
    own_dt = writes_to[frequency_of[F.col("interface_key")]]
    if initial:
        run_dt["half_year"] = cal.last_half_year_batch(date, monthly_day, half_year_months)
        half_year_keys = [row[0] for row in registry if row[12]]
        own_dt = F.when(F.col("interface_key").isin(half_year_keys), run_dt["half_year"]).otherwise(own_dt)
    # with a literal date the first test prunes the scan to two or three partitions
    current = records.where(F.col("dt").isin(*run_dt.values()) & (F.col("status_code") == 0) & (F.col("dt") == own_dt))
    # at most one entry per interface
    done = current.groupBy(F.col("input_param").alias("name")).agg(F.collect_set("interface_key").alias("done"))

    wanted = (
        by_name.join(by_list, "name", "full_outer")
        .join(excluded.withColumn("excluded", F.lit(True)), "name", "left")
        .join(done, "name", "left")
    )

    def needs(row: tuple) -> Column:
        key, cfg, source, exclude, half_year = row[0], row[3], row[10], row[11], row[12]
        rule = F.col("on_branch_list") if source == "branches" else F.col("half_year" if half_year else cfg)
        rule = F.coalesce(rule, F.lit(False))
        if exclude:
            rule = rule & F.col("excluded").isNull()
        return F.when(rule, F.lit(key))

    needed = F.array_compact(F.array(*[needs(row) for row in registry]))
    open_calls = F.array_except(needed, F.coalesce("done", F.array().cast("array<string>")))
    plan = wanted.select("name", F.explode(open_calls).alias("interface_key"))
    return plan.select("interface_key", own_dt.alias("dt"), "name")


def supplementary(
    customers: DataFrame, parsed: DataFrame, batch_dt: str, white_list: DataFrame | None = None
) -> DataFrame:
    """Prepaid customers without a parsed row in the batch partition."""
    company = company_column(parsed.columns)
    prepaid = named(customers).where(F.col("is_prepaid") == YES).select("name").distinct()
    present = parsed.where(F.col("dt") == batch_dt).select(F.col(company).alias("name")).distinct()
    return unlisted(prepaid.join(present, "name", "left_anti"), white_list)
