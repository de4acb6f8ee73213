"""Derived company lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlake.functions.values import digits_only, not_set, yes_no
from firmlake.operators.ids import dense_ids
from firmlake.operators.latest import first_per
from firmlake.plans.scopes import named

# fixed values of the source systems
EXCLUDED_PROVINCES = ["hk", "tw"]
BRANCH_MARK = "分"
PREPAID_CODE = "Y419"
CUSTOMER_GROUPS = ["Y001-Sold-to party", "Y003-Payer"]
COMPANY = "公司"


def white_list(profiles: DataFrame, before_dt: str, tie: str = "api_record_id",
               provinces: list[str] = EXCLUDED_PROVINCES) -> DataFrame:
    """Companies ever seen in the excluded provinces before a date, with their newest such profile.

    The province is tested before the newest row is picked, so a company that moved away stays listed.
    """
    seen = named(profiles, "company_name").where((F.col("dt") < before_dt) & F.col("province_short").isin(provinces))
    newest = first_per(seen, ["company_name"], [F.col("data_create_time").desc_nulls_last(), F.col(tie).desc()])
    rows = newest.select("company_name", "province_short", F.col("dt").alias("source_dt"), "data_create_time")
    return dense_ids(rows, [F.col("company_name")])


def branch_list(profiles: DataFrame, customers: DataFrame, dt: str, batch_dt: str, tie: str = "api_record_id",
                mark: str = BRANCH_MARK) -> DataFrame:
    """Customers whose newest profile of two partitions is that of a branch.

    The newest profile is picked before its type is tested. Every listing of a customer gives a row; its place in the
    customer table orders equal listings, so that many of them need not end in one range.
    """
    known = named(profiles, "company_name").where(F.col("dt").isin(dt, batch_dt))
    newest = first_per(known, ["company_name"], [F.col("update_time").desc_nulls_last(), F.col(tie).desc()])
    branches = newest.where(F.col("company_org_type").contains(mark)).select(
        F.col("company_name").alias("name"),
        "company_org_type",
        F.date_format("update_time", "yyyy-MM-dd HH:mm:ss").alias("update_time"),
        F.col("dt").alias("source_dt"),
    )
    listings = named(customers).select("name", "is_prepaid", F.monotonically_increasing_id().alias("_listing"))
    rows = listings.join(branches, "name").withColumnRenamed("name", "company_name")
    numbered = dense_ids(rows, [F.col("company_name"), F.col("is_prepaid"), F.col("_listing")])
    return numbered.drop("_listing").withColumn("dt", F.lit(dt))


def active_customers(accounts: DataFrame, groups: DataFrame, on_dt: str) -> DataFrame:
    """Open, numbered, non-dispenser accounts of the customer groups on one date: name and prepaid flag."""
    wanted = groups.where((F.col("dt") == on_dt) & F.col("new_name").isin(CUSTOMER_GROUPS))
    usable = accounts.where(
        (F.col("dt") == on_dt)
        & not_set(F.col("new_isclosed"))
        & not_set(F.col("new_dispensercustomer"))
        & digits_only(F.col("new_sapcode"))
    )
    joined = usable.join(
        wanted.select(F.col("new_accountgroupid").alias("new_accountgroup_id")).distinct(), "new_accountgroup_id",
        "left_semi",
    )
    return joined.select(
        F.trim("accountName").alias("company_name"),
        yes_no(F.col("new_ord_payment_new_code") == PREPAID_CODE).alias("is_prepaid"),
    )


def new_customers(accounts: DataFrame, groups: DataFrame, dt: str, previous_dt: str) -> DataFrame:
    """Active customers of a date that were not active the day before, one row each."""
    today = named(active_customers(accounts, groups, dt), "company_name")
    # a name listed both ways takes the smaller flag text; both sides are reduced to one row per name before they meet
    one_each = today.groupBy("company_name").agg(F.min("is_prepaid").alias("is_prepaid"))
    yesterday = active_customers(accounts, groups, previous_dt).select("company_name").distinct()
    added = one_each.join(yesterday, "company_name", "left_anti")
    return dense_ids(added, [F.col("company_name")]).withColumn("dt", F.lit(dt))


def customer_flags(today: DataFrame, yesterday: DataFrame, batch_companies: DataFrame) -> DataFrame:
    """``is_new_customer``: not listed the day before. ``in_monthly_batch``: in the last monthly batch partition."""
    known = yesterday.select("name").distinct().withColumn("_known", F.lit(True))
    batch = batch_companies.select("name").distinct().withColumn("_batch", F.lit(True))
    flagged = today.join(known, "name", "left").join(batch, "name", "left")
    return flagged.select(
        "name",
        "is_prepaid",
        yes_no(F.col("_known").isNull()).alias("is_new_customer"),
        yes_no(F.col("_batch").isNotNull()).alias("in_monthly_batch"),
    )


def parent_by_name(name: Column, word: str = COMPANY) -> Column:
    """Parent in the branch's own name: the text up to the first ``word``, if the word comes twice."""
    return F.when(name.rlike(f"{word}.+{word}"), F.regexp_extract(name, f"^(.*?{word})", 1))


def parent_company(branches: DataFrame, parents: DataFrame, since_dt: str, word: str = COMPANY) -> DataFrame:
    """Parent of each branch: from its name, else its newest parent on record since a date."""
    recent = parents.where((F.col("dt") >= since_dt) & F.col("parent_company_name").isNotNull())
    newest = first_per(recent, ["company_name"], [F.col("dt").desc(), F.col("api_record_id").desc()])
    looked_up = branches.join(newest.select("company_name", "parent_company_name"), "company_name", "left")
    by_name = parent_by_name(F.col("company_name"), word)
    return looked_up.select(
        *branches.columns,
        F.coalesce(by_name, "parent_company_name").alias("parent_name"),
        F.when(by_name.isNotNull(), "name").when(F.col("parent_company_name").isNotNull(), "record").alias("found_by"),
    )


def credit_code(companies: DataFrame, profiles: DataFrame) -> DataFrame:
    """Credit code of each company from its newest profile that has one."""
    coded = profiles.where(F.col("social_credit_code").isNotNull() & (F.col("social_credit_code") != ""))
    newest = first_per(coded, ["company_name"], [F.col("dt").desc(), F.col("social_credit_code").asc()])
    return companies.join(newest.select("company_name", "social_credit_code"), "company_name", "left")
