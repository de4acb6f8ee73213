"""Call, billing and parse statistics.

Records are counted per company and status before they meet the customer list, so a company with very many records
costs one row in the join. A report covers every business date present; filter the records for a single day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlake.functions import calendar as cal
from firmlake.functions.values import NO, YES, failure_reason, page_count
from firmlake.operators.decode import unknown
from firmlake.operators.latest import first_per
from firmlake.registry import HALF_YEAR_MONTHS, INTERFACES, MONTHLY_DAY
from firmlake.schemas import company_column
from firmlake.sources.files import export_csv
from firmlake.sources.tables import created_between

# fixed values: report texts
POST_PAID_TEXT, PREPAID_TEXT = "账期", "预付"
NO_DATA_TEXT = "无数据"
FREQUENCY_TEXT = {"daily": "Daily", "monthly": "Monthly", "half_year": "Half Year"}
EXAMPLES, REASONS, REASON_RECORDS = 10, 3, 5


def frequency_text() -> Column:
    """Frequency of post-paid and prepaid customers, from two registry columns."""

    def label(column: str) -> Column:
        pairs = [F.lit(part) for pair in FREQUENCY_TEXT.items() for part in pair]
        return F.create_map(*pairs)[F.col(column)]

    return F.concat(
        F.lit(f"{POST_PAID_TEXT}: "), label("post_paid_frequency"), F.lit(f" / {PREPAID_TEXT}: "), label("prepaid_frequency")
    )


def day_records(records: DataFrame, date: str, next_date: str, partitions: list[str]) -> DataFrame:
    """Records created on one business date, read from the few partitions its runs write."""
    return created_between(records.where(F.col("dt").isin(partitions)), date, next_date)


def reported_records(records: DataFrame, registry: DataFrame, monthly_day: int = MONTHLY_DAY, initial: bool = False,
                     half_year_months=HALF_YEAR_MONTHS) -> DataFrame:
    """Records of reported interfaces that sit in the partition of their own business date.

    Copies made later for another partition are thereby left out. In an initial load, interfaces with half-year months have
    written the half-year partition.
    """
    settings = registry.where("reported").drop("interface_name")
    dated = records.withColumn("report_date", F.to_date("create_time")).join(F.broadcast(settings), "interface_key")
    half_year = F.col("half_year_prepaid") if initial else None
    own = cal.run_partition(F.col("report_date"), F.col("frequency"), half_year, monthly_day, half_year_months)
    return dated.where(F.col("dt") == own)


def customer_classes(listings: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, how many distinct listings it has in each class (a name can be in several); nulls where it has none (``listed``)."""
    flag = F.col("is_prepaid")
    some = F.count("listed") > 0
    other = ~F.coalesce(flag.isin(YES, NO), F.lit(False))
    return listings.select(*keys, "listed", "is_prepaid").distinct().groupBy(*keys).agg(
        F.when(some, F.count_if(flag == NO)).alias("post_paid_listings"),
        F.when(some, F.count_if(flag == YES)).alias("prepaid_listings"),
        F.when(some, F.count_if(other)).alias("other_listings"),
    )


def with_classes(per_company: DataFrame, customers: DataFrame, company: str) -> DataFrame:
    """Counts per ``report_date`` and company, a row for each key, with the company's listings.

    Listings with a ``dt`` are those of the day before, so a name may change its class from one day to the next. The customer list
    streams past the called companies and only what they meet is counted: the list itself is neither sorted nor grouped nor sent
    to all tasks. A plan without the hint broadcasts it, as its size is guessed before its dates multiply it.
    """
    listed = customers.withColumnRenamed("name", company).withColumn("listed", F.lit(True))
    if "dt" not in customers.columns:
        wanted, met = per_company, [company]
    else:
        wanted, met = per_company.withColumn("customer_dt", cal.key_of(F.date_sub("report_date", 1))), ["customer_dt", company]
        listed = listed.withColumnRenamed("dt", "customer_dt")
    meeting = wanted.hint("shuffle_hash").join(listed.select(*met, "is_prepaid", "listed"), met, "left")
    return customer_classes(meeting, wanted.columns)


def expected_interfaces(records: DataFrame, registry: DataFrame, dates: DataFrame | None) -> DataFrame:
    """Every reported interface on every date of ``dates``, or on every day from the first record to the last."""
    if dates is None:
        span = records.agg(F.to_date(F.min("create_time")).alias("first_day"), F.to_date(F.max("create_time")).alias("last_day"))
        dates = span.select(F.explode(F.sequence("first_day", "last_day")).alias("report_date"))
    # a dozen registry rows for each date
    keys = F.array(*[F.lit(row[0]) for row in INTERFACES])
    settings = F.broadcast(registry.where("reported"))
    return dates.select("report_date", F.explode(keys).alias("interface_key")).join(settings, "interface_key")


def counted_calls(reported: DataFrame) -> DataFrame:
    """Calls behind each record: its pages for a paged interface, up to the interface's ``page_limit`` if it has one, else one."""
    pages = page_count(F.col("output_result"), F.col("page_size"), F.col("page_limit"))
    return reported.withColumn("calls", F.when(F.col("paged"), pages).otherwise(F.lit(1)))


def page_limits(records: DataFrame, registry: DataFrame) -> DataFrame:
    """Per date and paged interface: records, those that list more pages than the limit lets through, and the pages lost by it."""
    paged = reported_records(records, registry.where("paged"))
    listed = page_count(F.col("output_result"), F.col("page_size"))
    lost = F.greatest(F.lit(0), F.coalesce(listed - F.col("page_limit"), F.lit(0)))
    per_record = paged.select("report_date", "interface_key", "page_limit", listed.alias("listed"), lost.alias("lost"))
    return per_record.groupBy("report_date", "interface_key", "page_limit").agg(
        F.count("*").alias("records"), F.count_if(F.col("lost") > 0).alias("records_cut"), F.sum("listed").alias("pages_listed"), F.sum("lost").alias("pages_lost")
    )


def status_counts(records: DataFrame, registry: DataFrame) -> DataFrame:
    """Records and calls (pages for paged interfaces) per date, interface and status."""
    reported = counted_calls(reported_records(records, registry))
    return reported.groupBy("report_date", "interface_key", "status_code").agg(
        F.count("*").alias("records"), F.sum("calls").alias("calls")
    )


def call_report(records: DataFrame, customers: DataFrame, registry: DataFrame, dates: DataFrame | None = None,
                monthly_day: int = MONTHLY_DAY, half_year_months=HALF_YEAR_MONTHS, initial: bool = False) -> DataFrame:
    """Calls, outcomes and billing per business date and reported interface, interfaces without data included.

    ``dates`` (``report_date``) are the business dates to cover; by default every day from the first record to the last, so
    that a day on which nothing ran is reported as well. ``customers`` with a ``dt`` column are taken from the partition of the
    day before each business date, others hold for all dates.
    """
    code, calls = F.col("status_code"), F.col("calls")
    normal = F.array_contains("normal_codes", code)
    per_company = (
        counted_calls(reported_records(records, registry, monthly_day, initial, half_year_months))
        .groupBy("report_date", "interface_key", "input_param")
        .agg(
            F.sum(calls).alias("total"),
            F.sum(F.when(code == 0, calls)).alias("success"),
            F.sum(F.when((code != 0) & normal, calls)).alias("normal_failure"),
            F.sum(F.when((code != 0) & ~normal, calls)).alias("abnormal_failure"),
        )
    )
    split = with_classes(per_company, customers, "input_param")
    counted = split.groupBy("report_date", "interface_key").agg(
        *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("total", "success", "normal_failure", "abnormal_failure")],
        F.sum(F.col("total") * F.coalesce("post_paid_listings", F.lit(0))).alias("non_prepaid_calls"),
        F.sum(F.col("total") * F.coalesce("prepaid_listings", F.lit(0))).alias("prepaid_calls"),
    )
    expected = expected_interfaces(records, registry, dates)
    measures = ["total", "success", "normal_failure", "abnormal_failure", "non_prepaid_calls", "prepaid_calls"]
    report = expected.join(counted, ["report_date", "interface_key"], "left").fillna(0, measures)
    date = F.col("report_date")
    return report.select(
        "report_date", "interface_key", "interface_name", "provider",
        frequency_text().alias("frequency"),
        (F.col("total") > 0).alias("has_data"),
        *measures[:4],
        F.when(F.col("charge_per_query"), F.col("total")).otherwise(F.col("success")).alias("call_count"),
        *measures[4:],
        cal.is_run_day(date, F.col("post_paid_frequency"), monthly_day, half_year_months).alias("non_prepaid_run_day"),
        cal.is_run_day(date, F.col("prepaid_frequency"), monthly_day, half_year_months).alias("prepaid_run_day"),
        "prepaid_frequency", "normal_codes",
    )


def call_totals(report: DataFrame) -> DataFrame:
    """Report measures per interface and in total for each date."""
    measures = ["total", "success", "normal_failure", "abnormal_failure", "call_count", "non_prepaid_calls", "prepaid_calls"]
    summed = report.rollup("report_date", "interface_key").agg(
        *[F.sum(m).alias(m) for m in measures], F.grouping("interface_key").alias("is_total")
    )
    return summed.where(F.col("report_date").isNotNull())


def abnormal_examples(records: DataFrame, registry: DataFrame, codes: DataFrame, examples: int = EXAMPLES, reasons: int = REASONS,
                      reason_records: int = REASON_RECORDS) -> DataFrame:
    """Per date, interface and abnormal code: count, meaning, first companies and the first reasons given.

    The lists are samples: the companies of the first ``examples`` records by id, and up to ``reasons`` reasons of the first
    ``reason_records`` of those. ``companies_listed`` says how many records are listed, ``is_sample`` whether there are more. The
    ranking keeps as many records of a code per task ahead of its shuffle.
    """
    keys = ["report_date", "interface_key", "provider", "status_code"]
    abnormal = reported_records(records, registry).where(
        (F.col("status_code") != 0) & ~F.array_contains("normal_codes", F.col("status_code"))
    )
    counts = abnormal.groupBy(*keys).agg(F.count("*").alias("records"))
    first = first_per(abnormal.select(*keys, "id", "input_param", "output_result"), keys, [F.col("id")], examples)
    reason = failure_reason(F.col("output_result"))
    gathered = first.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("id", "input_param", reason.alias("reason")))).alias("examples")
    )
    given = F.transform(F.slice("examples", 1, reason_records), lambda e: e["reason"])
    known = codes.withColumnRenamed("code", "status_code")
    joined = counts.join(gathered, keys).join(F.broadcast(known), ["provider", "status_code"], "left")
    return joined.select(
        "report_date", "interface_key", "status_code", "records",
        F.coalesce("meaning", unknown(F.col("status_code"))).alias("meaning"),
        F.array_join(F.transform("examples", lambda e: e["input_param"]), ", ").alias("companies"),
        F.array_join(F.slice(F.filter(given, lambda r: r.isNotNull()), 1, reasons), "; ").alias("reasons"),
        F.size("examples").alias("companies_listed"), (F.col("records") > F.size("examples")).alias("is_sample"),
    )


def _missing() -> Column:
    return F.concat_ws(
        "/",
        F.when(F.col("non_prepaid_run_day"), F.lit(POST_PAID_TEXT)),
        F.when(F.col("prepaid_run_day"), F.lit(PREPAID_TEXT)),
    )


def status_labels(report: DataFrame) -> DataFrame:
    """Per interface whether it needs a look, and the customer classes whose run day passed without data."""
    missing = F.when((F.col("total") == 0) & (_missing() != ""), F.concat(F.lit(f"{NO_DATA_TEXT}-"), _missing()))
    attention = F.when(F.col("total") > 0, F.col("abnormal_failure") > 0).otherwise(missing.isNotNull())
    return report.select("report_date", "interface_key", attention.alias("needs_attention"), missing.alias("missing"))


def alert_decision(report: DataFrame) -> DataFrame:
    """Per date: any abnormal failure, or an interface with a run day but no data."""
    due = F.col("non_prepaid_run_day") | F.col("prepaid_run_day")
    decided = report.groupBy("report_date").agg(
        F.bool_or(F.col("abnormal_failure") > 0).alias("has_abnormal"),
        F.bool_or(due & ~F.col("has_data")).alias("has_missing"),
    )
    return decided.withColumn("need_alert", F.col("has_abnormal") | F.col("has_missing"))


def idle_interfaces(report: DataFrame, monthly_day: int = MONTHLY_DAY, half_year_months=HALF_YEAR_MONTHS) -> DataFrame:
    """Interfaces rightly without data: no customer class has its run day. The note names the days they wait for."""
    months = "和".join(f"{m}月" for m in half_year_months)
    half_year = F.when(F.col("prepaid_frequency") == cal.HALF_YEAR, F.lit(f", 半年度跑批日为{months}的{monthly_day}号"))
    note = F.concat(
        "frequency", F.lit(f", 月度跑批日为每月{monthly_day}号"), F.coalesce(half_year, F.lit(""))
    )
    idle = report.where((F.col("total") == 0) & ~F.col("non_prepaid_run_day") & ~F.col("prepaid_run_day"))
    return idle.select("report_date", "interface_key", note.alias("note"))


def normal_failures(report: DataFrame, codes: DataFrame) -> DataFrame:
    """Interfaces with expected failures, and the codes that count as such with their meaning."""
    failed = report.where((F.col("normal_failure") > 0) & (F.col("total") > 0))
    each = failed.select("report_date", "interface_key", "provider", "normal_failure", F.posexplode("normal_codes").alias("place", "code"))
    decoded = each.join(F.broadcast(codes), ["provider", "code"], "left")
    text = F.concat(F.col("code").cast("string"), F.lit("("), F.coalesce("meaning", F.lit("未知")), F.lit(")"))
    # a handful of codes per interface
    listed = decoded.groupBy("report_date", "interface_key", "normal_failure").agg(
        F.array_sort(F.collect_list(F.struct("place", text.alias("text")))).alias("codes")
    )
    return listed.select(
        "report_date", "interface_key", "normal_failure",
        F.array_join(F.transform("codes", lambda c: c["text"]), ", ").alias("normal_codes"),
    )


def succeeded_rows(parsed: DataFrame, records: DataFrame) -> DataFrame:
    """Parsed rows of companies with a success among ``records`` in the same partition."""
    company = company_column(parsed.columns)
    done = records.where("status_code = 0").select("interface_key", "dt", F.col("input_param").alias(company)).distinct()
    return parsed.join(done, ["interface_key", "dt", company], "left_semi")


def export_succeeded(parsed: DataFrame, records: DataFrame, path: str) -> bool:
    """CSV of the parsed rows that go back to a success among ``records``, none when there are no rows."""
    return export_csv(succeeded_rows(parsed, records), path)


PARSE_COUNTS = ["success_count", "total", "prepaid", "non_prepaid", "uncategorized"]


def parse_report(parsed: DataFrame, records: DataFrame, customers: DataFrame, registry: DataFrame, dates: DataFrame | None = None,
                 monthly_day: int = MONTHLY_DAY, half_year_months=HALF_YEAR_MONTHS, initial: bool = False) -> DataFrame:
    """Successful calls and parsed rows of every reported interface on every business date, the rows split by customer class.

    ``parsed`` holds ``interface_key, dt`` and the company, one row per parsed row. On a business date an interface's calls are
    those created on that day in the partition its run writes (``dt``), and its parsed rows are those of that partition whose company
    succeeded on that day; a monthly partition therefore counts again on each day with a success. Interfaces without data are
    rows with zeros. A company listed in two classes counts in both, and so does the total; dates and customers are as
    in ``call_report``.
    """
    company = company_column(parsed.columns)
    reported = reported_records(records, registry, monthly_day, initial, half_year_months).where("status_code = 0")
    per_company = reported.groupBy("report_date", "interface_key", "dt", "input_param").agg(F.count("*").alias("calls"))
    calls = per_company.groupBy("report_date", "interface_key").agg(F.sum("calls").alias("success_count"))
    found = parsed.groupBy("interface_key", "dt", company).agg(F.count("*").alias("rows"))
    done = per_company.withColumnRenamed("input_param", company).join(found, ["interface_key", "dt", company])
    split = with_classes(done, customers, company)
    listings = {c: F.coalesce(f"{c}_listings", F.lit(0)) for c in ("prepaid", "post_paid", "other")}
    unlisted = F.coalesce("other_listings", F.lit(1))
    rows = split.groupBy("report_date", "interface_key").agg(
        F.sum(F.col("rows") * (listings["prepaid"] + listings["post_paid"] + unlisted)).alias("total"),
        F.sum(F.col("rows") * listings["prepaid"]).alias("prepaid"),
        F.sum(F.col("rows") * listings["post_paid"]).alias("non_prepaid"),
        F.sum(F.col("rows") * unlisted).alias("uncategorized"),
    )
    keys = ["report_date", "interface_key"]
    expected = expected_interfaces(records, registry, dates)
    joined = expected.join(calls, keys, "left").join(rows, keys, "left").fillna(0, PARSE_COUNTS)
    half_year = F.col("half_year_prepaid") if initial else None
    return joined.select(
        *keys, cal.run_partition(F.col("report_date"), F.col("frequency"), half_year, monthly_day, half_year_months).alias("dt"),
        "interface_name", frequency_text().alias("frequency"), "relation", *PARSE_COUNTS,
        (F.col("total") > 0).alias("has_data"), F.when(F.col("total") == 0, NO_DATA_TEXT).alias("note"),
    )


def parse_totals(report: DataFrame) -> DataFrame:
    """Parse report measures per interface and in total for each date, with the number of interfaces that have data."""
    summed = report.rollup("report_date", "interface_key").agg(
        *[F.sum(m).alias(m) for m in PARSE_COUNTS], F.count_if("has_data").alias("with_data"), F.grouping("interface_key").alias("is_total")
    )
    return summed.where(F.col("report_date").isNotNull())
