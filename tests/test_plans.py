"""Scopes, lists, responses and reports on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from firmlake.operators import quality, responses
from firmlake.plans import lists, reports, scopes
from firmlake.sources import files, tables
from firmlake.registry import INTERFACES, interface_registry, response_codes

YES, NO = "是", "否"
CUSTOMER = "name STRING, is_prepaid STRING, is_new_customer STRING, in_monthly_batch STRING"
CUSTOMERS = [
    ("post", NO, NO, YES), ("pre_old", YES, NO, YES), ("pre_new", YES, YES, NO), ("back", YES, YES, YES),
    ("both", NO, NO, YES), ("both", YES, NO, YES), ("", NO, YES, NO), (None, NO, YES, NO),
]


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(CUSTOMERS, CUSTOMER)


def names(df):
    return sorted(r["name"] for r in df.collect())


EVERYONE = ["back", "both", "post", "pre_new", "pre_old"]


def test_daily_scope(customers):
    assert names(scopes.scope(customers, scopes.daily_rule(F.lit(dt.date(2026, 6, 5))))) == EVERYONE
    assert names(scopes.scope(customers, scopes.daily_rule(F.lit(dt.date(2026, 6, 6))))) == ["back", "both", "post", "pre_new"]


def test_monthly_scope(customers):
    batch_day, june, other = (F.lit(dt.date(2026, m, d)) for m, d in ((7, 5), (6, 5), (6, 6)))
    assert names(scopes.scope(customers, scopes.monthly_rule(june))) == EVERYONE
    assert names(scopes.scope(customers, scopes.monthly_rule(other))) == ["pre_new"]
    assert names(scopes.scope(customers, scopes.monthly_rule(batch_day, half_year_months=[1, 7]))) == EVERYONE
    assert names(scopes.scope(customers, scopes.monthly_rule(june, half_year_months=[1, 7]))) == ["back", "both", "post", "pre_new"]


def test_white_list_is_null_safe_and_optional(spark, customers):
    white = spark.createDataFrame([("post",), (None,), ("",)], "company_name STRING")
    assert names(scopes.scope(customers, None, white)) == ["back", "both", "pre_new", "pre_old"]
    assert names(scopes.scope(customers)) == EVERYONE
    assert scopes.single_company(customers, "post", white).count() == 0
    assert names(scopes.single_company(customers, "post")) == ["post"]


def test_supplementary(spark, customers):
    parsed = spark.createDataFrame([("pre_old", "20260604"), ("back", "20260605")], "main_company_name STRING, dt STRING")
    assert names(scopes.supplementary(customers, parsed, "20260604")) == ["back", "both", "pre_new"]


def test_call_plan(spark, customers):
    branches = spark.createDataFrame([("branch",), ("post",), (None,)], "company_name STRING")
    white = spark.createDataFrame([("back",)], "company_name STRING")
    log = [("819", "20260605", "post", 0), ("822", "20260605", "post", 1), ("851", "20260604", "post", 0), ("967", "20260604", "pre_new", 0)]
    records = spark.createDataFrame(log, "interface_key STRING, dt STRING, input_param STRING, status_code INT")
    plan = scopes.call_plan(customers, branches, white, records, INTERFACES, F.lit(dt.date(2026, 6, 6)))
    calls = {(r.interface_key, r["name"]): r.dt for r in plan.collect()}
    daily = {"819", "822", "851", "854", "1041", "1058", "1114", "1149"}
    monthly = {"967", "973", "1168", "P51060"}
    expected = {(k, n): "20260605" for k in daily for n in ("post", "both", "pre_new")}
    expected |= {(k, "pre_new"): "20260604" for k in monthly} | {("1001", n): "20260605" for n in ("post", "branch")}
    del expected[("819", "post")], expected[("967", "pre_new")]
    assert calls == expected and plan.count() == len(expected)


def test_call_plan_of_a_targeted_batch_day(spark, customers):
    empty = spark.createDataFrame([], "company_name STRING")
    added = spark.createDataFrame([("pre_new",)], "company_name STRING")
    records = spark.createDataFrame([], "interface_key STRING, dt STRING, input_param STRING, status_code INT")
    plan = scopes.call_plan(customers, empty, empty, records, INTERFACES, F.lit(dt.date(2026, 7, 5)), new_customers=added)
    counts = {r.interface_key: r["count"] for r in plan.groupBy("interface_key").count().collect()}
    assert counts == {row[0]: 1 if row[0] == "1001" else 5 for row in INTERFACES}
    assert {r.dt for r in plan.collect()} == {"20260704"}


def test_white_list_ignores_a_later_move(spark):
    profiles = spark.createDataFrame(
        [("a", "hk", "20260101", 1, 1), ("a", "gd", "20260102", 2, 2), ("b", "tw", "20260103", 3, 3), ("c", "gd", "20260101", 1, 4)],
        "company_name STRING, province_short STRING, dt STRING, data_create_time INT, api_record_id INT",
    )
    assert [tuple(r)[:3] for r in lists.white_list(profiles, "20260103").collect()] == [(1, "a", "hk")]


def test_branch_list_takes_the_newest_profile_first(spark):
    profiles = spark.createDataFrame(
        [(1, "a", "分公司", dt.datetime(2026, 1, 1), "d1"), (2, "a", "其他", dt.datetime(2026, 1, 2), "d2"), (3, "b", "分", None, "d1"),
         (4, "c", "分", dt.datetime(2026, 1, 1), "d0"), (5, "e", "其他", None, "d1"), (6, "e", "分x", dt.datetime(2020, 1, 1), "d2")],
        "api_record_id INT, company_name STRING, company_org_type STRING, update_time TIMESTAMP, dt STRING",
    )
    customers = spark.createDataFrame([("a", NO), ("b", NO), ("b", YES), ("c", NO), ("e", NO)], "name STRING, is_prepaid STRING")
    rows = lists.branch_list(profiles, customers, "d2", "d1").orderBy("id").collect()
    assert [(r.id, r.company_name, r.is_prepaid, r.source_dt) for r in rows] == [(1, "b", NO, "d1"), (2, "b", YES, "d1"), (3, "e", NO, "d2")]


def test_new_customers(spark):
    schema = (
        "accountName STRING, new_ord_payment_new_code STRING, new_accountgroup_id STRING, new_isclosed BOOLEAN, "
        "new_sapcode STRING, new_dispensercustomer BOOLEAN, dt STRING"
    )
    rows = [
        (" a ", "Y419", "g", None, " 12", None, "d2"), ("a", None, "g", False, "12", False, "d2"), ("old", None, "g", None, "1", None, "d2"),
        ("old", None, "g", None, "1", None, "d1"), ("closed", None, "g", True, "1", None, "d2"), ("code", None, "g", None, "1x", None, "d2"),
        ("nocode", None, "g", None, None, None, "d2"), ("disp", None, "g", None, "1", True, "d2"), ("other", None, "h", None, "1", None, "d2"),
        ("", None, "g", None, "1", None, "d2"), ("was_closed", "Y419", "g", True, "1", None, "d1"), ("was_closed", "Y419", "g", None, "1", None, "d2"),
    ]
    groups = [("g", "Y001-Sold-to party", "d1"), ("g", "Y001-Sold-to party", "d2"), ("h", "other", "d2")]
    found = lists.new_customers(
        spark.createDataFrame(rows, schema), spark.createDataFrame(groups, "new_accountgroupid STRING, new_name STRING, dt STRING"), "d2", "d1"
    )
    assert sorted((r.id, r.company_name, r.is_prepaid) for r in found.collect()) == [(1, "a", NO), (2, "was_closed", YES)]


def test_parent_company(spark):
    branches = spark.createDataFrame([("甲公司乙分公司",), ("丙分公司",), ("丁",)], "company_name STRING")
    parents = spark.createDataFrame(
        [(1, "丙分公司", "old", "20260101"), (2, "丙分公司", "new", "20260102"), (3, "丙分公司", None, "20260103"), (4, "丁", "x", "20250101")],
        "api_record_id INT, company_name STRING, parent_company_name STRING, dt STRING",
    )
    found = {r.company_name: (r.parent_name, r.found_by) for r in lists.parent_company(branches, parents, "20260101").collect()}
    assert found == {"甲公司乙分公司": ("甲公司", "name"), "丙分公司": ("new", "record"), "丁": (None, None)}


PAGE = "call INT, page_num INT, error_code INT, total INT, items ARRAY<INT>"


def test_merge_pages(spark):
    rows = [
        (1, 1, 0, 45, [1]), (1, 2, 0, 45, [2]), (1, 3, 0, 45, None), (1, 4, 0, 45, [9]),  # page 4 is beyond the total
        (2, 1, 0, 60, [1]), (2, 2, 7, 60, [2]), (2, 3, 0, 60, [3]),  # stops at the failed page
        (3, 1, 300000, None, None), (4, 1, 0, 0, []), (5, 2, 0, 60, [2]),  # no first page: no record
        (6, 1, 0, 60, [1]), (6, 3, 0, 60, [3]),  # stops at the missing page
    ]
    merged = {r.call: (r.status_code, r.total, r.pages_used, r.items) for r in responses.merge_pages(spark.createDataFrame(rows, PAGE), ["call"], [F.col("total")]).collect()}
    assert merged == {
        1: (0, 45, 3, [1, 2]), 2: (0, 60, 1, [1]), 3: (300000, None, 0, None), 4: (0, 0, 1, []), 6: (0, 60, 1, [1]),
    }


def test_merge_pages_limits_and_repeats(spark):
    pages = spark.range(1, 400).select(F.lit(1).alias("call"), F.col("id").cast("int").alias("page_num"), F.lit(0).alias("error_code"), F.lit(99999).alias("total"), F.array("id").alias("items"))
    order = [F.col("page_num")]
    assert responses.merge_pages(pages, ["call"], order).first().pages_used == 399  # stored pages are never thrown away
    assert responses.merge_pages(pages, ["call"], order, max_pages=250).first().pages_used == 250
    repeated = spark.createDataFrame([(1, 1, 0, 5, [1], 1), (1, 1, 9, 5, [2], 2)], PAGE + ", at INT")
    assert responses.merge_pages(repeated, ["call"], [F.col("at").desc()]).first().status_code == 9
    twice = spark.createDataFrame([(1, p, 0, 60, [p], at) for p, at in ((1, 1), (1, 2), (2, 1), (3, 1))], PAGE + ", at INT")
    assert responses.merge_pages(twice, ["call"], [F.col("at").desc()]).first()["items"] == [1, 2, 3]


def test_resolve_attempts(spark):
    rows = [
        (1, 1, -1), (1, 2, 0), (1, 3, -1),  # first success
        (2, 1, 300000), (2, 2, 0),  # a normal code ends it
        (3, 1, -1), (3, 2, -2), (3, 3, 300004), (3, 4, 0),  # a late success counts
        (4, 1, 300004), (4, 2, 0),  # billed per query: one attempt
    ]
    log = spark.createDataFrame([(*r, f"{r[0]}-{r[1]}") for r in rows], "call INT, attempt INT, code INT, payload STRING")
    found = responses.resolve_attempts(log, ["call"], F.array(F.lit(300000)), F.col("call") != 4, F.lit(True))
    assert {r.call: (r.status_code, r.output_result, r.outcome) for r in found.collect()} == {
        1: (0, "1-2", "SUCCESS"), 2: (300000, "2-1", "FAILED"), 3: (0, "3-4", "SUCCESS"), 4: (300004, "4-1", "FAILED"),
    }
    plain = responses.resolve_attempts(log, ["call"])
    assert plain.where("call = 2").first().outcome == "SUCCESS"


DAY = dt.datetime(2026, 6, 6, 3, 30)
RECORD = "id INT, interface_key STRING, input_param STRING, status_code INT, output_result STRING, create_time TIMESTAMP, dt STRING"


@pytest.fixture(scope="module")
def report(spark):
    total = '{"result":{"total":45}}'
    rows = [
        (1, "851", "both", 0, total, DAY, "20260605"), (2, "851", "stranger", 300000, "{}", DAY, "20260605"),
        (3, "851", "post", 300006, '{"reason":"broke"}', DAY, "20260605"), (4, "819", "post", 0, total, DAY, "20260605"),
        (5, "819", "post", 300000, "{}", DAY, "20260605"), (6, "967", "pre_new", 0, "{}", DAY, "20260604"),
        (7, "819", "copy", 0, "{}", DAY, "20260604"),  # a copy in the batch partition is not reported again
        (8, "1114", "post", 0, "{}", DAY, "20260605"),  # not a reported interface
    ]
    return spark.createDataFrame(rows, RECORD)


def test_call_report(spark, customers, report):
    rows = {r.interface_key: r for r in reports.call_report(report, customers, interface_registry(spark)).collect()}
    paged, plain, missing = rows["851"], rows["819"], rows["1168"]
    assert (paged.total, paged.success, paged.normal_failure, paged.abnormal_failure, paged.call_count) == (5, 3, 1, 1, 5)
    assert (paged.non_prepaid_calls, paged.prepaid_calls) == (4, 3)  # the name listed both ways counts in both
    assert (plain.total, plain.success, plain.call_count) == (2, 1, 1)
    assert not missing.has_data and missing.total == 0 and not missing.non_prepaid_run_day
    assert rows["967"].total == 1 and "1114" not in rows and len(rows) == 12


def test_alerts_and_labels(spark, customers, report):
    full = reports.call_report(report, customers, interface_registry(spark))
    decision = reports.alert_decision(full).first()
    assert (decision.has_abnormal, decision.has_missing, decision.need_alert) == (True, True, True)
    labels = {r.interface_key: (r.needs_attention, r.missing) for r in reports.status_labels(full).collect()}
    assert labels["851"] == (True, None) and labels["819"] == (False, None)
    assert labels["822"] == (True, "无数据-账期") and labels["1168"] == (False, None)
    idle = {r.interface_key: r.note for r in reports.idle_interfaces(full).collect()}
    assert set(idle) == {"1168", "973", "P51060"} and idle["P51060"].endswith("半年度跑批日为1月和7月的5号")
    totals = reports.call_totals(full).where("is_total = 1").first()
    assert (totals.total, totals.call_count) == (8, 7)


def test_a_day_without_any_record_raises_an_alert(spark, customers, report):
    later = report.withColumn("create_time", F.col("create_time") + F.expr("INTERVAL 2 DAYS")).withColumn("dt", F.lit("20260607"))
    full = reports.call_report(report.union(later), customers, interface_registry(spark))
    found = {str(r.report_date): r.has_missing for r in reports.alert_decision(full).collect()}
    assert found == {"2026-06-06": True, "2026-06-07": True, "2026-06-08": True}
    assert reports.call_report(report.limit(0), customers, interface_registry(spark)).count() == 0


def test_initial_load(spark, customers):
    row = (1, "P51060", "post", 0, "{}", dt.datetime(2026, 6, 6), "20260104")
    log = spark.createDataFrame([row], RECORD)
    totals = [reports.call_report(log, customers, interface_registry(spark), initial=i).where("interface_key = 'P51060'").first().total for i in (False, True)]
    assert totals == [0, 1]
    empty = spark.createDataFrame([], "company_name STRING")
    plan = scopes.call_plan(customers, empty, empty, log, INTERFACES, F.lit(dt.date(2026, 6, 6)), initial=True)
    found = {(r.interface_key, r["name"]): r.dt for r in plan.collect()}
    assert {n for k, n in found if k == "819"} == set(EVERYONE) and {n for k, n in found if k == "P51060"} == set(EVERYONE) - {"post"}
    assert (found["P51060", "both"], found["967", "both"], found["819", "both"]) == ("20260104", "20260604", "20260605")


def test_abnormal_examples(spark):
    payloads = ['{"reason":""}', "broken", '{"msg":"m1"}', '{"reason":"r2"}', '{"reason":"r3"}', '{"reason":"r4"}']
    rows = [(i, "819", f"c{i}", -1, payloads[i % 6], DAY, "20260605") for i in range(15)]
    found = reports.abnormal_examples(spark.createDataFrame(rows, RECORD), interface_registry(spark), response_codes(spark)).first()
    assert (found.records, found.meaning, found.reasons) == (15, "未知错误码(-1)", "m1; r2; r3")
    assert found.companies == ", ".join(f"c{i}" for i in range(10))
    assert (found.companies_listed, found.is_sample) == (10, True)
    whole = reports.abnormal_examples(spark.createDataFrame(rows, RECORD), interface_registry(spark), response_codes(spark), 20, 20, 20).first()
    assert (whole.companies_listed, whole.is_sample, whole.reasons.count(";")) == (15, False, 8)


def test_parse_report(spark, customers, report):
    parsed = spark.createDataFrame(
        [("851", "20260605", "both")] * 3 + [("851", "20260605", "post"), ("819", "20260605", "post")],
        "interface_key STRING, dt STRING, company_name STRING",
    )
    rows = {(r.interface_key, r.dt): r for r in reports.parse_report(parsed, report, customers, interface_registry(spark)).collect()}
    both = rows[("851", "20260605")]
    assert (both.success_count, both.total, both.prepaid, both.non_prepaid, both.uncategorized) == (1, 6, 3, 3, 0)
    assert rows[("819", "20260605")].total == 1 and not rows[("967", "20260604")].has_data


def test_parse_report_covers_interfaces_without_data(spark, customers, report):
    parsed = spark.createDataFrame([("851", "20260605", "both"), ("851", "20260601", "both")], "interface_key STRING, dt STRING, company_name STRING")
    later = report.withColumn("create_time", F.col("create_time") + F.expr("INTERVAL 2 DAYS")).withColumn("dt", F.lit("20260607"))
    full = reports.parse_report(parsed, report.union(later), customers, interface_registry(spark))
    rows = {(str(r.report_date), r.interface_key): r for r in full.collect()}
    assert len(rows) == 3 * 12  # every day and reported interface, the day between too
    found = rows["2026-06-06", "851"]
    assert (found.dt, found.total, found.has_data, found.note) == ("20260605", 2, True, None)
    gap = rows["2026-06-07", "851"]
    assert (gap.dt, gap.success_count, gap.total, gap.has_data, gap.note) == ("20260606", 0, 0, False, "无数据")
    assert rows["2026-06-08", "851"].success_count == 1 and rows["2026-06-08", "851"].total == 0
    totals = {str(r.report_date): r for r in reports.parse_totals(full).where("is_total = 1").collect()}
    assert (totals["2026-06-06"].total, totals["2026-06-06"].with_data, totals["2026-06-07"].total) == (2, 1, 0)
    day = spark.createDataFrame([(dt.date(2026, 6, 7),)], "report_date DATE")
    assert reports.parse_report(parsed, report, customers, interface_registry(spark), day).count() == 12


def test_a_monthly_partition_counts_on_each_day_with_a_success(spark, customers):
    times = [dt.datetime(2026, 6, 6, 3), dt.datetime(2026, 6, 8, 3)]
    log = spark.createDataFrame([(i, "967", "post", 0, "{}", t, "20260604") for i, t in enumerate(times)], RECORD)
    parsed = spark.createDataFrame([("967", "20260604", "post")] * 3, "interface_key STRING, dt STRING, company_name STRING")
    found = reports.parse_report(parsed, log, customers, interface_registry(spark)).where("interface_key = '967'").orderBy("report_date").collect()
    assert [(r.dt, r.success_count, r.total) for r in found] == [("20260604", 1, 3), ("20260604", 0, 0), ("20260604", 1, 3)]


def test_a_company_that_changes_class_counts_by_the_day(spark):
    """Customers are those of the partition before each business date."""
    days = [dt.datetime(2026, 6, d, 3) for d in (6, 7, 8)]
    log = spark.createDataFrame([(i, "819", "c", 0, "{}", t, f"2026060{t.day - 1}") for i, t in enumerate(days)], RECORD)
    listed = [("c", "否", "20260605"), ("c", "是", "20260606"), ("other", "是", "20260607")]
    customers = spark.createDataFrame(listed, "name STRING, is_prepaid STRING, dt STRING")
    found = reports.call_report(log, customers, interface_registry(spark)).where("interface_key = '819'").orderBy("report_date").collect()
    assert [(r.total, r.non_prepaid_calls, r.prepaid_calls) for r in found] == [(1, 1, 0), (1, 0, 1), (1, 0, 0)]
    parsed = spark.createDataFrame([("819", f"2026060{d}", "c") for d in (5, 6, 7)], "interface_key STRING, dt STRING, company_name STRING")
    found = reports.parse_report(parsed, log, customers, interface_registry(spark)).where("interface_key = '819'").orderBy("report_date").collect()
    assert [(r.non_prepaid, r.prepaid, r.uncategorized) for r in found] == [(1, 0, 0), (0, 1, 0), (0, 0, 1)]


@pytest.mark.parametrize("zone, day", [("UTC", "2026-06-05"), ("Asia/Shanghai", "2026-06-06")])
def test_business_dates_follow_the_zone_of_the_session(spark, customers, zone, day):
    """20:00 UTC is four in the morning of the next day in Shanghai."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        log = spark.range(1).selectExpr(
            "1 AS id", "'819' AS interface_key", "'post' AS input_param", "0 AS status_code", "'{}' AS output_result",
            "timestamp_seconds(unix_seconds(timestamp'2026-06-05 20:00:00Z')) AS create_time", f"date_format(date_sub('{day}', 1), 'yyyyMMdd') AS dt",
        )
        found = reports.call_report(log, customers, interface_registry(spark)).where("total > 0").first()
        assert (str(found.report_date), found.total) == (day, 1)
        window = tables.created_between(log, day, str(dt.date.fromisoformat(day) + dt.timedelta(days=1)))
        assert window.count() == 1 and tables.created_between(log, "2026-06-04", "2026-06-05").count() == 0
        name = spark.createDataFrame([("x", 1780689600000)], "filename STRING, modified_ms BIGINT")  # the same moment
        assert name.select(files.file_date(F.col("filename"), F.col("modified_ms"))).first()[0] == day.replace("-", "")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_trace_ratio_and_repeats(spark, report):
    parsed = spark.createDataFrame([(1, "20260605")] * 3 + [(99, "20260605")], "api_record_id INT, dt STRING")
    row = quality.trace_ratio(parsed, report).first()
    assert (row.parsed_rows, row.linked_rows, row.linked_share) == (4, 3, 0.75)
    assert quality.repeated_success(report).count() == 0
    assert quality.repeated_success(report.union(report)).where("interface_key = '851'").first().successes == 2
