"""Hand-written payloads for the rules each interface has of its own."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from firmlake.operators import responses
from firmlake.operators.latest import latest_success
from firmlake.plans import parsing as P

RECORD = "id BIGINT, input_param STRING, dt STRING, output_result STRING"


def parse(spark, key, *payloads):
    texts = [p if isinstance(p, str) or p is None else json.dumps(p, ensure_ascii=False) for p in payloads]
    records = spark.createDataFrame([(i, "甲公司", "20240101", t) for i, t in enumerate(texts)], RECORD)
    return [r.asDict() for r in P.parse(records, key).orderBy("api_record_id").collect()]


def statuses(spark, key, *payloads):
    texts = [p if isinstance(p, str) or p is None else json.dumps(p) for p in payloads]
    records = spark.createDataFrame([(i, "a", "d", t) for i, t in enumerate(texts)], RECORD)
    return [r.parse_status for r in P.parse_status(records, key).orderBy("api_record_id").collect()]


def given(row):
    return {k: v for k, v in row.items() if v is not None and k not in ("api_record_id", "dt")}


def test_profile(spark):
    payload = {
        "result": {
            "id": 77, "name": "other", "type": "1", "regStatus": "存续", "base": "hk", "websiteList": "", "isMicroEnt": 0,
            "estiblishTime": 1600000000000, "toTime": 253392422400000, "cancelDate": "", "approvedTime": "0",
            "emailList": ["a@b", "", None, "c"], "historyNameList": [], "historyNames": "x;", "tags": ["x", "y"],
            "BRNNumber": "b", "socialStaffNum": "12", "percentileScore": "n/a", "city": {"a": 1}, "district": [1, "q"],
            "industryAll": {"category": "C", "categoryCodeFirst": "F"}, "surprise": {"a": 1},
            "staffList": {"total": 2, "result": [{"name": "n"}]},
        }
    }
    (row,) = parse(spark, "819", payload)
    assert given(row) == {
        "company_name": "甲公司", "company_id": 77, "legal_person_type": 1, "reg_status": "存续", "province_short": "hk",
        "is_micro_ent": 0, "est_date": dt.datetime(2020, 9, 13, 12, 26, 40), "approval_date": dt.datetime(1970, 1, 1),
        "email_list": "a@b,c", "tags": "x,y", "brn_number": "b", "social_staff_num": 12, "city": '{"a":1}',
        "district": '[1,"q"]', "industry_all_category": "C", "industry_all_category_code_first": "F",
        "staff_list_total": 2, "staff_list_json": '[{"name":"n"}]',
    }


def test_profile_later_member_of_the_same_column_wins(spark):
    text = '{"result":{"companyId":5,"id":4,"regStatus":"a","reg_status":"b","reg_capital":"","regCapital":"9"}}'
    (row,) = parse(spark, "819", text)
    assert (row["company_id"], row["reg_status"], row["reg_capital"]) == (5, "b", "9")


def test_risks_three_levels(spark):
    leaf = {"id": 5, "companyId": 0, "companyName": "", "riskCount": "1", "title": "t", "type": "x", "desc": ""}
    other = {"id": "6", "companyId": "8", "companyName": "乙"}
    groups = [{"total": 3, "tag": "警示", "list": [leaf, other]}, {"total": 1, "tag": "t2", "list": None}]
    payload = {"result": {"riskLevel": "", "riskList": [{"count": 2, "name": "自身", "list": groups}, {"count": 1, "name": "无"}]}}
    first, second = parse(spark, "1058", payload)
    shared = {
        "main_company_name": "甲公司", "risk_category_count": 2, "risk_category_name": "自身", "risk_type_total": 3, "risk_type_tag": "警示",
    }
    assert given(first) == {**shared, "risk_id": 5, "risk_count": 1, "risk_title": "t", "risk_desc": ""}
    assert given(second) == {**shared, "risk_id": 6, "company_id": 8, "company_name": "乙"}


def test_zero_is_dropped_or_kept_by_interface(spark):
    (year,) = parse(spark, "967", {"result": [{"showYear": 2020, "tax_rate": 0, "basic_eps": "1.5", "current_ratio": "x"}]})
    assert given(year) == {"company_name": "甲公司", "show_year": "2020", "tax_rate": 0, "basic_eps": 1.5}
    (flow,) = parse(spark, "973", {"result": {"corpCashFlow": [{"showYear": "2020", "ncf_from_oa": 0, "invest_paid_cash": "0"}]}})
    assert given(flow) == {"company_name": "甲公司", "show_year": "2020", "invest_paid_cash": "0"}
    (change,) = parse(spark, "822", {"result": {"total": "1", "items": [{"changeItem": 0, "contentBefore": "", "changeTime": "2020"}]}})
    assert given(change) == {"company_name": "甲公司", "total": 1, "change_time": "2020"}


def test_lawsuit_persons(spark):
    persons = [{"role": "原告", "gid": 0, "emotion": "0", "result": "胜"}, {"name": "b", "emotion": "?"}, {"name": "third"}]
    items = [{"id": 9, "submitTime": 1600000000, "casePersons": persons}, {"id": "10", "casePersons": None, "caseMoney": 0}]
    first, second = parse(spark, "1114", {"result": {"total": 2, "items": items}})
    assert given(first) == {
        "company_name": "甲公司", "total": 2, "lawsuit_id": 9, "submit_time": dt.datetime(2020, 9, 13, 12, 26, 40),
        "case_result": "胜", "role1": "原告", "emotion1": 0, "name2": "b",
    }
    assert given(second) == {"company_name": "甲公司", "total": 2, "lawsuit_id": 10}


def test_parent_company(spark):
    office = '{"name":"总","id":"3","regStatus":"x","reg_status":"","estiblish_time":0,"other":1}'
    rows = parse(
        spark, "1001", f'{{"result":{{"companyName":"","headquarters":{office}}}}}', '{"result":{"companyName":"分","headquarters":null}}',
        '{"result":{"other":1}}', '{"result":{}}', '{"result":"x"}',
    )
    assert [given(r) for r in rows] == [
        {"company_name": "甲公司", "parent_company_name": "总", "parent_company_id": 3, "parent_company_estiblish_time": "0"},
        {"company_name": "分"},
        {"company_name": "甲公司"},
    ]


def test_payment_index(spark):
    inner = json.dumps({"companyPayDex": 0, "companyAverage": "8", "sic2": "", "companyHistoryPayDexes": [{"d": 1}]})
    (row,) = parse(spark, "P51060", {"res": inner}, {"res": ""}, {"res": "{oops"}, {"res": "[]"}, {})
    assert given(row) == {"company_name": "甲公司", "company_average": "8", "company_history_paydexes": '[{"d":1}]'}
    assert statuses(spark, "P51060", {"res": inner}, {"res": ""}, {"res": "{oops"}, {"res": "[]"}, {}, {"res": 5}) == [
        "SUCCESS", "SKIP_EMPTY", "SKIP_EMPTY", "FAILED", "SKIP_EMPTY", "FAILED",
    ]


def test_rows_that_are_kept_without_a_result(spark):
    for key in ("1149", "1168"):
        rows = parse(spark, key, {"result": None}, {}, {"result": ""})
        assert [given(r) for r in rows] == [{"company_name": "甲公司"}] * 3
    assert [r["company_scale"] for r in parse(spark, "1149", {"result": "大型"})] == ["大型"]


def test_null_lists_are_empty(spark):
    (row,) = parse(spark, "1168", {"result": {"orgTypes": None, "economyTypes": [{"level1": "a"}, {"level1": "b", "level2": ""}]}})
    assert given(row) == {"company_name": "甲公司", "economy_type_level1": "a,b"}
    assert parse(spark, "851", {"result": {"total": 1, "items": None}}) == []


@pytest.mark.parametrize("key", sorted(P.PARSERS))
def test_unreadable_payloads_fail_alone(spark, key):
    bad = ["broken", "[]", None, "", "{'result':{}}", '"text"']
    assert statuses(spark, key, *bad) == ["FAILED"] * len(bad)
    records = spark.createDataFrame([(i, "a", "d", t) for i, t in enumerate(bad)], RECORD)
    assert P.quarantine(records, key).count() == len(bad)
    assert P.parse(records, key).count() == 0


WHOLE = '{"result":{"total":0,"items":[]},"res":"{}"}'


@pytest.mark.parametrize("key", sorted(P.PARSERS))
def test_anything_after_a_document_fails(spark, key):
    after = [" garbage", "}", "]", "]}", "}]}", "] x }", f",{WHOLE}", WHOLE, ',"k":1', ',"k"', ' // x', ',"p":0}', ',"d41d8cd98f00b204e9800998ecf8427e":0}']
    assert statuses(spark, key, *[WHOLE + a for a in after], f"[{WHOLE}]", WHOLE[:-1]) == ["FAILED"] * (len(after) + 2)
    assert statuses(spark, key, WHOLE, f" {WHOLE}\n\t ") == ["SUCCESS"] * 2


def test_the_last_of_repeated_members_counts_at_every_depth(spark):
    (row,) = parse(spark, "822", '{"result":{"total":9,"total":1,"items":[{"changeItem":"a","changeItem":"b"}]}}')
    assert given(row) == {"company_name": "甲公司", "total": 1, "change_item": "b"}
    (row,) = parse(spark, "819", '{"result":{"id":1,"staffList":{"total":1,"total":2,"result":[{"n":1,"n":3}]}}}')
    assert (row["staff_list_total"], row["staff_list_json"]) == (2, '[{"n":3}]')


def test_text_after_the_inner_document_is_skipped(spark):
    assert statuses(spark, "P51060", {"res": "{} x"}, {"res": "{}}"}, {"res": "{} "}) == ["SKIP_EMPTY", "SKIP_EMPTY", "SUCCESS"]


def test_stats_count_rows(spark):
    texts = ['{"result":{"total":2,"items":[{},{}]}}', '{"result":{"items":[{}]}}', "broken"]
    records = spark.createDataFrame([(i, "a", "d", t) for i, t in enumerate(texts)], RECORD)
    assert {r.parse_status: (r.records, r.rows) for r in P.parse_stats(records, "822").collect()} == {"SUCCESS": (2, 3), "FAILED": (1, 0)}


def test_only_whole_objects_are_responses(spark):
    texts = ['{"a":1}', ' \n\t{"a":{}}', "{}", "[{}]", '"{"', "7", "null", "", "{", '{"a":', "broken", None]
    rows = spark.createDataFrame([(t,) for t in texts], "payload STRING")
    found = [r[0] for r in rows.select(F.coalesce(responses._is_object(F.col("payload")), F.lit(False))).collect()]
    assert found == [True, True, True] + [False] * 9


def test_merged_responses_go_into_the_parser(spark):
    page = lambda n, **more: json.dumps({"error_code": 0, "re\"ason": "o,k", "result": {"total": 45, "items": [{"name": f"[{n}]", "type": "]"}]}, **more})
    rows = [
        ("a", 1, page(1), 1), ("a", 2, page(2), 1), ("a", 3, page(3), 1), ("a", 4, page(4), 1),  # more pages than the total has
        ("b", 1, page(1), 1), ("b", 2, '{"error_code":300004,"reason":"slow"}', 1), ("b", 3, page(3), 1),
        ("c", 1, page(1), 1), ("c", 2, "broken", 1), ("c", 3, page(3), 1),
        ("d", 1, '{"error_code":300000,"reason":"none"}', 1), ("d", 2, page(2), 1),
        ("e", 1, "broken", 1), ("f", 1, '{"error_code":0,"result":null}', 1), ("f", 2, page(2), 1),
        ("g", 1, '{"error_code":0,"x":1,"result":{"total":3,"items":[{"name":"only"}]}}', 1), ("h", 2, page(2), 1),
        ("i", 1, '{"error_code":0,"result":{"total":25}}', 1), ("i", 2, page(2), 1), ("a", 2, page(9), 0), ("j", 1, None, 1),
    ]
    pages = spark.createDataFrame(rows, "call STRING, page_num INT, payload STRING, at INT")
    found = {r.call: r for r in responses.merge_responses(pages, ["call"], [F.col("at").desc()]).collect()}
    assert {c: (r.status_code, r.pages_used) for c, r in found.items()} == {
        "a": (0, 3), "b": (0, 1), "c": (0, 1), "d": (300000, 0), "e": (-1, 0), "f": (0, 1), "g": (0, 1), "i": (0, 2), "j": (-1, 0)
    }
    merged = json.loads(found["a"].output_result)
    assert merged == {"error_code": 0, 're"ason': "o,k", "result": {"total": 45, "items": [{"name": f"[{n}]", "type": "]"} for n in (1, 2, 3)]}}
    assert json.loads(found["i"].output_result)["result"] == {"total": 25, "items": [{"name": "[2]", "type": "]"}]}
    assert [found[c].output_result for c in "degf"] == [rows[10][2], "broken", rows[15][2], rows[13][2]]
    (parsed,) = parse(spark, "851", found["g"].output_result)
    assert given(parsed) == {"company_name": "甲公司", "total": 3, "taxpayer_name": "only"}
    assert [r["taxpayer_name"] for r in parse(spark, "851", found["a"].output_result)] == ["[1]", "[2]", "[3]"]


def test_newest_success_keeps_ties(spark):
    rows = [(1, "a", 0, 1), (2, "a", 0, 3), (3, "a", 0, 3), (4, "a", 300000, 9), (5, None, 0, 1), (6, "b", 1, 1), (7, "c", 0, None)]
    records = spark.createDataFrame(rows, "id INT, input_param STRING, status_code INT, create_time INT").selectExpr(
        "id", "input_param", "status_code", "timestamp_seconds(create_time) AS create_time", "'819' AS interface_key", "'d' AS dt"
    )
    assert sorted(r.id for r in latest_success(records).collect()) == [2, 3]
