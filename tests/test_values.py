import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from firmlake.functions import names
from firmlake.functions import values as v


def evaluate(spark, expression, **columns):
    """Value of an expression over one row of text columns."""
    schema = ", ".join(f"{c} STRING" for c in columns) or "nothing STRING"
    return spark.createDataFrame([tuple(columns.values()) or (None,)], schema).select(expression.alias("x")).first()["x"]


def variant(name="j"):
    return F.try_parse_json(F.col(name))


UTC_9998_END = 253370764799


@pytest.mark.parametrize(
    "json, seconds",
    [
        ("0", None), ("0.0", None), ('""', None), ("null", None), ("false", None), ('"soon"', None), ('"NaN"', None),
        ('"0"', 0), ("1", 1), ('" 12 "', 12), ('"1e3"', 1000), ("-1.9", -1),
        ("9999999999", 9999999999), ("10000000000", 10000000), ("1600000000999", 1600000000), ('"1600000000000"', 1600000000),
        ("-5000000000", -5000000000), ("-62135596800", -62135596800), ("-62135596801", None), ("-99999999999999", None),
        (str(UTC_9998_END * 1000), UTC_9998_END), (str((UTC_9998_END + 1) * 1000), None), ("253402214400000", None),
        ("1e300", None), ("[]", None),
    ],
)
def test_epoch(spark, json, seconds):
    assert evaluate(spark, F.unix_timestamp(v.epoch_to_timestamp(variant())), j=json) == seconds


@pytest.mark.parametrize(
    "json, empty, falsy",
    [
        ('"a"', "a", "a"), ('""', None, None), ("0", None, None), ("0.0", None, None), ("0e0", None, None), ('"0"', "0", "0"),
        ("false", None, None), ("true", "true", "true"), ("null", None, None), ("[]", "[]", None), ("{}", "{}", None),
        ('"[]"', "[]", "[]"), ('"false"', "false", "false"), ("[0]", "[0]", "[0]"), ("12.50", "12.5", "12.5"), ("-3", "-3", "-3"),
    ],
)
def test_null_rules(spark, json, empty, falsy):
    assert evaluate(spark, v.null_if_empty(variant()), j=json) == empty
    assert evaluate(spark, v.null_if_falsy(variant()), j=json) == falsy


def test_missing_member_is_null(spark):
    assert evaluate(spark, v.null_if_falsy(v.member(variant(), "b")), j='{"a":1}') is None


@pytest.mark.parametrize(
    "json, csv",
    [('["a","",null,0,"b"]', "a,b"), ('["",""]', ""), ("[]", None), ("null", None), ('"a"', None), ("[1,2]", "1,2"), ('["0"]', "0")],
)
def test_list_to_csv(spark, json, csv):
    assert evaluate(spark, v.list_to_csv(v.variant_list(variant())), j=json) == csv


@pytest.mark.parametrize(
    "json, csv",
    [
        ('[{"x":"a"},{"x":""},{},{"x":"b"}]', "a,b"), ('[{"x":""}]', None), ("[]", None), ("null", None), ('[{"y":1}]', None),
    ],
)
def test_field_to_csv(spark, json, csv):
    assert evaluate(spark, v.field_to_csv(v.variant_list(variant()), "x"), j=json) == csv


@pytest.mark.parametrize(
    "json, expected",
    [
        ('{"cType":1,"name":"n","id":"7"}', (1, "n", 7)), ('{"cType":0,"name":"","id":"0"}', (None, None, None)),
        ('{"cType":"0","name":"n","id":0}', (0, "n", None)), ('{"cType":"x","id":"x"}', (None, None, None)),
        ("{}", (None, None, None)), ("null", (None, None, None)), ('""', (None, None, None)),
    ],
)
def test_person(spark, json, expected):
    assert tuple(evaluate(spark, v.person(variant()), j=json)) == expected


@pytest.mark.parametrize(
    "text, amount",
    [("1.23455", Decimal("1.2346")), ("-1.23455", Decimal("-1.2346")), ("0", Decimal("0.0000")), ("x", None), ("", None), ("1e3", Decimal("1000.0000")), ("9" * 25, None)],
)
def test_money_rounds_half_up(spark, text, amount):
    assert evaluate(spark, v.money(F.col("j")), j=text) == amount


@pytest.mark.parametrize(
    "payload, pages",
    [
        ('{"result":{"total":0}}', 1), ('{"result":{"total":20}}', 1), ('{"result":{"total":21}}', 2),
        ('{"result":{"total":5000}}', 250), ('{"result":{"total":99999}}', 250), ('{"result":{"total":"45"}}', 3),
        ('{"result":{"total":"many"}}', 1), ('{"result":null}', 1), ("broken", 1), (None, 1), ('{"result":{"total":-5}}', 1),
    ],
)
def test_page_count(spark, payload, pages):
    assert evaluate(spark, v.page_count(F.col("j"), 20, 250), j=payload) == pages


@pytest.mark.parametrize(
    "payload, reason",
    [
        ('{"reason":"r","msg":"m"}', "r"), ('{"msg":"m"}', "m"), ('{"reason":"","msg":"m"}', None),
        ('{"reason":null,"msg":"m"}', None), ("broken", None), ("{}", None), (None, None),
    ],
)
def test_failure_reason(spark, payload, reason):
    assert evaluate(spark, v.failure_reason(F.col("j")), j=payload) == reason


def test_flags(spark):
    rows = spark.createDataFrame([(True,), (False,), (None,)], "b BOOLEAN").select(v.not_set(F.col("b"))).collect()
    assert [r[0] for r in rows] == [False, True, True]
    assert evaluate(spark, v.yes_no(F.col("c") == "Y419"), c=None) == v.NO
    assert evaluate(spark, v.digits_only(F.col("c")), c=" 12 ") is True
    assert evaluate(spark, v.digits_only(F.col("c")), c="1 2") is False


def test_lists_and_counts(spark):
    assert evaluate(spark, v.csv_items(F.col("c")), c=" a, ,b,,c ") == ["a", "b", "c"]
    assert evaluate(spark, v.counts_from_json(F.col("c")), c='{"a":1,"b":"x"}') == {"a": 1, "b": None}
    assert evaluate(spark, v.counts_from_json(F.col("c")), c="broken") is None
    assert evaluate(spark, v.counts_to_json(v.counts_from_json(F.col("c"))), c='{"a":1}') == '{"a":1}'


@pytest.mark.parametrize(
    "name, snake",
    [("regStatus", "reg_status"), ("BRNNumber", "b_r_n_number"), ("plain", "plain"), ("aB1C", "a_b1_c"), ("", "")],
)
def test_camel_to_snake(spark, name, snake):
    assert evaluate(spark, names.camel_to_snake(F.col("c")), c=name) == snake


def test_target_name_prefers_the_explicit_rename(spark):
    renames = {"BRNNumber": "brn_number"}
    assert evaluate(spark, names.target_name(F.col("c"), renames), c="BRNNumber") == "brn_number"
    assert evaluate(spark, names.target_name(F.col("c"), renames), c="orgNumber") == "org_number"


def test_clean_names(spark):
    assert evaluate(spark, names.clean_table_name(F.col("c")), c="_Order  Lines (EU)-") == "order_lines_eu"
    assert evaluate(spark, names.clean_column_name(F.col("c")), c=" a;b\t{c}=d/e#") == "a_b_c_d_e"
    assert names.number_repeats(["a", "b", "a", "a"]) == ["a", "b", "a_2", "a_3"]
    assert names.number_repeats(["a", "a", "a_2", "A", ""]) == ["a", "a_3", "a_2", "A_4", "column"]
    assert names.clean_columns(spark.createDataFrame([(1, 2, 3)], ["a b", "a  b", "c"])).columns == ["a_b", "a_b_2", "c"]


def test_stringify_and_timestamps(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(9999, 12, 31), None, True)], "n INT, t TIMESTAMP, e DATE, b BOOLEAN"
    )
    assert tuple(names.stringify(df, ["e"]).first()) == (1, "9999-12-31 00:00:00", "", True)
    assert names.timestamps_to_text(df).first()["t"] == "9999-12-31 00:00:00"
