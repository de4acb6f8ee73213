"""Queries for the parsers: every order becomes a call record with a payload built from its own columns.

Payload members cycle through text, ``""``, 0, a number, ``"0"`` and a missing member, so each null rule is met in
every column. The oracle computes the expected columns from the order, not from the payload.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlake.operators.latest import latest_success
from firmlake.plans import parsing as P
from firmlake.schemas import PARSED, parsed_schema
from firmlake.session import scratch_path
from firmlake.workload.tables import SPARK_NAME, SQL_NAME, filled, spread, table

CASES = 6


def token(seed: str, j: int) -> str:
    """JSON text of member ``j``; NULL leaves the member out."""
    return (
        f"CASE ({seed} + {j}) % {CASES} WHEN 0 THEN concat('\"v{j}-', {seed}, '\"') WHEN 1 THEN '\"\"' "
        f"WHEN 2 THEN '0' WHEN 3 THEN cast({seed} + 1 AS string) WHEN 4 THEN '\"0\"' END"
    )


def json_object(seed: str, keys: Sequence[str], more: Sequence[str] = (), offset: int = 0) -> str:
    members = [f"concat('\"{k}\":', {token(seed, j + offset)})" for j, k in enumerate(keys)]
    return f"concat('{{', concat_ws(',', {', '.join([*members, *more])}), '}}')"


def json_array(item: str, count: str) -> str:
    """Array of ``item``, an expression over the position ``i``."""
    return f"CASE WHEN {count} = 0 THEN '[]' ELSE concat('[', array_join(transform(sequence(1, cast({count} AS int)), i -> {item}), ','), ']') END"


# what each rule makes of the six cases, in SQL for the oracle
EXPECTED = {
    "null_if_empty": "CASE ({s} + {j}) % 6 WHEN 0 THEN 'v{j}-' || {s} WHEN 3 THEN ({s} + 1)::VARCHAR WHEN 4 THEN '0' END",
    "blank_to_null": "CASE ({s} + {j}) % 6 WHEN 0 THEN 'v{j}-' || {s} WHEN 2 THEN '0' WHEN 3 THEN ({s} + 1)::VARCHAR WHEN 4 THEN '0' END",
    "text": "CASE ({s} + {j}) % 6 WHEN 0 THEN 'v{j}-' || {s} WHEN 1 THEN '' WHEN 2 THEN '0' WHEN 3 THEN ({s} + 1)::VARCHAR WHEN 4 THEN '0' END",
    "int": "CASE ({s} + {j}) % 6 WHEN 2 THEN 0 WHEN 3 THEN {s} + 1 WHEN 4 THEN 0 END::INTEGER",
    "bigint": "CASE ({s} + {j}) % 6 WHEN 2 THEN 0 WHEN 3 THEN {s} + 1 WHEN 4 THEN 0 END::BIGINT",
    "bigint_not_zero": "CASE ({s} + {j}) % 6 WHEN 3 THEN {s} + 1 END::BIGINT",
    "money": "CASE ({s} + {j}) % 6 WHEN 2 THEN '0.0000' WHEN 3 THEN ({s} + 1) || '.0000' WHEN 4 THEN '0.0000' END",
}


def expected(rule: str, column: str, j: int, seed: str = "seed") -> str:
    return f"{EXPECTED[rule].format(s=seed, j=j)} AS {column}"


RECORD = [
    "o_orderkey AS id",
    "{name} AS input_param",
    "'{key}' AS interface_key",
    "concat(year(o_orderdate), '0101') AS dt",
    "CASE WHEN o_orderstatus = 'P' THEN 300000 ELSE 0 END AS status_code",
    "date_trunc('month', o_orderdate) AS create_time",
]


def as_records(orders: DataFrame, interface_key: str, payload: str) -> DataFrame:
    return orders.selectExpr(*filled(RECORD, name=SPARK_NAME, key=interface_key), f"{payload} AS output_result")


def call_records(spark: SparkSession, sf_dir: str, interface_key: str, payload: str) -> DataFrame:
    return as_records(spread(table(spark, sf_dir, "orders")), interface_key, payload)


def stored_log(spark: SparkSession, sf_dir: str, interface_key: str, payload: str, files: int) -> DataFrame:
    """The call records as a table on disk, the way a parse job finds them."""
    path = scratch_path(spark, f"log-{interface_key}")
    as_records(table(spark, sf_dir, "orders").repartition(files), interface_key, payload).write.parquet(path)
    return spark.read.parquet(path)


# newest successful orders of a customer and year, ties kept
SQL_LATEST = f"""logged AS (SELECT {', '.join(filled(RECORD, name=SQL_NAME, key=''))}, o_orderkey AS n,
    epoch(o_orderdate)::BIGINT AS t FROM orders),
newest AS (SELECT input_param, dt, max(create_time) AS create_time FROM logged WHERE status_code = 0 GROUP BY ALL),
latest AS (SELECT logged.* FROM logged JOIN newest USING (input_param, dt, create_time) WHERE status_code = 0)"""


def comparable(rows: DataFrame) -> DataFrame:
    """Timestamps as epoch seconds and decimals as text, so that both engines show them alike."""

    def column(field):
        kind = field.dataType.simpleString()
        if kind == "timestamp":
            return F.unix_timestamp(field.name).alias(field.name)
        return F.col(field.name).cast("string").alias(field.name) if kind.startswith("decimal") else F.col(field.name)

    return rows.select(*[column(f) for f in rows.schema.fields if f.name != "data_create_time"])


def parse_query(interface_key: str, payload: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        newest = latest_success(call_records(spark, sf_dir, interface_key, payload))
        return comparable(P.parse(newest, interface_key))

    return run


def in_table_order(interface_key: str, columns: dict[str, str], source: str, ctes: str = "") -> str:
    """Oracle that names the target columns from their expected expressions."""
    wanted = [c for c in parsed_schema(interface_key).fieldNames() if c != "data_create_time"]
    given = {"api_record_id": "id", "dt": "dt", **columns}
    listed = ",\n  ".join(f"{given[c]} AS {c}" for c in wanted)
    return f"WITH {SQL_LATEST}{ctes}\nSELECT {listed}\nFROM {source}"


def expect(rule: str, j: int, seed: str = "seed") -> str:
    return EXPECTED[rule].format(s=seed, j=j)


ITEMS = ",\nitems AS (SELECT *, n + i * 7 AS seed FROM latest, unnest(range(1, n % 4 + 1)) AS u(i))"
SEED = "(o_orderkey + i * 7)"
COUNT = "o_orderkey % 4"

PAYLOADS: dict[str, str] = {}
ORACLES: dict[str, str] = {}


def paged_payload(item: str) -> str:
    listed = f"CASE WHEN o_orderkey % 8 = 4 THEN NULL ELSE concat('\"items\":', {json_array(item, COUNT)}) END"
    return f"concat('{{\"result\":{{', concat_ws(',', concat('\"total\":', {COUNT}), {listed}), '}}}}')"


def add_paged(interface_key: str, fields: dict[str, str], rule: str, more: Sequence[str] = (), more_columns=None) -> None:
    PAYLOADS[interface_key] = paged_payload(json_object(SEED, list(fields.values()), more))
    columns = {c: expect(rule, j) for j, c in enumerate(fields)}
    given = {"company_name": "input_param", "total": "(n % 4)::INTEGER", **columns, **(more_columns or {})}
    ORACLES[interface_key] = in_table_order(interface_key, given, "items", ITEMS)


add_paged("822", P.CHANGE_FIELDS, "null_if_empty")
add_paged("851", P.TAX_FIELDS, "null_if_empty")
identity = f"CASE {SEED} % 5 WHEN 0 THEN '[]' WHEN 1 THEN concat('[\"a', {SEED}, '\",\"\",null,\"b\"]') WHEN 2 THEN '[\"\",\"\"]' WHEN 3 THEN 'null' END"
add_paged(
    "1041", P.CASE_FIELDS, "null_if_empty", [f"concat('\"caseIdentity\":', {identity})"],
    {"case_identity": "CASE seed % 5 WHEN 1 THEN 'a' || seed || ',b' WHEN 2 THEN '' END"},
)

PERSON_KEYS = [*P.PERSON_FIELDS.values(), "emotion", "result"]
persons = f"CASE {SEED} % 4 WHEN 0 THEN '[]' WHEN 1 THEN concat('[', {json_object(SEED, PERSON_KEYS, offset=20)}, ']') WHEN 2 THEN concat('[', {json_object(SEED, PERSON_KEYS, offset=20)}, ',', {json_object(SEED, PERSON_KEYS, offset=30)}, ',{{}}]') END".replace("{{}}", "{}")
submitted = f"CASE {SEED} % 5 WHEN 0 THEN cast(unix_seconds(cast(o_orderdate AS timestamp)) * 1000 + 999 AS string) WHEN 1 THEN concat('\"', unix_seconds(cast(o_orderdate AS timestamp)), '\"') WHEN 2 THEN '0' WHEN 3 THEN '\"0\"' ELSE '253402214400000' END"
lawsuit_more = [
    f"concat('\"id\":', {SEED})", f"concat('\"submitTime\":', {submitted})", f"concat('\"casePersons\":', {persons})",
]
person_columns = {}
for place, offset, there in ((1, 20, "seed % 4 IN (1, 2)"), (2, 30, "seed % 4 = 2")):
    for j, column in enumerate(P.PERSON_FIELDS):
        person_columns[f"{column}{place}"] = f"CASE WHEN {there} THEN {expect('null_if_empty', j + offset)} END"
    person_columns[f"emotion{place}"] = f"CASE WHEN {there} THEN {expect('int', 5 + offset)} END"
person_columns["case_result"] = f"CASE WHEN seed % 4 IN (1, 2) THEN {expect('null_if_empty', 26)} END"
add_paged(
    "1114", P.LAWSUIT_FIELDS, "null_if_empty", lawsuit_more,
    {
        "lawsuit_id": "seed::BIGINT",
        "submit_time": "CASE seed % 5 WHEN 0 THEN t WHEN 1 THEN t WHEN 3 THEN 0 END::BIGINT",
        **person_columns,
    },
)

# risks: n % 3 categories with n % 2 + 1 kinds of i leaves each
LEAF_KEYS = ["id", "companyId", "companyName", "riskCount", "title", "type", "desc"]
leaf_seed = "(o_orderkey + i * 7 + g * 5 + l * 3)"
leaf = json_object(leaf_seed, LEAF_KEYS)
leaves = f"concat('[', array_join(transform(sequence(1, cast(i AS int)), l -> {leaf}), ','), ']')"
group = f"concat('{{\"total\":', i, ',\"tag\":\"tag', g, '\",\"list\":', {leaves}, '}}')"
groups = f"concat('[', array_join(transform(sequence(1, cast(o_orderkey % 2 + 1 AS int)), g -> {group}), ','), ']')"
category = f"concat('{{\"count\":', i * 10, ',\"name\":\"name', i, '\",\"list\":', {groups}, '}}')"
PAYLOADS["1058"] = (
    f"CASE WHEN o_orderkey % 7 = 0 THEN '{{\"result\":null}}' ELSE concat('{{\"result\":{{\"riskLevel\":', "
    f"CASE WHEN o_orderkey % 5 = 0 THEN '\"\"' ELSE concat('\"L', o_orderkey % 5, '\"') END, ',\"riskList\":', "
    f"{json_array(category, 'o_orderkey % 3')}, '}}}}') END"
)
RISKS = """,
leaves AS (SELECT *, n + i * 7 + g * 5 + l * 3 AS seed FROM latest, unnest(range(1, n % 3 + 1)) AS a(i),
  unnest(range(1, n % 2 + 2)) AS b(g), unnest(range(1, i + 1)) AS c(l) WHERE n % 7 <> 0)"""
ORACLES["1058"] = in_table_order(
    "1058",
    {
        "main_company_name": "input_param",
        "risk_level": "CASE WHEN n % 5 <> 0 THEN 'L' || n % 5 END",
        "risk_category_count": "(i * 10)::INTEGER",
        "risk_category_name": "'name' || i",
        "risk_type_total": "i::INTEGER",
        "risk_type_tag": "'tag' || g",
        "risk_id": expect("bigint", 0),
        "company_id": expect("bigint_not_zero", 1),
        "company_name": expect("blank_to_null", 2),
        "risk_count": expect("int", 3),
        "risk_title": expect("text", 4),
        "risk_type": expect("int", 5),
        "risk_desc": expect("text", 6),
    },
    "leaves",
    RISKS,
)

# yearly figures
for key, rule, wrap in (("967", "money", "concat('{{\"result\":', {0}, '}}')"), ("973", "null_if_empty", "concat('{{\"result\":{{\"corpCashFlow\":', {0}, '}}}}')")):
    figures = P._figures(key)
    year = json_object(SEED, figures, ["concat('\"showYear\":\"', 2000 + i, '\"')"])
    PAYLOADS[key] = wrap.replace("{{", "{").replace("}}", "}").replace("{0}", json_array(year, COUNT))
    ORACLES[key] = in_table_order(
        key,
        {
            "company_name": "input_param",
            "show_year": "(2000 + i)::VARCHAR",
            **{c: expect(rule, j) for j, c in enumerate(figures)},
        },
        "items",
        ITEMS,
    )

# listed company: four persons
person_token = "CASE (o_orderkey + {p}) % 5 WHEN 0 THEN '\"\"' WHEN 1 THEN concat('{{\"cType\":2,\"name\":\"N', o_orderkey, '\",\"id\":\"', o_orderkey + 1, '\"}}') WHEN 2 THEN '{{\"cType\":0,\"name\":\"\",\"id\":\"0\"}}' WHEN 3 THEN '{{\"cType\":\"1\",\"id\":\"x\"}}' END"
person_members = [f"concat('\"{k}\":', {person_token.format(p=p)})" for p, k in enumerate(P.LISTED_PERSONS.values())]
PAYLOADS["854"] = f"CASE WHEN o_orderkey % 9 = 0 THEN '{{\"result\":null}}' ELSE concat('{{\"result\":', {json_object('o_orderkey', list(P.LISTED_FIELDS.values()), person_members)}, '}}') END"
people = {}
for p, prefix in enumerate(P.LISTED_PERSONS):
    people[f"{prefix}_type"] = f"CASE (n + {p}) % 5 WHEN 1 THEN 2 WHEN 3 THEN 1 END::INTEGER"
    people[f"{prefix}_name"] = f"CASE (n + {p}) % 5 WHEN 1 THEN 'N' || n END"
    people[f"{prefix}_id"] = f"CASE (n + {p}) % 5 WHEN 1 THEN n + 1 END::BIGINT"
ORACLES["854"] = in_table_order(
    "854",
    {
        "company_name": "input_param",
        **{c: expect("null_if_empty", j, "n") for j, c in enumerate(P.LISTED_FIELDS)},
        **people,
    },
    "latest WHERE n % 9 <> 0",
)

PAYLOADS["1149"] = f"concat('{{', concat_ws(',', '\"error_code\":0', concat('\"result\":', {token('o_orderkey', 0)})), '}}')"
ORACLES["1149"] = in_table_order("1149", {"company_name": "input_param", "company_scale": expect("null_if_empty", 0, "n")}, "latest")

# fixed shape: two levels per type, some blank
types = "CASE o_orderkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN '[]' WHEN 2 THEN concat('[{{\"level1\":\"{p}', o_orderkey, '\",\"level2\":\"\"}},{{\"level1\":\"z\"}}]') WHEN 3 THEN '[{{\"level2\":\"q\"}}]' END"
PAYLOADS["1168"] = (
    "CASE WHEN o_orderkey % 6 = 0 THEN '{\"result\":null}' ELSE concat('{\"result\":{', concat_ws(',', concat('\"orgTypes\":', "
    + types.format(p="o") + "), concat('\"economyTypes\":', " + types.format(p="e") + ")), '}}') END"
)
ORACLES["1168"] = in_table_order(
    "1168",
    {
        "company_name": "input_param",
        **{
            f"{prefix}_level1": f"CASE WHEN n % 6 <> 0 AND n % 5 = 2 THEN '{mark}' || n || ',z' END"
            for prefix, mark in (("org_type", "o"), ("economy_type", "e"))
        },
        **{f"{prefix}_level2": "CASE WHEN n % 6 <> 0 AND n % 5 = 3 THEN 'q' END" for prefix in ("org_type", "economy_type")},
    },
    "latest",
)

# parent company: both spellings of a key may be present, the later one counts
office_keys = ["name", "id", "alias", "logo", "personLogo", "legalPersonName"]
office_more = [
    "concat('\"regStatus\":\"s', o_orderkey, '\"')", "CASE WHEN o_orderkey % 2 = 0 THEN '\"reg_status\":\"\"' END",
    "concat('\"estiblish_time\":\"t', o_orderkey, '\"')", "CASE WHEN o_orderkey % 3 = 0 THEN '\"estiblishTime\":\"u\"' END",
    "CASE WHEN o_orderkey % 5 = 0 THEN '\"regCapital\":7' END",
]
office = f"CASE o_orderkey % 4 WHEN 0 THEN 'null' WHEN 1 THEN '{{}}' ELSE {json_object('o_orderkey', office_keys, office_more)} END"
PAYLOADS["1001"] = f"CASE WHEN o_orderkey % 9 = 0 THEN '{{\"result\":{{}}}}' ELSE concat('{{\"result\":{{', concat_ws(',', concat('\"companyName\":', {token('o_orderkey', 1)}), concat('\"headquarters\":', {office}), '\"other\":1'), '}}}}') END"
known = "n % 4 IN (2, 3)"
ORACLES["1001"] = in_table_order(
    "1001",
    {
        "company_name": f"coalesce({expect('null_if_empty', 1, 'n')}, input_param)",
        "parent_company_name": f"CASE WHEN {known} THEN {expect('blank_to_null', 0, 'n')} END",
        "parent_company_id": f"CASE WHEN {known} THEN {expect('bigint', 1, 'n')} END",
        "parent_company_reg_status": f"CASE WHEN {known} AND n % 2 <> 0 THEN 's' || n END",
        "parent_company_estiblish_time": f"CASE WHEN {known} THEN CASE WHEN n % 3 = 0 THEN 'u' ELSE 't' || n END END",
        "parent_company_reg_capital": f"CASE WHEN {known} AND n % 5 = 0 THEN '7' END",
        "parent_company_alias": f"CASE WHEN {known} THEN {expect('blank_to_null', 2, 'n')} END",
        "parent_company_logo": f"CASE WHEN {known} THEN {expect('blank_to_null', 3, 'n')} END",
        "parent_company_person_logo": f"CASE WHEN {known} THEN {expect('blank_to_null', 4, 'n')} END",
        "parent_company_legal_person_name": f"CASE WHEN {known} THEN {expect('blank_to_null', 5, 'n')} END",
    },
    "latest WHERE n % 9 <> 0",
)

# payment index: a document inside a text member
history = "CASE o_orderkey % 4 WHEN 0 THEN '[]' WHEN 1 THEN concat('[{\"d\":\"2020\",\"v\":', o_orderkey, '}]') WHEN 2 THEN 'null' END"
inner = json_object("o_orderkey", list(P.PAYMENT_FIELDS.values()), [f"concat('\"companyHistoryPayDexes\":', {history})"])
PAYLOADS["P51060"] = f"CASE o_orderkey % 10 WHEN 0 THEN '{{\"res\":\"\"}}' WHEN 1 THEN '{{\"res\":\"not json\"}}' ELSE to_json(named_struct('code', 0, 'res', {inner})) END"
ORACLES["P51060"] = in_table_order(
    "P51060",
    {
        "company_name": "input_param",
        **{c: expect("null_if_empty", j, "n") for j, c in enumerate(P.PAYMENT_FIELDS)},
        "company_history_paydexes": "CASE n % 4 WHEN 1 THEN '[{\"d\":\"2020\",\"v\":' || n || '}]' END",
    },
    "latest WHERE n % 10 > 1",
)

# company profile: the plain members by their camel-case name, and the members with a rule of their own
OWN = {"staff_list_total", "staff_list_json", "email_list", "history_names", *P.PROFILE_TIMES.values()}
RENAMED = {column: key for key, column in P.PROFILE_RENAMES.items()}


def camel(column: str) -> str:
    head, *rest = column.split("_")
    return head + "".join(w.capitalize() for w in rest)


fields = [f for f in parsed_schema("819").fields[3:-1] if f.name not in OWN]
industry = {f.name: camel(f.name.removeprefix("industry_all_")) for f in fields if f.name.startswith("industry_all_")}
plain = {f.name: RENAMED.get(f.name, camel(f.name)) for f in fields if f.name not in industry and f.name != "tags"}
EPOCH = "unix_seconds(cast(o_orderdate AS timestamp))"
time_token = "CASE (o_orderkey + {j}) % 6 WHEN 0 THEN cast(" + EPOCH + " AS string) WHEN 1 THEN concat('\"', " + EPOCH + " * 1000 + 7, '\"') WHEN 2 THEN '0' WHEN 3 THEN '\"\"' WHEN 4 THEN '253402214400000' ELSE cast(-5 - o_orderkey AS string) END"
time_expected = "CASE (n + {j}) % 6 WHEN 0 THEN t WHEN 1 THEN t WHEN 5 THEN -5 - n END::BIGINT"
profile_more = [
    *[f"concat('\"{k}\":', {time_token.format(j=j)})" for j, k in enumerate(P.PROFILE_TIMES)],
    f"concat('\"industryAll\":', {json_object('o_orderkey', list(industry.values()), offset=70)})",
    "concat('\"staffList\":{\"total\":', o_orderkey % 3, ',\"result\":', CASE WHEN o_orderkey % 3 = 0 THEN '[]' ELSE concat('[{\"name\":\"p', o_orderkey, '\"}]') END, '}')",
    "CASE o_orderkey % 3 WHEN 0 THEN '\"emailList\":[]' WHEN 1 THEN concat('\"emailList\":[\"m', o_orderkey, '\",\"\",\"x\"]') END",
    "CASE o_orderkey % 3 WHEN 0 THEN '\"historyNameList\":[\"\"]' WHEN 1 THEN '\"historyNameList\":[\"h\"]' END",
    "'\"historyNames\":\"h;\"'", "'\"unlisted\":{\"a\":1}'",
    "CASE o_orderkey % 4 WHEN 0 THEN '\"tags\":[\"a\",\"b\"]' WHEN 1 THEN '\"tags\":[1,\"b\"]' WHEN 2 THEN '\"tags\":{\"a\":1}' END",
    "CASE WHEN o_orderkey % 7 = 0 THEN '\"reg_status\":\"again\"' END",
    "CASE WHEN o_orderkey % 7 = 1 THEN '\"companyId\":99' END",
]
PAYLOADS["819"] = f"CASE WHEN o_orderkey % 9 = 0 THEN '{{\"result\":{{}}}}' ELSE concat('{{\"result\":', {json_object('o_orderkey', list(plain.values()), profile_more)}, '}}') END"
RULES = {"string": "blank_to_null", "int": "int", "bigint": "bigint"}
kinds = {f.name: RULES[f.dataType.simpleString()] for f in fields}
profile_columns = {
    "company_name": "input_param",
    **{c: expect(kinds[c], j, "n") for j, c in enumerate(plain)},
    **{c: expect(kinds[c], j + 70, "n") for j, c in enumerate(industry)},
    **{c: time_expected.format(j=j) for j, c in enumerate(P.PROFILE_TIMES.values())},
    "staff_list_total": "(n % 3)::INTEGER",
    "staff_list_json": "CASE WHEN n % 3 <> 0 THEN '[{\"name\":\"p' || n || '\"}]' END",
    "email_list": "CASE WHEN n % 3 = 1 THEN 'm' || n || ',x' END",
    "history_names": "CASE WHEN n % 3 = 1 THEN 'h' END",
    "tags": "CASE n % 4 WHEN 0 THEN 'a,b' WHEN 1 THEN '[1,\"b\"]' WHEN 2 THEN '{\"a\":1}' END",
}
profile_columns["reg_status"] = f"CASE WHEN n % 7 = 0 THEN 'again' ELSE {profile_columns['reg_status']} END"
profile_columns["company_id"] = f"CASE WHEN n % 7 = 1 THEN 99 ELSE {profile_columns['company_id']} END"
ORACLES["819"] = in_table_order("819", profile_columns, "latest WHERE n % 9 <> 0")

# --- parse outcomes ---------------------------------------------------------------------------------------------------

# payloads that some interface skips or cannot read
ODD = """CASE o_orderkey % 16 WHEN 0 THEN '{"result":null}' WHEN 1 THEN '{"result":"text"}' WHEN 2 THEN 'broken'
  WHEN 3 THEN '{"result":{"total":1,"items":[null]}}' WHEN 4 THEN '{"res":"{}"}' WHEN 5 THEN '{"res":"oops"}'
  WHEN 6 THEN '{"res":7}' WHEN 7 THEN '{"result":{}}' WHEN 8 THEN '{"result":[]}' WHEN 9 THEN '[]'
  WHEN 10 THEN '{"result":{"items":"","orgTypes":[]}}' WHEN 11 THEN '{"result":""}' WHEN 12 THEN '{"result":{},"res":"{}"} garbage'
  WHEN 13 THEN '{"result":{},"res":"{}"}}' WHEN 14 THEN '{"result":{},"res":"{}"},{"result":{}}'
  ELSE '{"res":"{\\\\"a\\\\":1,\\\\"a\\\\":2}","result":{"x":{"b":1,"b":2}}}' END"""
# fixed values: outcome of the sixteen payloads above per interface (S success, F failed, E skipped as empty)
OUTCOMES = {
    "819": "FFFSFFFFFFSFFFFS",
    "1058": "SFFSSSSSSFSSFFFS",
    "822": "SFFFSSSSSFSSFFFS",
    "851": "SFFFSSSSSFSSFFFS",
    "1041": "SFFFSSSSSFSSFFFS",
    "1114": "SFFFSSSSSFSSFFFS",
    "854": "FFFSFFFSFFSFFFFS",
    "967": "SSFSSSSSSFSSFFFS",
    "973": "SFFSSSSSSFSSFFFS",
    "1149": "SSFSSSSSSFSSFFFS",
    "1168": "SFFSSSSSSFSSFFFS",
    "1001": "FFFSFFFFFFSFFFFS",
    "P51060": "EEFESEFEEFEEFFFS",
}


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = None
    for key in P.PARSERS:
        one = P.parse_stats(call_records(spark, sf_dir, key, ODD), key)
        stats = one if stats is None else stats.unionByName(one)
    return stats


def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    unread = None
    for key in ("819", "822", "P51060"):
        one = P.quarantine(call_records(spark, sf_dir, key, ODD), key).withColumn("interface_key", F.lit(key))
        unread = one if unread is None else unread.unionByName(one)
    return unread


SQL_OUTCOMES = "outcome AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{o}')" for k, o in OUTCOMES.items()) + ") AS o(interface_key, letters))"
SQL_STATUS = "CASE letters[(o_orderkey % 16 + 1)::BIGINT] WHEN 'S' THEN 'SUCCESS' WHEN 'F' THEN 'FAILED' ELSE 'SKIP_EMPTY' END"

FLAGSHIP_COLUMNS = ["risk_category_name", "risk_type_tag"]


def flatten_risks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest success per company and year, three levels of lists to rows, rows counted per category and tag."""
    newest = latest_success(call_records(spark, sf_dir, "1058", PAYLOADS["1058"]))
    return P.parse(newest, "1058").groupBy(*FLAGSHIP_COLUMNS).agg(
        F.count("*").alias("risks"), F.countDistinct("main_company_name").alias("companies"),
        F.sum(F.coalesce("risk_count", F.lit(0))).alias("risk_count"),
    )


QUERIES = {f"parse_{key}": parse_query(key, PAYLOADS[key]) for key in PARSED}
QUERIES |= {"flatten_risks": flatten_risks, "parse_stats": outcomes, "quarantine": quarantined}
ORACLE = {f"parse_{key}": ORACLES[key] for key in PARSED}
ORACLE |= {
    "flatten_risks": f"""WITH {SQL_LATEST}{RISKS}
SELECT 'name' || i AS risk_category_name, 'tag' || g AS risk_type_tag, count(*) AS risks,
  count(DISTINCT input_param) AS companies, sum(coalesce({expect('int', 3)}, 0))::BIGINT AS risk_count
FROM leaves GROUP BY ALL""",
    "parse_stats": f"""WITH {SQL_OUTCOMES}
SELECT interface_key, parse_status, count(*) AS records,
  CASE WHEN interface_key IN ('819', '854', '1149', '1168', '1001', 'P51060') AND parse_status = 'SUCCESS' THEN count(*) ELSE 0 END AS rows
FROM (SELECT interface_key, {SQL_STATUS} AS parse_status FROM orders, outcome) GROUP BY interface_key, parse_status""",
    "quarantine": f"""WITH {SQL_OUTCOMES}
SELECT o_orderkey AS api_record_id, {SQL_NAME} AS input_param, year(o_orderdate) || '0101' AS dt, {ODD} AS output_result,
  interface_key
FROM orders, outcome WHERE interface_key IN ('819', '822', 'P51060') AND {SQL_STATUS} = 'FAILED'""",
}
