"""Flattening of the stored responses of each interface into typed rows.

Every parser reads the payload once with ``from_json`` against a schema of its own, turns arrays into rows with
``explode`` and picks columns with native expressions. Records that cannot be read are told apart by ``parse_status``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlake.functions import names
from firmlake.functions import values as v
from firmlake.schemas import parsed_schema
from firmlake.sources.tables import conform

SUCCESS, FAILED, SKIP_EMPTY = "SUCCESS", "FAILED", "SKIP_EMPTY"
READ_OPTIONS = {"columnNameOfCorruptRecord": "unread", "allowSingleQuotes": "false"}


def read_json(payload: Column, schema: str) -> Column:
    """Payload as a struct; ``unread`` holds the text when some part does not fit the schema."""
    return F.from_json(payload, f"{schema}, unread STRING", READ_OPTIONS)


REPEATS = "spark.sql.variant.allowDuplicateKeys"


def is_whole_document(payload: Column) -> Column:
    """True when the text is one JSON value and nothing else.

    The typed read stops at the end of its value and does not see what follows. Here the text is a member of an object whose
    last member bears the text's hash: whatever follows the value, be it a bracket that closes the object, takes that member
    away. The text's tokens are passed over once, nothing is built.
    """
    mark = F.md5(payload)
    keys = F.json_object_keys(F.concat(F.lit('{"p":'), payload, F.lit(',"'), mark, F.lit('":0}')))
    return F.coalesce(keys == F.array(F.lit("p"), mark), F.lit(False))


def _fits(doc: Column) -> Column:
    return doc.isNotNull() & doc["unread"].isNull()


def _once(value: Column, rule: Callable[[Column], Column]) -> Column:
    """``rule`` of a value that it uses several times: as an element of an array the value is worked out once."""
    return F.get(F.transform(F.array(value), rule), F.lit(0))


def _nothing_listed(payload: Column, path: str) -> Column:
    """True when ``result``, or the list at ``path`` inside it, is some empty value of another type."""

    def empty(root: Column) -> Column:
        result = v.member(root, "result")
        inside = F.to_json(result).startswith("{") & v.is_falsy(F.try_variant_get(root, path, "variant"))
        return F.to_json(root).startswith("{") & (v.is_falsy(result) | inside)

    return _once(F.try_parse_json(payload), empty)


def _size(items: Column) -> Column:
    return F.coalesce(F.array_size(items), F.lit(0))


@dataclass(frozen=True)
class Parser:
    schema: str
    status: Callable[[Column, Column], Column]
    """(doc, payload) to SUCCESS / FAILED / SKIP_EMPTY"""
    rows: Callable[[DataFrame], DataFrame]
    """Readable records with ``doc`` to rows holding the target columns"""
    count: Callable[[Column], Column] = lambda doc: F.lit(1)
    """``doc`` of a readable record to the number of its rows"""


def _at(doc: Column, path: str) -> Column:
    for part in path.split("."):
        doc = doc[part]
    return doc


def _state(ok: Column) -> Column:
    return F.when(F.coalesce(ok, F.lit(False)), F.lit(SUCCESS)).otherwise(F.lit(FAILED))


def _has_null(items: Column) -> Column:
    return F.coalesce(F.exists(items, lambda i: i.isNull()), F.lit(False))


def _structs(fields: Iterable[str], kind: str = "VARIANT") -> str:
    return "STRUCT<" + ", ".join(f"{f}: {kind}" for f in fields) + ">"


def _pick(source: str, fields: dict[str, str], rule: Callable[[Column], Column]) -> list[Column]:
    return [rule(F.col(f"{source}.{key}")).alias(column) for column, key in fields.items()]


# --- paged lists: result.total and result.items -----------------------------------------------------------------------

# fixed values: target column and payload key
CHANGE_FIELDS = {
    "change_item": "changeItem", "content_before": "contentBefore", "content_after": "contentAfter",
    "change_time": "changeTime", "create_time": "createTime",
}
TAX_FIELDS = {
    "tax_id_number": "taxIdNumber", "new_own_tax_balance": "newOwnTaxBalance", "own_tax_amount": "ownTaxAmount",
    "publish_date": "publishDate", "own_tax_balance": "ownTaxBalance", "type": "type",
    "person_id_number": "personIdNumber", "tax_category": "taxCategory", "taxpayer_type": "taxpayerType",
    "person_id_name": "personIdName", "taxpayer_name": "name", "location": "location", "department": "department",
    "reg_type": "regType", "legal_person_name": "legalpersonName",
}
CASE_FIELDS = {
    "case_code": "caseCode", "trial_time": "trialTime", "case_title": "caseTitle", "uuid": "uuid",
    "trial_procedure": "trialProcedure", "case_reason": "caseReason", "case_type": "caseType",
}
LAWSUIT_FIELDS = {
    "doc_type": "docType", "lawsuit_url": "lawsuitUrl", "lawsuit_h5_url": "lawsuitH5Url", "title": "title",
    "court": "court", "judge_time": "judgeTime", "uuid": "uuid", "case_no": "caseNo", "case_type": "caseType",
    "case_reason": "caseReason", "case_money": "caseMoney",
}
PERSON_FIELDS = {"role": "role", "gid": "gid", "sptname": "sptname", "name": "name", "type": "type"}


def _paged(item: str, columns: Callable[[], list[Column]]) -> Parser:
    def rows(df: DataFrame) -> DataFrame:
        items = df.select(
            "api_record_id", F.col("input_param").alias("company_name"), "dt",
            v.integer(F.col("doc.result.total"), "int").alias("total"),
            F.explode("doc.result.items").alias("item"),
        )
        return items.select("api_record_id", "company_name", "dt", "total", *columns())

    return Parser(
        schema=f"result STRUCT<total: STRING, items: ARRAY<{item}>>",
        status=lambda doc, payload: _state(
            F.when(_fits(doc), ~_has_null(doc["result"]["items"])).otherwise(_nothing_listed(payload, "$.result.items"))
        ),
        rows=rows,
        count=lambda doc: _size(doc["result"]["items"]),
    )


def _persons() -> list[Column]:
    columns = []
    for place in (1, 2):
        someone = F.get("item.casePersons", F.lit(place - 1))
        columns += [v.null_if_empty(someone[key]).alias(f"{column}{place}") for column, key in PERSON_FIELDS.items()]
        columns.append(v.integer(v.text(someone["emotion"]), "int").alias(f"emotion{place}"))
    first = F.get("item.casePersons", F.lit(0))
    return [*columns, v.null_if_empty(first["result"]).alias("case_result")]


CHANGES = _paged(_structs(CHANGE_FIELDS.values()), lambda: _pick("item", CHANGE_FIELDS, v.null_if_falsy))
TAX_ARREARS = _paged(_structs(TAX_FIELDS.values()), lambda: _pick("item", TAX_FIELDS, v.null_if_falsy))
CASES = _paged(
    _structs([*CASE_FIELDS.values(), "caseIdentity"]),
    lambda: [
        *_pick("item", CASE_FIELDS, v.null_if_falsy),
        v.list_to_csv(v.variant_list(F.col("item.caseIdentity"))).alias("case_identity"),
    ],
)
LAWSUITS = _paged(
    _structs([*LAWSUIT_FIELDS.values(), "id", "submitTime"])[:-1]
    + f", casePersons: ARRAY<{_structs([*PERSON_FIELDS.values(), 'emotion', 'result'])}>>",
    lambda: [
        v.integer(v.text(F.col("item.id"))).alias("lawsuit_id"),
        *_pick("item", LAWSUIT_FIELDS, v.null_if_empty),
        v.epoch_to_timestamp(F.col("item.submitTime")).alias("submit_time"),
        *_persons(),
    ],
)

# --- risks: three nested lists ----------------------------------------------------------------------------------------

RISK_LEAF = "STRUCT<id: STRING, companyId: STRING, companyName: STRING, riskCount: STRING, title: STRING, type: STRING, desc: STRING>"
RISK_SCHEMA = (
    "result STRUCT<riskLevel: VARIANT, riskList: ARRAY<STRUCT<count: STRING, name: STRING, "
    f"list: ARRAY<STRUCT<total: STRING, tag: STRING, list: ARRAY<{RISK_LEAF}>>>>>>"
)


def _risk_status(doc: Column, payload: Column) -> Column:
    leaf_missing = lambda group: group.isNull() | _has_null(group["list"])
    group_missing = lambda c: c.isNull() | F.coalesce(F.exists(c["list"], leaf_missing), F.lit(False))
    broken = F.coalesce(F.exists(doc["result"]["riskList"], group_missing), F.lit(False))
    return _state(F.when(_fits(doc), ~broken).otherwise(_nothing_listed(payload, "$.result.riskList")))


def _risk_rows(df: DataFrame) -> DataFrame:
    return (
        df.select(
            "api_record_id", F.col("input_param").alias("main_company_name"), "dt",
            v.null_if_empty(F.col("doc.result.riskLevel")).alias("risk_level"),
            F.explode("doc.result.riskList").alias("category"),
        )
        .select(
            "api_record_id", "main_company_name", "dt", "risk_level",
            F.col("category.count").alias("risk_category_count"),
            F.col("category.name").alias("risk_category_name"),
            F.explode("category.list").alias("kind"),
        )
        .select(
            "*", F.col("kind.total").alias("risk_type_total"), F.col("kind.tag").alias("risk_type_tag"),
            F.explode("kind.list").alias("risk"),
        )
        .select(
            "*",
            F.nullif(v.integer(F.col("risk.companyId")), F.lit(0).cast("bigint")).alias("company_id"),
            v.blank_to_null(F.col("risk.companyName")).alias("company_name"),
            F.col("risk.id").alias("risk_id"),
            F.col("risk.riskCount").alias("risk_count"),
            F.col("risk.title").alias("risk_title"),
            F.col("risk.type").alias("risk_type"),
            F.col("risk.desc").alias("risk_desc"),
        )
    )


def _risk_count(doc: Column) -> Column:
    in_kinds = lambda kinds: F.aggregate(kinds, F.lit(0), lambda n, kind: n + _size(kind["list"]))
    listed = F.aggregate(doc["result"]["riskList"], F.lit(0), lambda n, c: n + F.coalesce(in_kinds(c["list"]), F.lit(0)))
    return F.coalesce(listed, F.lit(0))


RISKS = Parser(RISK_SCHEMA, _risk_status, _risk_rows, _risk_count)

# --- yearly figures ---------------------------------------------------------------------------------------------------


def _figures(interface_key: str) -> list[str]:
    known = parsed_schema(interface_key).fieldNames()
    return [c for c in known if c not in ("api_record_id", "data_create_time", "company_name", "show_year", "dt")]


def _yearly(interface_key: str, path: str, schema: str, kind: str, rule: Callable[[Column], Column],
            empty: Callable[[Column], Column]) -> Parser:
    def rows(df: DataFrame) -> DataFrame:
        years = df.select(
            "api_record_id", F.col("input_param").alias("company_name"), "dt", F.explode(f"doc.{path}").alias("year")
        )
        return years.select(
            "api_record_id", "company_name", "dt",
            rule(F.coalesce(F.col("year.showYear"), F.col("year.show_year"))).alias("show_year"),
            *[rule(F.col(f"year.{c}")).alias(c) for c in _figures(interface_key)],
        )

    return Parser(
        schema=schema.format(_structs(["showYear", "show_year", *_figures(interface_key)], kind)),
        status=lambda doc, payload: _state(F.when(_fits(doc), ~_has_null(_at(doc, path))).otherwise(empty(payload))),
        rows=rows,
        count=lambda doc: _size(_at(doc, path)),
    )


def _no_year_list(payload: Column) -> Column:
    return _once(
        F.try_parse_json(payload),
        lambda root: F.to_json(root).startswith("{") & ~F.coalesce(v.is_list(v.member(root, "result")), F.lit(False)),
    )


# zero is a value here, and the figures become DECIMAL when the row is conformed
KEY_FIGURES = _yearly("967", "result", "result ARRAY<{}>", "STRING", lambda c: c, _no_year_list)
CASH_FLOWS = _yearly(
    "973", "result.corpCashFlow", "result STRUCT<corpCashFlow: ARRAY<{}>>", "VARIANT", v.null_if_falsy,
    lambda payload: _nothing_listed(payload, "$.result.corpCashFlow"),
)

# --- one row per record -----------------------------------------------------------------------------------------------

# fixed values: target column and payload key
LISTED_FIELDS = {
    "area": "area", "website": "website", "stock_code": "code", "address": "address",
    "stock_company_name": "companyName", "employees_num": "employeesNum", "main_business": "mainBusiness",
    "mobile": "mobile", "industry": "industry", "product_name": "productName",
    "actual_controller": "actualController", "controlling_shareholder": "controllingShareholder",
    "eng_name": "engName", "registered_capital": "registeredCapital", "postalcode": "postalcode",
    "listed_name": "name", "fax": "fax", "used_name": "usedName", "final_controller": "finalController",
    "introduction": "introduction",
}
LISTED_PERSONS = {"gm": "generalManager", "chairman": "chairman", "secretary": "secretaries", "legal_person": "legal"}
PAYMENT_FIELDS = {
    "company_paydex": "companyPayDex", "company_paydex_date": "companyPayDexDate",
    "industry_paydex_date": "industryPayDexDate", "industry_lower_quartile_paydex": "industryLowerQuartilePayDex",
    "industry_median_paydex": "industryMedianPayDex", "industry_upper_quartile_paydex": "industryUpperQuartilePayDex",
    "industry_count_num": "industryCountNum", "industry_company_position": "industryCompanyPosition",
    "company_average": "companyAverage", "en_company_average": "encompanyAverage",
    "industry_average": "industryAverage", "en_industry_average": "enindustryAverage",
    "uscc": "uscc", "sic2": "sic2", "sic3": "sic3", "sic4": "sic4",
}
PARENT_FIELDS = {
    "parent_company_name": ["name"],
    "parent_company_id": ["id"],
    "parent_company_reg_status": ["regStatus", "reg_status"],
    "parent_company_estiblish_time": ["estiblishTime", "estiblish_time"],
    "parent_company_reg_capital": ["regCapital", "reg_capital"],
    "parent_company_alias": ["alias"],
    "parent_company_logo": ["logo"],
    "parent_company_person_logo": ["personLogo"],
    "parent_company_legal_person_name": ["legalPersonName"],
}


def _own_row() -> list[Column]:
    return [F.col("api_record_id"), F.col("input_param").alias("company_name"), F.col("dt")]


def _listed_rows(df: DataFrame) -> DataFrame:
    people = [
        v.person(F.col(f"doc.result.{key}"))[part].alias(f"{prefix}_{part}")
        for prefix, key in LISTED_PERSONS.items()
        for part in ("type", "name", "id")
    ]
    return df.select(*_own_row(), *_pick("doc.result", LISTED_FIELDS, v.null_if_empty), *people)


LISTED_COMPANY = Parser(
    schema="result " + _structs([*LISTED_FIELDS.values(), *LISTED_PERSONS.values()]),
    status=lambda doc, payload: _state(_fits(doc) & doc["result"].isNotNull()),
    rows=_listed_rows,
)

SCALE = Parser(
    schema="result VARIANT",
    status=lambda doc, payload: _state(_fits(doc)),
    rows=lambda df: df.select(*_own_row(), v.null_if_falsy(F.col("doc.result")).alias("company_scale")),
)


def _type_rows(df: DataFrame) -> DataFrame:
    lists = {"org_type": "orgTypes", "economy_type": "economyTypes"}
    levels = [
        v.field_to_csv(v.variant_list(v.member(F.col("doc.result"), key)), level).alias(f"{prefix}_{level}")
        for prefix, key in lists.items()
        for level in ("level1", "level2")
    ]
    return df.select(*_own_row(), *levels)


COMPANY_TYPES = Parser(
    schema="result VARIANT",
    status=lambda doc, payload: _state(
        _fits(doc) & (v.is_falsy(doc["result"]) | F.to_json(doc["result"]).startswith("{"))
    ),
    rows=_type_rows,
)


def _parent_status(doc: Column, payload: Column) -> Column:
    blank = doc["result"]["companyName"].isNull() & doc["result"]["headquarters"].isNull()
    empty = blank & (F.get_json_object(payload, "$.result") == "{}")
    return _state(_fits(doc) & doc["result"].isNotNull() & ~empty)


def _parent_rows(df: DataFrame) -> DataFrame:
    office = F.col("doc.result.headquarters")
    listed = F.map_entries(F.from_json(F.when(office.startswith("{"), office), "map<string,variant>"))
    entries = df.select(
        "api_record_id",
        F.coalesce(v.null_if_falsy(F.col("doc.result.companyName")), F.col("input_param")).alias("company_name"),
        "dt",
        listed.alias("entries"),
    )

    def last_of(keys: list[str]) -> Column:
        return F.try_element_at(F.filter("entries", lambda e: e["key"].isin(keys)), F.lit(-1))["value"]

    parents = [v.blank_to_null(v.text(last_of(keys))).alias(column) for column, keys in PARENT_FIELDS.items()]
    return entries.select("api_record_id", "company_name", "dt", *parents)


PARENT_COMPANY = Parser("result STRUCT<companyName: VARIANT, headquarters: STRING>", _parent_status, _parent_rows)

PAYMENT_SCHEMA = ", ".join(f"{key} VARIANT" for key in PAYMENT_FIELDS.values()) + ", companyHistoryPayDexes VARIANT"


def _payment(doc: Column) -> Column:
    """The document held as text in ``res``."""
    return read_json(v.text(doc["res"]), PAYMENT_SCHEMA)


def _payment_status(doc: Column, payload: Column) -> Column:
    inner = F.try_parse_json(v.text(doc["res"]))
    return (
        F.when(~_fits(doc), F.lit(FAILED))
        .when(v.is_falsy(doc["res"]), F.lit(SKIP_EMPTY))
        .when(~v.is_json_string(doc["res"]), F.lit(FAILED))
        .when(inner.isNull() | ~is_whole_document(v.text(doc["res"])), F.lit(SKIP_EMPTY))
        .otherwise(_state(F.to_json(inner).startswith("{")))
    )


def _payment_rows(df: DataFrame) -> DataFrame:
    inner = df.select(*_own_row(), _payment(F.col("doc")).alias("inner"))
    history = F.col("inner.companyHistoryPayDexes")
    return inner.select(
        "api_record_id", "company_name", "dt",
        *_pick("inner", PAYMENT_FIELDS, v.null_if_empty),
        F.when(~v.is_falsy(history), F.to_json(history)).alias("company_history_paydexes"),
    )


PAYMENT_INDEX = Parser("res VARIANT", _payment_status, _payment_rows)

# --- company profile: known members get their own rule, the rest go by name -------------------------------------------

# fixed values: payload key and target column
PROFILE_TIMES = {
    "estiblishTime": "est_date", "fromTime": "from_date", "toTime": "to_date", "approvedTime": "approval_date",
    "updateTimes": "update_time", "cancelDate": "cancel_date", "revokeDate": "revoke_date",
}
PROFILE_RENAMES = {
    "id": "company_id", "type": "legal_person_type", "orgNumber": "org_code", "creditCode": "social_credit_code",
    "actualCapital": "paid_capital", "actualCapitalCurrency": "paid_capital_currency",
    "companyOrgType": "company_org_type", "base": "province_short", "alias": "company_alias",
    "name": "company_name_api", "BRNNumber": "brn_number",
}
PROFILE_OWN_RULE = ["industryAll", "staffList", "historyNames", "emailList", "historyNameList", *PROFILE_TIMES]


def _plain(value: Column) -> Column:
    """Lists of strings as a comma list, other lists and objects as JSON text, scalars as they are."""
    items = v.variant_list(value)
    listed = F.when(F.forall(items, v.is_json_string), v.list_to_csv(items)).otherwise(v.text(value))
    return F.when(v.text(value).startswith("[") & v.is_list(value), listed).otherwise(v.text(value))


def _last_wins(columns: str, texts: str, keys: str) -> Column:
    """Target columns and their texts as a map.

    Of two members for one column the later one is kept, an explicitly renamed one only without another.
    """
    members = F.arrays_zip(columns, texts, keys)
    renamed = F.filter(members, lambda m: m[keys].isin(list(PROFILE_RENAMES)))
    ranked = F.concat(renamed, F.filter(members, lambda m: ~m[keys].isin(list(PROFILE_RENAMES))))
    backwards = F.reverse(F.transform(ranked, lambda m: m[columns]))

    def newest(order: Column) -> Column:
        kept = F.filter(ranked, lambda m, i: F.array_position(order, m[columns]) == F.size(columns) - i)
        return F.map_from_entries(F.transform(kept, lambda m: F.struct(m[columns], m[texts])))

    # the order is an element of an array so that it is worked out once and not for every member
    deduplicated = F.get(F.transform(F.array(backwards), newest), F.lit(0))
    repeated = F.size(F.array_distinct(columns)) < F.size(columns)
    return F.when(repeated, deduplicated).otherwise(F.map_from_arrays(columns, texts))


def _profile_rows(df: DataFrame) -> DataFrame:
    result = F.col("doc.result")
    industry = F.try_variant_get(result["industryAll"], "$", "map<string,variant>")
    described = F.coalesce(industry, F.expr("CAST(map() AS map<string,variant>)"))
    members = F.map_filter(result, lambda k, _: ~k.isin(PROFILE_OWN_RULE))
    entries = {
        "columns": F.concat(
            F.transform(F.map_keys(described), lambda k: F.concat(F.lit("industry_all_"), names.camel_to_snake(k))),
            F.transform(F.map_keys(members), lambda k: names.target_name(k, PROFILE_RENAMES)),
        ),
        "texts": F.concat(F.transform(F.map_values(described), _plain), F.transform(F.map_values(members), _plain)),
        "keys": F.concat(F.transform(F.map_keys(described), lambda k: F.lit("")), F.map_keys(members)),
    }
    staff = v.member(result["staffList"], "result")
    own_rule = {
        "staff_list_total": v.text(v.member(result["staffList"], "total")),
        "staff_list_json": F.when(~v.is_falsy(staff), F.to_json(staff)),
        "email_list": v.list_to_csv(v.variant_list(result["emailList"])),
        "history_names": v.list_to_csv(v.variant_list(result["historyNameList"])),
        **{column: v.epoch_to_timestamp(result[key]) for key, column in PROFILE_TIMES.items()},
    }
    own = [value.alias(f"own_{column}") for column, value in own_rule.items()]
    targets = parsed_schema("819").fieldNames()[3:-1]  # all but the keys in front and dt
    gathered = df.select(*_own_row(), *[e.alias(name) for name, e in entries.items()], *own)
    # read into a struct by name: dozens of separate map lookups would make a method too long to be compiled
    by_name = F.from_json(F.to_json(_last_wins(*entries)), ", ".join(f"{c} STRING" for c in targets))
    looked_up = gathered.withColumn("member", by_name)

    def column(name: str) -> Column:
        member = v.blank_to_null(F.col(f"member.{name}"))
        if name in PROFILE_TIMES.values():
            member = F.coalesce(member.try_cast("timestamp"), F.col(f"own_{name}"))
        elif name in own_rule:
            member = F.coalesce(member, v.blank_to_null(F.col(f"own_{name}")))
        return member.alias(name)

    return looked_up.select("api_record_id", "company_name", "dt", *[column(c) for c in targets])


PROFILE = Parser(
    schema="result MAP<STRING, VARIANT>",
    status=lambda doc, payload: _state(_fits(doc) & (F.size(doc["result"]) > 0)),
    rows=_profile_rows,
)

PARSERS: dict[str, Parser] = {
    "819": PROFILE,
    "1058": RISKS,
    "822": CHANGES,
    "851": TAX_ARREARS,
    "1041": CASES,
    "1114": LAWSUITS,
    "854": LISTED_COMPANY,
    "967": KEY_FIGURES,
    "973": CASH_FLOWS,
    "1149": SCALE,
    "1168": COMPANY_TYPES,
    "1001": PARENT_COMPANY,
    "P51060": PAYMENT_INDEX,
}


def decode(records: DataFrame, interface_key: str) -> DataFrame:
    """Records with their payload as ``doc`` and a ``parse_status``.

    A payload with anything after its document has failed, whatever the document holds. Of a member that is repeated within an
    object the last one counts at every depth; the session setting for that (``REPEATS``) is switched on.
    """
    parser = PARSERS[interface_key]
    records.sparkSession.conf.set(REPEATS, "true")
    read = records.select(
        F.col("id").alias("api_record_id"), "input_param", "dt", "output_result",
        read_json(F.col("output_result"), parser.schema).alias("doc"),
    )
    status = F.when(is_whole_document(F.col("output_result")), parser.status(F.col("doc"), F.col("output_result"))).otherwise(FAILED)
    return read.withColumn("parse_status", status)


def _with_status(records: DataFrame, interface_key: str, status: str) -> DataFrame:
    """Decoded records of one status.

    A plain filter would be pushed below the projection and read the payload once more for every use of ``doc``;
    as an array of one or no element the document is read once.
    """
    chosen = F.when(F.col("parse_status") == status, F.array(F.struct("doc")))
    kept = decode(records, interface_key).select(
        "api_record_id", "input_param", "dt", "output_result", F.explode_outer(chosen).alias("kept")
    )
    return kept.where(F.col("kept").isNotNull()).withColumn("doc", F.col("kept.doc")).drop("kept")


def parse(records: DataFrame, interface_key: str, parsed_at: Column | None = None) -> DataFrame:
    """Typed rows of one interface from its newest successful records."""
    rows = PARSERS[interface_key].rows(_with_status(records, interface_key, SUCCESS))
    if parsed_at is not None:
        rows = rows.withColumn("data_create_time", parsed_at)
    return conform(rows, parsed_schema(interface_key))


def parse_status(records: DataFrame, interface_key: str) -> DataFrame:
    return decode(records, interface_key).select("api_record_id", "input_param", "dt", "parse_status")


def quarantine(records: DataFrame, interface_key: str) -> DataFrame:
    """Records that gave no row because they could not be read, with the text for a second look."""
    return _with_status(records, interface_key, FAILED).drop("doc")


def parse_stats(records: DataFrame, interface_key: str) -> DataFrame:
    """Records per parse status, and the rows that the successful ones give.

    Both are counted in one pass over the payloads, in which no target column is built and no row is made.
    """
    rows = F.when(F.col("parse_status") == SUCCESS, PARSERS[interface_key].count(F.col("doc"))).otherwise(0)
    read = decode(records, interface_key).select("parse_status", rows.alias("rows"))
    counted = read.groupBy("parse_status").agg(F.count("*").alias("records"), F.sum("rows").alias("rows"))
    return counted.select(F.lit(interface_key).alias("interface_key"), "parse_status", "records", "rows")
