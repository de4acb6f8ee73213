"""Column functions for JSON scalars and lists.

JSON scalars are read as VARIANT, which keeps the difference between ``0`` and ``"0"`` that the null rules depend on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# text of the values that count as empty, unless the value is a quoted string
EMPTY_SCALARS = ["", "0", "0.0", "-0.0", "false"]
EMPTY_LISTS = ["[]", "{}"]

MILLISECONDS_FROM = 10_000_000_000
FIRST_SECOND = -62135596800  # 0001-01-01T00:00:00Z
SENTINEL_SECOND = 253370764800  # 9999-01-01T00:00:00Z, "never" from here on


def text(value: Column) -> Column:
    """Scalar as text; lists and objects as JSON text."""
    return value.cast("string")


def is_json_string(value: Column) -> Column:
    return F.to_json(value).startswith('"')


def _is_one_of(value: Column, texts: list[str]) -> Column:
    # the text is at hand anyway; only the few candidates are looked at once more for their quotes
    return text(value).isin(texts) & ((text(value) == "") | ~is_json_string(value))


def is_empty(value: Column) -> Column:
    """True for ``''``, 0 and false (NULL for a missing or null value)."""
    return _is_one_of(value, EMPTY_SCALARS)


def is_falsy(value: Column) -> Column:
    """True for ``''``, 0, false, ``[]``, ``{}``, a JSON null and a missing value."""
    return F.coalesce(_is_one_of(value, EMPTY_SCALARS + EMPTY_LISTS), F.lit(True))


def null_if_empty(value: Column) -> Column:
    return F.when(~is_empty(value), text(value))


def null_if_falsy(value: Column) -> Column:
    return F.when(~_is_one_of(value, EMPTY_SCALARS + EMPTY_LISTS), text(value))


def blank_to_null(value: Column) -> Column:
    """``''`` becomes NULL; 0 is kept."""
    return F.nullif(value, F.lit(""))


def integer(value: Column, kind: str = "bigint") -> Column:
    """Whole number from a JSON number or numeric string, NULL when it is neither."""
    return value.try_cast(kind)


def money(value: Column) -> Column:
    return value.try_cast("decimal(24,4)")


def epoch_text_to_timestamp(value: Column) -> Column:
    """Epoch seconds, or milliseconds from 1e10 on, as text; outside years 1..9998 gives NULL."""
    number = value.try_cast("decimal(38,6)")
    seconds = F.when(number >= MILLISECONDS_FROM, F.floor(number / 1000)).otherwise(number).try_cast("bigint")
    return F.timestamp_seconds(F.when(seconds.between(FIRST_SECOND, SENTINEL_SECOND - 1), seconds))


def epoch_to_timestamp(value: Column) -> Column:
    """Variant epoch value; ``''`` and a numeric 0 mean "not set", the string ``'0'`` is 1970-01-01."""
    return epoch_text_to_timestamp(null_if_empty(value))


def list_to_csv(values: Column) -> Column:
    """Array of variants as a comma list without its falsy items; NULL when the array itself is empty."""
    kept = F.transform(F.filter(values, lambda v: ~is_falsy(v)), text)
    return F.when(F.size(values) > 0, F.array_join(kept, ","))


def field_to_csv(objects: Column, field: str) -> Column:
    """One field of an array of objects as a comma list; NULL when no value is left."""
    kept = F.filter(F.transform(objects, lambda o: null_if_falsy(member(o, field))), lambda v: v.isNotNull())
    return F.when(F.size(kept) > 0, F.array_join(kept, ","))


def variant_list(value: Column) -> Column:
    """Variant as an array of variants, NULL when it is not a list."""
    return F.try_variant_get(value, "$", "array<variant>")


def member(value: Column, name: str) -> Column:
    """Member of an object held in a variant, NULL when there is none."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def is_list(value: Column) -> Column:
    return F.to_json(value).startswith("[")


def person(value: Column) -> Column:
    """(type, name, id) of a person object; zero, blank and unreadable numbers become NULL."""
    return F.struct(
        integer(null_if_empty(member(value, "cType")), "int").alias("type"),
        null_if_falsy(member(value, "name")).alias("name"),
        F.nullif(integer(text(member(value, "id"))), F.lit(0).cast("bigint")).alias("id"),
    )


def csv_items(value: Column) -> Column:
    """Comma list as trimmed, non-empty items."""
    return F.filter(F.transform(F.split(value, ","), lambda v: F.trim(v)), lambda v: v != "")


def counts_from_json(value: Column) -> Column:
    """JSON object of row counts as a map; an entry that is no number stays, with a NULL count."""
    return F.transform_values(F.from_json(value, "map<string,string>"), lambda _, n: n.try_cast("bigint"))


def counts_to_json(value: Column) -> Column:
    return F.to_json(value)


def page_count(payload: Column, page_size: int | Column, max_pages: int | Column | None = None) -> Column:
    """Calls behind one stored response: ceil(total / page size), at least 1 and at most the page limit, where there is one."""
    size = page_size if isinstance(page_size, Column) else F.lit(page_size)
    limit = max_pages if isinstance(max_pages, Column) else F.lit(max_pages)
    total = F.coalesce(F.get_json_object(payload, "$.result.total").try_cast("int"), F.lit(0))
    pages = F.ceil(total / size).cast("bigint")
    return F.greatest(F.lit(1).cast("bigint"), F.least(pages, limit.cast("bigint")))


def failure_reason(payload: Column) -> Column:
    """``reason`` when the key is there at all, else ``msg``; blank text and unreadable payloads give NULL."""
    keys = F.json_object_keys(payload)
    chosen = F.when(F.array_contains(keys, "reason"), F.get_json_object(payload, "$.reason")).otherwise(
        F.get_json_object(payload, "$.msg")
    )
    return blank_to_null(chosen)


def digits_only(value: Column) -> Column:
    return F.trim(value).rlike(r"^\d+$")


def not_set(flag: Column) -> Column:
    """True unless the flag is true; a missing flag counts as false."""
    return ~F.coalesce(flag, F.lit(False))


def yes_no(condition: Column) -> Column:
    return F.when(condition, F.lit(YES)).otherwise(F.lit(NO))


# fixed values: flag texts of the customer lists
YES = "是"
NO = "否"
