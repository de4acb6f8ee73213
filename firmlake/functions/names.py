"""Name cleaning, as Column functions and as schema rewrites."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BEFORE_CAPITAL = r"(?<!^)(?=[A-Z])"
NOT_IN_TABLE_NAME = r"[^a-z0-9_]"
# fixed values: characters a column name may not hold
NOT_IN_COLUMN_NAME = r"[ ,;{}()\n\t=/#]"
NUMERIC = (T.NumericType, T.BooleanType)


def camel_to_snake(name: Column) -> Column:
    """Split before every capital letter but the first: ``BRNNumber`` gives ``b_r_n_number``."""
    return F.lower(F.regexp_replace(name, BEFORE_CAPITAL, "_"))


def target_name(name: Column, renames: dict[str, str]) -> Column:
    """Explicit rename if there is one, else the snake-case rule."""
    pairs = [F.lit(part) for pair in renames.items() for part in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), name), camel_to_snake(name))


def _collapse(name: Column) -> Column:
    return F.trim(F.regexp_replace(name, "_+", "_"), F.lit("_"))


def _plain_clean(name: str, invalid: str) -> str:
    return re.sub("_+", "_", re.sub(invalid, "_", name)).strip("_")


def table_name(name: str) -> str:
    """``clean_table_name`` for a name at hand."""
    return _plain_clean(name.lower(), NOT_IN_TABLE_NAME)


def clean_table_name(name: Column) -> Column:
    return _collapse(F.regexp_replace(F.lower(name), NOT_IN_TABLE_NAME, "_"))


def clean_column_name(name: Column) -> Column:
    return _collapse(F.regexp_replace(name, NOT_IN_COLUMN_NAME, "_"))


def number_repeats(names: list[str]) -> list[str]:
    """Second and later uses of a name, whatever its case, get the next free of ``_2``, ``_3`` and so on.

    Names that are given keep their place before numbered ones; an empty name becomes ``column``.
    """
    given = [name or "column" for name in names]
    taken = {name.lower() for name in given}
    seen: set[str] = set()
    result = []
    for name in given:
        free, number = name, 2
        while free.lower() in seen or (free != name and free.lower() in taken):
            free, number = f"{name}_{number}", number + 1
        seen.add(free.lower())
        result.append(free)
    return result


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*number_repeats([_plain_clean(c, NOT_IN_COLUMN_NAME) for c in df.columns]))


def stringify(df: DataFrame, all_null: list[str]) -> DataFrame:
    """Text for every non-numeric column, and ``''`` for columns known to hold no value at all."""
    return df.select(
        *[
            F.lit("").alias(f.name)
            if f.name in all_null
            else F.col(f"`{f.name}`")
            if isinstance(f.dataType, NUMERIC)
            else F.col(f"`{f.name}`").cast("string").alias(f.name)
            for f in df.schema.fields
        ]
    )


def timestamps_to_text(df: DataFrame) -> DataFrame:
    """Timestamps as text, so that years outside the range of a reader survive an export."""
    kinds = (T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, kinds) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
