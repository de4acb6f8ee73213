"""Codes to their meaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed value: text for a code missing from the dictionary
UNKNOWN_CODE = "未知错误码({})"


def unknown(code: Column) -> Column:
    return F.concat(F.lit(UNKNOWN_CODE.split("{}")[0]), code.cast("string"), F.lit(UNKNOWN_CODE.split("{}")[1]))


def decode(df: DataFrame, dictionary: DataFrame, on: Sequence[str], code: str, into: str) -> DataFrame:
    """``into`` holds the meaning of ``code``. The dictionaries of the registry hold some dozen rows."""
    joined = df.join(F.broadcast(dictionary), list(on), "left")
    return joined.withColumn(into, F.coalesce("meaning", unknown(F.col(code)))).drop("meaning")
