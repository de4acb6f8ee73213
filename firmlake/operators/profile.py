"""Row and column statistics in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: rows, values and NULLs. The table is read once, for all columns together."""
    counted = df.agg(F.count("*").alias("_rows"), *[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(df.columns)])
    per_column = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("filled")) for i, c in enumerate(df.columns)]
    )
    return counted.select(F.col("_rows").alias("row_count"), F.inline(per_column)).withColumn(
        "empty", F.col("row_count") - F.col("filled")
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table and a total, from one aggregate per table."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    summed = counts.rollup("table_name").agg(F.sum("row_count").alias("row_count"), F.grouping("table_name").alias("is_total"))
    return summed.select(F.coalesce("table_name", F.lit("total")).alias("table_name"), "row_count", (F.col("is_total") == 1).alias("is_total"))
