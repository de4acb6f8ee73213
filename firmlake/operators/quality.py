"""Checks on tables after a run. Each returns a DataFrame; nothing is printed or raised."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmlake.operators.profile import column_profile
from firmlake.sources import storage


REPORT = "column_name STRING, declared_type STRING, actual_type STRING, state STRING, is_partition BOOLEAN"


def _states(actual: T.StructType, declared: T.StructType, partitions: Sequence[str]) -> list[tuple]:
    present = {f.name: f.dataType.simpleString() for f in actual.fields}
    wanted = {f.name: f.dataType.simpleString() for f in declared.fields}

    def state(column: str) -> str:
        if column not in present:
            return "missing"
        if column not in wanted:
            return "unknown"
        return "ok" if present[column] == wanted[column] else "type differs"

    names = [*wanted, *[c for c in present if c not in wanted]]
    return [(c, wanted.get(c), present.get(c), state(c), c in partitions) for c in names]


def schema_report(df: DataFrame, declared: T.StructType, partitions: Sequence[str] = ()) -> DataFrame:
    """One row per declared or present column with its state and the number of values it holds.

    A DataFrame does not say by which columns it is stored: ``partitions`` names them.
    """
    expected = df.sparkSession.createDataFrame(_states(df.schema, declared, partitions), REPORT)
    # both sides hold one row per column
    return expected.join(F.broadcast(column_profile(df).select("column_name", "filled")), "column_name", "left")


def stored_schema_report(spark: SparkSession, path: str, declared: T.StructType, partition: str | None = "dt", counts: bool = True) -> DataFrame:
    """The same for a stored table, from its folders and footers alone: no row is read.

    Adds the table's state: ``missing`` (no files: every declared column is missing), ``not parquet``, ``not by <partition>``, else
    ``ok``. ``partition`` None expects a table without partitions. ``filled`` is null where ``counts`` is off; a partition column holds a
    value for each row.
    """
    kind, partitions = storage.file_format(spark, path), storage.partition_columns(spark, path)
    wanted = [] if partition is None else [partition]
    state = "missing" if kind is None else "not parquet" if kind != "parquet" else "ok" if partitions == wanted else f"not by {partition}"
    actual = spark.read.parquet(path).schema if kind == "parquet" else T.StructType([])
    actual = T.StructType([T.StructField(f.name, T.StringType()) if f.name in partitions else f for f in actual.fields])
    filled: dict[str, int] = {}
    if counts and kind == "parquet":
        plain = [f.name for f in actual.fields if f.name not in partitions]
        row = storage.footers(spark, path, F.count("*").alias("_rows"), *[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(plain)])
        filled = {c: row[f"n{i}"] for i, c in enumerate(plain)} | {c: row["_rows"] for c in partitions}
    rows = [(*r, filled.get(r[0]), state) for r in _states(actual, declared, partitions)]
    return spark.createDataFrame(rows, f"{REPORT}, filled BIGINT, table_state STRING")


def partition_counts(records: DataFrame) -> DataFrame:
    """Total, successful and failed records of each partition."""
    ok = F.col("status_code") == 0
    return records.groupBy("dt").agg(
        F.count("*").alias("total"), F.count_if(ok).alias("success"), F.count_if(~ok).alias("failed")
    )


def trace_ratio(parsed: DataFrame, records: DataFrame) -> DataFrame:
    """Per partition: parsed rows, those whose record exists in the same partition, and their share.

    Rows are counted per record before the join, so a record with many rows weighs no more than any other.
    """
    per_record = parsed.groupBy("api_record_id", "dt").agg(F.count("*").alias("rows"))
    known = records.select(F.col("id").alias("api_record_id"), "dt").distinct().withColumn("known", F.lit(True))
    linked = F.when(F.col("known"), F.col("rows")).otherwise(0)
    joined = per_record.join(known, ["api_record_id", "dt"], "left")
    counted = joined.groupBy("dt").agg(F.sum("rows").alias("parsed_rows"), F.sum(linked).alias("linked_rows"))
    return counted.withColumn("linked_share", F.col("linked_rows") / F.col("parsed_rows"))


def repeated_success(records: DataFrame) -> DataFrame:
    """Keys with more than one success on the same date."""
    keys = ["interface_key", "dt", "input_param"]
    return records.where("status_code = 0").groupBy(*keys).agg(F.count("*").alias("successes")).where("successes > 1")


def sample_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)
