"""Scans of date partitions and replacement of rows inside them.

Tables are Parquet folders partitioned by ``dt``. A replacement never overwrites what its own plan still reads: the new
content is written once, beside the old, and takes its place when it is whole (``storage``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmlake.schemas import company_column
from firmlake.sources import storage


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Table with ``dt`` as text, also where a session infers a number from the folder names.

    A replacement that was cut off half-way is undone first.
    """
    storage.settle(spark, path)
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    return df.withColumn("dt", F.col("dt").cast("string")) if "dt" in df.columns else df


def scan(df: DataFrame, *dts: str) -> DataFrame:
    return df.where(F.col("dt").isin(list(dts)))


def scan_latest(df: DataFrame) -> DataFrame:
    """Newest partition of any DataFrame. The subquery runs first and its value prunes the scan of the other partitions."""
    return df.where(F.col("dt") == df.select(F.max("dt")).scalar())


def scan_newest(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Newest partition with rows of a stored table, found in the listing: the scan has its key as a literal.

    A table without rows gives none; one without files needs its ``schema`` named.
    """
    newest = storage.newest_partition(spark, path)
    table = read_table(spark, path, schema)
    return table.where(F.lit(False)) if newest is None else scan(table, newest)


def scan_before(df: DataFrame, dt: str) -> DataFrame:
    return df.where(F.col("dt") < dt)


def created_between(df: DataFrame, start: str, end: str, column: str = "create_time") -> DataFrame:
    """Rows created in [start, end); the bounds take the column's own type so that the range reaches the scan."""
    kind = df.schema[column].dataType
    return df.where((F.col(column) >= F.lit(start).cast(kind)) & (F.col(column) < F.lit(end).cast(kind)))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Target columns only: unknown ones go, missing ones are NULL, values that do not fit the type are NULL."""
    present = set(df.columns)

    def column(field: T.StructField) -> Column:
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if df.schema[field.name].dataType == field.dataType:
            return F.col(field.name)
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def _write(df: DataFrame, path: str, mode: str) -> None:
    # one shuffle keeps the number of files per partition low; AQE splits a partition that is too big for one file
    spread = df.hint("rebalance", "dt") if "dt" in df.columns else df
    writer = spread.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy("dt") if "dt" in df.columns else writer).parquet(path)


def append(df: DataFrame, path: str) -> None:
    _write(df, path, "append")


def overwrite_partitions(df: DataFrame, path: str) -> None:
    """Replace the ``dt`` partitions present in ``df``; the others stay."""
    _write(df, path, "overwrite")


def rebuild_snapshot(df: DataFrame, path: str) -> None:
    """Replace the whole table, with its schema; the old one stands until the new one is whole."""
    storage.commit(df, path)


def split_log(df: DataFrame, path: str) -> None:
    """Adds rows to one folder per interface and date, so that writers of different interfaces never meet."""
    spread = df.hint("rebalance", "interface_key", "dt")
    spread.write.mode("append").partitionBy("interface_key", "dt").parquet(path)


def migrate_log(shared: DataFrame, registry: DataFrame, dt: str, keep_failures: Sequence[str] = ("1168",)) -> DataFrame:
    """Rows of a shared log under their interface key and a fixed ``dt``; failures only where they are wanted."""
    by_name = F.broadcast(registry.select("interface_key", "interface_name"))
    wanted = (F.col("status_code") == 0) | F.col("interface_key").isin(list(keep_failures))
    return shared.drop("interface_key", "dt").join(by_name, "interface_name").where(wanted).withColumn("dt", F.lit(dt))


def add_missing_column(df: DataFrame, column: str, kind: str) -> DataFrame:
    return df if column in df.columns else df.withColumn(column, F.lit(None).cast(kind))


def replace_keys(existing: DataFrame, new: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """``existing`` without the rows of ``keys``, plus ``new``. Keys without new rows just disappear."""
    return existing.join(keys.select(*on).distinct(), list(on), "left_anti").select(*existing.columns).unionByName(new)


def replace_in_partition(spark: SparkSession, path: str, dt: str, new: DataFrame, keys: DataFrame, on: str) -> None:
    """Replace the rows of ``keys`` inside one partition, which may end up without rows.

    Only that partition's folder is listed, and its content is written once.
    """
    storage.settle(spark, path)
    folder = f"{path}/dt={dt}"
    stored = storage.exists(spark, folder)
    existing = spark.read.parquet(folder if stored else path).drop("dt")
    kept = replace_keys(existing if stored else existing.limit(0), new.select(*existing.columns), keys, [on])
    storage.commit(kept.hint("rebalance"), folder)


def replace_records(existing: DataFrame, new: DataFrame) -> DataFrame:
    """One final record per company, date and interface: earlier records of the same key go.

    Records without a company name are never removed.
    """
    on = ["interface_key", "dt", "input_param"]
    return replace_keys(existing, new, new.where(F.coalesce("input_param", F.lit("")) != ""), on)


def restamp(parsed: DataFrame, keys: DataFrame, dt: str, target_dt: str) -> DataFrame:
    """Rows of some companies from one partition, stamped for another; their creation time is kept."""
    company = company_column(parsed.columns)
    wanted = keys.select(F.col(keys.columns[0]).alias(company)).distinct()
    return scan(parsed, dt).join(wanted, company, "left_semi").withColumn("dt", F.lit(target_dt))


def upsert(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows replace the columns they carry, other columns keep the old value; unknown keys are added.

    Both sides hold one row per key.
    """
    carried = [c for c in new.columns if c != key]
    fresh = new.select(key, F.lit(True).alias("_fresh"), *[F.col(c).alias(f"_new_{c}") for c in carried])
    merged = existing.join(fresh, key, "full_outer")

    def column(name: str) -> Column:
        if name not in carried:
            return F.col(name)
        return F.when(F.col("_fresh"), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)

    return merged.select(*[column(c) for c in existing.columns])


def upsert_into(spark: SparkSession, path: str, new: DataFrame, key: str) -> None:
    """``upsert`` of a stored table without partitions: written once, beside the old rows, and put in their place."""
    storage.settle(spark, path.rstrip("/").rpartition("/")[0])
    storage.commit(upsert(spark.read.parquet(path), new, key), path)
