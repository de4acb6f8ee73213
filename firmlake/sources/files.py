"""Uploaded files and their manifest, manual tables, and CSV exports."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from firmlake.functions import names
from firmlake.functions import values as v
from firmlake.operators.latest import first_per, nth_newest
from firmlake.schemas import MANIFEST
from firmlake.sources import storage

SUCCESS = "success"
# fixed values: texts of the change column
NEW, REMOVED, UNCHANGED, NOT_A_COUNT = "新增", "移除", "-", "类型异常"


# --- listing ----------------------------------------------------------------------------------------------------------


def classify_files(listing: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """``new``, ``changed`` or ``unchanged`` per file against the md5 of its last successful load; ``forced`` for all."""
    if force:
        return listing.withColumn("state", F.lit("forced"))
    loaded = manifest.where(F.col("status") == SUCCESS).groupBy("filename")
    # loads of the very same time: the larger md5 counts
    last = loaded.agg(F.max_by("md5", F.struct("processed_at", "md5")).alias("loaded_md5"), F.lit(True).alias("known"))
    state = (
        F.when(F.col("known").isNull(), "new")
        .when(F.col("loaded_md5") != F.col("md5"), "changed")
        .otherwise("unchanged")
    )
    joined = listing.join(last, "filename", "left")
    return joined.withColumn("state", state).drop("loaded_md5", "known")


def file_date(name: Column, modified_ms: Column) -> Column:
    """First eight digits in the name, else the day of the last change."""
    in_name = v.blank_to_null(F.regexp_extract(name, r"(\d{8})", 1))
    return F.coalesce(in_name, F.date_format(F.timestamp_millis(modified_ms), "yyyyMMdd"))


def newest_file(listing: DataFrame) -> DataFrame:
    """The file with the newest date, then the newest change; ``filename`` breaks ties."""
    dated = listing.withColumn("file_date", file_date(F.col("filename"), F.col("modified_ms")))
    return dated.orderBy(F.col("file_date").desc(), F.col("modified_ms").desc(), F.col("filename").desc()).limit(1)


def keep_newest(listing: DataFrame, n: int = 3) -> DataFrame:
    """Marks all but the ``n`` last changed files for removal. The kept ones are found as a top-n, not by a global sort."""
    last = listing.orderBy(F.col("modified_ms").desc(), F.col("filename").desc()).limit(n)
    kept = last.select("filename", F.lit(True).alias("keep"))
    return listing.join(kept, "filename", "left").withColumn("keep", F.coalesce("keep", F.lit(False)))


def expired(keys: DataFrame, date: Column, days: int, column: str = "dt") -> DataFrame:
    """Date keys of eight digits older than ``days`` days."""
    limit = F.date_format(F.date_sub(date, days), "yyyyMMdd")
    return keys.where(F.col(column).rlike(r"^\d{8}$") & (F.col(column) < limit))


# --- loads ------------------------------------------------------------------------------------------------------------


# what a lost executor or a full disk says; the source is not to blame for these
RUN_ERRORS = ("ExecutorLostFailure", "OutOfMemory", "FetchFailed", "No space left", "cancelled", "shut down")


def _is_readable(df: DataFrame) -> bool:
    """Whether the rows of ``df`` can be read to their end; trouble of the cluster is raised."""
    try:
        df.write.format("noop").mode("overwrite").save()
    except PySparkException as error:
        if any(text in str(error) for text in RUN_ERRORS):
            raise
        return False
    return True


def load_table(df: DataFrame, name: str, path: str, prefix: str = "manual_") -> int | None:
    """Write one uploaded table under its cleaned name, with clean columns.

    Returns its row count, or None for a table that cannot be read; that one is left out. The upload is read once: rows and values
    are counted while it is written to a folder beside the table, which takes the table's place when it is whole. Should some text
    column hold no value at all, the written copy is read again to fill it. Only after a failure the upload is read again, to tell an
    unreadable source from a write that failed; that one is raised and leaves the old table as it was.
    """
    spark = df.sparkSession
    cleaned = names.stringify(names.clean_columns(df), [])
    target = f"{path}/{prefix}{names.table_name(name)}"
    storage.settle(spark, path)
    staged = [storage.staging_path(spark, target)]
    seen = Observation()
    counts = [F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(cleaned.columns)]
    try:
        try:
            cleaned.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.parquet(staged[0])
        except PySparkException:
            if _is_readable(cleaned):
                raise
            return None
        rows = seen.get["rows"]
        no_value = [c for i, c in enumerate(cleaned.columns) if not seen.get[f"n{i}"]]
        kinds = dict(cleaned.dtypes)
        if any(kinds[c] == "string" for c in no_value):
            staged.append(storage.staging_path(spark, target))
            names.stringify(spark.read.schema(cleaned.schema).parquet(staged[0]), no_value).write.parquet(staged[1])
        storage.swap(spark, staged[-1], target)
    finally:
        for folder in staged:
            storage.discard(spark, folder)
    return rows


def load_file(spark: SparkSession, tables: Mapping[str, DataFrame], path: str, filename: str, md5: str,
              processed_at: dt.datetime) -> DataFrame:
    """Load all tables of a file and return its manifest row.

    The row lists every table and the counts of those that could be read; where some could not, the status names them. When a
    table cannot be written, or two tables have the same cleaned name, the file has failed and the error is recorded whole.
    """
    try:
        targets = [names.table_name(name) for name in tables]
        if clash := sorted(name for name in tables if targets.count(names.table_name(name)) > 1):
            raise ValueError(f"tables of one name: {', '.join(clash)}")
        loaded = {name: load_table(df, name, path) for name, df in tables.items()}
        counts = {name: rows for name, rows in loaded.items() if rows is not None}
        unread = [name for name, rows in loaded.items() if rows is None]
        status = f"partial: {', '.join(unread)}" if unread else SUCCESS
        row = (filename, md5, processed_at, ",".join(tables), json.dumps(counts, ensure_ascii=False), status)
    except Exception as error:  # whatever went wrong belongs into the manifest
        row = (filename, md5, processed_at, "", "", f"failed: {error}")
    return spark.createDataFrame([row], MANIFEST)


# --- load report ------------------------------------------------------------------------------------------------------


def last_of_day(manifest: DataFrame) -> DataFrame:
    """Last manifest row of each file and day."""
    dated = manifest.withColumn("load_date", F.to_date("processed_at"))
    return first_per(dated, ["load_date", "filename"], [F.col("processed_at").desc(), F.col("md5").desc()])


def counted_loads(manifest: DataFrame) -> DataFrame:
    done = (F.col("status") == SUCCESS) | F.col("status").startswith("partial: ")
    return manifest.where(done & F.col("table_counts").isNotNull() & (F.col("table_counts") != ""))


def previous_load(manifest: DataFrame, tie: str = "md5") -> DataFrame:
    """The second newest successful load with counts, whatever its file name."""
    return nth_newest(counted_loads(manifest), 2, [F.col("processed_at").desc(), F.col(tie).desc()])


def count_changes(current: DataFrame, previous: DataFrame, on: list[str]) -> DataFrame:
    """Row counts of two loads side by side (``on, table_name, row_count``), with the change as text.

    A count that is no number is kept as NULL on its side and reported as such.
    """
    now = current.select(*on, "table_name", F.col("row_count").alias("current_rows"), F.lit(True).alias("_now"))
    then = previous.select(*on, "table_name", F.col("row_count").alias("previous_rows"), F.lit(True).alias("_then"))
    joined = now.join(then, [*on, "table_name"], "full_outer")
    delta = F.col("current_rows") - F.col("previous_rows")
    change = (
        F.when(F.col("_then").isNull(), NEW)
        .when(F.col("_now").isNull(), REMOVED)
        .when(delta.isNull(), NOT_A_COUNT)
        .when(delta == 0, UNCHANGED)
        .otherwise(F.concat(F.when(delta > 0, "+").otherwise(""), F.format_number(delta, 0)))
    )
    return joined.select(*on, "table_name", "previous_rows", "current_rows", change.alias("change"))


def exploded_counts(manifest: DataFrame, keep: list[str]) -> DataFrame:
    """One row per table of a load, from its JSON counts."""
    return manifest.select(*keep, F.explode(v.counts_from_json(F.col("table_counts"))).alias("table_name", "row_count"))


def listed_tables(manifest: DataFrame, keep: list[str]) -> DataFrame:
    """One row per table name a load lists, with the cleaned name of its table."""
    listed = manifest.select(*keep, F.explode(v.csv_items(F.col("table_names"))).alias("table_name"))
    return listed.withColumn("target_name", F.concat(F.lit("manual_"), names.clean_table_name(F.col("table_name"))))


def load_report(manifest: DataFrame) -> DataFrame:
    """Per day with loads: files, failed files, tables and rows of the last load of each file, and whether to alert."""
    last = last_of_day(manifest)
    failed = F.col("status") != SUCCESS
    files = last.groupBy("load_date").agg(F.count("*").alias("files"), F.count_if(failed).alias("failed_files"))
    counts = exploded_counts(counted_loads(last), ["load_date"])
    rows = counts.groupBy("load_date").agg(F.count("*").alias("tables"), F.sum("row_count").alias("row_count"))
    report = files.join(rows, "load_date", "left").fillna(0, ["tables", "row_count"])
    return report.withColumn("need_alert", F.col("failed_files") > 0)


def load_details(manifest: DataFrame, stored: DataFrame, date: dt.date) -> DataFrame:
    """Every table of one day's loads beside the load before, and a grand total, as one result.

    Of each file the day's last manifest row counts. ``stored`` (``target_name, row_count``) holds the rows that its tables have
    now; the load before is the second newest counted one up to that day, whatever its file is called. Rows: a table listed by a
    file, a table that only the load before had (no file, ``移除``), a file without tables (failed ones), and the total
    (``is_total``) with the rows of all listed tables. A table that is not stored has no current rows (``类型异常``). A day without
    loads gives no row.
    """
    next_day = date + dt.timedelta(days=1)
    until = manifest.where(F.col("processed_at") < F.lit(next_day))
    last = last_of_day(until.where(F.col("processed_at") >= F.lit(date)))
    names_ = F.when((F.col("status") == SUCCESS) | F.col("status").startswith("partial: "), v.csv_items(F.col("table_names")))
    listed = last.select("filename", "status", F.explode_outer(names_).alias("table_name"))
    target = F.concat(F.lit("manual_"), names.clean_table_name(F.col("table_name")))
    listed = listed.withColumn("target_name", F.when(F.col("table_name").isNotNull(), target))
    now = listed.join(stored.withColumnRenamed("row_count", "current_rows"), "target_name", "left")
    previous = exploded_counts(previous_load(until), []).withColumnsRenamed({"table_name": "previous_name", "row_count": "previous_rows"})
    joined = now.join(previous, now["table_name"] == previous["previous_name"], "full_outer")
    delta = F.col("current_rows") - F.col("previous_rows")
    change = (
        F.when(F.col("target_name").isNull() & F.col("previous_name").isNull(), None)
        .when(F.col("target_name").isNull(), REMOVED)
        .when(F.col("previous_name").isNull(), NEW)
        .when(delta.isNull(), NOT_A_COUNT)
        .when(delta == 0, UNCHANGED)
        .otherwise(F.concat(F.when(delta > 0, "+").otherwise(""), F.format_number(delta, 0)))
    )
    columns = ["filename", "status", "table_name", "target_name", "previous_rows", "change"]
    rows = joined.withColumn("change", change).withColumn("table_name", F.coalesce("table_name", "previous_name"))
    report = rows.groupingSets([[F.col(c) for c in columns], []], *columns).agg(
        F.sum("current_rows").alias("current_rows"), (F.grouping("change") == 1).alias("is_total")
    )
    any_load = last.select(F.count("*")).scalar() > 0
    return report.where(any_load).select(*columns, "current_rows", "is_total")


# --- exports ----------------------------------------------------------------------------------------------------------


def export_csv(df: DataFrame, path: str, dt_key: str | None = None) -> bool:
    """Write all rows, or those of one ``dt``, as CSV with a header; nothing is written for no rows."""
    chosen = df if dt_key is None else df.where(F.col("dt") == dt_key)
    if chosen.isEmpty():
        return False
    names.timestamps_to_text(chosen).write.mode("overwrite").option("header", True).csv(path)
    return True
