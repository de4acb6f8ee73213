"""Listing, footers, staged commits and what is left by writers that were killed."""

import datetime as dt
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmlake.operators import ids, quality
from firmlake.session import hadoop_file, scratch_path
from firmlake.sources import files, storage, tables

SCHEMA = "id BIGINT, name STRING, dt STRING"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def log(spark):
    path = scratch_path(spark, "t")
    tables.overwrite_partitions(spark.createDataFrame([(1, "a", "20240101"), (2, "b", "20240101"), (7, "a", "20240102")], SCHEMA), path)
    return path


def rename(spark, old, new):
    place, fs = hadoop_file(spark, old)
    assert fs.rename(place, hadoop_file(spark, new)[0])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_partition_comes_from_the_listing(spark, log):
    assert storage.partition_values(spark, log) == ["20240101", "20240102"]
    newest = tables.scan_newest(spark, log, SCHEMA)
    assert rows_of(newest) == [(7, "a", "20240102")]
    plan = plan_of(newest)
    assert re.search(r"PartitionFilters: \[[^]]*dt#\d+ = 20240102", plan) and "Subquery" not in plan
    # a partition whose rows have all gone is not the newest one
    gone = spark.createDataFrame([("a",)], "name STRING")
    tables.replace_in_partition(spark, log, "20240102", spark.createDataFrame([], "id BIGINT, name STRING"), gone, "name")
    assert {r.dt for r in tables.scan_newest(spark, log, SCHEMA).collect()} == {"20240101"}


def test_newest_partition_of_an_empty_table(spark):
    path = scratch_path(spark, "none")
    assert storage.newest_partition(spark, path) is None
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    assert storage.newest_partition(spark, path) is None and tables.scan_newest(spark, path, SCHEMA).count() == 0


def test_highest_id_reads_footers_only(spark, log):
    plan = storage.footer_plan(spark, log, F.max("id"))
    assert "PushedAggregation: [MAX(id)]" in plan
    assert storage.highest_id(spark, log) == 7
    tables.append(spark.createDataFrame([], SCHEMA), log)  # an empty run
    assert storage.highest_id(spark, log) == 7
    assert storage.highest_id(spark, scratch_path(spark, "none")) == -1
    new = spark.createDataFrame([("b",), ("a",)], "name STRING")
    assert {r.name: r.id for r in ids.continue_ids(new, storage.highest_id(spark, log), [F.col("name")]).collect()} == {"a": 8, "b": 9}
    assert spark.conf.get(storage.V1_SOURCES).count("parquet") == 1  # the session is as before


def test_failed_writer_leaves_the_old_rows(spark, log):
    broken = spark.range(1).select("id", F.raise_error(F.lit("stop")).cast("string").alias("name"))
    keys = spark.createDataFrame([("a",)], "name STRING")
    with pytest.raises(PySparkException):
        tables.replace_in_partition(spark, log, "20240101", broken, keys, "name")
    assert len(rows_of(tables.read_table(spark, log))) == 3
    flat = scratch_path(spark, "flat")
    tables.rebuild_snapshot(spark.range(3), flat)
    with pytest.raises(PySparkException):
        tables.rebuild_snapshot(broken, flat)
    assert spark.read.parquet(flat).count() == 3
    assert not [n for n, _ in storage._children(spark, log) if n.startswith(".staged")]


def test_killed_between_the_two_renames(spark, log):
    # killed after the old rows went aside: they come back
    rename(spark, f"{log}/dt=20240101", f"{log}/{storage.OLD}dt=20240101")
    assert len(rows_of(tables.read_table(spark, log))) == 3
    # killed after the new rows took their place: the old ones go
    rename(spark, f"{log}/dt=20240101", f"{log}/{storage.OLD}dt=20240101")
    spark.range(1).select("id", F.lit("n").alias("name")).write.parquet(f"{log}/dt=20240101")
    assert rows_of(tables.read_table(spark, log).select("id")) == [(0,), (7,)]
    assert not storage.exists(spark, f"{log}/{storage.OLD}dt=20240101")


def test_unfinished_writes_are_passed_over(spark, log):
    spark.range(5).withColumn("name", F.lit("x")).write.parquet(storage.staging_path(spark, f"{log}/dt=20240101"))
    assert len(rows_of(tables.read_table(spark, log))) == 3


def test_replacing_in_a_partition_that_is_not_there_yet(spark, log):
    new = spark.createDataFrame([(9, "z")], "id BIGINT, name STRING")
    tables.replace_in_partition(spark, log, "20240105", new, new.select("name"), "name")
    assert rows_of(tables.scan_newest(spark, log, SCHEMA)) == [(9, "z", "20240105")]


def test_upsert_into_a_stored_table(spark):
    path = scratch_path(spark, "u")
    tables.rebuild_snapshot(spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, x INT"), path)
    for _ in range(2):
        tables.upsert_into(spark, path, spark.createDataFrame([("b", 5), ("c", 6)], "k STRING, x INT"), "k")
    assert rows_of(spark.read.parquet(path)) == [("a", 1), ("b", 5), ("c", 6)]


def test_an_upload_is_read_once(spark):
    path, count = scratch_path(spark, "m"), spark.sparkContext.accumulator(0)

    def seen(x):
        count.add(1)
        return x

    source = spark.range(10, numPartitions=1).select(F.udf(seen, "long")("id").alias("id"), F.lit(None).cast("string").alias("note"))
    assert files.load_table(source, "Up", path) == 10
    assert count.value == 10
    assert {r.note for r in spark.read.parquet(f"{path}/manual_up").collect()} == {""}


def test_only_the_source_is_to_blame_for_an_unread_table(spark, monkeypatch):
    path = scratch_path(spark, "m")
    good = {"T": spark.range(3)}
    files.load_file(spark, good, path, "f", "m", dt.datetime(2024, 1, 1))
    monkeypatch.setattr(storage, "staging_path", lambda spark, target: "unknown-store://x/y")
    row = files.load_file(spark, {"T": spark.range(9)}, path, "f", "m", dt.datetime(2024, 1, 2)).first()
    assert row.status.startswith("failed: ") and spark.read.parquet(f"{path}/manual_t").count() == 3


def test_schema_report_knows_partitions_by_their_folders(spark, log):
    declared = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("dt", T.StringType())])
    flat = scratch_path(spark, "flat")
    tables.rebuild_snapshot(spark.createDataFrame([(1, None, "20240101")], SCHEMA), flat)
    get = lambda path, **k: {r.column_name: (r.state, r.is_partition, r.filled, r.table_state) for r in quality.stored_schema_report(spark, path, declared, **k).collect()}
    assert get(log) == {"id": ("ok", False, 3, "ok"), "name": ("ok", False, 3, "ok"), "dt": ("ok", True, 3, "ok")}
    assert get(flat)["dt"] == ("ok", False, 1, "not by dt") and get(flat, partition=None)["name"] == ("ok", False, 0, "ok")
    assert get(flat, counts=False)["id"] == ("ok", False, None, "not by dt")
    assert set(get(scratch_path(spark, "none")).values()) == {("missing", False, None, "missing")}
    text = scratch_path(spark, "csv")
    spark.range(2).write.csv(text)
    assert get(text)["id"] == ("missing", False, None, "not parquet")
    frame = spark.read.parquet(flat)
    assert not any(r.is_partition for r in quality.schema_report(frame, declared).collect())


def test_load_details_of_a_day_without_loads(spark):
    manifest = spark.createDataFrame([("f", "m", dt.datetime(2024, 1, 1), "A", '{"A": 3}', "success")], files.MANIFEST)
    stored = spark.createDataFrame([("manual_a", 3)], "target_name STRING, row_count BIGINT")
    assert files.load_details(manifest, stored, dt.date(2024, 1, 2)).count() == 0
    (total, row) = sorted(files.load_details(manifest, stored, dt.date(2024, 1, 1)).collect(), key=lambda r: not r.is_total)
    assert (total.current_rows, row.table_name, row.current_rows, row.change) == (3, "A", 3, "新增")
    none = files.load_details(manifest, stored.limit(0), dt.date(2024, 1, 1)).where("not is_total").first()
    assert none.current_rows is None
