"""Writes: run twice, other partitions untouched, nothing lost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from firmlake.operators import ids
from firmlake.session import build_session, cut_lineage, scratch_path, shared_dir
from firmlake.sources import files, tables

SCHEMA = "api_record_id BIGINT, company_name STRING, dt STRING"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def log(spark):
    path = scratch_path(spark, "t")
    old = [(1, "a", "20240101"), (2, "b", "20240101"), (3, None, "20240101"), (4, "a", "20240102")]
    tables.overwrite_partitions(spark.createDataFrame(old, SCHEMA), path)
    return path


def read(spark, path):
    return rows_of(tables.read_table(spark, path).select("api_record_id", F.coalesce("company_name", F.lit("?")), "dt"))


def test_dynamic_overwrite_is_repeatable(spark, log):
    new = spark.createDataFrame([(9, "z", "20240102")], SCHEMA)
    for _ in range(2):
        tables.overwrite_partitions(new, log)
    assert read(spark, log) == [(1, "a", "20240101"), (2, "b", "20240101"), (3, "?", "20240101"), (9, "z", "20240102")]


def test_replace_key_keeps_rows_without_key(spark, log):
    new = spark.createDataFrame([(10, "a"), (11, "a")], "api_record_id BIGINT, company_name STRING")
    keys = spark.createDataFrame([("a",)], "company_name STRING")
    for _ in range(2):
        tables.replace_in_partition(spark, log, "20240101", new, keys, "company_name")
    assert read(spark, log) == [
        (2, "b", "20240101"), (3, "?", "20240101"), (4, "a", "20240102"), (10, "a", "20240101"), (11, "a", "20240101"),
    ]


def test_replace_key_without_new_rows_clears_it(spark, log):
    none = spark.createDataFrame([], "api_record_id BIGINT, company_name STRING")
    keys = spark.createDataFrame([("a",)], "company_name STRING")
    tables.replace_in_partition(spark, log, "20240102", none, keys, "company_name")
    assert read(spark, log) == [(1, "a", "20240101"), (2, "b", "20240101"), (3, "?", "20240101")]


def test_restamp_appends(spark, log):
    table = tables.read_table(spark, log)
    keys = spark.createDataFrame([("a",), ("a",)], "name STRING")
    tables.append(tables.restamp(table, keys, "20240102", "20240101"), log)
    assert (4, "a", "20240101") in read(spark, log) and len(read(spark, log)) == 5


def test_replace_records_leaves_nameless_ones(spark):
    schema = "id INT, interface_key STRING, dt STRING, input_param STRING"
    old = spark.createDataFrame([(1, "819", "d", "a"), (2, "819", "d", ""), (3, "851", "d", "a"), (4, "819", "e", "a")], schema)
    new = spark.createDataFrame([(5, "819", "d", "a"), (6, "819", "d", "")], schema)
    assert [r[0] for r in rows_of(tables.replace_records(old, new))] == [2, 3, 4, 5, 6]


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1, 2), ("b", 3, 4)], "k STRING, x INT, y INT")
    new = spark.createDataFrame([("a", None), ("c", 9)], "k STRING, x INT")
    assert {r[0]: tuple(r[1:]) for r in tables.upsert(old, new, "k").collect()} == {"a": (None, 2), "b": (3, 4), "c": (9, None)}


def test_partition_key_stays_text(spark, log):
    assert dict(tables.read_table(spark, log).dtypes)["dt"] == "string"
    assert tables.scan_latest(tables.read_table(spark, log)).first()["api_record_id"] == 4
    assert rows_of(tables.scan_before(tables.read_table(spark, log), "20240102").select("api_record_id")) == [(1,), (2,), (3,)]


def test_created_between_is_half_open(spark):
    times = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 1, 23, 59, 59),), (dt.datetime(2024, 1, 2),)], "create_time TIMESTAMP")
    assert tables.created_between(times, "2024-01-01", "2024-01-02").count() == 2


@pytest.mark.parametrize("rows", [0, 1, 997])
def test_dense_ids(spark, rows):
    df = spark.range(rows).select(F.concat(F.lit("k"), F.xxhash64("id").cast("string")).alias("name")).repartition(5)
    numbered = ids.dense_ids(df, [F.col("name")]).orderBy("name").collect()
    assert [r.id for r in numbered] == list(range(1, rows + 1))


def test_continue_ids_of_an_empty_table_start_at_zero(spark):
    none = spark.createDataFrame([], "id BIGINT")
    new = spark.createDataFrame([("b",), ("a",)], "name STRING")
    assert {r.name: r.id for r in ids.continue_ids(new, none, [F.col("name")]).collect()} == {"a": 0, "b": 1}


def test_shared_folder_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert cut_lineage(spark.range(3)).count() == 3
    assert build_session().conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"


def test_load_file_records_counts_and_failures(spark):
    path, when = scratch_path(spark, "m"), dt.datetime(2024, 1, 1)
    good = {"T 1": spark.createDataFrame([(1, None), (2, None)], "a INT, `b c` DATE")}
    row = files.load_file(spark, good, path, "f", "m", when).first()
    assert (row.status, row.table_names, row.table_counts) == ("success", "T 1", '{"T 1": 2}')
    assert rows_of(spark.read.parquet(f"{path}/manual_t_1")) == [(1, ""), (2, "")]
    # a reload with other columns replaces the table
    files.load_file(spark, {"T 1": spark.createDataFrame([("x",)], "z STRING")}, path, "f", "m", when)
    assert spark.read.parquet(f"{path}/manual_t_1").columns == ["z"]
    # a table that cannot be read is left out, one that cannot be written fails the file
    unread = spark.range(1).select(F.raise_error(F.lit("x")).cast("string").alias("e"))
    row = files.load_file(spark, {"T": unread, **good}, path, "f", "m", when).first()
    assert (row.status, row.table_names, row.table_counts) == ("partial: T", "T,T 1", '{"T 1": 2}')
    clash = {"A b": spark.range(3), "A_b": spark.range(5)}
    assert files.load_file(spark, clash, path, "f", "m", when).first().status == "failed: tables of one name: A b, A_b"
    row = files.load_file(spark, good, f"{path}/manual_t_1/_SUCCESS", "f", "m", when).first()
    assert row.status.startswith("failed: ") and row.table_names == ""


def test_export_skips_empty(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.datetime(9999, 12, 31), "d")], "a INT, t TIMESTAMP, dt STRING")
    assert files.export_csv(df, str(tmp_path / "out"), "d")
    assert spark.read.csv(str(tmp_path / "out"), header=True).first()["t"] == "9999-12-31 00:00:00"
    assert not files.export_csv(df, str(tmp_path / "none"), "e") and not (tmp_path / "none").exists()


def test_classify_and_newest_file(spark):
    manifest = spark.createDataFrame(
        [("a", "1", 1, "success"), ("a", "2", 2, "success"), ("a", "3", 3, "failed: x"), ("b", "9", 1, "failed: y")],
        "filename STRING, md5 STRING, processed_at INT, status STRING",
    )
    listing = spark.createDataFrame([("a", "2", 5), ("b", "9", 6), ("x_20240105_1", "1", 1), ("y20240105", "1", 2)], "filename STRING, md5 STRING, modified_ms BIGINT")
    states = {r.filename: r.state for r in files.classify_files(listing, manifest).collect()}
    assert states["a"] == "unchanged" and states["b"] == "new"
    assert files.classify_files(listing.withColumn("md5", F.lit("3")), manifest).where("filename = 'a'").first().state == "changed"
    assert files.newest_file(listing).first().filename == "y20240105"


def test_count_changes(spark):
    schema = "table_name STRING, row_count BIGINT"
    now = spark.createDataFrame([("a", 1500), ("b", 2), ("c", 5), ("n", 1), ("t", None)], schema)
    then = spark.createDataFrame([("a", 200), ("b", 9), ("c", 5), ("g", 1), ("t", 4)], schema)
    changes = {r.table_name: r.change for r in files.count_changes(now, then, []).collect()}
    assert changes == {"a": "+1,300", "b": "-7", "c": "-", "n": "新增", "g": "移除", "t": "类型异常"}
