"""Plans and results that must hold when one key owns a third of all rows."""

import re

import pytest
from pyspark.sql import functions as F

from firmlake.operators.latest import first_per, latest_success, sieve
from firmlake.plans import parsing, reports
from firmlake.registry import interface_registry
from firmlake.session import scratch_path
from firmlake.sources import tables
from firmlake.workload import QUERIES, interfaces
from firmlake.workload import records as tables_queries

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


PYTHON = r"EvalPython|MapInPandas|MapInArrow|FlatMap\w*In(Pandas|Arrow)|PythonUDF|AttachDistributedSequence"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loops_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert not re.search(rf"CartesianProduct|BroadcastNestedLoopJoin|{PYTHON}", plan)


@pytest.mark.parametrize("key", sorted(parsing.PARSERS))
def test_payload_is_read_once(spark, key):
    log = interfaces.stored_log(spark, SF_DIR, key, interfaces.PAYLOADS[key], 1)
    assert len(re.findall(r"columnNameOfCorruptRecord,unread\), output_result#", plan_of(parsing.parse(log, key)))) == 1


@pytest.mark.parametrize("key", sorted(parsing.PARSERS))
def test_stats_read_a_payload_once_and_count_the_rows_of_the_parser(spark, key):
    own = interfaces.stored_log(spark, SF_DIR, key, interfaces.PAYLOADS[key], 1)
    odd = interfaces.stored_log(spark, SF_DIR, key, interfaces.ODD, 1)
    lists = "[null, {}, {\"list\": null}, {\"list\": [{\"list\": null}, {\"list\": []}, {\"list\": [{}, {}]}]}]"
    texts = [f'{{"result":{{"riskList":{lists}}}}}', f'{{"result":{{"riskList":{lists[:1] + lists[7:]}}}}}', None, "", "[]", '{"result":[{},{}]}']
    hand = spark.createDataFrame([(k, "a", "20240101", t) for k, t in enumerate(texts)], "id BIGINT, input_param STRING, dt STRING, output_result STRING")
    log = own.unionByName(odd).select("id", "input_param", "dt", "output_result").unionByName(hand)
    stats = parsing.parse_stats(log, key)
    assert len(re.findall(r"columnNameOfCorruptRecord,unread\), ", plan_of(parsing.parse_stats(own, key)))) == 1
    found = {r["parse_status"]: (r["records"], r["rows"]) for r in stats.collect()}
    assert {s: n for s, (n, _) in found.items()} == dict(parsing.parse_status(log, key).groupBy("parse_status").count().collect())
    assert {s: n for s, (_, n) in found.items() if n} == {"SUCCESS": parsing.parse(log, key).count()}


@pytest.mark.parametrize("name", ["parse_854", "parse_973", "parse_stats", "merged_records"])
def test_orders_are_dealt_to_all_tasks_before_their_payloads(spark, name):
    assert "REPARTITION_BY_COL" in plan_of(QUERIES[name](spark, SF_DIR))


@pytest.fixture(scope="module")
def skewed(spark):
    """Every third record belongs to one company, a third of those share the newest time."""
    hot = F.col("id") % 3 == 0
    return spark.range(30000).select(
        "id",
        F.lit("819").alias("interface_key"),
        F.lit("20240101").alias("dt"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 5000)).alias("input_param"),
        F.when(F.col("id") % 10 == 7, -1).otherwise(0).alias("status_code"),
        F.timestamp_seconds(F.when(hot & (F.col("id") % 9 == 0), 10**9).otherwise(F.col("id"))).alias("create_time"),
        F.lit('{"result":{"total":1}}').alias("output_result"),
    )


def test_newest_success_of_a_hot_key(spark, skewed):
    newest = latest_success(skewed)
    expected = len([i for i in range(0, 30000, 9) if i % 10 != 7])
    assert newest.where("input_param = 'hot'").count() == expected
    # companies besides the hot one whose records are not all failures
    others = {(i % 5000) for i in range(30000) if i % 3 and i % 10 != 7}
    assert newest.where("input_param <> 'hot'").count() == len(others)
    # the payload of a key is spread by its time
    assert re.search(r"hashpartitioning\([^)]*input_param#\d+, create_time#\d+", plan_of(newest)) or "BroadcastHashJoin" in plan_of(newest)


@pytest.mark.parametrize("bits", [4, 20, 27])
def test_sieve_leaves_old_payloads_behind(spark, skewed, bits):
    wanted = skewed.where("input_param = 'c17'").select("input_param", "create_time")
    kept = sieve(skewed, wanted, ["input_param", "create_time"], bits)
    assert kept.where("input_param = 'c17'").count() == wanted.count() > 0
    if bits == 27:
        assert kept.count() == wanted.count()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        newest = latest_success(skewed, sieve_bits=bits)
        assert {tuple(r) for r in newest.select("id").collect()} == {tuple(r) for r in latest_success(skewed).select("id").collect()}
        plan = plan_of(latest_success(skewed, sieve_bits=bits))
        above = plan[: plan.index("BroadcastHashJoin")]  # the sieve
        assert "SortMergeJoin" in above and re.search(r"hashpartitioning\([^)]*create_time", above)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_first_rows_of_a_hot_key_are_cut_before_the_shuffle(skewed):
    top = first_per(skewed, ["input_param"], [F.col("id")], 3)
    assert plan_of(top).count("WindowGroupLimit") == 2
    assert [r.id for r in top.where("input_param = 'hot'").orderBy("id").collect()] == [0, 3, 6]


def test_report_counts_a_hot_company_before_the_join(spark, skewed):
    log = skewed.withColumn("create_time", F.lit("2024-01-02 01:00:00").cast("timestamp"))
    customers = spark.createDataFrame([("hot", "是"), ("hot", "否")], "name STRING, is_prepaid STRING")
    report = reports.call_report(log, customers, interface_registry(spark)).where("interface_key = '819'").first()
    assert (report.total, report.prepaid_calls, report.non_prepaid_calls) == (30000, 10000, 10000)
    assert report.abnormal_failure == 3000


def test_customer_list_meets_the_called_companies_without_a_broadcast(spark):
    """Each listing is taken on 40 dates; its size as the optimizer guesses it would allow a broadcast."""
    flags = ["是", "是", "否", "x", "x", "y", None]
    dates = F.explode(F.array(*[F.lit(f"202401{d:02d}") for d in range(40)])).alias("dt")
    path = scratch_path(spark, "customers")
    spark.createDataFrame([("a", f) for f in flags] + [("b", "否"), (None, "是")], "name STRING, is_prepaid STRING").write.parquet(path)
    customers = spark.read.parquet(path).select("name", "is_prepaid", dates)
    rows = [("2024-01-02", "a", 1), ("2024-01-02", "b", 2), ("2024-01-02", "c", 3), ("2024-01-02", None, 4), ("2025-01-02", "a", 5)]
    called = spark.createDataFrame(rows, "day STRING, input_param STRING, total INT").selectExpr("date(day) AS report_date", "input_param", "total")
    split = reports.with_classes(called, customers, "input_param")
    plan = plan_of(split)
    assert "ShuffledHashJoin" in plan and "Broadcast" not in plan
    found = {r["total"]: (r["post_paid_listings"], r["prepaid_listings"], r["other_listings"]) for r in split.collect()}
    none = (None, None, None)
    assert found == {1: (1, 1, 3), 2: (1, 0, 0), 3: none, 4: none, 5: none}


def test_scans_are_pruned(spark):
    log = tables_queries.records(spark, SF_DIR).select(*tables_queries.LOG)
    path = scratch_path(spark, "log")
    tables.overwrite_partitions(log, path)
    table = tables.read_table(spark, path, log.schema)
    window = plan_of(tables.created_between(tables.scan(table, "20240116"), "2024-01-17", "2024-01-18").select("id"))
    assert re.search(r"PartitionFilters: \[[^]]*dt#\d+ = 20240116", window)
    assert "GreaterThanOrEqual(create_time" in window and "LessThan(create_time" in window
    assert "ReadSchema: struct<id:bigint,create_time" in window
    assert re.search(r"PartitionFilters: \[[^]]*dt#\d+ = Subquery", plan_of(tables.scan_latest(table)))
