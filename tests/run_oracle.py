"""python tests/run_oracle.py SF_DIR [name ...]: compare queries with their SQL twins, with timings."""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from firmlake.session import build_session  # noqa: E402
from tests.harness import compare  # noqa: E402

if __name__ == "__main__":
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    conf = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"}
    if os.environ.get("PLAIN_SESSION"):  # Spark's own defaults, as in a session that was set up elsewhere
        builder = SparkSession.builder.master("local[8]")
        for key, value in conf.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    else:
        spark = build_session(master="local[8]", zone="UTC", **conf)  # the SQL twins know no zones
    spark.sparkContext.setLogLevel("ERROR")
    oracle, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        began = time.time()
        try:
            if name in oracle:
                problem = compare(query(spark, sf_dir), sf_dir, oracle[name])
            else:
                problem = None if query(spark, sf_dir).count() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - began:.1f}s {problem or ''}", flush=True)
    print("failed:", bad)
