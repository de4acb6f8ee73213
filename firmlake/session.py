"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # generated methods above 8000 bytes are not JIT compiled; wide parsers split better without whole-stage codegen
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # checkpoints go once nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # dt is a yyyyMMdd string; never let a path read turn it into an INT
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # of a member that an object repeats the last one counts, as in a plain reader
    "spark.sql.variant.allowDuplicateKeys": "true",
}
ZONE = "spark.sql.session.timeZone"
BUSINESS_ZONE = "Asia/Shanghai"  # business dates, their create-time windows and dates of files follow this zone


def build_session(app: str = "firmlake", master: str | None = None, zone: str | None = None, **conf: str) -> SparkSession:
    """Session whose business dates are those of ``zone``, whatever zone its machines are in.

    Without ``zone`` a new session takes ``BUSINESS_ZONE``, one that runs already keeps its own.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if zone or SparkSession.getActiveSession() is None:
        conf = {ZONE: zone or BUSINESS_ZONE, **conf}
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster session must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    current = spark.sparkContext.getCheckpointDir()
    return current or tempfile.mkdtemp(prefix="firmlake-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, removed when the session's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place, files = hadoop_file(spark, path)
    files.mkdirs(place.getParent())
    files.create(place).close()  # only a path that exists can be marked
    files.deleteOnExit(place)
    files.delete(place, False)
    _MADE.append(path)
    return path


_MADE: list[str] = []  # scratch paths of this process, in order


def scratch_paths() -> list[str]:
    """All scratch paths made so far, the last one last."""
    return list(_MADE)


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes scratch data that nothing reads any more."""
    place, files = hadoop_file(spark, path)
    files.delete(place, True)


def hadoop_file(spark: SparkSession, path: str):
    """The path and its file system, for work on names alone."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())


def write_and_read(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored as Parquet in the shared folder and read from there: lineage ends, a lost executor costs nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(*stored: DataFrame) -> None:
    """Removes what ``write_and_read`` has stored for DataFrames that nothing reads any more."""
    for df in stored:
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            drop_path(df.sparkSession, folder)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the queries that begin inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
