"""What folders and file footers tell about a Parquet table, and commits that leave the old rows readable until the new ones are whole.

A commit writes beside the table, into a folder that readers pass over, and then swaps two names. A writer that is killed before the
swap leaves the table as it was. Between the two renames the old folder bears the name ``.old-…``; the next reader or writer that comes
through here puts it back (``settle``). On stores without an atomic rename the swap takes as long as the copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from firmlake.session import hadoop_file

STAGED, OLD = ".staged-", ".old-"
V1_SOURCES, PUSHED = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"


def _children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Names directly below ``path`` and whether each is a folder; none for a path that does not exist."""
    place, files = hadoop_file(spark, path)
    if not files.exists(place):
        return []
    return [(s.getPath().getName(), s.isDirectory()) for s in files.listStatus(place)]


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def exists(spark: SparkSession, path: str) -> bool:
    place, files = hadoop_file(spark, path)
    return files.exists(place)


def partition_values(spark: SparkSession, path: str, column: str = "dt") -> list[str]:
    """Values of the first partition level by its folder names, ascending."""
    prefix = f"{column}="
    return sorted(name.removeprefix(prefix) for name, folder in _children(spark, path) if folder and name.startswith(prefix))


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns by the folders' names, outermost first."""
    for name, folder in _children(spark, path):
        if folder and "=" in name and not _hidden(name):
            return [name.partition("=")[0], *partition_columns(spark, f"{path}/{name}")]
    return []


def file_format(spark: SparkSession, path: str) -> str | None:
    """Suffix of a data file of the table, None without any."""
    for name, folder in _children(spark, path):
        if not _hidden(name):
            found = file_format(spark, f"{path}/{name}") if folder else name.rpartition(".")[2]
            if found:
                return found
    return None


def newest_partition(spark: SparkSession, path: str, column: str = "dt") -> str | None:
    """The highest partition value that has rows, None for a table without any.

    Values come from the listing; of the highest folders only the footers are read, until one names rows.
    """
    for value in reversed(partition_values(spark, path, column)):
        if footers(spark, f"{path}/{column}={value}", F.count("*").alias("n"))["n"]:
            return value
    return None


@contextmanager
def _footer_reads(spark: SparkSession):
    before = spark.conf.get(V1_SOURCES), spark.conf.get(PUSHED)
    spark.conf.set(V1_SOURCES, ",".join(s for s in before[0].split(",") if s.strip() != "parquet"))
    spark.conf.set(PUSHED, "true")
    try:
        yield
    finally:
        spark.conf.set(V1_SOURCES, before[0])
        spark.conf.set(PUSHED, before[1])


def footers(spark: SparkSession, path: str, *aggregates: Column) -> Row:
    """One row of counts, minima or maxima of plain columns, taken from the footers of the table's files."""
    with _footer_reads(spark):
        return spark.read.parquet(path).agg(*aggregates).first()


def footer_plan(spark: SparkSession, path: str, *aggregates: Column) -> str:
    """The plan that ``footers`` runs."""
    with _footer_reads(spark):
        return spark.read.parquet(path).agg(*aggregates)._jdf.queryExecution().executedPlan().toString()


def highest_id(spark: SparkSession, path: str, column: str = "id") -> int:
    """Highest id of a stored table, -1 without rows or without a table."""
    if file_format(spark, path) is None:
        return -1
    highest = footers(spark, path, F.max(column).alias("highest"))["highest"]
    return -1 if highest is None else int(highest)


def stored_counts(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """(target_name, row_count) of the tables ``names`` below ``path``; null for one that is not there."""
    counts = [(n, footers(spark, f"{path}/{n}", F.count("*").alias("n"))["n"] if file_format(spark, f"{path}/{n}") else None) for n in names]
    return spark.createDataFrame(counts, "target_name STRING, row_count BIGINT")


# --- commits ----------------------------------------------------------------------------------------------------------


def _parent(path: str) -> tuple[str, str]:
    folder, _, name = path.rstrip("/").rpartition("/")
    return folder, name


def settle(spark: SparkSession, folder: str) -> None:
    """Ends swaps that were cut off below ``folder``: an old part goes back where nothing took its place, else it goes."""
    for name, _ in _children(spark, folder):
        if name.startswith(OLD):
            old, files = hadoop_file(spark, f"{folder}/{name}")
            target, _ = hadoop_file(spark, f"{folder}/{name.removeprefix(OLD)}")
            if files.exists(target):
                files.delete(old, True)
            else:
                files.rename(old, target)


def staging_path(spark: SparkSession, target: str) -> str:
    """A fresh folder beside ``target`` that readers pass over."""
    return f"{_parent(target)[0]}/{STAGED}{uuid.uuid4().hex}"


def swap(spark: SparkSession, staged: str, target: str) -> None:
    """Puts the folder ``staged`` in the place of ``target``."""
    folder, name = _parent(target)
    source, files = hadoop_file(spark, staged)
    place, _ = hadoop_file(spark, target)
    old, _ = hadoop_file(spark, f"{folder}/{OLD}{name}")
    if files.exists(old):
        settle(spark, folder)
    files.mkdirs(place.getParent())
    if files.exists(place) and not files.rename(place, old):
        raise OSError(f"{target} cannot be moved aside")
    if not files.rename(source, place):
        settle(spark, folder)
        raise OSError(f"{staged} cannot be moved to {target}")
    files.delete(old, True)


def discard(spark: SparkSession, staged: str) -> None:
    place, files = hadoop_file(spark, staged)
    if files.exists(place):
        files.delete(place, True)


def commit(df: DataFrame, target: str) -> None:
    """Writes ``df`` once, beside ``target``, and puts it in its place; ``df`` may read what is there now."""
    spark = df.sparkSession
    staged = staging_path(spark, target)
    try:
        df.write.parquet(staged)
        swap(spark, staged, target)
    finally:
        discard(spark, staged)
