"""Words, shingles, stored steps and connected components shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlake.session import drop_path, write_and_read

WORD = r"[^\x20\x09-\x0D]+"
U64 = np.uint64
MIX_1, MIX_2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
GOLDEN = U64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """Scatters 64-bit values (the finalizer of splitmix64)."""
    values = (values ^ (values >> U64(30))) * MIX_1
    values = (values ^ (values >> U64(27))) * MIX_2
    return values ^ (values >> U64(31))


class WordHashes(dict):
    """64-bit hash of a word, remembered while at most ``limit`` words are held."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=U64, count=len(words))


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Texts are long, so tasks get them in batches of ``rows`` at most, unless the session asks for even fewer."""
    if int(spark.conf.get(BATCH_ROWS, "10000")) not in range(1, rows + 1):
        spark.conf.set(BATCH_ROWS, str(rows))


def draw(df: DataFrame, most: int, *keys: str) -> DataFrame:
    """At most ``most`` rows, drawn by the hash of ``keys``; tasks pass on hardly more than that in all."""
    n = df.count()
    if n > 2 * most:
        share = int(1.2 * most / n * (1 << 40)) + 1
        df = df.where(F.pmod(F.xxhash64(*keys, F.lit("draw")), F.lit(1 << 40)) < share)
    return df.orderBy(F.xxhash64(*keys), *keys).limit(most)


def give_back(run):
    """``run`` over a task's batches; memory that it no longer needs goes back at the end, as workers are kept for other tasks."""

    def whole(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return whole


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8 with A-Z lower-cased; bytes.split knows just the blanks 0x20 and 0x09-0x0D."""
    return text.lower().split() if text else []


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words in order, or of the whole sequence where it is shorter; none without words."""
    n = len(hashes)
    if not n:
        return np.empty(0, U64)
    width = min(n, size)
    total = np.full(n - width + 1, U64(width), U64)
    for at in range(width):
        total = mix(total * GOLDEN + hashes[at : n - width + 1 + at])
    return total


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles, ascending."""
    return np.unique(shingles(hashes, size))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def list_array(parts: list[np.ndarray], kind=np.int64) -> pa.ListArray:
    """One Arrow list per part."""
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0, kind)
    return pa.LargeListArray.from_arrays(offsets, pa.array(flat.astype(kind, copy=False))).cast(pa.list_(pa.from_numpy_dtype(kind)))


FILTER_BITS = (16, 26)  # least and most, as powers of two: 8 MB at most


def _marks(bits: int):
    def run(batches):
        held = np.zeros(1 << bits, bool)
        for batch in batches:
            held[filter_places(batch.column(0).to_numpy(zero_copy_only=False), bits)] = True
        yield pa.RecordBatch.from_pydict({"marks": pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())})

    return run


def _either(batches):
    held = None
    for batch in batches:
        for marks in batch.column("marks"):
            own = np.frombuffer(marks.as_py(), np.uint8)
            held = own.copy() if held is None else held | own
    if held is not None:
        yield pa.RecordBatch.from_pydict({"marks": pa.array([held.tobytes()], pa.binary())})


def filter_places(ids: np.ndarray, bits: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(U64) * GOLDEN) >> U64(64 - bits)).astype(np.int64)


def id_filter(ids: DataFrame, bits_each: int = 16) -> np.ndarray:
    """Bits that are set for each id of the single, non-null long column; of bounded size, so with many ids it lets more others pass."""
    bits = int(np.clip((bits_each * ids.count()).bit_length(), *FILTER_BITS))
    found = ids.coalesce(64).mapInArrow(_marks(bits), "marks binary").repartition(1).mapInArrow(_either, "marks binary").collect()
    marks = np.zeros(1 << (bits - 3), np.uint8)
    for row in found:
        marks |= np.frombuffer(row.marks, np.uint8)
    return marks


def may_hold(marks: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = filter_places(ids, (len(marks) * 8).bit_length() - 1)
    return (marks[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _passes(spark: SparkSession, ids: DataFrame, column: str):
    """Whether a row's id may be one of ``ids``: all of them, and few others."""
    marks = spark.sparkContext.broadcast(id_filter(ids, 1024))

    @F.pandas_udf("boolean")
    def test(values: pd.Series) -> pd.Series:
        return pd.Series(may_hold(marks.value, values.to_numpy(np.int64)))

    return F.col(column).isNotNull() & test(F.coalesce(F.col(column), F.lit(0)))


def without_ids(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """``rows`` whose long ``column`` is null or none of ``ids`` (a column of that name, distinct, stored).

    Whole rows are not shuffled: a filter of bounded size lets through all but the wanted ids and a few others, and only those
    few others meet a join, as ids first and then as rows.
    """
    spark = rows.sparkSession
    passes = _passes(spark, ids, column)
    others = write_and_read(rows.where(passes).select(column).distinct().join(ids, column, "left_anti"), "others")
    kept = rows.where(~passes)
    if others.isEmpty():
        return kept
    return kept.union(rows.where(passes & _passes(spark, others, column)).join(others, column, "left_semi").select(*rows.columns))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id on an edge of ``edges`` (a, b): component is the smallest id that it reaches.

    Large-star and small-star steps in turn, as joins, until nothing changes. The smallest neighbours are stored before they
    are joined back, so both sides of each join are shuffled and adaptive execution can split a node with many links.
    Null ends and links of an id with itself add nothing; repeated links count once.
    """
    spark = edges.sparkSession
    held: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        stored = write_and_read(df, "links")
        held.extend(stored.inputFiles()[:1])
        return stored

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("lo", "hi"))).first())

    def folder(file: str) -> str:
        return file.rpartition("/")[0]

    links = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    now = state(links)
    while now[0]:
        first = len(held)
        both = links.select("hi", "lo").union(links.select("lo", "hi")).toDF("u", "v")
        least = keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = keep(both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        lowest = keep(large.groupBy("hi").agg(F.min("lo").alias("m")))
        joined = large.join(lowest, "hi")
        small = joined.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(lowest.select("hi", F.col("m").alias("lo")))
        links = keep(small.distinct())
        before, now = now, state(links)
        done, held = held[: len(held) - 1], held[len(held) - 1 :]
        if first or done:
            for file in done:
                drop_path(spark, folder(file))
        if before == now:
            break
    nodes = links.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return nodes.union(links.select("lo", "lo").distinct().toDF("id", "component"))
