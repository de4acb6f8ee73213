"""Newest rows per key, also for a key that holds a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RECORD_KEYS = ("interface_key", "dt", "input_param")


def ranked_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of each key with their ``place``; ``order`` must end in a unique column to be repeatable.

    Spark puts a group limit ahead of the shuffle, so a task passes on at most ``n`` rows of a key.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("place", place).where(F.col("place") <= n)


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    return ranked_per(df, keys, order, n).drop("place")


def sieve(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """``rows`` whose keys may be in ``wanted``: all that are, and of the others about one in 2**bits / distinct wanted keys.

    The keys' hashes are marked in bitmaps of 4 KiB, together 2**bits / 8 bytes at most whatever the number of keys, which go to
    all tasks. Rows are tested where they are read, so those that fail are never shuffled.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << bits))
    bucket, position = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    marks = wanted.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(position).alias("_marks"))
    byte = F.conv(F.hex(F.expr("substring(_marks, cast(_position div 8 as int) + 1, 1)")), 16, 10).cast("int")
    placed = rows.withColumn("_bucket", bucket).withColumn("_position", position)
    tested = placed.join(F.broadcast(marks), "_bucket").where(F.getbit(byte, (F.col("_position") % 8).cast("int")) == 1)
    return tested.select(*rows.columns)


def latest_success(records: DataFrame, keys: Sequence[str] = RECORD_KEYS, sieve_bits: int | None = None) -> DataFrame:
    """Newest successful records of each key. Records sharing the newest time are all kept.

    The newest time per key comes from a partial aggregate without the payload. The records meet it on key and time
    together: the records of one busy key spread over the tasks, and many copies with the newest time are a skewed
    join partition, which adaptive execution splits.

    With ``sieve_bits`` (27 make 16 MiB at most) records that are not the newest are left out ahead of that join, so that their
    payloads are not shuffled; worth it where the log holds many records per key and too many keys for a broadcast.
    """
    usable = records.where(
        (F.col("status_code") == 0)
        & F.col("create_time").isNotNull()
        & F.col("input_param").isNotNull()
    )
    newest = usable.groupBy(*keys).agg(F.max("create_time").alias("create_time"))
    matched = [*keys, "create_time"]
    if sieve_bits is None:
        return usable.join(newest, matched, "left_semi").select(*records.columns)
    # one row per key in newest: an inner join gives the same, and the optimizer does not move it below the sieve as it would a semi join
    return sieve(usable, newest, matched, sieve_bits).join(newest, matched).select(*records.columns)


def nth_newest(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The n-th row of the whole table in ``order``, no row when there are fewer."""
    place = F.row_number().over(Window.orderBy(*order))
    return df.orderBy(*order).limit(n).withColumn("place", place).where(F.col("place") == n).drop("place")
