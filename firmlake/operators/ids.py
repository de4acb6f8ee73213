"""Consecutive ids over a global order, without passing the table through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmlake.session import cut_lineage

ROW_BITS = 33  # monotonically_increasing_id keeps the row number of its partition in the lower bits


def dense_ids(df: DataFrame, order: Sequence[Column], start: Column | int = 1, id_column: str = "id") -> DataFrame:
    """``start``, ``start + 1``, ... in ``order``, which must be unique for repeatable ids.

    Rows are range partitioned and sorted in place; the ids are the place within the partition plus the number of rows
    in the partitions before it. The checkpoint pins the partitions, so that a lost executor cannot move a boundary.
    """
    kept = df.columns
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(ranged.withColumn("_at", F.monotonically_increasing_id())).select(
        *kept,
        F.shiftright("_at", ROW_BITS).alias("_part"),
        F.col("_at").bitwiseAND((1 << ROW_BITS) - 1).alias("_row"),
    )
    # one row per partition, whatever the size of the table
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    first = start if isinstance(start, Column) else F.lit(start)
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.select((F.col("_before") + F.col("_row") + first).cast("bigint").alias(id_column), *kept)


def continue_ids(new: DataFrame, existing: DataFrame | int, order: Sequence[Column]) -> DataFrame:
    """Ids for new rows, from one above the highest id in use (0 for an empty table).

    ``existing`` is the highest id, for a stored table the one of ``storage.highest_id``, which reads no rows; or a DataFrame
    whose ids are read.
    """
    highest = F.lit(existing) if isinstance(existing, int) else existing.select(F.coalesce(F.max("id"), F.lit(-1))).scalar()
    return dense_ids(new.drop("id"), order, start=highest + 1)
