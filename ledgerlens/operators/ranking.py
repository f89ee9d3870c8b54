"""Top-k, per-group top-k and ordering helpers.

Every limit gets a total order (measure, then key) so two engines -- or two
runs -- agree on which rows survive a tie.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import scratch_path


def top_k(df: DataFrame, k: int, order_by: Sequence[Column | str]) -> DataFrame:
    """``ORDER BY ... LIMIT k``.

    Planned as ``TakeOrderedAndProject``: each task keeps its own k best rows
    and only those reach the final merge, so no task ever holds more than k
    rows per input partition.
    """
    return df.orderBy(*order_by).limit(k)


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], k: int,
                    order_by: Sequence[Column | str], rank_col: str = "rank") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY g ORDER BY ...) <= k``.

    Spark plans a partial ``WindowGroupLimit`` before the shuffle, so even a
    group that holds a third of all rows arrives at its window task as at most
    k rows per map partition.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_by)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def with_position(df: DataFrame, order_by: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Add every row's place (from 1) in the whole order, without a task that sees all rows.

    The rows are dealt into ranges of the order and sorted there, and written
    once with their place inside their range (a second evaluation could draw
    other ranges).  The ranges' sizes, one row each, are summed up, and a
    row's position is its place after all ranges before its own.  ``order_by``
    must be a total order.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ordered")
    numbered = df.orderBy(*order_by).withColumn("__id", F.monotonically_increasing_id())
    # The id has the range in its upper 31 bits and the place in its range in the lower 33.
    numbered = numbered.withColumn("__range", F.shiftright("__id", 33)).withColumn("__place", F.col("__id").bitwiseAND((1 << 33) - 1)).drop("__id")
    numbered.write.parquet(path)
    back = spark.read.schema(numbered.schema).parquet(path)
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = back.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    placed = back.join(offsets, "__range").withColumn(name, F.col("__before") + F.col("__place") + 1)
    return placed.drop("__range", "__place", "__before")


def rank_all(df: DataFrame, order_by: Sequence[Column | str], k: int, rank_col: str = "rank") -> DataFrame:
    """Global ``ROW_NUMBER() ... <= k`` for a ``k`` of any size (see :func:`with_position`)."""
    return with_position(df, order_by, rank_col).filter(F.col(rank_col) <= k)
