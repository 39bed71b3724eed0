"""Window operators: streaks (W4), running totals (W5/W6), partition-max flags
(W7/W8), distinct counts per partition (W10).

Windows that share a partitioning run after one exchange (Catalyst's
EnsureRequirements sees the same required distribution).  Partition-wide
statistics over low-cardinality keys (a tenant) are computed as an aggregate
and joined back instead, so no single task holds a whole tenant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def streaks(df: DataFrame, partition_by: Sequence[str], status: str, order_col: str, counter: str) -> DataFrame:
    """W4 gaps-and-islands: ``counter`` = position of the row inside its run of
    equal ``status`` values, ordered by ``order_col``.

    A row starts a run where its status differs from the row before (``lag``);
    its position in the run is its rank less that of the run's first row, the
    greatest rank of a start so far.  All of it runs in one order, that of the
    running totals, so it adds no sort to theirs.
    """
    w = Window.partitionBy(*_cols(partition_by)).orderBy(order_col)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank, before = F.dense_rank().over(w), F.lag(F.struct(status)).over(w)
    out = df.withColumn("__rc_rank", rank).withColumn(
        "__rc_start", F.when(before.isNull() | ~F.col(status).eqNullSafe(before[status]), F.col("__rc_rank")))
    first = F.max("__rc_start").over(so_far)
    return out.withColumn(counter, F.col("__rc_rank") - first + 1).drop("__rc_rank", "__rc_start")


def running_sum(col, partition_by: Sequence[str], order_col: str) -> Column:
    """Running total through the current row."""
    w = (Window.partitionBy(*_cols(partition_by)).orderBy(order_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.sum(col).over(w)


def partition_sum(col, partition_by: Sequence[str]) -> Column:
    """Total over the whole partition."""
    return F.sum(col).over(Window.partitionBy(*_cols(partition_by)))


def flag_partition_max(df: DataFrame, partition_by: Sequence[str], col: str, name: str,
                       few_partitions: bool = False) -> DataFrame:
    """``name`` = (col equals its maximum within the partition).

    ``few_partitions=True`` is for keys like a tenant, where a window would put
    a third of the table into one task: the maxima are aggregated (map-side
    partial aggregation, one row per key) and joined back by a broadcast.  Left to
    AQE, the rows themselves would be dealt by those few keys, one task each,
    before the size of the aggregate is known.
    """
    if not few_partitions:
        return df.withColumn(name, F.col(col) == F.max(col).over(Window.partitionBy(*_cols(partition_by))))
    mx = df.groupBy(*partition_by).agg(F.max(col).alias("__rc_max"))
    # one row per key, and the caller says that the keys are few
    out = df.join(F.broadcast(mx), list(partition_by), "left")
    return out.withColumn(name, F.col(col) == F.col("__rc_max")).drop("__rc_max")


def keep_partition_max(df: DataFrame, partition_by: Sequence[str], col: str,
                       few_partitions: bool = False) -> DataFrame:
    """Keep only rows holding the partition maximum of ``col``."""
    flagged = flag_partition_max(df, partition_by, col, "__rc_is_max", few_partitions)
    return flagged.filter(F.col("__rc_is_max")).drop("__rc_is_max")


def count_distinct_per(df: DataFrame, partition_by: Sequence[str], col: str, name: str) -> DataFrame:
    """``count(distinct col)`` over a partition, attached to every row.

    Spark has no DISTINCT window aggregate; an exact aggregate + join does it
    without buffering a set per row.
    """
    agg = df.groupBy(*partition_by).agg(F.countDistinct(col).alias(name))
    return df.join(agg, list(partition_by), "left")


def count_per(df: DataFrame, partition_by: Sequence[str], name: str) -> DataFrame:
    """Rows per partition, attached to every row."""
    return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*_cols(partition_by))))
