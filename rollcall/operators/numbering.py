"""Dense row numbers without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dense_index(df: DataFrame, order: str, name: str, write) -> DataFrame:
    """Rows with ``name``: 0, 1, 2, ... in the order of the unique column ``order``.

    Rows are range-partitioned, sorted and written (``write(df, what)``, which
    reads them back), so their places are fixed; then each partition is counted
    on from the ones before it.  Only one row per partition goes through a
    window, never the rows themselves.
    """
    placed = write(df.repartitionByRange(order).sortWithinPartitions(order)
                   .withColumn("__at", F.monotonically_increasing_id()).withColumn("__part", F.spark_partition_id()),
                   f"{name}-placed")
    parts = placed.groupBy("__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select("__part", (F.col("__first") - F.coalesce(before, F.lit(0))).alias("__zero"))
    return (placed.join(starts, "__part").withColumn(name, F.col("__at") - F.col("__zero"))
            .drop("__at", "__part", "__zero"))
