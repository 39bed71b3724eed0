"""Range-partitioned streams whose partitions meet at their ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def following(ends: DataFrame, around: bool) -> DataFrame:
    """``(pid, next_pid)`` of the partitions listed in ``ends`` (one row each);
    with ``around`` the last is followed by the first.  One row per partition,
    not per record, goes through one task."""
    nxt = F.lead("pid").over(Window.orderBy("pid"))
    if around:
        nxt = F.coalesce(nxt, F.min("pid").over(Window.partitionBy(F.lit(0))))
    return ends.select("pid", nxt.alias("next_pid")).where("next_pid is not null")
