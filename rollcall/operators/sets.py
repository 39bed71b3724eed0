"""Set operators (U1-U5) and array aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False,
              source_col: str | None = None, names: Sequence[str] | None = None) -> DataFrame:
    """UNION ALL by column name; missing columns become NULL when allowed.

    ``source_col`` tags each row with the name of the input it came from.
    """
    frames = list(frames)
    if source_col:
        names = names or [str(i) for i in range(len(frames))]
        frames = [f.withColumn(source_col, F.lit(n)) for f, n in zip(frames, names)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def sorted_array(col) -> Column:
    """Array of the group's values in element order (NULLs dropped)."""
    return F.sort_array(F.collect_list(col))


def sorted_distinct_array(col) -> Column:
    """Distinct values, sorted."""
    return F.sort_array(F.collect_set(col))


def sorted_struct_array(*fields) -> Column:
    """Array of objects, sorted by the struct fields in order."""
    return F.sort_array(F.collect_list(F.struct(*fields)))


def map_agg(key, value) -> Column:
    """Key -> value object; keys must be unique in the group (dedupe first)."""
    return F.map_from_entries(F.collect_list(F.struct(key, value)))


def render_array(col, sep: str = ",") -> Column:
    """Text form of an array for comparison and export."""
    return F.array_join(col, sep)
