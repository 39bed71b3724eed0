"""Crosswalk-driven pivots and unpivot.

The output columns of a pivot come from the distinct values of a crosswalk.
Those values are read once while the plan is built (``crosswalk_values``);
the pivot itself is a single hash aggregate of conditional aggregates, so it
is one pass with map-side partial aggregation and stays in whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import slugify

# a crosswalk that names columns is a hand-edited seed; more values than this
# would be a configuration error, not data, so it is refused instead of collected.
def crosswalk_values(df: DataFrame, column: str, where: Column | None = None) -> list:
    """Ordered distinct non-NULL values of a crosswalk column."""
    if where is not None:
        df = df.filter(where)
    return [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).collect()]


def is_empty(df: DataFrame) -> bool:
    """Does the relation have no rows (one-row probe)."""
    return df.isEmpty()


_AGG = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}


def pivot_values(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence,
                 value_col: str, agg: str = "min", prefix: str = "", suffix: str = "") -> DataFrame:
    """One column per crosswalk value holding ``agg(value_col)`` of matching rows."""
    fn = _AGG[agg]
    cols = [fn(F.when(F.col(pivot_col) == F.lit(v), F.col(value_col))).alias(slugify(f"{prefix}{v}{suffix}"))
            for v in values]
    if not cols:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*cols)


def pivot_flags(df: DataFrame, keys: Sequence[str], pivot_col: str,
                pairs: Sequence[tuple[str, str]], prefix: str = "", suffix: str = "",
                null_false: bool = True) -> DataFrame:
    """Boolean flag per ``(value, alias)``: any row of the group has that value."""
    cols = []
    for value, alias in pairs:
        hit = F.col(pivot_col) == F.lit(value)
        if null_false:
            hit = F.coalesce(hit, F.lit(False))
        cols.append(F.max(hit).alias(slugify(f"{prefix}{alias}{suffix}")))
    if not cols:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*cols)


def pivot_counts(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence,
                 prefix: str = "", suffix: str = "") -> DataFrame:
    """X2 count form: number of rows per value (0 when absent)."""
    cols = [F.count_if(F.col(pivot_col) == F.lit(v)).alias(slugify(f"{prefix}{v}{suffix}")) for v in values]
    return df.groupBy(*keys).agg(*cols)


def pivot_2d(df: DataFrame, keys: Sequence[str], type_col: str, types: Sequence[str],
             parts: Sequence[str]) -> DataFrame:
    """``{type}_{part}`` = min(part) of the row with that type."""
    cols = [F.min(F.when(F.col(type_col) == F.lit(t), F.col(p))).alias(slugify(f"{t}_{p}"))
            for t in types for p in parts]
    if not cols:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*cols)


def cast_by_type(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Recode pivoted text columns by their crosswalk type (boolean via P15)."""
    from ..functions.columns import recode_boolean
    out = []
    for c in df.columns:
        t = types.get(c)
        if t is None or t in ("string", "varchar", "text"):
            out.append(F.col(c))
        elif t == "boolean":
            out.append(recode_boolean(c).alias(c))
        else:
            out.append(F.col(c).try_cast(t).alias(c))
    return df.select(*out)


def unpivot(df: DataFrame, ids: Sequence[str], exclude: Sequence[str] = (), remove: Sequence[str] = (),
            name_col: str = "field_name", value_col: str = "value") -> DataFrame:
    """Wide row -> (field, value as text); NULL values are kept.

    One ``Expand`` over one scan, instead of a union of one scan per column.
    """
    skip = set(ids) | set(exclude) | set(remove)
    values = [c for c in df.columns if c not in skip]
    cast = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in values])
    return cast.unpivot(list(ids), values, name_col, value_col)
