"""Join shapes the warehouse needs beyond a plain equi join.

Physical strategy is left to Catalyst + AQE (``spark.sql.adaptive.*``):
AQE turns a sort-merge join into a broadcast join when the measured shuffle
output of one side is under the threshold, and splits skewed partitions of
the big side.  We only force ``broadcast`` where the size is bounded by
construction (seed crosswalks).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def seed(df: DataFrame) -> DataFrame:
    """Mark a seed crosswalk (bounded, user-edited lookup) for broadcast."""
    return F.broadcast(df)


def wildcard_condition(left: DataFrame, right: DataFrame, optional_keys: Sequence[str],
                       left_names: Sequence[str] | None = None) -> Column:
    """For each optional key, a NULL on the crosswalk side matches anything."""
    left_names = left_names or optional_keys
    cond = F.lit(True)
    for rk, lk in zip(optional_keys, left_names):
        cond = cond & (right[rk].isNull() | (right[rk] == left[lk]))
    return cond


def wildcard_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                  optional_keys: Sequence[str], how: str = "left") -> DataFrame:
    """J11 join: hash join on the mandatory ``keys`` and a residual filter for the
    optional ones, so the physical join stays an equi join."""
    cond = [left[k] == right[k] for k in keys]
    cond.append(wildcard_condition(left, right, optional_keys))
    out = left.join(right, on=cond, how=how)
    for k in list(keys) + list(optional_keys):
        out = out.drop(right[k])
    return out


def optional_key_join(left: DataFrame, xwalk: DataFrame, optional: Sequence[tuple[str, str]], payload: Sequence[str]) -> DataFrame:
    """J11 without mandatory keys: every pair ``(left column, crosswalk column)``
    is matched, or skipped where the crosswalk has NULL.  Left join: rows of
    ``left``, once per match, with the ``payload`` columns, NULL without a match.

    The crosswalk (a seed) is split by which of its keys are NULL.  Each part is
    one equi join; the part without any key goes along with every row as a
    literal array.  So no part needs a nested loop over ``left``.
    """
    given = [F.col(x).isNotNull().alias(f"g{i}") for i, (_, x) in enumerate(optional)]
    parts, lost = [], left
    for pattern in xwalk.select(*given).distinct().collect():
        same = [c if p else ~c for c, p in zip([F.col(x).isNotNull() for _, x in optional], pattern, strict=True)]
        own = xwalk.filter(reduce(lambda a, b: a & b, same))
        keys = [pair for pair, p in zip(optional, pattern, strict=True) if p]
        if not keys:
            rows = own.select(*payload).collect()
            each = F.array(*[F.struct(*[F.lit(r[p]).cast(own.schema[p].dataType).alias(p) for p in payload]) for r in rows])
            parts.append(left.select("*", F.inline(each)))
            lost = lost.filter(F.lit(False))
            continue
        theirs = own.select(*[F.col(x).alias(f"__x{i}") for i, (_, x) in enumerate(keys)], *payload)
        on = reduce(lambda a, b: a & b, [left[c] == F.col(f"__x{i}") for i, (c, _) in enumerate(keys)])
        marks = [f"__x{i}" for i in range(len(keys))]
        parts.append(left.join(seed(theirs), on).drop(*marks))
        anti = reduce(lambda a, b: a & b, [lost[c] == F.col(f"__x{i}") for i, (c, _) in enumerate(keys)])
        lost = lost.join(seed(theirs.select(*marks).distinct()), anti, "left_anti")
    parts.append(lost.select("*", *[F.lit(None).cast(xwalk.schema[p].dataType).alias(p) for p in payload]))
    return reduce(DataFrame.unionByName, parts)


def eq_null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality on several column pairs (still hashes)."""
    cond = F.lit(True)
    for lk, rk in pairs:
        cond = cond & left[lk].eqNullSafe(right[rk])
    return cond


def unambiguous_only(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """J17 helper: rows whose ``group`` has exactly one row (count window = 1)."""
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__rc_n")).filter(F.col("__rc_n") == 1).drop("__rc_n")
    return df.join(counts, list(group), "left_semi")
