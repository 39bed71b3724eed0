"""Deterministic dedupe (R1), preferred-row pluck (R2) and first-row flags.

``first_by`` keeps the first row of each key as a mergeable aggregate: rows are
combined before the shuffle, so a key that holds a third of all rows sends one
row per task.  ``deduplicate`` is the window form (``row_number() = 1``): whole
rows are shuffled and sorted by key and order; Catalyst puts a
``WindowGroupLimit`` on both sides of the exchange, after a sort of its input.
Use it where keys are the dataset grain and rows of one key are few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RN = "__rc_rn"


def _cols(xs) -> list[Column]:
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def deduplicate(df: DataFrame, partition_by: Sequence, order_by: Sequence) -> DataFrame:
    """Keep the first row per ``partition_by`` under ``order_by``.

    ``order_by`` must be written with explicit null placement and should end
    in a full tie-break; that is the caller's contract for determinism.
    """
    w = Window.partitionBy(*_cols(partition_by)).orderBy(*_cols(order_by))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def first_by(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[tuple[str, str]]) -> DataFrame:
    """R1 as an aggregate: the first row per ``partition_by`` under ``order_by``,
    pairs like ``("entry_date", "desc nulls first")``, found by ``min_by`` over a
    struct of the encoded sort keys.

    A sort key becomes two fields: whether it is null, placed as asked, and its
    value.  Values of the other direction are turned, which numbers, dates,
    timestamps and booleans can be; text can't, so text keys must all ascend or
    all descend (then the greatest is taken instead of the least).
    """
    parts, greatest = _ranked(df, order_by)
    rest = [c for c in df.columns if c not in partition_by]
    pick = (F.max_by if greatest else F.min_by)(F.struct(*rest), F.struct(*parts))
    best = df.groupBy(*partition_by).agg(pick.alias("__rc_row"))
    return best.select(*[F.col(c) if c in partition_by else F.col(f"__rc_row.`{c}`").alias(c) for c in df.columns])


def first_along(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[tuple[str, str]], sorted_by: str) -> DataFrame:
    """R1 for rows that are already sorted by ``partition_by`` and ``sorted_by``:
    the first row under ``order_by`` without a sort in that order.  The least
    encoded key of the partition is found by an unordered window; rows that are
    equal in it are told apart by their place."""
    parts, greatest = _ranked(df, order_by)
    whole = Window.partitionBy(*partition_by)
    place = F.row_number().over(whole.orderBy(sorted_by))
    key = F.struct(*parts, (-F.col(_RN) if greatest else F.col(_RN)).alias("place"))
    best = (F.max if greatest else F.min)("__rc_key").over(whole)
    return (df.withColumn(_RN, place).withColumn("__rc_key", key).withColumn("__rc_best", best)
            .filter(F.col("__rc_key") == F.col("__rc_best")).drop(_RN, "__rc_key", "__rc_best"))


def _ranked(df: DataFrame, order_by: Sequence[tuple[str, str]]) -> tuple[list[Column], bool]:
    """Fields of a struct that ranks rows, and whether the first row has the greatest."""
    text = {how.startswith("desc") for name, how in order_by if isinstance(df.schema[name].dataType, T.StringType)}
    if len(text) > 1:
        raise ValueError("text keys sort in both directions; use deduplicate")
    greatest = text == {True}
    parts = []
    for i, (name, how) in enumerate(order_by):
        null = F.col(name).isNull()
        parts.append((null if how.endswith("first") == greatest else ~null).alias(f"n{i}"))
        value = F.col(name) if how.startswith("desc") == greatest else _turned(F.col(name), df.schema[name].dataType)
        parts.append(value.alias(f"v{i}"))
    return parts, greatest


def _turned(c: Column, t: T.DataType) -> Column:
    """A value that sorts the other way round."""
    if isinstance(t, T.BooleanType):
        return ~c
    if isinstance(t, T.DateType):
        return -F.unix_date(c)
    if isinstance(t, T.TimestampType):
        return -F.unix_micros(c)
    if isinstance(t, T.NumericType):
        return -c
    raise ValueError(f"first_by can't turn {t.simpleString()}")


def flag_first(df: DataFrame, name: str, partition_by: Sequence, order_by: Sequence) -> DataFrame:
    """Boolean column, True on the first row of each partition."""
    w = Window.partitionBy(*_cols(partition_by)).orderBy(*_cols(order_by))
    return df.withColumn(name, F.row_number().over(w) == 1)


def row_pluck(df: DataFrame, key: Sequence | str, column: str, preferred: str,
              where: Column | None = None, tie_break: Sequence = ()) -> DataFrame:
    """R2: one row per ``key`` - the ``preferred`` value of ``column`` if present,
    else the first alphabetically.  Adds ``is_preferred``.  ``tie_break``
    orders rows sharing the same value (the reference leaves that arbitrary)."""
    if where is not None:
        df = df.filter(where)
    df = df.withColumn("is_preferred", F.col(column) == F.lit(preferred))
    return deduplicate(df, key, [F.col("is_preferred").desc_nulls_last(), F.col(column).asc_nulls_last(),
                                 *_cols(list(tie_break))])


def flag_first_by_key(df: DataFrame, name: str, partition_by: Sequence[str], sort_key: Column,
                      tie_break: str) -> DataFrame:
    """W3 for coarse, possibly hot keys: True on the row with the smallest
    ``(sort_key, tie_break)`` per partition.

    Instead of a window (one task would sort a whole hot key), the winner is
    found by an aggregate over a struct of the sort keys, which combines
    map-side, and joined back on the key (AQE splits a skewed side of that
    join).  ``sort_key`` must sort ascending in the wanted order (negate dates
    or numbers for descending).
    """
    win = (df.groupBy(*partition_by)
           .agg(F.min(F.struct(sort_key.alias("s"), F.col(tie_break).alias("t")))["t"].alias("__rc_winner")))
    out = df.join(win, list(partition_by), "left")
    return out.withColumn(name, F.coalesce(F.col(tie_break) == F.col("__rc_winner"), F.lit(False))).drop("__rc_winner")
