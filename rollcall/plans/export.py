"""Flat, engine-neutral rendering of a dataset for export and comparison.

Integers widen to bigint, decimals become double (values here have at most
two decimals, so the conversion is exact-rounded in every engine), arrays of
scalars become ','-joined text (datasets already sort their arrays), arrays of
objects and maps become sorted text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _flat_col(name: str, t: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(t, (T.DecimalType, T.FloatType)):
        return c.cast("double")
    if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
        return c.cast("bigint")
    if isinstance(t, T.ArrayType):
        if isinstance(t.elementType, (T.StructType, T.ArrayType, T.MapType)):
            return F.array_join(F.sort_array(F.transform(c, lambda e: F.to_json(e, {"ignoreNullFields": "false"}))), ";")
        return F.array_join(c.cast("array<string>"), ",")
    if isinstance(t, T.MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.concat(e["key"].cast("string"), F.lit("="),
                                                                    e["value"].cast("string")))
        return F.array_join(F.sort_array(entries), ",")
    return c


def flat(df: DataFrame) -> DataFrame:
    return df.select(*[_flat_col(f.name, f.dataType).alias(f.name) for f in df.schema.fields])
