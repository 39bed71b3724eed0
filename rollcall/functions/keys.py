"""Surrogate keys (F1, F2).

A key is the md5 of the ordered inputs rendered as text, joined by '-'.
NULL and '' must give different keys, so NULL is replaced by a sentinel
before joining.  Inputs should be strings, integers or dates: the text form
of those is the same in every SQL engine, unlike doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed value: text standing in for NULL inside a key
NULL_SENTINEL = "_rc_null_"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """md5 over the ordered columns; NULL-aware."""
    parts = [F.coalesce(_as_col(c).cast("string"), F.lit(NULL_SENTINEL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def key_from_struct(struct_col: str, fields: list[str]) -> Column:
    """key built from the fields of a nested reference object."""
    return surrogate_key(*[F.col(f"{struct_col}.{f}") for f in fields])


#: zero bytes behind a key that is no md5, so that its length differs from that of any packed md5
_PAD = bytes(17)


def packed(c) -> Column:
    """A key in half its bytes, for rows on their way through a join: an md5 as
    its 16 bytes, any other text as itself and ``_PAD``.  Equal only for equal keys."""
    c = _as_col(c)
    return F.when(c.rlike("^[0-9a-f]{32}\\z"), F.unhex(c)).otherwise(F.concat(F.encode(c, "UTF-8"), F.lit(_PAD)))


def unpacked(c) -> Column:
    """The key that ``packed`` made."""
    c = _as_col(c)
    return F.when(F.octet_length(c) == 16, F.lower(F.hex(c))).otherwise(
        F.decode(F.substring(c, F.lit(1), F.octet_length(c) - len(_PAD)), "UTF-8"))


def pack_keys(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({k: packed(k) for k in names})


def unpack_keys(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({k: unpacked(k) for k in names})
