"""Column helpers: projection shapes, recodes and labels.

P4 accordion columns, P11 not-in-list, P15 boolean recode, P18 two-way
conditional, F8 descriptor short name, F14/F15 time-of-day repair, F20
single-or-multiple collapse, F24 race/ethnicity label, F25 display name,
plus the driver-side ``slugify`` used for pivoted and configured names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def accordion(df: DataFrame, exclude: Iterable[str] = (), alias: str | None = None,
              coalesce_value=None) -> list[Column]:
    """Every column of ``df`` except ``exclude``, optionally coalesced."""
    skip = {c.lower() for c in exclude}
    out = []
    for name in df.columns:
        if name.lower() in skip:
            continue
        col = df[name] if alias is None else F.col(f"{alias}.{name}")
        if coalesce_value is not None:
            col = F.coalesce(col, F.lit(coalesce_value))
        out.append(col.alias(name))
    return out


def not_in(field, excluded: Iterable[str] | str | None) -> Column:
    """True when the list is empty/None; else ``field NOT IN (...)``.

    A NULL field gives NULL (three-valued), exactly like SQL NOT IN.
    """
    if excluded is None:
        return F.lit(True)
    if isinstance(excluded, str):
        excluded = [excluded]
    excluded = list(excluded)
    if not excluded:
        return F.lit(True)
    return ~_c(field).isin(excluded)


# fixed values: default text forms recoded to booleans
TRUE_CASES = ("yes", "y", "true", "t", "1", "1.0")
FALSE_CASES = ("no", "n", "false", "f", "0", "0.0")


def recode_boolean(col, true_cases=TRUE_CASES, false_cases=FALSE_CASES, default=None) -> Column:
    """Case-insensitive text -> boolean, else ``default``."""
    text = F.lower(_c(col).cast("string"))
    expr = None
    if true_cases is not None:
        expr = F.when(text.isin(list(true_cases)), F.lit(True))
    if false_cases is not None:
        cond = text.isin(list(false_cases))
        expr = F.when(cond, F.lit(False)) if expr is None else expr.when(cond, F.lit(False))
    dflt = F.lit(default).cast("boolean")
    return dflt if expr is None else expr.otherwise(dflt)


def iff(cond: Column, a, b) -> Column:
    """``cond ? a : b`` where a NULL condition takes ``b``."""
    a = a if isinstance(a, Column) else F.lit(a)
    b = b if isinstance(b, Column) else F.lit(b)
    return F.when(cond, a).otherwise(b)


def descriptor_short(col) -> Column:
    """F8: the code value after '#' of a descriptor URI (whole text if no '#')."""
    return F.substring_index(_c(col), "#", -1)


def single_or_multiple(arr, multiple_label: str = "Multiple") -> Column:
    """one element -> that element; several -> label; none -> NULL."""
    arr = _c(arr)
    return (F.when(F.size(arr) == 1, F.get(arr, 0))
            .when(F.size(arr) > 1, F.lit(multiple_label))
            .otherwise(F.lit(None).cast("string")))


def repair_time(col) -> Column:
    """'HH:MM:SS' where an hour of 1..6 is taken as afternoon (+12 h)."""
    c = _c(col)
    hour = F.substring(c, 1, 2).try_cast("int")
    return F.when(hour.between(1, 6),
                  F.concat(F.lpad((hour + 12).cast("string"), 2, "0"), F.substring(c, 3, 100))
                  ).otherwise(c)


def minutes_between(start, end) -> Column:
    """minutes from start to end time of day; an end before start gets +12 h."""
    s = F.to_timestamp(F.concat(F.lit("1970-01-01 "), _c(start)))
    e = F.to_timestamp(F.concat(F.lit("1970-01-01 "), _c(end)))
    e = F.when(s > e, e + F.expr("INTERVAL 12 HOURS")).otherwise(e)
    return F.timestamp_diff("MINUTE", s, e)


def json_items(col) -> Column:
    """the elements of a JSON list, each read by path later; NULL if the
    text is no list."""
    return F.try_variant_get(F.try_parse_json(_c(col)), "$", "array<variant>")


def json_size(col) -> Column:
    """number of elements of a JSON list, 0 if there is none."""
    return F.coalesce(F.size(json_items(col)), F.lit(0))


def race_label(is_hispanic, races, hispanic_code: str, multiple_code: str, unknown_code: str) -> Column:
    """hispanic flag first, then several races, then the one race, else unknown."""
    races = _c(races)
    return (F.when(F.coalesce(_c(is_hispanic), F.lit(False)), F.lit(hispanic_code))
            .when(F.coalesce(F.size(races), F.lit(0)) > 1, F.lit(multiple_code))
            .when(F.coalesce(F.size(races), F.lit(0)) == 1, F.get(races, 0))
            .otherwise(F.lit(unknown_code)))


def display_name(last, first, middle, expr: str | None = None) -> Column:
    """'Last, First M' (NULL-propagating concat) unless an expression is configured."""
    if expr:
        return F.expr(expr)
    middle_initial = F.concat(F.lit(" "), F.left(_c(middle), F.lit(1)))
    return F.concat(_c(last), F.lit(", "), _c(first), F.coalesce(middle_initial, F.lit("")))


_slug_space = re.compile(r"[\s\-]+")
_slug_drop = re.compile(r"[^0-9a-zA-Z_]")


def slugify(text: str) -> str:
    """Column-name form of a value: lower case, blanks/hyphens -> '_', other punctuation dropped."""
    s = _slug_space.sub("_", str(text).strip().lower())
    return _slug_drop.sub("", s)
