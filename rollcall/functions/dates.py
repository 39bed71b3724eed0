"""Open-ended date windows and calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def within_end_date(d, end, inclusive: bool = True, coalesce_to: Column | None = None) -> Column:
    """Is date ``d`` inside a window whose end may be open (NULL)?

    * inclusive:  ``end IS NULL OR d <= end``
    * exclusive:  ``end IS NULL OR d < end``
    * with ``coalesce_to`` (the run date): ``d <= coalesce(end, coalesce_to)``;
      this form ignores ``inclusive`` on purpose (it never clips a future end).
    """
    d, end = _c(d), _c(end)
    if coalesce_to is not None:
        return d <= F.coalesce(end, coalesce_to)
    if inclusive:
        return end.isNull() | (d <= end)
    return end.isNull() | (d < end)


def day_count_in_range(begin, end, today: Column, inclusive: bool = True) -> Column:
    """Length of ``[begin, end]`` in days; an open end counts through today."""
    begin, end = _c(begin), _c(end)
    if inclusive:
        return F.datediff(F.date_add(F.coalesce(end, today), 1), begin)
    return F.datediff(F.coalesce(end, F.date_add(today, 1)), begin)


def short_day_name(d) -> Column:
    """Three-letter day name, e.g. 'Mon' (F12)."""
    return F.date_format(_c(d), "EEE")


def iso_week(d) -> Column:
    """ISO-8601 week of year."""
    return F.weekofyear(_c(d))


def week_of_school_year(is_school_day, week_of_year, start_offset) -> Column:
    """week count from the first school week, wrapping at the calendar year.

    ISO years with 53 weeks are not special-cased (the +52 wrap is kept as is).
    """
    w, off = _c(week_of_year), _c(start_offset)
    return (F.when(~_c(is_school_day), F.lit(None))
            .when(w >= off, w - off)
            .otherwise(w + 52 - off))
