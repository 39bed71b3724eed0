"""Calendars, calendar days, school-year windows and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.columns import single_or_multiple
from ..operators.joins import seed
from ..operators.sets import sorted_array
from .registry import dataset


@dataset("dim_school_calendar", grain=("k_school_calendar",))
def dim_school_calendar(wh) -> DataFrame:
    """Calendars at known schools (J1) with their sorted grade list."""
    cal = wh("stg_ef3__calendars")
    sch = wh("dim_school").select("k_school")
    grades = (wh("stg_ef3__calendars__grade_levels").groupBy("k_school_calendar")
              .agg(sorted_array("grade_level").alias("applicable_grade_levels_array")))
    return (cal.join(sch, "k_school").join(grades, "k_school_calendar", "left")
            .select("k_school_calendar", "k_school", "tenant_code", "school_year", "calendar_code",
                    "calendar_type", "applicable_grade_levels_array"))


@dataset("dim_calendar_date", grain=("k_calendar_date",))
def dim_calendar_date(wh) -> DataFrame:
    """One row per calendar day: school-day flag, event label, day and week of
    the school year (A5 A11 F20 W2 F12 F13).

    Days whose events are all unmapped, and calendars without a school day,
    drop out through inner joins, as in the reference.
    """
    cfg = wh.config
    ev = wh("stg_ef3__calendar_dates__calendar_events")
    xw = seed(wh("xwalk_calendar_events"))
    summary = (ev.join(xw, ev.calendar_event == xw.calendar_event_descriptor)
               .groupBy("k_calendar_date")
               .agg((F.sum(F.col("is_school_day").cast("int")) >= cfg.num_school_day_calendar_events)
                    .alias("is_school_day"),
                    sorted_array("calendar_event").alias("calendar_events_array")))
    days = wh("stg_ef3__calendar_dates").select("k_calendar_date", "k_school_calendar", "tenant_code",
                                                "school_year", "calendar_date")
    cal = wh("dim_school_calendar").select("k_school_calendar", "k_school", "calendar_code", "calendar_type")
    d = (days.join(cal, "k_school_calendar").join(summary, "k_calendar_date")
         .withColumn("calendar_event", single_or_multiple("calendar_events_array")))
    # Running count of school days inside each calendar
    w = Window.partitionBy("k_school_calendar", "is_school_day").orderBy("calendar_date")
    d = (d.withColumn("day_of_school_year", F.when(F.col("is_school_day"), F.row_number().over(w)))
         .withColumn("week_day", dates.short_day_name("calendar_date"))
         .withColumn("week_of_calendar_year", dates.iso_week("calendar_date")))
    # week of the first school day per calendar (aggregate, one row per calendar)
    first = (d.filter(F.col("is_school_day")).groupBy("k_school_calendar")
             .agg((F.weekofyear(F.min("calendar_date")) - 1).alias("start_week_offset")))
    d = d.join(first, "k_school_calendar")
    d = d.withColumn("week_of_school_year", dates.week_of_school_year(
        "is_school_day", "week_of_calendar_year", "start_week_offset"))
    from .custom import add_custom_columns
    out = d.select("k_calendar_date", "k_school_calendar", "k_school", "tenant_code", "calendar_code",
                   "school_year", "calendar_date", "calendar_event", "calendar_events_array",
                   "is_school_day", "day_of_school_year", "week_day", "week_of_calendar_year",
                   "week_of_school_year")
    return add_custom_columns(wh, "dim_calendar_date", out, ["k_calendar_date"])


@dataset("bld_school_calendar_windows", grain=("tenant_code", "k_school", "school_year", "k_school_calendar"))
def school_calendar_windows(wh) -> DataFrame:
    """first/last school day per school-year and per calendar (grouping sets).

    The school-level rows carry a NULL ``k_school_calendar``.
    """
    d = wh("dim_calendar_date").filter(F.col("is_school_day"))
    school = ["tenant_code", "k_school", "school_year"]
    return (d.groupingSets([school, school + ["k_school_calendar"]], *school, "k_school_calendar")
            .agg(F.min("calendar_date").alias("first_school_day"),
                 F.max("calendar_date").alias("last_school_day")))


@dataset("dim_session", grain=("k_session",))
def dim_session(wh) -> DataFrame:
    """Sessions at known schools."""
    s = wh("stg_ef3__sessions")
    return s.join(wh("dim_school").select("k_school"), "k_school").select(
        "k_session", "k_school", "tenant_code", "school_year", "session_name", "academic_term",
        "session_begin_date", "session_end_date", "total_instructional_days")


@dataset("dim_class_period", grain=("k_class_period",))
def dim_class_period(wh) -> DataFrame:
    """Class periods at known schools (J1).  Times are read by path from the JSON
    list of meetings where it has exactly one (F22), else NULL, and beside them
    those of the first of all meetings; 12-hour times repaired (F14), minutes
    between (F15), the meetings counted, the JSON dropped (P3)."""
    from ..functions.columns import json_items, json_size, minutes_between, repair_time
    from .custom import add_custom_columns

    first = F.get(json_items("v_meeting_times"), F.lit(0))
    one = F.when(json_size("v_meeting_times") == 1, first)

    def time(meeting, path: str):
        return repair_time(F.try_variant_get(meeting, path, "string"))
    p = wh("stg_ef3__class_periods").join(wh("dim_school").select("k_school"), "k_school")
    p = p.withColumns({
        "n_meeting_times": json_size("v_meeting_times"),
        "first_start_time": time(first, "$.startTime"), "first_end_time": time(first, "$.endTime"),
        "start_time": time(one, "$.startTime"), "end_time": time(one, "$.endTime")})
    out = p.select("k_class_period", "k_school", "tenant_code", "school_year", "class_period_name", "is_official_attendance_period",
                   "n_meeting_times", "first_start_time", "first_end_time", "start_time", "end_time",
                   minutes_between("first_start_time", "first_end_time").alias("class_duration"),
                   minutes_between("start_time", "end_time").alias("period_duration"))
    return add_custom_columns(wh, "dim_class_period", out, ["k_class_period"])


@dataset("dim_cohort", grain=("k_cohort",))
def dim_cohort(wh) -> DataFrame:
    """P1 projection of cohorts."""
    return wh("stg_ef3__cohorts").select("k_cohort", "k_lea", "k_school", "tenant_code", "school_year", "cohort_id",
                                         "cohort_description", "cohort_type", "cohort_scope")


@dataset("fct_student_cohort_association", grain=("k_student", "k_cohort", "cohort_begin_date"))
def fct_student_cohort_association(wh) -> DataFrame:
    """Student x cohort of known students and cohorts (J1), active flag."""
    from ..functions.columns import iff
    from ..operators.windows import flag_partition_max
    today = wh.config.today()
    s = (wh("stg_ef3__student_cohort_associations").join(wh("dim_student").select("k_student", "k_student_xyear"),
                                                           "k_student")
         .join(wh("dim_cohort").select("k_cohort"), "k_cohort"))
    s = flag_partition_max(s, ["tenant_code"], "school_year", "__latest", few_partitions=True)
    active = F.col("__latest") & (F.col("cohort_begin_date") <= today) & (
        F.col("cohort_end_date").isNull() | (F.col("cohort_end_date") >= today))
    return s.select("k_student", "k_student_xyear", "k_cohort", "tenant_code", "school_year", "cohort_begin_date",
                    "cohort_end_date", iff(active, True, False).alias("is_active_cohort_association"))
