"""Attendance: events per day, the daily attendance fact and annual measures.

Scale notes
-----------
* The daily fact is an expansion join (enrollment x school day).  It is
  equi-joined on ``k_school_calendar``; the calendar side is one row per
  school day, so AQE broadcasts it when it is small and otherwise the
  sort-merge join has skew splitting for a calendar that holds many students.
* The day's event is attached by a window, not a join: day rows and event
  rows are unioned and shuffled ONCE on (k_student, k_school); the event
  lookup, dedupe, streaks and cumulatives all partition by that key or a
  superset, so they share the one exchange (checked with ``explain``).  No
  window partition is larger than the days of one student at one school.
* The fill session is resolved per calendar day (dimension-sized), so the
  big table never shuffles on the school key alone.
* Band labels are a generated CASE over the seed, not a nested-loop join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import day_count_in_range, within_end_date
from ..functions.metrics import band_lookup, chronic_absentee, rate_pct
from ..operators.dedupe import first_along, first_by
from ..operators.joins import seed
from ..operators.windows import partition_sum, running_sum, streaks
from ..sources.seeds import ABSENTEE_CATEGORIES
from .registry import dataset


@dataset("fct_student_school_attendance_event", grain=("k_student", "k_school", "k_calendar_date"))
def fct_student_school_attendance_event(wh) -> DataFrame:
    """Attendance events mapped to a calendar day through the enrollment they
    fall in (J9, P12 with run-date coalesce), one per day by the longest
    enrollment (P13, R1)."""
    cfg = wh.config
    today = cfg.today()
    ev = wh("stg_ef3__student_school_attendance_events")
    stu = wh("dim_student").select("k_student", "k_student_xyear")
    sch = wh("dim_school").select("k_school")
    ses = wh("dim_session").select("k_session")
    enr = wh("fct_student_school_association").select(
        "k_student", "k_school", "k_school_calendar", "entry_date", "exit_withdraw_date",
        day_count_in_range("entry_date", "exit_withdraw_date", today, cfg.exit_withdraw_date_inclusive)
        .alias("enrollment_length"))
    cd = wh("dim_calendar_date").select("k_calendar_date", F.col("k_school_calendar").alias("__cd_cal"),
                                        "calendar_date")
    xw = seed(wh("xwalk_attendance_events"))
    excusal = F.expr(cfg.excusal_status_expr) if cfg.excusal_status_expr else F.col("attendance_excusal_status")

    j = ev.join(stu, "k_student").join(sch, "k_school").join(ses, "k_session").join(enr, ["k_student", "k_school"])
    j = j.join(cd, (j.k_school_calendar == cd.__cd_cal) & (j.attendance_event_date == cd.calendar_date)
               & (cd.calendar_date >= j.entry_date)
               & within_end_date(cd.calendar_date, j.exit_withdraw_date, coalesce_to=today))
    j = j.join(xw, j.attendance_event_category == xw.attendance_event_descriptor)
    j = j.withColumn("attendance_excusal_status", excusal)
    d = first_by(j, ["k_student", "k_school", "k_calendar_date"], [
        ("enrollment_length", "desc nulls first"), ("entry_date", "desc nulls first"), ("exit_withdraw_date", "desc nulls first"),
        # tie-break so the kept event is deterministic
        ("attendance_event_category", "asc nulls last"), ("k_session", "asc nulls last"),
        ("attendance_event_reason", "asc nulls last"), ("event_duration", "asc nulls last"), ("arrival_time", "asc nulls last")])
    return d.select("k_student", "k_student_xyear", "k_school", "k_calendar_date", "k_session", "tenant_code",
                    "school_year", "calendar_date", "attendance_event_category", "attendance_event_reason",
                    "is_absent", "attendance_excusal_status", "event_duration", "school_attendance_duration",
                    "arrival_time", "departure_time", "educational_environment")


@dataset("bld_attendance_sessions", grain=("k_school", "k_session"))
def attendance_sessions(wh) -> DataFrame:
    """Distinct (school, session) pairs attendance events actually use."""
    ev = wh(wh.config.daily_attendance_source).select("k_school", "k_session", "tenant_code")
    ses = wh("dim_session").select("k_session", "session_begin_date", "session_end_date", "total_instructional_days")
    return ev.join(ses, "k_session").select(
        "k_school", "k_session", "tenant_code", "session_begin_date", "session_end_date",
        "total_instructional_days").distinct()


@dataset("fct_student_daily_attendance", grain=("k_student", "k_school", "calendar_date"))
def fct_student_daily_attendance(wh) -> DataFrame:
    """One row per student, school and school day from entry on (the flagship).

    Steps: last submitted day per school-year; calendar end; attendance
    calendar; expansion by enrollment (J10); fill from events, else the
    school's session covering the day (J6); dedupe (R1); streaks (W4);
    cumulatives (W5/W6); chronic flag (P14); band label (J7).
    """
    cfg = wh.config
    today = cfg.today()
    att = wh(cfg.daily_attendance_source)
    cal = wh("dim_calendar_date").select("k_calendar_date", "k_school_calendar", "k_school", "school_year",
                                         "calendar_date", "is_school_day")
    cal_days = cal.select("k_calendar_date", "k_school", "school_year", "calendar_date")

    submitted = (att.select("k_calendar_date").distinct().join(cal_days, "k_calendar_date")
                 .groupBy("k_school", "school_year").agg(F.max("calendar_date").alias("max_date_by_school")))
    cal_end = cal.groupBy("k_school", "school_year").agg(F.max("calendar_date").alias("max_calendar_date"))
    att_cal = (cal.join(submitted, ["k_school", "school_year"]).join(cal_end, ["k_school", "school_year"])
               .filter(F.col("is_school_day")
                       & (((F.col("calendar_date") <= today) & (F.col("calendar_date") <= F.col("max_date_by_school")))
                          | (F.col("max_calendar_date") <= today)))
               .select("k_school_calendar", "k_school", "k_calendar_date", "school_year", "calendar_date"))

    # fill session per calendar day: the covering session with the fewest
    # instructional days (then lowest key) among sessions the school's events
    # use.  Dimension-sized (calendar days x sessions of one school).
    fill = wh("bld_attendance_sessions").select(
        F.col("k_school").alias("__f_school"), F.col("k_session").alias("__f_session"),
        "session_begin_date", "session_end_date", F.col("total_instructional_days").alias("__f_days"))
    cal_fill = att_cal.join(
        fill, (att_cal.k_school == fill.__f_school)
        & att_cal.calendar_date.between(fill.session_begin_date, fill.session_end_date), "left")
    cal_fill = first_by(cal_fill, ["k_calendar_date"], [("__f_days", "asc nulls last"), ("__f_session", "asc nulls last")])
    cal_fill = cal_fill.select("k_school_calendar", "k_calendar_date", "school_year", "calendar_date",
                               "__f_session", "__f_days")

    enr = wh("fct_student_school_association").select(
        "k_student", "k_student_xyear", "k_school", "tenant_code", "entry_date", "exit_withdraw_date",
        "k_school_calendar")
    days = (enr.join(cal_fill, "k_school_calendar")
            .filter(F.col("calendar_date") >= F.col("entry_date")).drop("k_school_calendar"))

    # Attach the day's event with a window instead of a join: events are unique
    # per (student, school, day), so after ONE exchange on (k_student, k_school)
    # the event lookup, the dedupe, the streaks and the cumulatives all run in
    # the same stage.
    ses = wh("dim_session").select(F.col("k_session").alias("__ev_session"),
                                   F.col("total_instructional_days").alias("__ev_days"))
    ev = (att.select("k_student", "k_school", "calendar_date", "k_calendar_date", F.col("k_session").alias("__ev_session"),
                     "attendance_event_category", "attendance_event_reason", "is_absent",
                     "attendance_excusal_status", "event_duration", "school_attendance_duration")
          .join(ses, "__ev_session", "left"))
    ev_fields = ["__ev_days", "attendance_event_category", "__ev_session", "attendance_event_reason",
                 "event_duration", "is_absent", "attendance_excusal_status", "school_attendance_duration"]
    both = days.withColumn("__is_day", F.lit(True)).unionByName(
        ev.withColumn("__is_day", F.lit(False)), allowMissingColumns=True)
    both = both.repartition("k_student", "k_school")
    # one sort by student, school and day serves this, the dedupe, the streaks and the running totals
    w_day = Window.partitionBy("k_student", "k_school", "calendar_date", "k_calendar_date")
    picked = F.min(F.when(~F.col("__is_day"), F.struct(*ev_fields))).over(w_day)
    filled = both.withColumn("__ev", picked).filter(F.col("__is_day"))
    filled = filled.select(*[c for c in days.columns], *[F.col(f"__ev.{c}").alias(c) for c in ev_fields])

    enrolled = within_end_date("calendar_date", "exit_withdraw_date", cfg.exit_withdraw_date_inclusive)
    absent = F.col("is_absent")
    zero = F.lit(0).cast("decimal(3,2)")
    one = F.lit(1).cast("decimal(3,2)")
    rows = filled.select(
        "k_student", "k_student_xyear", "k_school", "k_calendar_date", "school_year",
        F.coalesce("__ev_session", "__f_session").alias("k_session"),
        F.coalesce("__ev_days", "__f_days").alias("total_instructional_days"),
        "tenant_code", "calendar_date", "attendance_event_reason",
        F.when(enrolled, one).otherwise(zero).alias("is_enrolled"),
        F.when(~enrolled, F.lit("Not Enrolled"))
         .otherwise(F.coalesce("attendance_event_category", F.lit(cfg.in_attendance_code)))
         .alias("attendance_event_category"),
        F.coalesce(F.when(enrolled, absent).otherwise(zero), zero).alias("is_absent"),
        (one - F.coalesce(F.when(enrolled, absent).otherwise(one), zero)).alias("is_present"),
        F.when(~enrolled, F.lit("Not Enrolled"))
         .when(F.coalesce(absent, zero) == 0, F.lit("Not Absent"))
         .otherwise(F.coalesce("attendance_excusal_status", F.lit("Unknown Excusal Status")))
         .alias("attendance_excusal_status"),
        "event_duration", "school_attendance_duration",
    )
    rows = first_along(rows, ["k_student", "k_school", "calendar_date"], [
        ("is_enrolled", "desc nulls first"), ("total_instructional_days", "asc nulls last"),
        ("attendance_event_category", "asc nulls last"), ("k_session", "asc nulls last"),
        ("attendance_event_reason", "asc nulls last"), ("event_duration", "asc nulls last")], "k_calendar_date")
    key = ["k_student", "k_school"]
    rows = streaks(rows, key, "attendance_excusal_status", "calendar_date", "consecutive_days_by_excusal_status")
    rows = (rows
            .withColumn("total_days_enrolled", partition_sum("is_enrolled", key))
            .withColumn("cumulative_days_absent", running_sum("is_absent", key, "calendar_date"))
            .withColumn("cumulative_days_attended", running_sum("is_present", key, "calendar_date"))
            .withColumn("cumulative_days_enrolled", running_sum("is_enrolled", key, "calendar_date")))
    rate = rate_pct("cumulative_days_attended", "cumulative_days_enrolled")
    rows = rows.withColumn("cumulative_attendance_rate", rate)
    return _labels(rows, "cumulative_attendance_rate", "cumulative_days_enrolled", cfg).select(
        "k_student", "k_student_xyear", "k_school", "k_calendar_date", "school_year", "calendar_date",
        "k_session", "tenant_code", "attendance_event_category", "attendance_event_reason", "is_absent",
        "is_present", "is_enrolled", "attendance_excusal_status", "consecutive_days_by_excusal_status",
        "total_days_enrolled", "cumulative_days_absent", "cumulative_days_attended", "cumulative_days_enrolled",
        "cumulative_attendance_rate", "meets_enrollment_threshold", "is_chronic_absentee",
        "event_duration", "school_attendance_duration", "absentee_category_rank", "absentee_category_label")


def _labels(df: DataFrame, rate: str, enrolled: str, cfg) -> DataFrame:
    meets = F.col(enrolled) >= cfg.chronic_absence_min_days
    df = (df.withColumn("meets_enrollment_threshold", meets)
          .withColumn("is_chronic_absentee", chronic_absentee(rate, enrolled, cfg.chronic_absence_threshold,
                                                              cfg.chronic_absence_min_days)))
    return (df.withColumn("absentee_category_rank",
                          F.when(meets, band_lookup(rate, ABSENTEE_CATEGORIES, 0)).cast("int"))
            .withColumn("absentee_category_label",
                        F.when(meets, band_lookup(rate, ABSENTEE_CATEGORIES, 1)).cast("string")))


@dataset("msr_student_cumulative_attendance", grain=("k_student", "k_school", "school_year"))
def msr_student_cumulative_attendance(wh) -> DataFrame:
    """Annual totals, rate, chronic flag and band."""
    cfg = wh.config
    daily = wh("fct_student_daily_attendance")
    cd = wh("dim_calendar_date").select("k_calendar_date", F.col("school_year").alias("__cal_year"))
    a = (daily.drop("school_year").join(cd, "k_calendar_date")
         .groupBy("k_student", "k_student_xyear", "k_school", F.col("__cal_year").alias("school_year"))
         .agg(F.min("tenant_code").alias("tenant_code"),  # A4 any_value, made deterministic
              F.sum("is_absent").alias("days_absent"),
              F.sum("is_present").alias("days_attended"),
              F.sum("is_enrolled").alias("days_enrolled")))
    a = a.withColumn("attendance_rate", rate_pct("days_attended", "days_enrolled"))
    return _labels(a, "attendance_rate", "days_enrolled", cfg)


@dataset("fct_student_section_attendance_event",
         grain=("k_student", "k_course_section", "attendance_event_category", "attendance_event_date"))
def fct_student_section_attendance_event(wh) -> DataFrame:
    """Section events of known students and sections (J1) whose code the
    absence lookup knows (J2)."""
    e = wh("stg_ef3__student_section_attendance_events")
    xw = seed(wh("xwalk_attendance_events"))
    j = (e.join(wh("dim_student").select("k_student", "k_student_xyear"), "k_student")
         .join(wh("dim_course_section").select("k_course_section", "k_school"), "k_course_section")
         .join(xw, e.attendance_event_category == xw.attendance_event_descriptor))
    return j.select("k_student", "k_student_xyear", "k_course_section", "k_school", "tenant_code", "school_year",
                    "attendance_event_date", "attendance_event_category", "attendance_event_reason", "is_absent",
                    "attendance_excusal_status")
