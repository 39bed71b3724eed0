"""Student school enrollments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import iff, not_in
from ..functions.dates import within_end_date
from ..operators.joins import seed
from ..operators.windows import flag_partition_max
from .registry import dataset


@dataset("fct_student_school_association", grain=("k_student", "k_school", "entry_date"))
def fct_student_school_association(wh) -> DataFrame:
    """Valid enrollments with calendar fallback, active flag and latest-entry flag.

    * calendar: the enrollment's own, else the school's only calendar for the
      year (J17: filled only when unambiguous);
    * windows: first/last school day matched null-safely on the *un-filled*
      calendar (P17), so fallback rows match the school-level window;
    * active: latest school year of the tenant (aggregate + broadcast, a tenant
      is a hot key), entered by the run date and not yet exited (P12);
    * filters: exit on/after first school day (P12), exit >= entry, withdraw
      code not excluded (P10 with the explicit NULL guard).
    """
    cfg = wh.config
    today = cfg.today()
    stg = wh("stg_ef3__student_school_associations")
    stu = wh("dim_student").select("k_student", "k_student_xyear", F.col("school_year").alias("__stu_year"))
    sch = wh("dim_school").select("k_school", "k_lea")
    cal = wh("dim_school_calendar").select(F.col("k_school_calendar").alias("__cal_own"))
    dsc = wh("dim_school_calendar").select("k_school", "school_year", "k_school_calendar")
    n_cal = dsc.groupBy("k_school", "school_year").agg(F.count(F.lit(1)).alias("__n"),
                                                       F.min("k_school_calendar").alias("__cal_single"))
    single = n_cal.filter(F.col("__n") == 1).drop("__n")
    win = wh("bld_school_calendar_windows").select(
        F.col("k_school").alias("__w_school"), F.col("school_year").alias("__w_year"),
        F.col("k_school_calendar").alias("__w_cal"), "first_school_day", "last_school_day")
    grades = seed(wh("xwalk_grade_levels"))

    e = (stg.join(stu, "k_student").join(sch, "k_school")
         .join(cal, stg.k_school_calendar == cal.__cal_own, "left")
         .join(single, ["k_school", "school_year"], "left"))
    e = e.join(win, (e.k_school == win.__w_school) & (e.school_year == win.__w_year)
               & e.__cal_own.eqNullSafe(win.__w_cal), "left")
    e = e.join(grades, e.entry_grade_level == grades.grade_level, "left")

    # filters
    if cfg.exclude_exit_before_first_day:
        e = e.filter(within_end_date("first_school_day", "exit_withdraw_date", cfg.first_day_inclusive)
                     | F.col("first_school_day").isNull())
    e = e.filter(F.col("exit_withdraw_date").isNull() | (F.col("exit_withdraw_date") >= F.col("entry_date")))
    if cfg.exclude_withdraw_codes:
        e = e.filter(not_in("exit_withdraw_type", cfg.exclude_withdraw_codes) | F.col("exit_withdraw_type").isNull())
    if cfg.exclude_cross_year_enrollments:
        e = e.filter(F.col("__stu_year") == F.col("school_year"))

    # W7 over the tenant: aggregate + broadcast, never a window over a tenant
    e = flag_partition_max(e, ["tenant_code"], "school_year", "__is_latest_year", few_partitions=True)
    not_exited = within_end_date(today, "exit_withdraw_date", cfg.exit_withdraw_date_inclusive)
    if cfg.year_end_active_buffer_days is not None:
        cutoff = F.date_add(F.col("last_school_day"), -cfg.year_end_active_buffer_days)
        not_exited = not_exited | ((F.col("exit_withdraw_date") >= cutoff)
                                   & (F.year("last_school_day") == F.year(today)))
    active = F.col("__is_latest_year") & (F.col("entry_date") <= today) & not_exited
    latest_entry = F.col("entry_date") == F.max("entry_date").over(Window.partitionBy("k_student", "k_school"))
    return e.select(
        "k_student", "k_student_xyear", "k_lea", "k_school",
        F.coalesce(F.col("__cal_own"), F.col("__cal_single")).alias("k_school_calendar"),
        "tenant_code", "school_year", "entry_date", "exit_withdraw_date", "is_primary_school", "enrollment_type",
        iff(active, True, False).alias("is_active_enrollment"),
        "entry_grade_level", "grade_level_integer", "exit_withdraw_type",
        latest_entry.alias("is_latest_annual_entry"),
    )
