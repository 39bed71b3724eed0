"""Documented analyst queries over the finished star (Q1-Q10).

Inputs are read as tables (``wh.table``), the way an analyst queries the
materialized warehouse.  All run over every school, year and subgroup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import pack_keys, unpack_keys
from ..functions.metrics import rate_pct


def q1_students_by_subgroup(wh) -> DataFrame:
    """Q1: distinct students by school, year and subgroup."""
    e = wh.table("fct_student_school_association").select("k_student", "k_school", "school_year")
    s = wh.table("fct_student_subgroup").select("k_student", "k_subgroup")
    d = wh.table("dim_school").select("k_school", "school_id", "school_name")
    g = wh.table("dim_subgroup").select("k_subgroup", "subgroup_category", "subgroup_value")
    return (e.join(s, "k_student").join(d, "k_school").join(g, "k_subgroup")
            .groupBy("k_school", "school_id", "school_name", "school_year", "k_subgroup", "subgroup_category",
                     "subgroup_value")
            .agg(F.countDistinct("k_student").alias("total_unique_students")))


def q2_attendance_rate_by_subgroup(wh) -> DataFrame:
    """Q2: attendance rate by school, year and subgroup (ratio of sums, A18)."""
    a = wh.table("msr_student_cumulative_attendance").select("k_student", "k_school", "school_year",
                                                             "days_attended", "days_enrolled")
    s = wh.table("fct_student_subgroup").select("k_student", "k_subgroup")
    d = wh.table("dim_school").select("k_school", "school_id", "school_name")
    g = wh.table("dim_subgroup").select("k_subgroup", "subgroup_category", "subgroup_value")
    out = (a.join(s, "k_student").join(d, "k_school").join(g, "k_subgroup")
           .groupBy("k_school", "school_id", "school_name", "school_year", "k_subgroup", "subgroup_category",
                    "subgroup_value")
           .agg(F.sum("days_attended").alias("total_days_attended"),
                F.sum("days_enrolled").alias("total_days_enrolled"),
                F.countDistinct("k_student").alias("total_unique_students")))
    return out.withColumn("attendance_rate", rate_pct("total_days_attended", "total_days_enrolled"))


def q3_active_students_by_grade(wh) -> DataFrame:
    """Q3: distinct actively enrolled students per entry grade."""
    e = wh.table("fct_student_school_association").filter(F.col("is_active_enrollment"))
    return e.groupBy("entry_grade_level").agg(F.countDistinct("k_student").alias("n_students"))


def q4_enrolled_in_february(wh) -> DataFrame:
    """Q4: students enrolled at some point in February of each school year."""
    e = wh.table("fct_student_school_association")
    feb1 = F.make_date("school_year", F.lit(2), F.lit(1))
    mar1 = F.make_date("school_year", F.lit(3), F.lit(1))
    e = e.filter((F.col("entry_date") < mar1)
                 & ((F.col("exit_withdraw_date") >= feb1) | F.col("exit_withdraw_date").isNull()))
    return e.groupBy("school_year").agg(F.countDistinct("k_student").alias("n_students"))


def q5_discipline_counts(wh) -> DataFrame:
    """Q5: discipline actions by school, date and action type."""
    a = wh.table("fct_student_discipline_actions")
    counts = a.groupBy("k_school", "discipline_date", "discipline_action", "is_iss", "is_oss").agg(
        F.count(F.lit(1)).alias("n_actions"))
    d = wh.table("dim_school").select("k_school", "school_id", "school_name")
    return counts.join(d, "k_school").select("school_id", "school_name", "discipline_date", "discipline_action",
                                             "is_iss", "is_oss", "n_actions")


def q6_suspension_rate(wh) -> DataFrame:
    """Q6: suspension rate per school and year.  Each student is assigned to
    their longest primary enrollment (W1), actions are left-joined on student
    and school (J2), suspensions counted (A5) and rated (A18)."""
    from ..operators.dedupe import deduplicate
    e = wh.table("fct_student_school_association").filter(F.col("is_primary_school"))
    inferred = F.coalesce(F.col("exit_withdraw_date"), F.make_date("school_year", F.lit(6), F.lit(30)))
    e = e.withColumn("n_days_enrolled", F.datediff(inferred, F.col("entry_date")))
    e = deduplicate(e, ["k_student"], [F.col("n_days_enrolled").desc_nulls_first(),
                                       F.col("exit_withdraw_date").desc_nulls_first(), F.col("k_school").asc()])
    a = wh.table("fct_student_discipline_actions").select("k_student", "k_school", "is_oss", "is_iss")
    j = e.select("k_student", "k_school", "school_year").join(a, ["k_student", "k_school"], "left")
    per = j.groupBy("k_student", "k_school", "school_year").agg(
        F.sum(F.coalesce(F.col("is_oss").cast("int"), F.lit(0))).alias("n_oss"),
        F.sum(F.coalesce(F.col("is_iss").cast("int"), F.lit(0))).alias("n_iss"))
    per = per.withColumn("has_any_suspension", (F.col("n_oss") + F.col("n_iss")) > 0)
    out = per.groupBy("k_school", "school_year").agg(
        F.sum(F.col("has_any_suspension").cast("int")).alias("n_students_suspended"),
        F.count(F.lit(1)).alias("n_students_enrolled"))
    return out.withColumn("suspension_rate", rate_pct("n_students_suspended", "n_students_enrolled"))


def q9_program_enrollments_with_services(wh) -> DataFrame:
    """Q9: program enrollments (J1 to programs) with their services."""
    a = wh.table("fct_student_program_association")
    p = wh.table("dim_program").select("k_program", "program_type", "program_id", "program_name")
    s = wh.table("fct_student_program_service").select(
        "k_student", "k_program", "program_enroll_begin_date", "program_service", "service_begin_date",
        "service_end_date")
    return (a.join(p, "k_program").join(s, ["k_student", "k_program", "program_enroll_begin_date"], "left")
            .select("k_student", "school_year", "k_program", "program_type", "program_id", "program_name",
                    "program_enroll_begin_date", "program_enroll_end_date", "program_service",
                    "service_begin_date", "service_end_date"))


def q10_other_result_score(wh) -> DataFrame:
    """Q10: one named score pulled out of the other-results map (F23), as an integer."""
    a = wh.table("fct_student_assessment")
    return a.select("k_student_assessment", "k_student", "school_year",
                    F.try_element_at("v_other_results", F.lit("Percentile")).try_cast("int").alias("percentile"))


def q7_latest_staff_assignment(wh) -> DataFrame:
    """Q7: each active staff member's most recent school assignment (W1) with
    school and e-mail (J1)."""
    from ..operators.dedupe import deduplicate
    a = wh.table("fct_staff_school_association").filter(F.col("is_active_assignment"))
    a = deduplicate(a, ["k_staff"], [F.col("end_date").desc_nulls_first(), F.col("begin_date").desc_nulls_first(),
                                     F.col("order_of_assignment").asc_nulls_last(), F.col("k_school").asc_nulls_last(),
                                     F.col("program_assignment").asc_nulls_last()])
    st = wh.table("dim_staff").select("k_staff", "staff_unique_id", "email_address", "display_name")
    sc = wh.table("dim_school").select("k_school", "school_id", "school_name")
    return a.join(st, "k_staff").join(sc, "k_school").select(
        "staff_unique_id", "email_address", "display_name", "school_id", "school_name", "position_title",
        "staff_classification", "begin_date", "end_date")


def with_latest_student(wh, rows: DataFrame) -> DataFrame:
    """Rows of any year with their student's latest dimension row.  Keys
    are packed on their way through the join."""
    keys = [c for c in rows.columns if c.startswith("k_")]
    s = (wh.table("dim_student").filter(F.col("is_latest_record"))
         .select("k_student_xyear", F.col("k_student").alias("latest_k_student"), "display_name", "grade_level"))
    j = pack_keys(rows, *keys).join(pack_keys(s, "k_student_xyear", "latest_k_student"), "k_student_xyear", "left")
    return unpack_keys(j, *keys, "latest_k_student")


def q8_gpa_with_latest_student(wh) -> DataFrame:
    """Q8: GPA rows of all years with the student as last known."""
    return with_latest_student(wh, wh.table("fct_student_gpa").select(
        "k_student_academic_record", "k_student_xyear", "school_year", "academic_term", "gpa_type", "gpa_value"))


def q8_transcripts_with_latest_student(wh) -> DataFrame:
    """Q8: transcript rows of all years with the student as last known."""
    return with_latest_student(wh, wh.table("fct_course_transcripts").select(
        "k_course", "k_student_academic_record", "k_student_xyear", "school_year", "academic_term", "course_title",
        "course_attempt_result", "earned_credits", "final_letter_grade_earned"))


def q8_records_with_latest_student(wh) -> DataFrame:
    """Q8: academic records of all years with the student as last known."""
    return with_latest_student(wh, wh.table("fct_student_academic_record").select(
        "k_student_academic_record", "k_student_xyear", "school_year", "academic_term", "cumulative_earned_credits"))


QUERIES = {
    "q1_students_by_subgroup": q1_students_by_subgroup,
    "q2_attendance_rate_by_subgroup": q2_attendance_rate_by_subgroup,
    "q3_active_students_by_grade": q3_active_students_by_grade,
    "q4_enrolled_in_february": q4_enrolled_in_february,
    "q5_discipline_counts": q5_discipline_counts,
    "q6_suspension_rate": q6_suspension_rate,
    "q7_latest_staff_assignment": q7_latest_staff_assignment,
    "q8_gpa_with_latest_student": q8_gpa_with_latest_student,
    "q8_transcripts_with_latest_student": q8_transcripts_with_latest_student,
    "q8_records_with_latest_student": q8_records_with_latest_student,
    "q9_program_enrollments_with_services": q9_program_enrollments_with_services,
    "q10_other_result_score": q10_other_result_score,
}
