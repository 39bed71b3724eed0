"""Smaller dimensions and builds: classrooms, graduation plans, learning
standards and their grades, cohort years, primary disability, district ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedupe import first_by
from ..operators.joins import seed
from ..operators.reshape import crosswalk_values, pivot_values
from ..operators.sets import sorted_struct_array
from .registry import dataset


@dataset("dim_classroom", grain=("k_classroom",))
def dim_classroom(wh) -> DataFrame:
    """Rooms at known schools."""
    loc = wh("stg_ef3__locations")
    return loc.join(wh("dim_school").select("k_school"), "k_school").select(
        F.col("k_location").alias("k_classroom"), "k_school", "tenant_code", "classroom_id_code", "maximum_seating")


@dataset("dim_graduation_plan", grain=("k_graduation_plan",))
def dim_graduation_plan(wh) -> DataFrame:
    """Projection with the JSON requirement list passed through."""
    return wh("stg_ef3__graduation_plans")


@dataset("dim_learning_standard", grain=("k_learning_standard",))
def dim_learning_standard(wh) -> DataFrame:
    return wh("stg_ef3__learning_standards")


@dataset("fct_student_learning_standard_grades",
         grain=("k_student", "k_school", "k_course_section", "k_grading_period", "k_learning_standard", "grade_type"))
def fct_student_learning_standard_grades(wh) -> DataFrame:
    """J1 x 5: standard-level grades of known students, schools, sections, periods and standards."""
    g = wh("stg_ef3__grades__learning_standards")
    return (g.join(wh("dim_student").select("k_student"), "k_student")
            .join(wh("dim_school").select("k_school"), "k_school")
            .join(wh("dim_course_section").select("k_course_section"), "k_course_section")
            .join(wh("dim_grading_period").select("k_grading_period"), "k_grading_period")
            .join(wh("dim_learning_standard").select("k_learning_standard"), "k_learning_standard"))


@dataset("bld_student_cohort_years", grain=("k_student",))
def student_cohort_years(wh) -> DataFrame:
    """Array of {type, year, term} objects per student."""
    c = wh("stg_ef3__stu_ed_org__cohort_years")
    return c.groupBy("tenant_code", "api_year", "k_student").agg(
        sorted_struct_array("cohort_year_type", "school_year", "academic_term").alias("cohort_year_array"))


@dataset("bld_student_program__special_education__primary_disability", grain=("k_student_program",))
def primary_disability(wh) -> DataFrame:
    """The first-order disability, first by type when several."""
    d = wh("stg_ef3__stu_spec_ed__disabilities").filter(F.col("order_of_disability") == 1)
    return first_by(d, ["k_student_program"], [
        ("disability_type", "asc nulls last"), ("disability_source_type", "asc nulls last")]).select(
        "tenant_code", "school_year", "k_student_program", "k_student", "k_student_xyear", "k_program", "k_lea", "k_school",
        "program_enroll_begin_date", "disability_type", "disability_source_type", "disability_diagnosis", "order_of_disability")


@dataset("bld_wide_ids_lea", grain=("tenant_code", "api_year", "k_lea"))
def wide_ids_lea(wh) -> DataFrame:
    """District identification codes pivoted to ``{id_name}_lea_code``."""
    xw = seed(wh("xwalk_id_types_ed_org"))
    ids = (wh("stg_ef3__local_education_agencies__identification_codes").join(xw, "id_system")
           .join(wh("dim_lea").select("k_lea"), "k_lea"))
    return pivot_values(ids, ["tenant_code", "api_year", "k_lea"], "id_name", crosswalk_values(xw, "id_name"),
                        "id_code", agg="min", suffix="_lea_code")
