"""Courses, sections, grading periods and grades."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import pack_keys, unpack_keys
from ..operators.joins import seed
from .registry import dataset


@dataset("dim_course", grain=("k_course",))
def dim_course(wh) -> DataFrame:
    """Courses with wide id codes and their subject."""
    from .custom import add_custom_columns
    ids = wh("bld_wide_ids_course").drop("tenant_code", "api_year")
    subject = wh("bld_course_subject").select("k_course", "academic_subject", "subject_array")
    out = (wh("stg_ef3__courses").drop("academic_subject").join(ids, "k_course", "left").join(subject, "k_course", "left")
           .select("k_course", "tenant_code", "school_year", "course_code", "course_title",
                   *[c for c in ids.columns if c != "k_course"], "k_lea", "k_school", "ed_org_id", "ed_org_type",
                   "academic_subject", "subject_array"))
    return add_custom_columns(wh, "dim_course", out, ["k_course"])


@dataset("dim_course_section", grain=("k_course_section",))
def dim_course_section(wh) -> DataFrame:
    """Sections joined to their offering and its course (J1), with the flags and
    the list of their characteristics from all three levels (J2)."""
    from .custom import add_custom_columns
    s = wh("stg_ef3__sections").drop("school_year", "api_year")
    o = wh("stg_ef3__course_offerings").drop("tenant_code", "api_year", "v_course_level_characteristics")
    c = wh("dim_course").select("k_course", "course_code", "course_title", "academic_subject")
    chars = wh("bld_course_char__combined_wide").drop("tenant_code", "api_year")
    flags = [x for x in chars.columns if x not in ("k_course_section", "course_level_characteristics_array")]
    out = (s.join(o, "k_course_offering").join(c, "k_course").join(chars, "k_course_section", "left").select(
        "k_course_section", "k_course", "k_school", "k_session", F.col("k_location").alias("k_classroom"), "tenant_code", "section_id",
        "section_name", "local_course_code", "local_course_title", "course_code", "course_title", "school_year", "session_name",
        "academic_subject", "instructional_time_planned", "is_official_attendance_period", "sequence_of_course",
        *[F.coalesce(f, F.lit(False)).alias(f) for f in flags], "course_level_characteristics_array",
        "educational_environment_type", "available_credits"))
    return add_custom_columns(wh, "dim_course_section", out, ["k_course_section"])


@dataset("dim_grading_period", grain=("k_grading_period",))
def dim_grading_period(wh) -> DataFrame:
    """Grading periods at known schools."""
    g = wh("stg_ef3__grading_periods")
    return g.join(wh("dim_school").select("k_school"), "k_school").select(
        "k_grading_period", "k_school", "tenant_code", "school_year", "grading_period", "begin_date", "end_date",
        "period_sequence")


@dataset("fct_student_grades", grain=("k_student", "k_course_section", "k_grading_period", "grade_type"))
def fct_student_grades(wh) -> DataFrame:
    """Grades of known students, schools, periods and sections (J1), with the
    letter-grade lookup matched case-insensitively (J14).

    The big input (line items x orders) joins the dimensions by key, packed on
    its way; dimensions that are small enough are broadcast by AQE at run time.
    Schools are met by the text of their key: packed, it is planned with 100
    bytes, and all grades would be dealt where the schools could be broadcast.
    """
    from .custom import add_extensions, extension_names
    keys = ["k_student", "k_school", "k_grading_period", "k_course_section"]
    g = add_extensions(wh, "stg_ef3__grades", wh("stg_ef3__grades"))
    g = pack_keys(g.join(wh("dim_school").select("k_school"), "k_school"), *keys)
    stu, gp, sec = (pack_keys(wh(t).select(k), k) for t, k in (
        ("dim_student", "k_student"), ("dim_grading_period", "k_grading_period"), ("dim_course_section", "k_course_section")))
    xw = seed(wh("xwalk_letter_grades"))
    j = g.join(stu, "k_student").join(gp, "k_grading_period").join(sec, "k_course_section")
    j = j.join(xw, F.lower(j.letter_grade_earned) == xw.letter_grade, "left")
    return unpack_keys(j, *keys).select("k_student", "k_course_section", "k_school", "k_grading_period", "grade_type", "tenant_code",
                    "school_year", "letter_grade_earned", "numeric_grade_earned", "unweighted_gpa_points",
                    "exclude_from_gpa", "is_dorf", "grade_sort_index", *extension_names(wh, "stg_ef3__grades"))


@dataset("bld_course_char__combined_long", grain=("k_course_section", "course_level_characteristic"))
def course_char_combined_long(wh) -> DataFrame:
    """Characteristics of the section, its offering and its course
    (JSON lists read by path, flattened with ``explode_outer``), stacked and made
    distinct."""
    from ..functions.columns import descriptor_short, json_items
    sections = wh("stg_ef3__sections").select("tenant_code", "api_year", "k_course_offering", "k_course_section",
                                              F.col("v_course_level_characteristics").alias("list"))
    offerings = wh("stg_ef3__course_offerings").select("tenant_code", "api_year", "k_course", "k_course_offering",
                                                       F.col("v_course_level_characteristics").alias("list"))
    courses = wh("stg_ef3__courses").select("tenant_code", "api_year", "k_course", F.col("v_level_characteristics").alias("list"))
    of_section = sections.select("k_course_offering", "k_course_section")
    of_offering = offerings.select("k_course", "k_course_offering").join(of_section, "k_course_offering").select("k_course", "k_course_section")
    keys = ["tenant_code", "api_year", "k_course_section"]
    stacked = (sections.join(offerings.select("k_course_offering"), "k_course_offering", "left_semi").select(*keys, "list")
               .unionByName(offerings.join(of_section, "k_course_offering").select(*keys, "list"))
               .unionByName(courses.join(of_offering, "k_course").select(*keys, "list")))
    c = stacked.select(*keys, F.explode_outer(json_items("list")).alias("c")).select(
        *keys, descriptor_short(F.try_variant_get("c", "$.courseLevelCharacteristicDescriptor", "string"))
        .alias("course_level_characteristic"))
    return c.filter(F.col("course_level_characteristic").isNotNull()).distinct()


@dataset("bld_course_char__combined_wide", grain=("k_course_section",))
def course_char_combined_wide(wh) -> DataFrame:
    """The sorted list of a section's characteristics and one flag per
    crosswalk indicator, in one aggregate."""
    xw = seed(wh("xwalk_course_level_characteristics"))
    pairs = [(r[0], r[1]) for r in xw.orderBy("indicator_name").collect()]
    name = F.col("course_level_characteristic")
    return wh("bld_course_char__combined_long").groupBy("tenant_code", "api_year", "k_course_section").agg(
        F.sort_array(F.collect_list(name)).alias("course_level_characteristics_array"),
        *[F.max(name == F.lit(value)).alias(flag) for value, flag in pairs])


@dataset("bld_course_subject", grain=("k_course",))
def course_subject(wh) -> DataFrame:
    """The course's single subject, 'Multiple', or the legacy column."""
    from ..functions.columns import single_or_multiple
    from ..operators.sets import sorted_array
    subj = (wh("stg_ef3__courses__academic_subjects").groupBy("k_course")
            .agg(sorted_array("academic_subject").alias("subject_array")))
    c = wh("stg_ef3__courses").select("tenant_code", "api_year", "k_course", "academic_subject")
    return c.join(subj, "k_course", "left").select(
        "tenant_code", "api_year", "k_course", "subject_array",
        F.coalesce(single_or_multiple("subject_array"), F.col("academic_subject")).alias("academic_subject"))


@dataset("bld_wide_ids_course", grain=("tenant_code", "api_year", "k_course"))
def wide_ids_course(wh) -> DataFrame:
    """Course identification codes pivoted to ``{id_name}_course_code``."""
    from ..operators.reshape import crosswalk_values, pivot_values
    xw = seed(wh("xwalk_id_types_course"))
    ids = wh("stg_ef3__courses__identification_codes").join(xw, "id_system")
    return pivot_values(ids, ["tenant_code", "api_year", "k_course"], "id_name", crosswalk_values(xw, "id_name"),
                        "id_code", agg="min", suffix="_course_code")


@dataset("brg_course_section_program", grain=("k_course_section", "k_program"))
def brg_course_section_program(wh) -> DataFrame:
    """Section <-> program pairs where both exist."""
    b = wh("stg_ef3__sections__programs")
    return (b.join(wh("dim_course_section").select("k_course_section"), "k_course_section")
            .join(wh("dim_program").select("k_program"), "k_program")
            .select("k_course_section", "k_program", "tenant_code"))
