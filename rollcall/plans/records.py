"""Academic records, GPAs and diplomas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import pack_keys, unpack_keys
from ..operators.dedupe import first_by
from ..operators.sets import union_all
from ..operators.windows import count_per
from .checks import check
from .registry import dataset


@dataset("fct_student_academic_record", grain=("k_student_academic_record",))
def fct_student_academic_record(wh) -> DataFrame:
    """All records kept; ``k_student`` is NULL when the student has no
    dimension row that year (J2); district filled from the school (F17)."""
    r = wh("stg_ef3__student_academic_records")
    sch = wh("dim_school").select(F.col("k_school").alias("__s"), F.col("k_lea").alias("__school_lea"))
    stu = wh("dim_student").select(F.col("k_student").alias("__k_student"), F.col("k_student_xyear").alias("__x"),
                                   F.col("school_year").alias("__y"))
    j = (r.join(sch, r.k_school == sch.__s, "left")
         .join(stu, (r.k_student_xyear == stu.__x) & (r.school_year == stu.__y), "left"))
    return j.select("k_student_academic_record", F.col("__k_student").alias("k_student"), "k_student_xyear",
                    F.coalesce("k_lea", "__school_lea").alias("k_lea"), "k_school", "tenant_code", "school_year",
                    "academic_term", "cumulative_earned_credits")


@dataset("bld_combine_gpas", grain=("k_student_academic_record", "gpa_type"))
def combine_gpas(wh) -> DataFrame:
    """Current GPA rows, plus legacy cumulative and session GPA columns
    as rows with fixed labels (NULL legacy values are kept)."""
    cur = wh("stg_ef3__student_academic_records__gpas").select(
        "tenant_code", "api_year", "k_student_academic_record", "gpa_type", "gpa_value", "is_cumulative",
        "max_gpa_value")
    old = wh("stg_ef3__student_academic_records")
    base = ["tenant_code", "api_year", "k_student_academic_record"]
    cum = old.select(*base, F.lit("Cumulative, unknown weighting").alias("gpa_type"),
                     F.col("cumulative_gpa").alias("gpa_value"), F.lit(True).alias("is_cumulative"),
                     F.lit(None).cast("double").alias("max_gpa_value"))
    ses = old.select(*base, F.lit("Non-cumulative, unknown weighting").alias("gpa_type"),
                     F.col("session_gpa").alias("gpa_value"), F.lit(False).alias("is_cumulative"),
                     F.lit(None).cast("double").alias("max_gpa_value"))
    return union_all([cur, cum, ses])


@dataset("fct_student_gpa", grain=("k_student_academic_record", "gpa_type"))
def fct_student_gpa(wh) -> DataFrame:
    """GPAs of known academic records."""
    g = wh("bld_combine_gpas").drop("tenant_code", "api_year")
    r = wh("fct_student_academic_record").select("k_student_academic_record", "k_student", "k_student_xyear",
                                                 "k_lea", "k_school", "tenant_code", "school_year", "academic_term")
    return g.join(r, "k_student_academic_record")


def _diplomas(wh) -> DataFrame:
    d = wh("stg_ef3__student_academic_records__diplomas").drop("tenant_code")
    r = wh.table("fct_student_academic_record").select(
        "k_student_academic_record", "tenant_code", "k_student", "k_student_xyear", "k_lea", "k_school", "school_year",
        "academic_term")
    terms = F.lit(1)
    if wh.config.academic_terms:
        terms = F.lit(None).cast("int")
        for term, place in wh.config.academic_terms:
            terms = F.when(F.col("academic_term") == term, F.lit(place)).otherwise(terms)
    return d.join(r, "k_student_academic_record").withColumn("sort_index", terms)


_DIPLOMA_KEY = ["k_student", "k_student_xyear", "school_year", "k_lea", "k_school", "diploma_type", "diploma_award_date"]


@dataset("fct_student_diploma", grain=tuple(_DIPLOMA_KEY))
def fct_student_diploma(wh) -> DataFrame:
    """One diploma per student, year, organization, type and date: that of
    the first academic term, by the configured order if there is one (P3: term
    and order dropped from the output)."""
    d = first_by(_diplomas(wh), _DIPLOMA_KEY, _term_order(wh))
    return d.drop("academic_term", "sort_index")


def _term_order(wh) -> list[tuple[str, str]]:
    by = "sort_index" if wh.config.academic_terms else "academic_term"
    return [(by, "asc nulls last"), ("k_student_academic_record", "asc nulls last")]


@check("d27_diploma_record_duplicates")
def diploma_record_duplicates(wh) -> DataFrame:
    """Diplomas sharing the fact's key, marking the row the fact keeps."""
    from ..operators.dedupe import flag_first
    d = count_per(_diplomas(wh), _DIPLOMA_KEY, "n_duplicates")
    order = [F.col(c).asc_nulls_last() for c, _ in _term_order(wh)]
    return flag_first(d, "is_kept_in_fct_student_diploma", _DIPLOMA_KEY, order).filter(F.col("n_duplicates") > 1).drop("sort_index")


@dataset("fct_course_transcripts", grain=("k_course", "k_student_academic_record", "course_attempt_result"))
def fct_course_transcripts(wh) -> DataFrame:
    """Transcript rows of known academic records and courses (J1); the title
    falls back to the course's (F17).  Keys are packed on their way through the joins."""
    t = pack_keys(wh("stg_ef3__course_transcripts").drop("tenant_code"), "k_course", "k_student_academic_record")
    r = pack_keys(wh("fct_student_academic_record").select("k_student_academic_record", "k_student", "k_student_xyear",
                                                           "tenant_code", "school_year", "academic_term"),
                  "k_student_academic_record", "k_student", "k_student_xyear")
    c = pack_keys(wh("dim_course").select("k_course", F.col("course_title").alias("__course_title")), "k_course")
    j = t.join(r, "k_student_academic_record").join(c, "k_course")
    j = unpack_keys(j, "k_course", "k_student_academic_record", "k_student", "k_student_xyear")
    return j.select("k_course", "k_student_academic_record", "k_student", "k_student_xyear", "tenant_code",
                    "school_year", "academic_term", "course_attempt_result",
                    F.coalesce("course_title", "__course_title").alias("course_title"), "earned_credits",
                    "final_letter_grade_earned")
