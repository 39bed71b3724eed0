"""Assessments: metadata arrays, long results, the wide student fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedupe import first_by
from ..operators.joins import seed
from ..operators.reshape import crosswalk_values
from ..operators.sets import sorted_array, sorted_struct_array
from .cross_tenant import dimension_with_copies, with_copies
from .registry import dataset

@dataset("bld_assessment_scores", grain=("k_assessment",), domain="assessment")
def assessment_scores(wh) -> DataFrame:
    """Score names per assessment."""
    return (wh("stg_ef3__assessments__scores").groupBy("tenant_code", "api_year", "k_assessment")
            .agg(sorted_array("score_name").alias("scores_array")))


@dataset("bld_assessment_performance_levels", grain=("k_assessment",), domain="assessment")
def assessment_performance_levels(wh) -> DataFrame:
    """Array of {name, value} objects per assessment."""
    pl = wh("stg_ef3__assessments__performance_levels")
    return pl.groupBy("tenant_code", "api_year", "k_assessment").agg(
        sorted_struct_array(F.col("performance_level_name").alias("performance_level_name"),
                            F.col("performance_level_value").alias("performance_level_value"))
        .alias("performance_levels_array"))


@dataset("bld_assessment_grade_levels", grain=("k_assessment",), domain="assessment")
def assessment_grade_levels(wh) -> DataFrame:
    return (wh("stg_ef3__assessments__grade_levels").groupBy("tenant_code", "api_year", "k_assessment")
            .agg(sorted_array("grade_level").alias("grades_array")))


@dataset("dim_assessment", grain=("k_assessment",), domain="assessment")
def dim_assessment(wh) -> DataFrame:
    """Assessment metadata with score, level and grade arrays (J2), one row per key."""
    a = wh("stg_ef3__assessments")
    j = (a.join(wh("bld_assessment_scores").select("k_assessment", "scores_array"), "k_assessment", "left")
         .join(wh("bld_assessment_performance_levels").select("k_assessment", "performance_levels_array"),
               "k_assessment", "left")
         .join(wh("bld_assessment_grade_levels").select("k_assessment", "grades_array"), "k_assessment", "left"))
    j = dimension_with_copies(wh, j.withColumn("school_year", F.col("api_year")), "bld_student_assessment_cross_tenant",
                              "k_assessment", ["k_assessment", "tenant_code", "school_year"])
    j = first_by(j, ["k_assessment"], [("tenant_code", "asc nulls last"), ("school_year", "asc nulls last")])
    return j.select("k_assessment", "tenant_code", "school_year", "assessment_identifier", "namespace",
                    "assessment_title", "academic_subject", "assessment_family", "scores_array",
                    "performance_levels_array", "grades_array")


@dataset("bld_student_assessments_long_results", grain=("k_student_assessment", "original_score_name"),
         domain="assessment")
def student_assessments_long_results(wh) -> DataFrame:
    """Score results and performance levels stacked, the highest
    (text order) result kept per score name, then normalized through the
    score crosswalk whose identifier and family are optional (NULL = any);
    unmapped names become 'other'.  Rows are dealt by their result's key once,
    for this and for the fact's pivot of its few scores."""
    cols = ["tenant_code", "api_year", "k_student_assessment", "k_assessment", "assessment_identifier", "namespace",
            "score_name", "score_result"]
    sr = wh("stg_ef3__student_assessments__score_results").select(*cols)
    pl = wh("stg_ef3__student_assessments__performance_levels").select(
        *cols[:6], F.col("performance_level_name").alias("score_name"),
        F.col("performance_level_result").alias("score_result"))
    stacked = sr.unionByName(pl)
    d = first_by(stacked.repartition("k_student_assessment"), ["k_student_assessment", "score_name"], [("score_result", "desc nulls first")])
    fam = wh("dim_assessment").select("k_assessment", "assessment_family")
    d = d.join(fam, "k_assessment", "left")
    xw = seed(wh("xwalk_assessment_scores")).select(
        F.col("assessment_identifier").alias("__x_id"), F.col("namespace").alias("__x_ns"),
        F.col("assessment_family").alias("__x_fam"), F.col("original_score_name").alias("__x_score"),
        "normalized_score_name")
    cond = ((d.namespace == xw.__x_ns) & (d.score_name == xw.__x_score)
            & (xw.__x_id.isNull() | (xw.__x_id == d.assessment_identifier))
            & (xw.__x_fam.isNull() | (xw.__x_fam == d.assessment_family)))
    j = d.join(xw, cond, "left")
    return j.select("tenant_code", "api_year", "k_student_assessment", F.col("score_name").alias("original_score_name"),
                    F.coalesce("normalized_score_name", F.lit("other")).alias("normalized_score_name"),
                    "score_result")


@dataset("fct_student_assessment", grain=("k_student_assessment",), domain="assessment")
def fct_student_assessment(wh) -> DataFrame:
    """Long results pivoted to one column per normalized score (X1, max),
    unmapped scores kept in ``v_other_results`` (A15); students resolved
    against dim_student (J2, NULL for historic years) and kept only if the
    student is ever known (J4 left semi on the cross-year key)."""
    key = "k_student_assessment"
    names = crosswalk_values(wh("xwalk_assessment_scores"), "normalized_score_name")
    sa = with_copies(wh, wh("stg_ef3__student_assessments"), "bld_student_assessment_cross_tenant", key,
                     [key, "k_assessment", "k_student", "k_student_xyear", "tenant_code", "school_year"])
    j = _resolved(wh, sa).join(
        _results(wh("bld_student_assessments_long_results"), key, names).withColumnRenamed(key, f"{key}__original"),
        f"{key}__original", "left")
    return j.select(key, "k_assessment", "k_student", "k_student_xyear", "tenant_code", "student_assessment_identifier",
                    "school_year", "administration_date", "when_assessed_grade_level", *_copy_columns(wh, key), *names,
                    "v_other_results")


def _results(long: DataFrame, key: str, names: list[str]) -> DataFrame:
    """X1 A15 in one aggregate: a column per normalized score (max), the
    unmapped ones in ``v_other_results`` (NULL if none)."""
    score = F.col("normalized_score_name")
    other = F.collect_list(F.when(score == "other", F.struct("original_score_name", "score_result")))
    return long.groupBy(key).agg(
        *[F.max(F.when(score == F.lit(n), F.col("score_result"))).alias(n) for n in names],
        other.alias("__other")).withColumn(
        "v_other_results", F.when(F.size("__other") > 0, F.map_from_entries("__other"))).drop("__other")


def _resolved(wh, results: DataFrame) -> DataFrame:
    """Results of students ever known, ``k_student`` NULL where the
    student has no demographics for that year."""
    stu = wh("dim_student")
    return (results.join(stu.select("k_student_xyear").distinct(), "k_student_xyear", "left_semi")
            .withColumnRenamed("k_student", "__k_student")
            .join(stu.select("k_student"), F.col("__k_student") == F.col("k_student"), "left").drop("__k_student"))


def _copy_columns(wh, key: str) -> list[str]:
    """Columns that facts have only where results are copied across tenants."""
    return [f"{key}__original", "is_original_record", "original_tenant_code"] if wh.config.cross_tenant_assessments else []


_OBJ_KEY = ["assessment_identifier", "namespace", "objective_assessment_identification_code"]


@dataset("dim_objective_assessment", grain=("k_objective_assessment",), domain="assessment")
def dim_objective_assessment(wh) -> DataFrame:
    """Objective assessments with their parent assessment key, one row per key."""
    o = wh("stg_ef3__objective_assessments").withColumn("school_year", F.col("api_year"))
    key = "k_objective_assessment"
    o = (o.join(wh("bld_objective_assessment_scores").select(key, "scores_array"), key, "left")
         .join(wh("bld_objective_assessment_performance_levels").select(key, "performance_levels_array"), key, "left"))
    o = dimension_with_copies(wh, o, "bld_student_objective_assessment_cross_tenant", key,
                              [key, "k_assessment", "tenant_code", "school_year"])
    o = first_by(o, ["k_assessment", key], [("tenant_code", "asc nulls last"), ("school_year", "asc nulls last")])
    return o.select(key, "k_assessment", "tenant_code", "school_year", *_OBJ_KEY, "objective_assessment_description",
                    "max_raw_score", "nomenclature", "percent_of_assessment", "academic_subject", "scores_array",
                    "performance_levels_array")


@dataset("bld_student_objective_assessments_long_results",
         grain=("k_student_objective_assessment", "original_score_name"), domain="assessment")
def student_objective_assessments_long_results(wh) -> DataFrame:
    """Scores and levels stacked, highest (text) result per name,
    normalized through a crosswalk keyed on four columns (no wildcard).  Rows are
    dealt by their result's key once, for this and for the fact's pivot."""
    cols = ["tenant_code", "k_student_objective_assessment", *_OBJ_KEY, "score_name", "score_result"]
    sr = wh("stg_ef3__student_objective_assessments__score_results").select(*cols)
    pl = wh("stg_ef3__student_objective_assessments__performance_levels").select(
        *cols[:5], F.col("performance_level_name").alias("score_name"),
        F.col("performance_level_result").alias("score_result"))
    d = first_by(sr.unionByName(pl).repartition("k_student_objective_assessment"), ["k_student_objective_assessment", "score_name"],
                 [("score_result", "desc nulls first")])
    xw = seed(wh("xwalk_objective_assessment_scores")).withColumnRenamed("original_score_name", "score_name")
    j = d.join(xw, [*_OBJ_KEY, "score_name"], "left")
    return j.select("tenant_code", "k_student_objective_assessment", F.col("score_name").alias("original_score_name"),
                    F.coalesce("normalized_score_name", F.lit("other")).alias("normalized_score_name"),
                    "score_result")


@dataset("fct_student_objective_assessment", grain=("k_student_objective_assessment",), domain="assessment")
def fct_student_objective_assessment(wh) -> DataFrame:
    """Wide normalized scores, other scores in a map, students
    ever known only, one row per key."""
    key = "k_student_objective_assessment"
    names = crosswalk_values(wh("xwalk_objective_assessment_scores"), "normalized_score_name")
    sa = with_copies(wh, wh("stg_ef3__student_objective_assessments"), "bld_student_objective_assessment_cross_tenant", key,
                     [key, "k_objective_assessment", "k_student_assessment", "k_assessment", "k_student", "k_student_xyear",
                      "tenant_code", "school_year"])
    # a key made anew can meet that of a record the tenant has itself, which wins
    one = first_by(_resolved(wh, sa), [key], [("is_original_record", "desc nulls last"), ("school_year", "desc nulls first")])
    j = one.join(
        _results(wh("bld_student_objective_assessments_long_results"), key, names).withColumnRenamed(key, f"{key}__original"),
        f"{key}__original", "left")
    return j.select(key, "k_objective_assessment", "k_student_assessment", "k_assessment", "k_student", "k_student_xyear",
                    "tenant_code", "school_year", "administration_date", *_copy_columns(wh, key), *names, "v_other_results")


@dataset("bld_objective_assessment_scores", grain=("k_objective_assessment",), domain="assessment")
def objective_assessment_scores(wh) -> DataFrame:
    """Score names per objective assessment."""
    return (wh("stg_ef3__objective_assessments__scores").groupBy("tenant_code", "api_year", "k_objective_assessment")
            .agg(sorted_array("score_name").alias("scores_array")))


@dataset("bld_objective_assessment_performance_levels", grain=("k_objective_assessment",), domain="assessment")
def objective_assessment_performance_levels(wh) -> DataFrame:
    """Array of {name, value} objects per objective assessment."""
    pl = wh("stg_ef3__objective_assessments__performance_levels")
    return pl.groupBy("tenant_code", "api_year", "k_objective_assessment").agg(
        sorted_struct_array(F.col("performance_level_name").alias("performance_level_name"),
                            F.col("performance_level_value").alias("performance_level_value"))
        .alias("performance_levels_array"))
