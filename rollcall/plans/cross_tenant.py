"""Copies of assessment results for every tenant where a student is enrolled.

Off by default (``Config.cross_tenant_assessments``); then both builds are typed
empty relations and the facts and dimensions keep their original rows.

One person has the same ``student_unique_id`` in all tenants.  Whether that id
really names one person is decided by distinct counts per id: an aggregate that
combines map-side, joined back on the id, not a window, so no task holds more
than one aggregated row of an id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..operators.dedupe import first_by
from .registry import dataset

# at most so many distinct birth dates, first and last names of one id in all
MOST_IDENTITIES = 5

_COPY = ("tenant_code string, school_year int, api_year int, k_student string, k_student_xyear string, "
         "k_assessment string, k_student_assessment string, k_student_assessment__original string, "
         "k_assessment__original string, student_unique_id string, student_assessment_identifier string, "
         "is_original_record boolean, original_tenant_code string")
_OBJECTIVE_COPY = ("k_student_objective_assessment string, k_objective_assessment string, "
                   "k_student_objective_assessment__original string, k_objective_assessment__original string, "
                   "k_student_assessment string, k_student_assessment__original string, k_student string, "
                   "k_student_xyear string, k_assessment string, k_assessment__original string, tenant_code string, "
                   "school_year int, api_year int, is_original_record boolean, original_tenant_code string")


def same_person(people: DataFrame) -> DataFrame:
    """The ids of ``people`` (one row per enrolled student: id, birth date,
    names, tenant) whose records agree: one birth date at most, or in several
    tenants with ``MOST_IDENTITIES`` dates and names together at most."""
    def distinct(c):
        # NULLs don't count, as in count(distinct)
        return F.size(F.collect_set(c))
    dates, tenants = distinct("birth_date"), distinct("tenant_code")
    names = distinct(F.lower("first_name")) + distinct(F.lower("last_name"))
    counts = people.groupBy("student_unique_id").agg(dates.alias("dates"), names.alias("names"), tenants.alias("tenants"))
    agree = (F.col("dates") <= 1) | ((F.col("dates") + F.col("names") <= MOST_IDENTITIES) & (F.col("tenants") > 1))
    return counts.filter(agree).select("student_unique_id")


def active_students(wh) -> DataFrame:
    """One row per actively enrolled (school year, tenant, student) of those ids
    that name one person, or of all ids where removed students are configured."""
    enrolled = (wh("fct_student_school_association").filter("is_active_enrollment")
                .select("school_year", "tenant_code", "k_student", "k_student_xyear").distinct())
    who = wh("dim_student").select("k_student", "student_unique_id", "birth_date", "first_name", "last_name")
    people = enrolled.join(who, "k_student")
    if wh.config.removed_students_source is None:
        people = people.join(same_person(people), "student_unique_id")
    return people.select("school_year", "tenant_code", "k_student", "k_student_xyear", "student_unique_id")


@dataset("bld_student_assessment_cross_tenant", grain=("k_student_assessment",), domain="assessment", materialized="table")
def student_assessment_cross_tenant(wh) -> DataFrame:
    """Originals of enrolled students, and a copy with new keys for every
    other tenant they are enrolled in; a record the tenant has itself wins."""
    if not wh.config.cross_tenant_assessments:
        return wh.spark.createDataFrame([], _COPY)
    stg = wh("stg_ef3__student_assessments")
    students = active_students(wh)
    common = ["student_unique_id", "student_assessment_identifier"]
    originals = (stg.join(students.select("student_unique_id").distinct(), "student_unique_id", "left_semi")
                 .select("tenant_code", "school_year", "api_year", "k_student", "k_student_xyear", "k_assessment",
                         "k_student_assessment", F.col("k_student_assessment").alias("k_student_assessment__original"),
                         F.col("k_assessment").alias("k_assessment__original"), *common,
                         F.lit(True).alias("is_original_record"), F.col("tenant_code").alias("original_tenant_code")))
    receiving = students.select(F.col("tenant_code").alias("to_tenant"), F.col("k_student").alias("to_student"),
                                F.col("k_student_xyear").alias("to_xyear"), "student_unique_id")
    shared = stg
    if wh.config.removed_students_source is not None:
        removed = wh(wh.config.removed_students_source).select("k_student").distinct()
        shared = shared.join(removed, "k_student", "left_anti")
        receiving = receiving.join(removed.withColumnRenamed("k_student", "to_student"), "to_student", "left_anti")
    names = [F.lower(c) for c in ("academic_subject", "assessment_identifier", "namespace")]
    copies = (shared.join(receiving.distinct(), "student_unique_id").filter("tenant_code != to_tenant")
              .select(F.col("to_tenant").alias("tenant_code"), "school_year", "api_year",
                      F.col("to_student").alias("k_student"), F.col("to_xyear").alias("k_student_xyear"),
                      surrogate_key("to_tenant", "api_year", *names).alias("k_assessment"),
                      surrogate_key("to_tenant", "api_year", *names, F.lower("student_assessment_identifier"),
                                    F.lower("student_unique_id")).alias("k_student_assessment"),
                      F.col("k_student_assessment").alias("k_student_assessment__original"),
                      F.col("k_assessment").alias("k_assessment__original"), *common,
                      F.lit(False).alias("is_original_record"), F.col("tenant_code").alias("original_tenant_code")))
    return first_by(originals.unionByName(copies), ["k_student_assessment"], [
        ("is_original_record", "desc nulls last"), ("original_tenant_code", "asc nulls first"),
        ("k_student_assessment__original", "asc nulls first")])


@dataset("bld_student_objective_assessment_cross_tenant", grain=("k_student_objective_assessment",), domain="assessment",
         materialized="table")
def student_objective_assessment_cross_tenant(wh) -> DataFrame:
    """The objective results of every original or copied assessment result."""
    if not wh.config.cross_tenant_assessments:
        return wh.spark.createDataFrame([], _OBJECTIVE_COPY)
    obj = wh("stg_ef3__student_objective_assessments").select(
        F.col("k_student_assessment").alias("k_student_assessment__original"),
        F.col("k_student_objective_assessment").alias("k_student_objective_assessment__original"),
        F.col("k_objective_assessment").alias("k_objective_assessment__original"),
        "assess_academic_subject", "academic_subject", "assessment_identifier", "namespace",
        "objective_assessment_identification_code", "student_assessment_identifier")
    copies = wh("bld_student_assessment_cross_tenant").drop("student_assessment_identifier", "student_unique_id")
    lower = {c: F.lower(c) for c in obj.columns[3:]}
    own = [lower[c] for c in ("assessment_identifier", "namespace", "objective_assessment_identification_code")]
    keyed = obj.join(copies, "k_student_assessment__original").select(
        surrogate_key("tenant_code", "api_year", lower["assess_academic_subject"], *own,
                      lower["student_assessment_identifier"]).alias("k_student_objective_assessment"),
        surrogate_key("tenant_code", "api_year", lower["assess_academic_subject"], lower["academic_subject"], *own)
        .alias("k_objective_assessment"),
        "k_student_objective_assessment__original", "k_objective_assessment__original", *copies.columns)
    return first_by(keyed, ["k_student_objective_assessment"], [
        ("is_original_record", "desc nulls last"), ("original_tenant_code", "asc nulls first"),
        ("k_student_objective_assessment__original", "asc nulls first")]).select(
        *[part.split()[0] for part in _OBJECTIVE_COPY.split(", ")])


def _filled(df: DataFrame, copies: DataFrame, original: str, taken: list[str]) -> DataFrame:
    """Left join rows with their copies on the original key; the copy's values
    take the place of the row's own."""
    theirs = copies.select(F.col(f"{original}__original").alias("__original"),
                           *[F.col(c).alias(f"__copy_{c}") for c in taken],
                           *[F.col(c) for c in copies.columns if c.startswith("is_original") or c == "original_tenant_code"])
    joined = df.join(theirs, df[original] == F.col("__original"), "left")
    return joined.select(
        *[F.coalesce(F.col(f"__copy_{c}"), df[c]).alias(c) for c in taken], df[original].alias(f"{original}__original"),
        F.coalesce("is_original_record", F.lit(True)).alias("is_original_record"),
        F.coalesce("original_tenant_code", df["tenant_code"]).alias("original_tenant_code"),
        *[df[c] for c in df.columns if c not in taken])


def with_copies(wh, results: DataFrame, build: str, key: str, taken: list[str]) -> DataFrame:
    """Results with their cross-tenant copies; ``{key}__original`` is the key
    their scores are found by.  Without copies the rows are as they were."""
    if not wh.config.cross_tenant_assessments:
        return results.select("*", F.col(key).alias(f"{key}__original"), F.lit(True).alias("is_original_record"),
                              F.col("tenant_code").alias("original_tenant_code"))
    return _filled(results, wh(build), key, taken)


def dimension_with_copies(wh, rows: DataFrame, build: str, key: str, taken: list[str]) -> DataFrame:
    """A dimension with rows for the tenants that only received copies, their
    attributes taken from the original's row."""
    if not wh.config.cross_tenant_assessments:
        return rows
    copies = wh(build)
    one = first_by(copies.select(*taken, f"{key}__original"), [key], [
        ("tenant_code", "asc nulls first"), ("school_year", "asc nulls first"), (f"{key}__original", "asc nulls first")])
    theirs = one.select(F.col(f"{key}__original").alias("__original"), *[F.col(c).alias(f"__copy_{c}") for c in taken])
    return rows.join(theirs, rows[key] == F.col("__original"), "left").select(
        *[F.coalesce(F.col(f"__copy_{c}"), rows[c]).alias(c) for c in taken], *[rows[c] for c in rows.columns if c not in taken])
