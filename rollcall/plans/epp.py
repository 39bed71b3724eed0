"""Educator preparation: candidates, programs, certification exams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import display_name, race_label
from ..operators.dedupe import deduplicate
from ..operators.reshape import pivot_2d
from ..operators.sets import sorted_array
from .registry import dataset


@dataset("bld_candidate_race_ethnicity", grain=("k_candidate",), domain="tpdm")
def candidate_race_ethnicity(wh) -> DataFrame:
    """Race array and label; candidates without race rows stay."""
    cfg = wh.config
    c = wh("stg_tpdm__candidates").select("k_candidate", "has_hispanic_latino_ethnicity")
    r = wh("stg_tpdm__candidate__races").groupBy("k_candidate").agg(sorted_array("race").alias("race_array"))
    j = c.join(r, "k_candidate", "left")
    return j.select("k_candidate", "race_array", "has_hispanic_latino_ethnicity",
                    race_label("has_hispanic_latino_ethnicity", "race_array", cfg.hispanic_code,
                               cfg.race_multiple_code, cfg.race_unknown_code).alias("race_ethnicity"))


@dataset("bld_immutable_candidate_demos", grain=("k_candidate",), domain="tpdm")
def immutable_candidate_demos(wh) -> DataFrame:
    """Names, display names and race, one row per candidate key
    (per cross-year candidate when demographics are immutable)."""
    cfg = wh.config
    c = wh("stg_tpdm__candidates")
    r = wh("bld_candidate_race_ethnicity")
    dn = display_name("last_name", "first_name", "middle_name", cfg.display_name_expr)
    j = c.join(r.drop("has_hispanic_latino_ethnicity"), "k_candidate", "left").select(
        "k_candidate", "k_candidate_xyear", "tenant_code", "school_year", "first_name", "middle_name", "last_name",
        dn.alias("display_name"), F.concat(dn, F.lit(" ("), F.col("candidate_id"), F.lit(")")).alias("safe_display_name"),
        "gender", "race_ethnicity", "race_array", "has_hispanic_latino_ethnicity")
    part = "k_candidate_xyear" if cfg.immutable_demos else "k_candidate"
    return deduplicate(j, [part], [F.col("school_year").desc_nulls_first()])


@dataset("bld_candidate__other_names", grain=("k_candidate",), domain="tpdm")
def candidate_other_names(wh) -> DataFrame:
    """A column per configured other-name type and name part."""
    o = wh("stg_tpdm__candidates__other_names")
    return pivot_2d(o, ["tenant_code", "api_year", "k_candidate", "k_candidate_xyear"], "other_name_type",
                    wh.config.candidate_name_types, ["first_name", "last_surname"])


@dataset("dim_candidate", grain=("k_candidate",), domain="tpdm")
def dim_candidate(wh) -> DataFrame:
    """Candidates joined to their demographics on ``k_candidate`` (J1) and
    other names (J2)."""
    c = wh("stg_tpdm__candidates").select("k_candidate", "k_candidate_xyear", "k_person", "tenant_code", "school_year",
                                          "candidate_id", "is_economic_disadvantaged")
    d = wh("bld_immutable_candidate_demos").drop("k_candidate_xyear", "tenant_code", "school_year")
    o = wh("bld_candidate__other_names").drop("tenant_code", "api_year", "k_candidate_xyear")
    return c.join(d, "k_candidate").join(o, "k_candidate", "left")


@dataset("dim_educator_preparation_program", grain=("k_educator_preparation_program",), domain="tpdm")
def dim_educator_preparation_program(wh) -> DataFrame:
    return wh("stg_tpdm__educator_preparation_programs").select(
        "k_educator_preparation_program", "tenant_code", "program_id", "program_name", "program_type")


@dataset("fct_candidate_educator_preparation_program_association", domain="tpdm",
         grain=("k_candidate", "k_educator_preparation_program", "begin_date"))
def fct_candidate_epp_association(wh) -> DataFrame:
    """Candidate x program where both exist."""
    s = wh("stg_tpdm__candidate_educator_preparation_program_associations")
    return (s.join(wh("dim_educator_preparation_program").select("k_educator_preparation_program"),
                   "k_educator_preparation_program")
            .join(wh("dim_candidate").select("k_candidate", "k_candidate_xyear"), "k_candidate")
            .select("k_candidate", "k_candidate_xyear", "k_educator_preparation_program", "tenant_code",
                    "school_year", "begin_date", "end_date", "program_type"))


@dataset("dim_certification_exam", grain=("k_certification_exam",), domain="tpdm")
def dim_certification_exam(wh) -> DataFrame:
    return wh("stg_tpdm__certification_exams")


@dataset("fct_certification_exam_result", grain=("k_certification_exam_result",), domain="tpdm")
def fct_certification_exam_result(wh) -> DataFrame:
    return wh("stg_tpdm__certification_exam_results")


@dataset("fct_candidate_staff_association", domain="tpdm")
def fct_candidate_staff_association(wh) -> DataFrame:
    """Candidate x staff where both exist."""
    s = wh("stg_tpdm__candidate_relationship_to_staff_associations")
    return (s.join(wh("dim_candidate").select("k_candidate"), "k_candidate")
            .join(wh("dim_staff").select("k_staff"), "k_staff"))
