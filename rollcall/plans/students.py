"""Student demographics builds and the student dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import display_name, race_label
from ..operators.dedupe import first_by
from ..operators.joins import seed
from ..operators.reshape import crosswalk_values, pivot_2d, pivot_flags, pivot_values
from ..operators.sets import sorted_array
from .registry import dataset


@dataset("bld_choose_stu_demos", grain=("k_student",))
def choose_stu_demos(wh) -> DataFrame:
    """One ed-org record per student-year, first by (ed_org_type, ed_org_id)."""
    d = wh("stg_ef3__student_education_organization_associations")
    return first_by(d, ["k_student"], [("ed_org_type", "asc nulls last"), ("ed_org_id", "asc nulls last"),
                                       ("api_year", "desc nulls first")])


@dataset("bld_stu_race_ethnicity", grain=("k_student", "ed_org_id"))
def stu_race_ethnicity(wh) -> DataFrame:
    """Race array and label per student and ed-org; students without race rows stay."""
    cfg = wh.config
    demos = wh("stg_ef3__student_education_organization_associations").select(
        "k_student", "ed_org_id", "has_hispanic_latino_ethnicity")
    races = (wh("stg_ef3__stu_ed_org__races").groupBy("k_student", "ed_org_id")
             .agg(sorted_array("race").alias("race_array")))
    j = demos.join(races, ["k_student", "ed_org_id"], "left")
    return j.select("k_student", "ed_org_id", "has_hispanic_latino_ethnicity", "race_array",
                    race_label("has_hispanic_latino_ethnicity", "race_array", cfg.hispanic_code,
                               cfg.race_multiple_code, cfg.race_unknown_code).alias("race_ethnicity"))


@dataset("bld_stu_grade_level", grain=("k_student", "school_year"))
def stu_grade_level(wh) -> DataFrame:
    """Grade at the latest enrollment (then longest, then reverse
    alphabetical grade), with its integer from the grade crosswalk."""
    e = wh("stg_ef3__student_school_associations").select(
        "tenant_code", "k_student", "school_year", "entry_date", "exit_withdraw_date", "entry_grade_level")
    g = first_by(e, ["k_student", "school_year"], [
        ("entry_date", "desc nulls first"), ("exit_withdraw_date", "desc nulls first"),
        ("entry_grade_level", "desc nulls first")])
    if wh.config.grade_level_override:
        # Left join the override source, coalesce(override, enrolled grade);
        # D19 checks the source is unique on k_student
        source, expr = wh.config.grade_level_override
        ov = wh(source).select("k_student", F.expr(expr).cast("string").alias("__override"))
        g = (g.join(ov, "k_student", "left")
             .withColumn("entry_grade_level", F.coalesce("__override", "entry_grade_level")).drop("__override"))
    xw = seed(wh("xwalk_grade_levels"))
    return (g.join(xw, g.entry_grade_level == xw.grade_level, "left")
            .select("tenant_code", "k_student", "school_year", "entry_grade_level", "grade_level_integer"))


@dataset("bld_student_characteristics", grain=("k_student", "ed_org_id"))
def student_characteristics(wh) -> DataFrame:
    """One boolean column per crosswalk indicator."""
    xw = seed(wh("xwalk_student_characteristics"))
    ch = wh("stg_ef3__stu_ed_org__characteristics")
    j = ch.join(xw, ch.student_characteristic == xw.characteristic_descriptor, "left")
    names = crosswalk_values(xw, "indicator_name")
    return pivot_flags(j, ["tenant_code", "api_year", "k_student", "k_student_xyear", "ed_org_id"],
                       "indicator_name", [(n, n) for n in names])


@dataset("bld_immutable_stu_demos", grain=("k_student",))
def immutable_stu_demos(wh) -> DataFrame:
    """Demographics as last known: per student-year, or with ``immutable_demos``
    the latest year's for all years of a student (R1: the key is then
    ``k_student_xyear``, one row each)."""
    cfg = wh.config
    s = wh("stg_ef3__students")
    demos = wh("bld_choose_stu_demos").select("k_student", "ed_org_id", "gender", "gender_identity")
    races = wh("bld_stu_race_ethnicity")
    dn = display_name("last_name", "first_name", "middle_name", cfg.display_name_expr)
    j = (s.join(demos, "k_student").join(races, ["k_student", "ed_org_id"], "left")
         .withColumn("display_name", dn)
         .select("k_student", "k_student_xyear", "tenant_code", F.col("api_year").alias("school_year"), "ed_org_id", "first_name",
                 "middle_name", "last_name", "display_name",
                 F.concat("display_name", F.lit(" ("), "student_unique_id", F.lit(")")).alias("safe_display_name"),
                 "birth_date", "birth_country", "gender", "gender_identity", "race_ethnicity", "race_array",
                 "has_hispanic_latino_ethnicity"))
    if not cfg.immutable_demos:
        return j  # one row per student-year already: demographics are chosen per student-year
    return first_by(j, ["k_student_xyear"], [("school_year", "desc nulls first"), ("k_student", "desc nulls last")])


#: builds that dim_student left-joins on the student and the chosen ed-org, with the default of their missing columns
_BY_ED_ORG = {"bld_wide_ids_student": None, "bld_student_characteristics": False, "bld_student_indicators": None,
              "bld_student_programs": False}
_KEYS = ("tenant_code", "api_year", "k_student", "k_student_xyear", "ed_org_id")
NAME_PARTS = ("personal_title_prefix", "first_name", "middle_name", "last_surname", "generation_code_suffix")


@dataset("dim_student", grain=("k_student",))
def dim_student(wh) -> DataFrame:
    """Student dimension, a star of builds around the student-year: chosen and
    immutable demographics (inner), ids, characteristics, indicators and
    generic programs of the chosen ed-org, grade, cohorts, other names and the
    flags of every enabled program domain (left), ``is_latest_record`` (W7).

    All builds are tables bucketed by ``k_student``; so the joins need no
    exchange but the one of the student-years themselves.  A domain that is
    switched off is neither read nor joined, and has no columns.
    """
    cfg = wh.config
    programs = cfg.enabled_programs()
    by_student = ["bld_choose_stu_demos", *(() if cfg.immutable_demos else ("bld_immutable_stu_demos",)), *_BY_ED_ORG,
                  "bld_stu_grade_level", "bld_student_cohort_years", "bld_student__other_names",
                  *(f"bld_student_program__{p}" for p in programs)]
    wh.bucketed(by_student, "k_student")
    latest = F.max("api_year").over(Window.partitionBy("k_student_xyear"))
    d = wh("stg_ef3__students").select("k_student", "k_student_xyear", "tenant_code", F.col("api_year").alias("school_year"),
                                       "student_unique_id", (F.col("api_year") == latest).alias("is_latest_record"))
    d = d.join(wh("bld_choose_stu_demos").select("k_student", "ed_org_id", "lep_code"), "k_student")
    immutable = wh("bld_immutable_stu_demos").drop("tenant_code", "school_year")
    if cfg.immutable_demos:
        # one row per student of all years, from an ed-org that need not be this year's
        d = d.join(immutable.drop("k_student", "ed_org_id"), "k_student_xyear")
    else:
        d = d.join(immutable.drop("k_student_xyear", "ed_org_id"), "k_student")

    for build, missing in _BY_ED_ORG.items():
        b = wh(build)
        own = [c for c in b.columns if c not in _KEYS]
        theirs = b.select(F.col("k_student").alias("__k"), F.col("ed_org_id").alias("__e"), *own)
        d = d.join(theirs, (F.col("k_student") == F.col("__k")) & _same(F.col("ed_org_id"), F.col("__e")), "left").drop("__k", "__e")
        if missing is not None:
            d = d.withColumns({c: F.coalesce(F.col(c), F.lit(missing)) for c in own})
    grade = wh("bld_stu_grade_level").select(F.col("k_student").alias("__k"), F.col("school_year").alias("__y"),
                                             F.col("entry_grade_level").alias("grade_level"), "grade_level_integer")
    d = d.join(grade, (F.col("k_student") == F.col("__k")) & _same(F.col("school_year"), F.col("__y")), "left").drop("__k", "__y")
    for build in ("bld_student_cohort_years", "bld_student__other_names"):
        b = wh(build)
        d = d.join(b.select("k_student", *[c for c in b.columns if c not in _KEYS]), "k_student", "left")
    program_flags = []
    for build, spec in programs.items():
        flags = [f"is_{spec.flag}_{t}" for t in spec.agg_types] + [name for name, _ in spec.custom_aggregates]
        d = d.join(wh(f"bld_student_program__{build}").select("k_student", *flags), "k_student", "left")
        d = d.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in flags})
        program_flags += flags

    for name, expr in cfg.intersection_groups:
        d = d.withColumn(name, F.expr(expr))
    from .custom import add_custom_columns
    ids, chars, indicators, generic = ([c for c in wh(b).columns if c not in _KEYS] for b in _BY_ED_ORG)
    others = [c for c in wh("bld_student__other_names").columns if c not in _KEYS]
    out = d.select("k_student", "k_student_xyear", "tenant_code", "school_year", "student_unique_id", *ids, "first_name", "middle_name",
                   "last_name", "display_name", "birth_date", "birth_country", "lep_code", "gender", "gender_identity",
                   "grade_level", "grade_level_integer", "race_ethnicity", "has_hispanic_latino_ethnicity", *program_flags, *chars,
                   *indicators, *generic, *[n for n, _ in cfg.intersection_groups], *others, "is_latest_record", "race_array",
                   "cohort_year_array", "safe_display_name", "ed_org_id")
    return add_custom_columns(wh, "dim_student", out, ["k_student"])


def _same(a, b):
    """Equality as a filter on the matches of a join, not as a join key: tables
    bucketed by the first key alone then still need no exchange."""
    return F.array_contains(F.array(a), b)


@dataset("bld_student__other_names", grain=("k_student",))
def student_other_names(wh) -> DataFrame:
    """``{type}_{part}`` per configured other-name type."""
    o = wh("stg_ef3__students__other_names")
    return pivot_2d(o, ["tenant_code", "api_year", "k_student", "k_student_xyear"], "other_name_type",
                    wh.config.other_name_types, NAME_PARTS)


@dataset("bld_student_indicators", grain=("k_student", "ed_org_id"))
def student_indicators(wh) -> DataFrame:
    """Raw indicator values pivoted by their dimension name, then
    typed by the crosswalk (booleans recoded, numbers try-cast)."""
    from ..operators.reshape import cast_by_type
    xw = seed(wh("xwalk_student_indicators"))
    ind = wh("stg_ef3__stu_ed_org__indicators")
    j = ind.join(xw, ind.indicator_name == xw.original_indicator_name, "left")
    names = crosswalk_values(xw, "dim_stu_name")
    wide = pivot_values(j, ["tenant_code", "api_year", "k_student", "k_student_xyear", "ed_org_id"], "dim_stu_name",
                        names, "indicator_value", agg="min")
    types = {r[0]: r[1] for r in xw.select("dim_stu_name", "type").distinct().collect()}
    return cast_by_type(wide, types)


@dataset("bld_wide_ids_student", grain=("k_student", "ed_org_id"))
def wide_ids_student(wh) -> DataFrame:
    """Student identification codes pivoted to ``{id_name}_student_id``."""
    xw = seed(wh("xwalk_id_types_student"))
    ids = wh("stg_ef3__stu_ed_org__identification_codes").join(xw, "id_system")
    return pivot_values(ids, ["tenant_code", "api_year", "k_student", "k_student_xyear", "ed_org_id"], "id_name",
                        crosswalk_values(xw, "id_name"), "id_code", agg="min", suffix="_student_id")
