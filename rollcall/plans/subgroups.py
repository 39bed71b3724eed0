"""Subgroups: every (demographic column, value) a student has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..operators.joins import seed
from ..operators.reshape import unpivot
from .registry import dataset

# fixed values: dim_student columns that are identity, names or arrays, not groups
_NOT_SUBGROUPS = ("k_student", "k_student_xyear", "tenant_code", "school_year", "student_unique_id", "first_name",
                  "middle_name", "last_name", "display_name", "birth_date", "race_array", "safe_display_name",
                  "is_latest_record", "ed_org_id")
ALL = "all_students"


def _long(wh) -> DataFrame:
    """dim_student unpivoted to (subgroup_category, subgroup_value) with NULLs
    kept; the columns of student ids are left out too."""
    stu = wh("dim_student")
    arrays = [f.name for f in stu.schema.fields if f.dataType.typeName() in ("array", "map", "struct")]
    return unpivot(stu, ["k_student", "k_student_xyear", "tenant_code", "school_year"],
                   exclude=[c for c in _NOT_SUBGROUPS if c not in ("k_student", "k_student_xyear", "tenant_code",
                                                                   "school_year")],
                   remove=[*arrays, *(c for c in wh("bld_wide_ids_student").columns if c != "ed_org_id")],
                   name_col="subgroup_category", value_col="subgroup_value")


@dataset("dim_subgroup", grain=("k_subgroup",))
def dim_subgroup(wh) -> DataFrame:
    """Distinct subgroups plus 'all_students', display names, key."""
    distinct = (_long(wh).select(F.lower("subgroup_category").alias("subgroup_category"), "subgroup_value")
                .distinct())
    groups = distinct.unionByName(wh.spark.createDataFrame([(ALL, ALL)], "subgroup_category string, subgroup_value string"))
    cat = seed(wh("xwalk_subgroup_category_display_names"))
    val = seed(wh("xwalk_subgroup_value_display_names"))
    j = (groups.join(val, ["subgroup_category", "subgroup_value"], "left")
         .join(cat, "subgroup_category", "left"))
    return j.select(
        surrogate_key("subgroup_category", "subgroup_value").alias("k_subgroup"), "subgroup_category",
        F.coalesce("subgroup_category_display_name", "subgroup_category").alias("subgroup_category_display_name"),
        "subgroup_value",
        F.coalesce("subgroup_value_display_name", "subgroup_value").alias("subgroup_value_display_name"))


@dataset("fct_student_subgroup", grain=("k_student", "k_subgroup"))
def fct_student_subgroup(wh) -> DataFrame:
    """Student -> every subgroup, case-folded match to the dimension.

    NULL values never match (they exist only in the dimension).  The
    'all_students' subgroup holds every student: the join is keyed on the
    (small) dimension, broadcast by AQE, so that hot key never shuffles.
    """
    stu = wh("dim_student").select("k_student", "k_student_xyear", "tenant_code", "school_year")
    all_rows = stu.select("*", F.lit(ALL).alias("subgroup_category"), F.lit(ALL).alias("subgroup_value"))
    long = _long(wh).unionByName(all_rows)
    dim = wh("dim_subgroup").select("k_subgroup", F.lower("subgroup_category").alias("__c"),
                                    F.lower("subgroup_value").alias("__v"))
    j = long.join(dim, (F.lower(long.subgroup_category) == dim.__c) & (F.lower(long.subgroup_value) == dim.__v))
    return j.select("k_student", "k_student_xyear", "k_subgroup", "tenant_code", "school_year")
