"""Discipline: incidents, behaviors, actions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import descriptor_short, json_size
from ..functions.keys import surrogate_key
from ..operators.dedupe import deduplicate, flag_first
from ..operators.joins import seed, wildcard_condition
from ..operators.sets import sorted_array, sorted_distinct_array, sorted_struct_array
from .registry import dataset

_DISCIPLINES = "array<struct<disciplineDescriptor:string>>"
_STAFFS = "array<struct<staffReference:struct<staffUniqueId:string>>>"


@dataset("dim_discipline_incident", grain=("k_discipline_incident",), domain="discipline")
def dim_discipline_incident(wh) -> DataFrame:
    """Incidents at known schools (J1) with their behaviors as an array of
    objects (A14), and whether the source lists several (F22: the size of its
    JSON list, whatever objects are in it)."""
    inc = wh("stg_ef3__discipline_incidents")
    beh = (wh("stg_ef3__discipline_incidents__behaviors").groupBy("k_discipline_incident")
           .agg(sorted_struct_array("behavior_type", "behavior_detailed_description").alias("behavior_array")))
    j = inc.join(wh("dim_school").select("k_school"), "k_school").join(beh, "k_discipline_incident", "left")
    return j.select("k_discipline_incident", "k_school", "tenant_code", "school_year", "incident_id", "incident_date",
                    (json_size("v_behaviors") > 1).alias("has_multiple_behaviors"), "incident_cost",
                    "was_reported_to_law_enforcement", "behavior_array")


@dataset("bld_stu_discipline_action__stu_incident_behavior", domain="discipline",
         grain=("k_student", "k_student_xyear", "discipline_action_id", "discipline_date"))
def action_incident_behaviors(wh) -> DataFrame:
    """Behavior keys linked to each action.  The link's behavior
    type is optional: NULL matches every behavior of the incident."""
    act = wh("stg_ef3__discipline_actions").select(
        "k_student", "k_student_xyear", "discipline_action_id", "discipline_date", "incident_id", "school_id",
        "link_behavior_type")
    beh = wh("stg_ef3__student_discipline_incident_behavior_associations").select(
        F.col("k_student").alias("__b_student"), F.col("incident_id").alias("__b_incident"),
        F.col("school_id").alias("__b_school"), "k_discipline_incident", "behavior_type")
    cond = ((act.k_student == beh.__b_student) & (act.incident_id == beh.__b_incident)
            & (act.school_id == beh.__b_school)
            & (act.link_behavior_type.isNull() | (act.link_behavior_type == beh.behavior_type)))
    j = act.join(beh, cond)
    k = surrogate_key("k_student", "k_discipline_incident", F.lower("behavior_type"))
    return j.groupBy("k_student", "k_student_xyear", "discipline_action_id", "discipline_date").agg(
        sorted_array(k).alias("k_student_discipline_incident_behavior_array"))


@dataset("fct_student_discipline_actions", domain="discipline",
         grain=("k_student", "k_discipline_actions_event", "discipline_action"))
def fct_student_discipline_actions(wh) -> DataFrame:
    """One row per action and discipline type (U4 explode of the JSON list,
    F8 descriptor code), school = responsibility else assignment (J12), staff
    keys from nested references (F2, A11), severity from the crosswalk and a
    most-severe flag per action event (W3)."""
    a = wh("stg_ef3__discipline_actions").filter(
        F.col("assignment_school_id").isNotNull() | F.col("responsibility_school_id").isNotNull())
    stu = wh("dim_student").select("k_student")
    resp = wh("dim_school").select(F.col("k_school").alias("k_school__responsibility"), F.lit(1).alias("__r"))
    asg = wh("dim_school").select(F.col("k_school").alias("k_school__assignment"), F.lit(1).alias("__a"))
    links = wh("bld_stu_discipline_action__stu_incident_behavior")
    staff = F.from_json("v_staffs", _STAFFS)
    staff_keys = F.transform(staff, lambda s: surrogate_key(F.col("tenant_code"), s["staffReference"]["staffUniqueId"]))
    j = (a.join(stu, "k_student")
         .join(resp, "k_school__responsibility", "left").join(asg, "k_school__assignment", "left")
         .join(links, ["k_student", "k_student_xyear", "discipline_action_id", "discipline_date"], "left"))
    j = j.select(
        "k_student", "k_student_xyear",
        F.coalesce(F.when(F.col("__r").isNotNull(), F.col("k_school__responsibility")),
                   F.when(F.col("__a").isNotNull(), F.col("k_school__assignment"))).alias("k_school"),
        F.when(F.col("__a").isNotNull(), F.col("k_school__assignment")).alias("k_school__assignment"),
        F.when(F.col("__r").isNotNull(), F.col("k_school__responsibility")).alias("k_school__responsibility"),
        "school_year",
        surrogate_key("tenant_code", "api_year", "discipline_action_id", "discipline_date").alias(
            "k_discipline_actions_event"),
        F.array_max(staff_keys).alias("k_staff"),
        "tenant_code", "discipline_action_id", "discipline_date",
        F.explode(F.from_json("v_disciplines", _DISCIPLINES)).alias("__d"),
        "discipline_action_length", F.array_sort(staff_keys).alias("k_staff_array"),
        "k_student_discipline_incident_behavior_array")
    j = j.withColumn("discipline_action", descriptor_short(F.col("__d.disciplineDescriptor"))).drop("__d")
    xw = seed(wh("xwalk_discipline_actions"))
    j = j.join(xw, "discipline_action", "left")
    j = flag_first(j, "is_most_severe_action", ["k_student", "k_student_xyear", "k_school", "k_discipline_actions_event"],
                   [F.col("severity_order").desc_nulls_last(), F.col("discipline_action").asc_nulls_last()])
    j = j.withColumn("is_most_severe_action", F.when(F.col("severity_order").isNotNull(), F.col("is_most_severe_action")))
    return j.select("k_student", "k_student_xyear", "k_school", "k_school__assignment", "k_school__responsibility",
                    "school_year", "k_discipline_actions_event", "k_staff", "tenant_code", "discipline_action_id",
                    "discipline_date", "discipline_action", "discipline_action_length", "k_staff_array",
                    "k_student_discipline_incident_behavior_array", "severity_order", "is_oss", "is_iss", "is_exp",
                    "is_minor", "is_most_severe_action")


@dataset("fct_student_discipline_incident_behaviors", domain="discipline",
         grain=("k_student", "k_discipline_incident", "behavior_type"))
def fct_student_discipline_incident_behaviors(wh) -> DataFrame:
    """Offender behaviors of known students, schools and incidents (J1), severity
    and further columns from the crosswalk (J2), participation codes (A12),
    most-severe flag per student and incident (W3)."""
    b = wh("stg_ef3__student_discipline_incident_behavior_associations")
    who = ["k_student", "k_student_xyear", "k_discipline_incident"]
    codes = (wh("stg_ef3__student_discipline_incident_behavior_associations__participation_codes").groupBy(*who)
             .agg(sorted_distinct_array("participation_code").alias("participation_codes_array")))
    xw = wh("xwalk_discipline_behaviors")
    more = [c for c in xw.columns if c not in ("behavior_type", "severity_order")]
    j = (b.join(codes, who, "left").join(wh("dim_student").select("k_student"), "k_student")
         .join(wh("dim_school").select("k_school"), "k_school")
         .join(wh("dim_discipline_incident").select("k_discipline_incident"), "k_discipline_incident")
         .join(seed(xw), "behavior_type", "left"))
    j = flag_first(j, "is_most_severe_behavior", ["k_student", "k_student_xyear", "k_school", "k_discipline_incident"],
                   [F.col("severity_order").desc_nulls_last(), F.col("behavior_type").asc_nulls_last()])
    j = j.withColumn("is_most_severe_behavior", F.when(F.col("severity_order").isNotNull(), F.col("is_most_severe_behavior")))
    return j.select("k_student", "k_student_xyear", "k_school", "k_discipline_incident",
                    surrogate_key("k_student", "k_discipline_incident", F.lower("behavior_type"))
                    .alias("k_student_discipline_incident_behavior"), "tenant_code", "school_year", "school_id", "incident_id",
                    "behavior_type", "behavior_detailed_description", F.lit(True).alias("is_offender"), "severity_order",
                    "is_most_severe_behavior", *more, F.get("participation_codes_array", F.lit(0)).alias("participation_code"),
                    "participation_codes_array")


@dataset("fct_student_discipline_actions_summary", domain="discipline",
         grain=("k_student", "k_discipline_actions_event"))
def fct_student_discipline_actions_summary(wh) -> DataFrame:
    """Per action event: its behaviors and incidents (A11 A12, through the link
    with an optional behavior type, J11 J15), its actions, and the most severe
    action/behavior pair, reported only when both severities are known (W1)."""
    link = wh("stg_ef3__discipline_actions__student_discipline_incident_behaviors").drop("tenant_code")
    beh = wh("fct_student_discipline_incident_behaviors").select(
        F.col("k_student").alias("__b_student"), F.col("k_student_xyear").alias("__b_xyear"),
        F.col("school_id").alias("__b_school"), F.col("incident_id").alias("__b_incident"),
        F.col("behavior_type").alias("__b_type"), F.col("severity_order").alias("__b_sev"))

    def link_cond(l, b):
        return ((l.k_student == b.__b_student) & (l.k_student_xyear == b.__b_xyear) & (l.school_id == b.__b_school)
                & (l.incident_id == b.__b_incident) & (l.behavior_type.isNull() | (l.behavior_type == b.__b_type)))

    arrays = (link.join(beh, link_cond(link, beh))
              .groupBy("k_student", "k_student_xyear", "discipline_action_id", "discipline_date")
              .agg(sorted_array("__b_type").alias("behavior_types_array"),
                   sorted_distinct_array("__b_incident").alias("incident_id_array")))
    act = wh("fct_student_discipline_actions")
    acts = act.groupBy("k_student", "k_student_xyear", "k_discipline_actions_event").agg(
        sorted_array("discipline_action").alias("discipline_actions_array"))
    a = act.select("k_student", "k_student_xyear", "k_discipline_actions_event", "tenant_code", "school_year",
                   "discipline_action_id", "discipline_date", "discipline_action", "severity_order")
    ln = link.select(F.col("k_student").alias("__l_student"), F.col("k_student_xyear").alias("__l_xyear"),
                     F.col("discipline_action_id").alias("__l_action"), F.col("discipline_date").alias("__l_date"),
                     "incident_id", "school_id", "behavior_type", F.col("k_student").alias("k_student"),
                     F.col("k_student_xyear").alias("k_student_xyear")).drop("k_student", "k_student_xyear")
    j = a.join(ln, (a.k_student == ln.__l_student) & (a.k_student_xyear == ln.__l_xyear)
               & (a.discipline_action_id == ln.__l_action) & (a.discipline_date == ln.__l_date), "left")
    j = j.join(beh, (j.__l_student == beh.__b_student) & (j.__l_xyear == beh.__b_xyear) & (j.school_id == beh.__b_school)
               & (j.incident_id == beh.__b_incident) & (j.behavior_type.isNull() | (j.behavior_type == beh.__b_type)),
               "left")
    j = (j.join(acts, ["k_student", "k_student_xyear", "k_discipline_actions_event"])
         .join(arrays, ["k_student", "k_student_xyear", "discipline_action_id", "discipline_date"], "left"))
    both = F.col("__b_sev").isNotNull() & F.col("severity_order").isNotNull()
    j = j.withColumn("most_severe_behavior_type", F.when(both, F.col("__b_type"))) \
         .withColumn("most_severe_discipline_action", F.when(both, F.col("discipline_action")))
    j = deduplicate(j, ["k_student", "k_discipline_actions_event"], [
        F.col("severity_order").desc_nulls_last(), F.col("__b_sev").desc_nulls_last(),
        F.col("discipline_action").asc_nulls_last(), F.col("__b_type").asc_nulls_last(),
        F.col("incident_id").asc_nulls_last()])
    return j.select("k_student", "k_student_xyear", "k_discipline_actions_event", "tenant_code", "school_year",
                    "behavior_types_array", "incident_id_array", "discipline_actions_array",
                    "most_severe_behavior_type", "most_severe_discipline_action")


@dataset("fct_student_discipline_incident_summary", domain="discipline",
         grain=("k_student", "k_discipline_incident"))
def fct_student_discipline_incident_summary(wh) -> DataFrame:
    """Per student and incident: behaviors (A11), the distinct actions taken
    for it (F21 array_distinct, through the link with an optional behavior
    type, J11), and the most severe pair when both severities are known (W1)."""
    beh = wh("fct_student_discipline_incident_behaviors")
    link = wh("stg_ef3__discipline_actions__student_discipline_incident_behaviors").select(
        F.col("k_student").alias("__l_student"), F.col("k_student_xyear").alias("__l_xyear"),
        F.col("school_id").alias("__l_school"), F.col("incident_id").alias("__l_incident"),
        F.col("behavior_type").alias("__l_type"), "discipline_action_id", "discipline_date")
    dis = wh("stg_ef3__discipline_actions__disciplines")
    act = wh("fct_student_discipline_actions").select(
        F.col("k_student").alias("__a_student"), F.col("k_student_xyear").alias("__a_xyear"),
        F.col("discipline_action_id").alias("__a_action"), F.col("discipline_date").alias("__a_date"),
        "discipline_action", F.col("severity_order").alias("__a_sev"))
    barr = beh.groupBy("k_student", "k_student_xyear", "k_discipline_incident").agg(
        sorted_array("behavior_type").alias("behavior_types_array"))
    la = link.select("__l_student", "__l_xyear", "__l_incident", "discipline_action_id", "discipline_date")
    aarr = (la.join(dis, (la.__l_student == dis.k_student) & (la.discipline_action_id == dis.discipline_action_id)
                    & (la.discipline_date == dis.discipline_date))
            .groupBy(F.col("__l_student").alias("k_student"), F.col("__l_xyear").alias("k_student_xyear"),
                     F.col("__l_incident").alias("incident_id"))
            .agg(F.array_distinct(sorted_array("discipline_type")).alias("discipline_actions_array")))
    j = beh.join(link, (beh.k_student == link.__l_student) & (beh.k_student_xyear == link.__l_xyear)
                 & (beh.school_id == link.__l_school) & (beh.incident_id == link.__l_incident)
                 & (link.__l_type.isNull() | (link.__l_type == beh.behavior_type)), "left")
    j = j.join(act, (j.__l_student == act.__a_student) & (j.__l_xyear == act.__a_xyear)
               & (j.discipline_action_id == act.__a_action) & (j.discipline_date == act.__a_date), "left")
    j = (j.join(barr, ["k_student", "k_student_xyear", "k_discipline_incident"])
         .join(aarr, ["k_student", "k_student_xyear", "incident_id"], "left"))
    both = F.col("severity_order").isNotNull() & F.col("__a_sev").isNotNull()
    j = (j.withColumn("most_severe_behavior_type", F.when(both, F.col("behavior_type")))
         .withColumn("most_severe_discipline_action", F.when(both, F.col("discipline_action"))))
    j = deduplicate(j, ["k_student", "k_discipline_incident"], [
        F.col("__a_sev").desc_nulls_last(), F.col("severity_order").desc_nulls_last(),
        F.col("behavior_type").asc_nulls_last(), F.col("discipline_action").asc_nulls_last(),
        F.col("discipline_action_id").asc_nulls_last()])
    return j.select("k_student", "k_student_xyear", "k_discipline_incident", "tenant_code", "school_year",
                    "behavior_types_array", "discipline_actions_array", "most_severe_behavior_type",
                    "most_severe_discipline_action")


@dataset("fct_student_discipline_incident_non_offenders", domain="discipline",
         grain=("k_student", "k_discipline_incident"))
def fct_student_discipline_incident_non_offenders(wh) -> DataFrame:
    """Non-offenders of known students, schools and incidents (J1) with their
    sorted participation codes (A13); the inner join to codes drops people
    without any code.  The first code is the analytic one."""
    s = wh("stg_ef3__student_discipline_incident_non_offender_associations")
    codes = (wh("stg_ef3__student_discipline_incident_non_offender_associations__participation_codes")
             .groupBy("k_student", "k_student_xyear", "k_discipline_incident")
             .agg(sorted_array("participation_code").alias("participation_codes_array")))
    j = (s.join(codes, ["k_student", "k_student_xyear", "k_discipline_incident"])
         .join(wh("dim_student").select("k_student"), "k_student")
         .join(wh("dim_school").select("k_school"), "k_school")
         .join(wh("dim_discipline_incident").select("k_discipline_incident"), "k_discipline_incident"))
    return j.select("k_student", "k_student_xyear", "k_school", "k_discipline_incident", "tenant_code", "school_id",
                    "incident_id", F.lit(False).alias("is_offender"),
                    F.get(F.col("participation_codes_array"), 0).alias("participation_code"),
                    "participation_codes_array")
