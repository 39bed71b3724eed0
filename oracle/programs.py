"""Oracle SQL for the seven program domains: stages, flags, services, statuses, facts."""

from __future__ import annotations

from .base import AS_OF, K, cte

_KEYS = f"""tenant_code, school_year AS api_year, school_year, {K('tenant_code', 'o_custkey', 'o_orderkey')} AS k_student_program,
       {K('tenant_code', 'o_custkey', 'school_year')} AS k_student, {K('tenant_code', 'o_custkey')} AS k_student_xyear,
       {K('tenant_code', 'home_school_id', 'o_orderpriority')} AS k_program, {K('tenant_code', 'home_nationkey')} AS k_lea,
       {K('tenant_code', 'home_school_id')} AS k_school, begin_date AS program_enroll_begin_date"""
_END = "CASE WHEN o_orderstatus = 'F' THEN begin_date + 90 END"
_COMMON = f"""o_orderkey % 3 = 0 AS is_served_outside_regular_session, o_orderstatus AS participation_status,
       CASE WHEN o_orderkey % 4 = 0 THEN 'Counselor' END AS participation_status_designated_by,
       begin_date AS participation_status_begin_date, {_END} AS participation_status_end_date,
       CASE WHEN o_orderstatus = 'F' THEN 'Completed' END AS reason_exited"""

#: short name, filter, attributes, (first service, second), (status, designated by)
STAGES = {
    "special_education": ("spec_ed", "o_orderpriority = '3-MEDIUM'", f"""
       o_orderkey % 2 = 0 AS is_idea_eligible, begin_date AS iep_begin_date, begin_date + 365 AS iep_end_date,
       begin_date + 180 AS iep_review_date, begin_date - 30 AS last_evaluation_date, o_orderkey % 13 = 0 AS is_medically_fragile,
       o_orderkey % 5 = 0 AS is_multiply_disabled, 35::BIGINT AS school_hours_per_week,
       o_orderkey % 10 AS spec_ed_hours_per_week, 'Inside regular class' AS special_education_setting, {_COMMON}""",
                          ("Speech Therapy", "Occupational Therapy"), ("Evaluated", None)),
    "language_instruction": ("lang_instr", "o_orderpriority = '2-HIGH'", f"""
       o_orderkey % 3 = 0 AS has_english_learner_participation, o_orderkey % 60 AS intervention_duration_min, {_COMMON}""",
                             ("Newcomer", "Dual Language"), ("Limited", "Teacher")),
    "homeless": ("homeless", "o_orderpriority = '1-URGENT'", f"""
       o_orderkey % 6 = 0 AS is_awaiting_foster_care, o_orderkey % 7 = 0 AS is_homeless_unaccompanied_youth,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Shelters' ELSE 'Doubled-up' END AS homeless_primary_nighttime_residence, {_COMMON}""",
                 ("Transportation", "School Supplies"), ("Eligible", "Counselor")),
    "title_i_part_a": ("title_i_part_a", "o_orderpriority = '4-NOT SPECIFIED'", f"""
       CASE WHEN o_orderkey % 2 = 0 THEN 'Targeted' ELSE 'Schoolwide' END AS title_i_part_a_participant_status, {_COMMON}""",
                       ("Reading", "Mathematics"), ("Served", None)),
    "cte": ("cte", "o_orderpriority = '5-LOW'", """
       o_orderkey % 4 = 0 AS non_traditional_gender_status, o_orderkey % 9 = 0 AS private_cte_program,
       o_orderkey % 3 = 0 AS served_outside_of_regular_session, 'Passed' AS technical_skills_assessment,
       CASE WHEN o_orderstatus = 'F' THEN 'Completed' END AS reason_exited""",
            ("Mentoring", "Internship"), ("Concentrator", "Teacher")),
    "migrant_education": ("migrant_edu", "o_orderstatus = 'P'", """
       o_orderkey % 2 = 0 AS priority_for_service, begin_date - 60 AS last_qualifying_move, begin_date - 400 AS us_initial_entry,
       begin_date - 90 AS us_most_recent_entry, begin_date - 380 AS us_initial_school_entry,
       begin_date - 58 AS qualifying_arrival_date, begin_date - 50 AS state_residency_date,
       begin_date + 1000 AS eligibility_expiration_date,
       CASE WHEN o_orderkey % 5 = 0 THEN 'Unfinished term' END AS continuation_of_services_reason""",
                          ("Migrant Counseling", "Summer School"), ("Migrant", None)),
    "food_services": ("school_food_service", "o_orderstatus = 'F'", """
       o_orderkey % 2 = 0 AS direct_certification, o_orderkey % 8 = 0 AS served_outside_of_regular_session""",
                      ("Lunch", "Breakfast"), ("Free", "District")),
}
FLAGS = {"special_education": "special_education", "language_instruction": "english_language_learner", "homeless": "homeless",
         "title_i_part_a": "title_i", "cte": "cte", "food_services": "food_service", "migrant_education": "migrant_education"}
ATTRIBUTES = {
    "special_education": ("is_idea_eligible", "is_multiply_disabled"),
    "language_instruction": ("has_english_learner_participation",),
    "homeless": ("is_awaiting_foster_care", "is_homeless_unaccompanied_youth", "homeless_primary_nighttime_residence"),
    "title_i_part_a": ("title_i_part_a_participant_status",),
    "cte": ("non_traditional_gender_status", "private_cte_program"),
    "food_services": ("direct_certification", "served_outside_of_regular_session"),
    "migrant_education": ("priority_for_service", "continuation_of_services_reason"),
}
_ACTIVE = f"program_enroll_begin_date <= {AS_OF} AND (program_enroll_end_date IS NULL OR program_enroll_end_date > {AS_OF})"


def _flags(build: str, keep: str = "true", extra: str = "") -> str:
    flag = FLAGS[build]
    attrs = "".join(f", max({a}) AS {a}" for a in ATTRIBUTES[build])
    return f"""
SELECT *, bool_or(is_{flag}_annual) OVER (PARTITION BY k_student_xyear) AS is_{flag}_ever
FROM (SELECT k_student, k_student_xyear, min(tenant_code) AS tenant_code, bool_or({keep} AND {_ACTIVE}) AS is_{flag}_active,
             bool_or({keep}) AS is_{flag}_annual{extra}{attrs}
      FROM stg_enr_{build} GROUP BY 1, 2)"""


services, statuses = [], []
for _build, (_short, _where, _attrs, (_first, _second), (_status, _by)) in STAGES.items():
    cte(f"stg_enr_{_build}", f"""
SELECT {_KEYS}, {_END} AS program_enroll_end_date, o_orderpriority AS program_name, {_attrs}, o_orderkey, o_custkey
FROM orders_home WHERE {_where}""", "orders_home")
    cte(f"o_program_{_build}", _flags(_build), f"stg_enr_{_build}")
    _service_end = "CAST(NULL AS DATE)" if _build == "homeless" else "e.program_enroll_end_date"
    _providers = ("'[{\"staffUniqueId\": \"T' || CAST(e.o_custkey AS VARCHAR) || '\"}]'" if _build == "special_education"
                  else "CAST(NULL AS VARCHAR)")
    _cip = "'12.' || CAST(e.o_orderkey % 50 AS VARCHAR)" if _build == "cte" else "CAST(NULL AS VARCHAR)"
    services.append(f"""
SELECT e.tenant_code, e.api_year, e.k_student_program, e.k_student, e.k_student_xyear, e.k_program, e.k_lea, e.k_school,
       e.program_enroll_begin_date, s.s AS program_service, s.s = '{_first}' AS primary_indicator, {_providers} AS v_providers,
       {_cip} AS cip_code, e.program_enroll_begin_date AS service_begin_date, {_service_end} AS service_end_date, '{_build}' AS build
FROM stg_enr_{_build} e JOIN (VALUES ('{_first}'), ('{_second}')) s(s) ON s.s = '{_first}' OR e.o_orderkey % 2 = 0""")
    _status_end = "CAST(NULL AS DATE)" if _build == "homeless" else "program_enroll_end_date"
    statuses.append(f"""
SELECT k_student_program, k_student, k_student_xyear, k_program, tenant_code, program_enroll_begin_date,
       '{_status}' AS participation_status, program_enroll_begin_date AS status_begin_date, {_status_end} AS status_end_date,
       {f"'{_by}'" if _by else 'CAST(NULL AS VARCHAR)'} AS designated_by
FROM stg_enr_{_build}""")

services.append("""
SELECT e.tenant_code, e.school_year, e.k_student_program, e.k_student, e.k_student_xyear, e.k_program, e.k_lea, e.k_school,
       e.program_enroll_begin_date, s.s, s.s = 'Tutoring', NULL, NULL, e.program_enroll_begin_date,
       e.program_enroll_end_date, 'generic'
FROM stg_prog_assoc e JOIN (VALUES ('Tutoring'), ('Counseling')) s(s) ON s.s = 'Tutoring' OR e.o_orderkey % 2 = 0""")
statuses.append("""
SELECT k_student_program, k_student, k_student_xyear, k_program, tenant_code, program_enroll_begin_date, participation_status,
       program_enroll_begin_date, program_enroll_end_date, NULL
FROM stg_prog_assoc""")
_stages = [f"stg_enr_{b}" for b in STAGES]
cte("stg_services", "\nUNION ALL\n".join(services), *_stages, "stg_prog_assoc")
cte("o_participation_status", "\nUNION ALL\n".join(statuses), *_stages, "stg_prog_assoc")
for _build in (*STAGES, "generic"):
    cte(f"o_services_{_build}", f"""
SELECT tenant_code, api_year, k_student_program, k_student, k_student_xyear, k_program, k_lea, k_school, program_enroll_begin_date,
       list_sort(list(program_service)) AS program_services
FROM stg_services WHERE build = '{_build}' GROUP BY ALL""", "stg_services")

cte("o_fct_program_service", """
SELECT s.* EXCLUDE (api_year, k_lea, k_school, build) FROM stg_services s JOIN o_dim_program p ON s.k_program = p.k_program""",
    "stg_services", "o_dim_program")

cte("o_primary_disability", """
SELECT e.tenant_code, e.school_year, e.k_student_program, e.k_student, e.k_student_xyear, e.k_program, e.k_lea, e.k_school,
       e.program_enroll_begin_date, d.t AS disability_type, CASE WHEN e.o_orderkey % 2 = 0 THEN 'Parent' END AS disability_source_type,
       'Diagnosis of ' || lower(d.t) AS disability_diagnosis, 1 AS order_of_disability
FROM stg_enr_special_education e JOIN (VALUES ('Autism', 1), ('Another Disability', 5)) d(t, m) ON e.o_orderkey % d.m = 0
QUALIFY row_number() OVER (PARTITION BY e.k_student_program ORDER BY d.t ASC NULLS LAST) = 1""", "stg_enr_special_education")

for _fact, _build in (("homeless", "homeless"), ("language_instruction", "language_instruction"),
                      ("special_education_bare", "special_education"), ("title_i_part_a", "title_i_part_a"), ("cte", "cte"),
                      ("school_food_service", "food_services"), ("migrant_education", "migrant_education")):
    cte(f"o_fct_{_fact}_program", f"""
SELECT e.* EXCLUDE (api_year, program_name, o_orderkey, o_custkey)
FROM stg_enr_{_build} e JOIN o_dim_student s ON e.k_student = s.k_student JOIN o_dim_program p ON e.k_program = p.k_program""",
        f"stg_enr_{_build}", "o_dim_student", "o_dim_program")
cte("o_fct_special_education_program", """
SELECT e.*, v.program_services AS special_education_program_services, d.disability_type AS primary_disability_type
FROM o_fct_special_education_bare_program e
LEFT JOIN o_services_special_education v ON e.k_student_program = v.k_student_program
LEFT JOIN o_primary_disability d ON e.k_student_program = d.k_student_program""",
    "o_fct_special_education_bare_program", "o_services_special_education", "o_primary_disability")

# ---------------------------------------------------------------- the custom config's programs
cte("o_program_homeless_custom", _flags("homeless", "program_name NOT IN ('1-URGENT')"), "stg_enr_homeless")
cte("o_program_title_i_part_a_custom", _flags("title_i_part_a", extra=", bool_or(program_enroll_end_date IS NULL) AS has_open_title_i"),
    "stg_enr_title_i_part_a")

# ---------------------------------------------------------------- Title I over the enrollments of all programs
cte("o_program_title_i_part_a_all", f"""
SELECT g.*, bool_or(g.is_title_i_part_a_annual) OVER (PARTITION BY g.k_student_xyear) AS is_title_i_part_a_ever,
       coalesce(t.is_title_i_active, false) AS is_title_i_active, coalesce(t.is_title_i_annual, false) AS is_title_i_annual,
       t.title_i_part_a_participant_status, coalesce(t.is_title_i_ever, false) AS is_title_i_ever
FROM (SELECT k_student, k_student_xyear, min(tenant_code) AS tenant_code,
             bool_or(program_name NOT IN ('1-URGENT') AND {_ACTIVE}) AS is_title_i_part_a_active,
             bool_or(program_name NOT IN ('1-URGENT')) AS is_title_i_part_a_annual, count(*) AS n_title_i_enrollments
      FROM stg_prog_assoc GROUP BY 1, 2) g
LEFT JOIN o_program_title_i_part_a t ON g.k_student = t.k_student""", "stg_prog_assoc", "o_program_title_i_part_a")
