"""Oracle SQL for the key and reference summaries.

Keys and references are written out by hand, apart from the library's rule for them.
"""

from __future__ import annotations

#: table -> (relation, key columns, {column: parent})
TABLES = {
    "dim_lea": ("o_dim_lea", "k_lea", {"k_esc": "dim_esc"}),
    "dim_school": ("o_dim_school", "k_school", {"k_lea": "dim_lea"}),
    "dim_school_calendar": ("o_dim_school_calendar", "k_school_calendar", {"k_school": "dim_school"}),
    "dim_session": ("o_dim_session", "k_session", {"k_school": "dim_school"}),
    "dim_class_period": ("o_dim_class_period", "k_class_period", {"k_school": "dim_school"}),
    "dim_classroom": ("o_dim_classroom", "k_classroom", {"k_school": "dim_school"}),
    "dim_cohort": ("o_dim_cohort", "k_cohort", {"k_lea": "dim_lea", "k_school": "dim_school"}),
    "dim_student": ("o_dim_student", "k_student", {}),
    "fct_student_school_association": ("o_fct_enrollment", "k_student,k_school,entry_date", {
        "k_student": "dim_student", "k_lea": "dim_lea", "k_school": "dim_school", "k_school_calendar": "dim_school_calendar"}),
    "fct_student_cohort_association": ("o_fct_cohort", "k_student,k_cohort,cohort_begin_date", {
        "k_student": "dim_student", "k_cohort": "dim_cohort"}),
    "dim_parent": ("o_dim_parent", "k_parent", {}),
    "fct_student_parent_association": ("o_fct_student_parent", "k_student,k_parent", {
        "k_student": "dim_student", "k_parent": "dim_parent"}),
    "dim_program": ("o_dim_program", "k_program", {"k_lea": "dim_lea", "k_school": "dim_school"}),
    "fct_student_program_association": ("o_fct_program_assoc", "k_student_program", {
        "k_student": "dim_student", "k_program": "dim_program", "k_school": "dim_school"}),
    "fct_student_program_service": ("o_fct_program_service", "k_student_program,program_service", {
        "k_student": "dim_student", "k_program": "dim_program"}),
    "fct_student_program_participation_status": (
        "o_participation_status", "k_student_program,participation_status,status_begin_date",
        {"k_student": "dim_student", "k_program": "dim_program"}),
    "fct_student_homeless_program_association": ("o_fct_homeless_program", "k_student_program", {
        "k_student": "dim_student", "k_program": "dim_program", "k_lea": "dim_lea", "k_school": "dim_school"}),
    "fct_student_special_education_program_association": ("o_fct_special_education_program", "k_student_program", {
        "k_student": "dim_student", "k_program": "dim_program", "k_lea": "dim_lea", "k_school": "dim_school"}),
    "dim_course": ("o_dim_course", "k_course", {"k_lea": "dim_lea", "k_school": "dim_school"}),
    "dim_course_section": ("o_dim_course_section", "k_course_section", {
        "k_course": "dim_course", "k_school": "dim_school", "k_session": "dim_session", "k_classroom": "dim_classroom"}),
    "dim_grading_period": ("o_dim_grading_period", "k_grading_period", {"k_school": "dim_school"}),
    "fct_student_grades": ("o_fct_grades", "k_student,k_course_section,k_grading_period,grade_type", {
        "k_student": "dim_student", "k_course_section": "dim_course_section", "k_school": "dim_school",
        "k_grading_period": "dim_grading_period"}),
    "fct_student_section_association": ("o_fct_student_section", "k_student,k_course_section,begin_date", {
        "k_student": "dim_student", "k_course_section": "dim_course_section", "k_school": "dim_school"}),
    "fct_staff_section_association": ("o_fct_staff_section", "k_staff,k_course_section,begin_date", {
        "k_staff": "dim_staff", "k_course_section": "dim_course_section", "k_school": "dim_school"}),
    "brg_course_section_program": ("o_brg_section_program", "k_course_section,k_program", {
        "k_course_section": "dim_course_section", "k_program": "dim_program"}),
    "dim_discipline_incident": ("o_dim_discipline_incident", "k_discipline_incident", {"k_school": "dim_school"}),
    "fct_student_discipline_actions": ("o_fct_discipline_actions", "k_student,k_discipline_actions_event,discipline_action", {
        "k_student": "dim_student", "k_school": "dim_school", "k_staff": "dim_staff",
        "k_school__assignment": "dim_school", "k_school__responsibility": "dim_school"}),
    "fct_student_discipline_incident_behaviors": ("o_fct_incident_behaviors", "k_student,k_discipline_incident,behavior_type", {
        "k_student": "dim_student", "k_school": "dim_school", "k_discipline_incident": "dim_discipline_incident"}),
    "dim_assessment": ("o_dim_assessment", "k_assessment", {}),
    "dim_objective_assessment": ("o_dim_objective_assessment", "k_objective_assessment", {"k_assessment": "dim_assessment"}),
    "fct_student_assessment": ("o_fct_student_assessment", "k_student_assessment", {
        "k_assessment": "dim_assessment", "k_student": "dim_student"}),
    "fct_student_objective_assessment": ("o_fct_student_objective", "k_student_objective_assessment", {
        "k_objective_assessment": "dim_objective_assessment", "k_assessment": "dim_assessment", "k_student": "dim_student"}),
}
PARENTS = {"dim_esc": ("o_dim_esc", "k_esc"), "dim_staff": ("o_dim_staff", "k_staff"),
           **{t: (rel, key) for t, (rel, key, _) in TABLES.items() if t.startswith("dim_")}}
GROUPS = {
    "organizations": ("dim_lea", "dim_school", "dim_school_calendar", "dim_session", "dim_class_period", "dim_classroom", "dim_cohort"),
    "students": ("dim_student", "fct_student_school_association", "fct_student_cohort_association", "dim_parent",
                 "fct_student_parent_association"),
    "programs": ("dim_program", "fct_student_program_association", "fct_student_program_service",
                 "fct_student_program_participation_status", "fct_student_homeless_program_association",
                 "fct_student_special_education_program_association"),
    "courses": ("dim_course", "dim_course_section", "dim_grading_period", "fct_student_grades", "fct_student_section_association",
                "fct_staff_section_association", "brg_course_section_program"),
    "discipline": ("dim_discipline_incident", "fct_student_discipline_actions", "fct_student_discipline_incident_behaviors"),
    "assessments": ("dim_assessment", "dim_objective_assessment", "fct_student_assessment", "fct_student_objective_assessment"),
}


def keys_sql(group: str) -> tuple[str, set[str]]:
    parts, needs = [], set()
    for table in GROUPS[group]:
        rel, key, _ = TABLES[table]
        needs.add(rel)
        null = " OR ".join(f"{k} IS NULL" for k in key.split(","))
        parts.append(f"""SELECT '{table}' AS table_name, '{key}' AS key_columns, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, count(*) AS n_keys,
       count_if(n > 1) AS n_repeated_keys, CAST(coalesce(sum(n) FILTER (WHERE has_null), 0) AS BIGINT) AS n_null_rows
FROM (SELECT {key}, {null} AS has_null, count(*) AS n FROM {rel} GROUP BY ALL)""")
    return "\nUNION ALL\n".join(parts), needs


def references_sql(group: str) -> tuple[str, set[str]]:
    parts, needs = [], set()
    for table in GROUPS[group]:
        rel, _, refs = TABLES[table]
        for column, parent in refs.items():
            prel, pkey = PARENTS[parent]
            needs |= {rel, prel}
            parts.append(f"""SELECT '{table}' AS table_name, '{column}' AS key_columns, '{parent}' AS parent_name,
       count(DISTINCT c.{column}) AS n_keys, count(*) AS n_rows,
       count(DISTINCT c.{column}) FILTER (WHERE p.k IS NULL) AS n_orphan_keys, count_if(p.k IS NULL) AS n_orphan_rows
FROM {rel} c LEFT JOIN (SELECT DISTINCT {pkey} AS k FROM {prel}) p ON c.{column} = p.k
WHERE c.{column} IS NOT NULL HAVING count(*) > 0""")
    return "\nUNION ALL\n".join(parts), needs
