"""Oracle SQL for subgroups, programs, finance and analyst queries."""

from __future__ import annotations

from .base import AS_OF, RATE, K, cte
from .core import CHARACTERISTICS, GENERIC_PROGRAMS, INDICATORS, OTHER_NAMES, PROGRAM_FLAGS

SUBGROUP_COLS = ["birth_country", "lep_code", "gender", "gender_identity", "grade_level", "grade_level_integer", "race_ethnicity",
                 "has_hispanic_latino_ethnicity", *PROGRAM_FLAGS, *CHARACTERISTICS, *INDICATORS, *GENERIC_PROGRAMS, *OTHER_NAMES]

cte("xwalk_subgroup_category_display_names", """
SELECT c AS subgroup_category, n AS subgroup_category_display_name
FROM (VALUES ('gender', 'Gender'), ('race_ethnicity', 'Race and Ethnicity'), ('grade_level', 'Grade Level')) t(c, n)""")
cte("xwalk_subgroup_value_display_names", """
SELECT c AS subgroup_category, v AS subgroup_value, n AS subgroup_value_display_name
FROM (VALUES ('gender', 'Female', 'Female students'), ('gender', 'Male', 'Male students'),
             ('is_gifted', 'true', 'Gifted')) t(c, v, n)""")
cte("xwalk_student_programs", """
SELECT p AS program_name, i AS indicator_name, a AS is_active, n AS is_annual, e AS is_ever
FROM (VALUES ('1-URGENT', 'urgent_support', true, true, true), ('2-HIGH', 'high_support', true, true, false),
             ('3-MEDIUM', 'medium_support', false, true, true)) t(p, i, a, n, e)""")

cte("o_stu_long", "\nUNION ALL\n".join(
    f"SELECT k_student, k_student_xyear, tenant_code, school_year, '{c}' AS subgroup_category, "
    f"CAST({c} AS VARCHAR) AS subgroup_value FROM o_dim_student" for c in SUBGROUP_COLS), "o_dim_student")

cte("o_dim_subgroup", f"""
SELECT {K('g.subgroup_category', 'g.subgroup_value')} AS k_subgroup, g.subgroup_category,
       coalesce(c.subgroup_category_display_name, g.subgroup_category) AS subgroup_category_display_name,
       g.subgroup_value, coalesce(v.subgroup_value_display_name, g.subgroup_value) AS subgroup_value_display_name
FROM (SELECT DISTINCT lower(subgroup_category) AS subgroup_category, subgroup_value FROM o_stu_long
      UNION ALL SELECT 'all_students', 'all_students') g
LEFT JOIN xwalk_subgroup_value_display_names v
  ON g.subgroup_category = v.subgroup_category AND g.subgroup_value = v.subgroup_value
LEFT JOIN xwalk_subgroup_category_display_names c ON g.subgroup_category = c.subgroup_category""",
    "o_stu_long", "xwalk_subgroup_value_display_names", "xwalk_subgroup_category_display_names")

cte("o_fct_student_subgroup", """
SELECT l.k_student, l.k_student_xyear, d.k_subgroup, l.tenant_code, l.school_year
FROM (SELECT * FROM o_stu_long
      UNION ALL
      SELECT k_student, k_student_xyear, tenant_code, school_year, 'all_students', 'all_students' FROM o_dim_student) l
JOIN o_dim_subgroup d
  ON lower(l.subgroup_category) = lower(d.subgroup_category) AND lower(l.subgroup_value) = lower(d.subgroup_value)""",
    "o_stu_long", "o_dim_student", "o_dim_subgroup")

# ---------------------------------------------------------------- programs
cte("orders_home", """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
       h.home_school_id, h.home_nationkey, h.tenant_code, CAST(o.o_orderdate AS DATE) AS begin_date,
       CASE WHEN year(o.o_orderdate) >= 1998 THEN 2024 ELSE 2023 END AS school_year
FROM orders o JOIN home_school h ON o.o_custkey % (SELECT count(*) FROM supplier) = h.school_index""", "home_school")

cte("o_dim_program", f"""
SELECT {K('tenant_code', 'home_school_id', 'o_orderpriority')} AS k_program, {K('tenant_code', 'home_nationkey')} AS k_lea,
       {K('tenant_code', 'home_school_id')} AS k_school, 2024 AS school_year, tenant_code,
       CAST(home_school_id AS VARCHAR) AS ed_org_id, 'School' AS ed_org_type, o_orderpriority AS program_id,
       o_orderpriority AS program_name,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Intervention' ELSE 'Enrichment' END AS program_type
FROM (SELECT DISTINCT tenant_code, home_school_id, home_nationkey, o_orderpriority FROM orders_home) t""", "orders_home")

cte("stg_prog_assoc", f"""
SELECT tenant_code, school_year, {K('tenant_code', 'o_custkey', 'school_year')} AS k_student,
       {K('tenant_code', 'o_custkey')} AS k_student_xyear, {K('tenant_code', 'home_school_id', 'o_orderpriority')} AS k_program,
       {K('tenant_code', 'o_custkey', 'o_orderkey')} AS k_student_program,
       {K('tenant_code', 'home_nationkey')} AS k_lea, {K('tenant_code', 'home_school_id')} AS k_school,
       CAST(home_school_id AS VARCHAR) AS ed_org_id, o_orderpriority AS program_name, begin_date AS program_enroll_begin_date,
       CASE WHEN o_orderstatus = 'F' THEN begin_date + 90 END AS program_enroll_end_date,
       o_orderstatus AS participation_status, (o_orderkey % 3 = 0) AS is_served_outside_regular_session,
       o_orderkey
FROM orders_home""", "orders_home")

cte("o_fct_program_assoc", """
SELECT a.k_student_program, a.k_student, a.k_student_xyear, a.k_program, a.k_school, a.tenant_code, a.school_year,
       a.program_enroll_begin_date, a.program_enroll_end_date, a.participation_status,
       a.is_served_outside_regular_session
FROM stg_prog_assoc a
JOIN o_dim_student s ON a.k_student = s.k_student
JOIN o_dim_program p ON a.k_program = p.k_program""", "stg_prog_assoc", "o_dim_student", "o_dim_program")

_ACTIVE = f"program_enroll_begin_date <= {AS_OF} AND (program_enroll_end_date IS NULL OR program_enroll_end_date > {AS_OF})"

cte("o_student_programs_m", f"""
SELECT k_student, k_student_xyear, min(tenant_code) AS tenant_code, min(ed_org_id) AS ed_org_id,
       bool_or(indicator_name = 'high_support' AND {_ACTIVE}) AS is_high_support_active,
       bool_or(indicator_name = 'high_support') AS is_high_support_annual,
       bool_or(indicator_name = 'medium_support' AND {_ACTIVE}) AS is_medium_support_active,
       bool_or(indicator_name = 'medium_support') AS is_medium_support_annual,
       bool_or(indicator_name = 'urgent_support' AND {_ACTIVE}) AS is_urgent_support_active,
       bool_or(indicator_name = 'urgent_support') AS is_urgent_support_annual
FROM stg_prog_assoc JOIN xwalk_student_programs USING (program_name)
GROUP BY k_student, k_student_xyear""", "stg_prog_assoc", "xwalk_student_programs")

cte("o_student_programs", """
SELECT m.k_student, m.k_student_xyear, m.tenant_code, m.is_high_support_active, m.is_high_support_annual,
       m.is_medium_support_annual, x.is_medium_support_ever, m.is_urgent_support_active,
       m.is_urgent_support_annual, x.is_urgent_support_ever, m.ed_org_id
FROM o_student_programs_m m
LEFT JOIN (SELECT k_student_xyear, bool_or(is_medium_support_annual) AS is_medium_support_ever,
                  bool_or(is_urgent_support_annual) AS is_urgent_support_ever
           FROM o_student_programs_m GROUP BY k_student_xyear) x ON m.k_student_xyear = x.k_student_xyear""",
    "o_student_programs_m")


# ---------------------------------------------------------------- finance
cte("o_dim_local_account", f"""
SELECT {K('tenant_code', 'o_custkey')} AS k_local_account, {K('tenant_code', 'home_school_id')} AS k_school,
       tenant_code, 2024 AS fiscal_year, CAST(o_custkey AS VARCHAR) AS local_account_identifier,
       'Account ' || CAST(o_custkey AS VARCHAR) AS local_account_name, CAST(home_school_id AS VARCHAR) AS ed_org_id,
       'School' AS ed_org_type
FROM (SELECT DISTINCT tenant_code, o_custkey, home_school_id FROM orders_home) t""", "orders_home")

cte("o_fct_actuals", f"""
SELECT s.k_local_actual_snapshot, s.k_local_account, a.k_school, s.tenant_code, s.as_of_date,
       s.local_account_identifier, s.ed_org_id, s.fiscal_year, s.amount, s.financial_collection,
       row_number() OVER (PARTITION BY s.k_local_account
                          ORDER BY s.as_of_date DESC, s.k_local_actual_snapshot ASC) = 1 AS is_latest_snapshot
FROM (SELECT tenant_code, {K('tenant_code', 'o_orderkey')} AS k_local_actual_snapshot,
             {K('tenant_code', 'o_custkey')} AS k_local_account, o_totalprice AS amount, begin_date AS as_of_date,
             CAST(home_school_id AS VARCHAR) AS ed_org_id, o_orderpriority AS financial_collection,
             year(begin_date) AS fiscal_year, CAST(o_custkey AS VARCHAR) AS local_account_identifier
      FROM orders_home) s
JOIN o_dim_local_account a ON s.k_local_account = a.k_local_account""", "orders_home", "o_dim_local_account")

# ---------------------------------------------------------------- analyst
cte("o_q1", """
SELECT e.k_school, d.school_id, d.school_name, e.school_year, g.k_subgroup, g.subgroup_category, g.subgroup_value,
       count(DISTINCT e.k_student) AS total_unique_students
FROM o_fct_enrollment e
JOIN o_fct_student_subgroup s ON e.k_student = s.k_student
JOIN o_dim_school d ON e.k_school = d.k_school
JOIN o_dim_subgroup g ON s.k_subgroup = g.k_subgroup
GROUP BY 1, 2, 3, 4, 5, 6, 7""", "o_fct_enrollment", "o_fct_student_subgroup", "o_dim_school", "o_dim_subgroup")

cte("o_q2", f"""
SELECT *, {RATE('total_days_attended', 'total_days_enrolled')} AS attendance_rate FROM (
SELECT a.k_school, d.school_id, d.school_name, a.school_year, g.k_subgroup, g.subgroup_category, g.subgroup_value,
       sum(a.days_attended) AS total_days_attended, sum(a.days_enrolled) AS total_days_enrolled,
       count(DISTINCT a.k_student) AS total_unique_students
FROM o_msr_cum a
JOIN o_fct_student_subgroup s ON a.k_student = s.k_student
JOIN o_dim_school d ON a.k_school = d.k_school
JOIN o_dim_subgroup g ON s.k_subgroup = g.k_subgroup
GROUP BY 1, 2, 3, 4, 5, 6, 7) t""", "o_msr_cum", "o_fct_student_subgroup", "o_dim_school", "o_dim_subgroup")

# ---------------------------------------------------------------- grades
cte("xwalk_letter_grades", """
SELECT l AS letter_grade, CAST(p AS DECIMAL(3,2)) AS unweighted_gpa_points, x AS exclude_from_gpa, d AS is_dorf,
       CAST(i AS INTEGER) AS grade_sort_index
FROM (VALUES ('a', 4.00, false, false, 1), ('n', 1.00, false, true, 2)) t(l, p, x, d, i)""")

cte("part_home", """
SELECT p.p_partkey, p.p_name, p.p_brand, p.p_type, p.p_size, h.home_school_id, h.home_nationkey, h.tenant_code
FROM part p JOIN home_school h ON p.p_partkey % (SELECT count(*) FROM supplier) = h.school_index""", "home_school")

cte("o_dim_course", f"""
SELECT {K('p.tenant_code', 'p.p_partkey')} AS k_course, p.tenant_code, 2024 AS school_year, CAST(p.p_partkey AS VARCHAR) AS course_code,
       p.p_name AS course_title, p.p_name AS lea_course_code, 'S' || CAST(p.p_partkey % 100 AS VARCHAR) AS sced_course_code,
       {K('p.tenant_code', 'p.home_nationkey')} AS k_lea, {K('p.tenant_code', 'p.home_school_id')} AS k_school,
       CAST(p.home_school_id AS VARCHAR) AS ed_org_id, 'School' AS ed_org_type, s.academic_subject, s.subject_array
FROM part_home p LEFT JOIN o_course_subject s ON {K('p.tenant_code', 'p.p_partkey')} = s.k_course""", "part_home", "o_course_subject")

cte("o_dim_course_section", f"""
SELECT {K('p.tenant_code', 'p.p_partkey', "'S1'")} AS k_course_section, c.k_course, c.k_school,
       {K('p.tenant_code', 'p.home_school_id', '2024', "'Year Round'")} AS k_session,
       CASE WHEN p.p_partkey % 3 <> 0 THEN {K('p.tenant_code', 'p.home_school_id', "'R101'")} END AS k_classroom, p.tenant_code,
       CAST(p.p_partkey AS VARCHAR) || '-S1' AS section_id, p.p_brand AS section_name,
       'L' || CAST(p.p_partkey AS VARCHAR) AS local_course_code, p.p_name || ' (local)' AS local_course_title,
       c.course_code, c.course_title, 2024 AS school_year, 'Year Round' AS session_name, c.academic_subject,
       p.p_size * 10 AS instructional_time_planned, p.p_partkey % 8 = 0 AS is_official_attendance_period,
       p.p_partkey % 2 + 1 AS sequence_of_course, coalesce(w.is_ap, false) AS is_ap,
       coalesce(w.is_dual_credit, false) AS is_dual_credit, coalesce(w.is_honors, false) AS is_honors,
       w.course_level_characteristics_array, 'Classroom' AS educational_environment_type, p.p_size AS available_credits
FROM part_home p
JOIN o_dim_course c ON {K('p.tenant_code', 'p.p_partkey')} = c.k_course
LEFT JOIN o_course_char_wide w ON {K('p.tenant_code', 'p.p_partkey', "'S1'")} = w.k_course_section""",
    "part_home", "o_dim_course", "o_course_char_wide")

cte("o_dim_grading_period", f"""
SELECT {K('s.tenant_code', 's.school_id', '2024', 'g.n')} AS k_grading_period, s.k_school, s.tenant_code,
       2024 AS school_year, g.n AS grading_period, g.b AS begin_date, g.e AS end_date, g.q AS period_sequence
FROM stg_schools s
CROSS JOIN (VALUES ('Third Quarter', DATE '2024-01-01', DATE '2024-01-15', 3),
                   ('Fourth Quarter', DATE '2024-01-16', DATE '2024-01-31', 4)) g(n, b, e, q)
WHERE s.k_school IN (SELECT k_school FROM o_dim_school)""", "stg_schools", "o_dim_school")

cte("stg_grades", f"""
SELECT hs.tenant_code, 2024 AS school_year, {K('hs.tenant_code', 'o.o_custkey', '2024')} AS k_student,
       {K('hs.tenant_code', 'hs.home_school_id')} AS k_school,
       {K('hp.tenant_code', 'l.l_partkey', "'S1'")} AS k_course_section,
       {K('hs.tenant_code', 'hs.home_school_id', '2024',
          "CASE WHEN l.l_linenumber % 2 = 0 THEN 'Third Quarter' ELSE 'Fourth Quarter' END")} AS k_grading_period,
       CASE WHEN l.l_linestatus = 'F' THEN 'Final' ELSE 'Grading Period' END AS grade_type,
       l.l_returnflag AS letter_grade_earned, l.l_quantity AS numeric_grade_earned, l.l_linenumber
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN home_school hs ON o.o_custkey % (SELECT count(*) FROM supplier) = hs.school_index
JOIN home_school hp ON l.l_partkey % (SELECT count(*) FROM supplier) = hp.school_index""", "home_school")

cte("o_fct_grades", """
SELECT g.k_student, g.k_course_section, g.k_school, g.k_grading_period, g.grade_type, g.tenant_code, g.school_year,
       g.letter_grade_earned, g.numeric_grade_earned, x.unweighted_gpa_points, x.exclude_from_gpa, x.is_dorf,
       x.grade_sort_index
FROM stg_grades g
JOIN o_dim_student s ON g.k_student = s.k_student
JOIN o_dim_school d ON g.k_school = d.k_school
JOIN o_dim_grading_period p ON g.k_grading_period = p.k_grading_period
JOIN o_dim_course_section c ON g.k_course_section = c.k_course_section
LEFT JOIN xwalk_letter_grades x ON lower(g.letter_grade_earned) = x.letter_grade""",
    "stg_grades", "o_dim_student", "o_dim_school", "o_dim_grading_period", "o_dim_course_section",
    "xwalk_letter_grades")

# ---------------------------------------------------------------- discipline
cte("error_events", """
SELECT e.event_id, e.ts, e.user_id, e.value, h.home_school_id, h.tenant_code,
       CASE WHEN e.value >= 200 THEN 'Major' WHEN e.value >= 50 THEN 'Moderate' ELSE 'Minor' END AS behavior_type,
       CAST(e.ts AS DATE) AS incident_date
FROM events e JOIN home_school h ON e.user_id % (SELECT count(*) FROM supplier) = h.school_index
WHERE e.event_type = 'error'""", "home_school")

cte("stg_incident_behaviors", f"""
SELECT *, CASE WHEN event_id % 3 = 0 THEN 'Seen by staff: ' || behavior_type END AS behavior_detailed_description
FROM (SELECT {K('tenant_code', 'home_school_id', 'event_id')} AS k_discipline_incident, behavior_type, tenant_code,
             home_school_id, event_id, user_id
      FROM error_events
      UNION ALL
      SELECT {K('tenant_code', 'home_school_id', 'event_id')}, CASE WHEN event_id % 3 = 0 THEN behavior_type ELSE 'Unlisted' END,
             tenant_code, home_school_id, event_id, user_id
      FROM error_events WHERE event_id % 7 = 0)""", "error_events")

cte("o_dim_discipline_incident", f"""
SELECT {K('e.tenant_code', 'e.home_school_id', 'e.event_id')} AS k_discipline_incident,
       {K('e.tenant_code', 'e.home_school_id')} AS k_school, e.tenant_code, 2024 AS school_year,
       CAST(e.event_id AS VARCHAR) AS incident_id, e.incident_date, e.event_id % 7 = 0 AS has_multiple_behaviors,
       e.value AS incident_cost, (e.event_id % 4 = 0) AS was_reported_to_law_enforcement, b.behavior_array
FROM error_events e
JOIN o_dim_school s ON {K('e.tenant_code', 'e.home_school_id')} = s.k_school
LEFT JOIN (SELECT k_discipline_incident,
                  list({{'behavior_type': behavior_type, 'behavior_detailed_description': behavior_detailed_description}})
                    AS behavior_array
           FROM stg_incident_behaviors GROUP BY 1) b
  ON {K('e.tenant_code', 'e.home_school_id', 'e.event_id')} = b.k_discipline_incident""",
    "error_events", "o_dim_school", "stg_incident_behaviors")

cte("stg_student_behaviors", f"""
SELECT tenant_code, 2024 AS school_year, {K('tenant_code', 'user_id', '2024')} AS k_student,
       {K('tenant_code', 'user_id')} AS k_student_xyear, k_discipline_incident, behavior_type, behavior_detailed_description,
       CAST(event_id AS VARCHAR) AS incident_id, CAST(home_school_id AS VARCHAR) AS school_id,
       {K('tenant_code', 'home_school_id')} AS k_school
FROM (SELECT DISTINCT * FROM stg_incident_behaviors)""", "stg_incident_behaviors")

cte("stg_discipline_actions", f"""
SELECT tenant_code, 2024 AS school_year, 2024 AS api_year, {K('tenant_code', 'user_id', '2024')} AS k_student,
       {K('tenant_code', 'user_id')} AS k_student_xyear, 'A' || CAST(event_id AS VARCHAR) AS discipline_action_id,
       incident_date AS discipline_date,
       CASE WHEN event_id % 3 <> 0 THEN {K('tenant_code', 'home_school_id')} END AS k_school__responsibility,
       CASE WHEN event_id % 3 <> 2 THEN {K('tenant_code', 'home_school_id')} END AS k_school__assignment,
       CASE WHEN event_id % 3 <> 0 THEN CAST(home_school_id AS VARCHAR) END AS responsibility_school_id,
       CASE WHEN event_id % 3 <> 2 THEN CAST(home_school_id AS VARCHAR) END AS assignment_school_id,
       round(value / 10, 0) AS discipline_action_length,
       CASE WHEN value >= 100 THEN 'Suspension' ELSE 'Detention' END AS first_action,
       event_id % 3 = 0 AS has_warning,
       'T' || CAST(user_id % 7 AS VARCHAR) AS staff_unique_id,
       CAST(event_id AS VARCHAR) AS incident_id, CAST(home_school_id AS VARCHAR) AS school_id,
       CASE WHEN event_id % 5 <> 0 THEN behavior_type END AS link_behavior_type
FROM error_events""", "error_events")

cte("o_action_behaviors", f"""
SELECT a.k_student, a.k_student_xyear, a.discipline_action_id, a.discipline_date,
       list_sort(list({K('a.k_student', 'b.k_discipline_incident', 'lower(b.behavior_type)')}))
         AS k_student_discipline_incident_behavior_array
FROM stg_discipline_actions a
JOIN stg_student_behaviors b
  ON a.k_student = b.k_student AND a.incident_id = b.incident_id AND a.school_id = b.school_id
 AND (a.link_behavior_type IS NULL OR a.link_behavior_type = b.behavior_type)
GROUP BY 1, 2, 3, 4""", "stg_discipline_actions", "stg_student_behaviors")

cte("o_fct_discipline_actions", f"""
SELECT *, CASE WHEN severity_order IS NOT NULL THEN
            row_number() OVER (PARTITION BY k_student, k_student_xyear, k_school, k_discipline_actions_event
                               ORDER BY severity_order DESC NULLS LAST, discipline_action ASC NULLS LAST) = 1 END
            AS is_most_severe_action
FROM (
  SELECT a.k_student, a.k_student_xyear, coalesce(r.k_school, s.k_school) AS k_school,
         s.k_school AS k_school__assignment, r.k_school AS k_school__responsibility, a.school_year,
         {K('a.tenant_code', 'a.api_year', 'a.discipline_action_id', 'a.discipline_date')} AS k_discipline_actions_event,
         {K('a.tenant_code', 'a.staff_unique_id')} AS k_staff, a.tenant_code, a.discipline_action_id, a.discipline_date,
         d.action AS discipline_action, a.discipline_action_length,
         [{K('a.tenant_code', 'a.staff_unique_id')}] AS k_staff_array,
         l.k_student_discipline_incident_behavior_array,
         x.severity_order, x.is_oss, x.is_iss, x.is_exp, x.is_minor
  FROM stg_discipline_actions a
  JOIN o_dim_student st ON a.k_student = st.k_student
  LEFT JOIN o_dim_school r ON a.k_school__responsibility = r.k_school
  LEFT JOIN o_dim_school s ON a.k_school__assignment = s.k_school
  LEFT JOIN o_action_behaviors l
    ON a.k_student = l.k_student AND a.k_student_xyear = l.k_student_xyear
   AND a.discipline_action_id = l.discipline_action_id AND a.discipline_date = l.discipline_date
  JOIN (SELECT 'first' AS which UNION ALL SELECT 'warning') w ON w.which = 'first' OR a.has_warning
  CROSS JOIN LATERAL (SELECT CASE WHEN w.which = 'first' THEN a.first_action ELSE 'Warning' END AS action) d
  LEFT JOIN (VALUES ('Suspension', 2, true, false, false, false), ('Detention', 1, false, true, false, false))
       x(discipline_action, severity_order, is_oss, is_iss, is_exp, is_minor) ON d.action = x.discipline_action
  WHERE a.assignment_school_id IS NOT NULL OR a.responsibility_school_id IS NOT NULL
) t""", "stg_discipline_actions", "o_dim_student", "o_dim_school", "o_action_behaviors")

cte("o_fct_incident_behaviors", f"""
SELECT b.k_student, b.k_student_xyear, b.k_school, b.k_discipline_incident,
       {K('b.k_student', 'b.k_discipline_incident', 'lower(b.behavior_type)')} AS k_student_discipline_incident_behavior,
       b.tenant_code, b.school_year, b.school_id, b.incident_id, b.behavior_type, b.behavior_detailed_description, true AS is_offender,
       x.severity_order,
       CASE WHEN x.severity_order IS NOT NULL THEN
         row_number() OVER (PARTITION BY b.k_student, b.k_student_xyear, b.k_school, b.k_discipline_incident
                            ORDER BY x.severity_order DESC NULLS LAST, b.behavior_type ASC NULLS LAST) = 1 END
         AS is_most_severe_behavior,
       x.behavior_group, CASE WHEN c.n IS NOT NULL THEN c.codes[1] END AS participation_code, c.codes AS participation_codes_array
FROM stg_student_behaviors b
LEFT JOIN (SELECT {K('tenant_code', 'user_id', '2024')} AS k_student, {K('tenant_code', 'home_school_id', 'event_id')} AS k_incident,
                  1 AS n, CASE WHEN event_id % 2 = 0 THEN ['Accomplice', 'Perpetrator'] ELSE ['Perpetrator'] END AS codes
           FROM error_events WHERE event_id % 2 = 0 OR event_id % 5 <> 0) c
  ON b.k_student = c.k_student AND b.k_discipline_incident = c.k_incident
JOIN o_dim_student s ON b.k_student = s.k_student
JOIN o_dim_school h ON b.k_school = h.k_school
JOIN o_dim_discipline_incident i ON b.k_discipline_incident = i.k_discipline_incident
LEFT JOIN (VALUES ('Major', 3, 'Safety'), ('Moderate', 2, 'Conduct'), ('Minor', 1, 'Conduct'))
     x(behavior_type, severity_order, behavior_group) ON b.behavior_type = x.behavior_type""",
    "stg_student_behaviors", "error_events", "o_dim_student", "o_dim_school", "o_dim_discipline_incident")

cte("o_q3", """
SELECT entry_grade_level, count(DISTINCT k_student) AS n_students
FROM o_fct_enrollment WHERE is_active_enrollment GROUP BY 1""", "o_fct_enrollment")

cte("o_q4", """
SELECT school_year, count(DISTINCT k_student) AS n_students
FROM o_fct_enrollment
WHERE entry_date < make_date(school_year, 3, 1)
  AND (exit_withdraw_date >= make_date(school_year, 2, 1) OR exit_withdraw_date IS NULL)
GROUP BY 1""", "o_fct_enrollment")

cte("o_q5", """
SELECT d.school_id, d.school_name, c.discipline_date, c.discipline_action, c.is_iss, c.is_oss, c.n_actions
FROM (SELECT k_school, discipline_date, discipline_action, is_iss, is_oss, count(*) AS n_actions
      FROM o_fct_discipline_actions GROUP BY 1, 2, 3, 4, 5) c
JOIN o_dim_school d ON c.k_school = d.k_school""", "o_fct_discipline_actions", "o_dim_school")

cte("o_q6", f"""
SELECT *, {RATE('n_students_suspended', 'n_students_enrolled')} AS suspension_rate
FROM (SELECT k_school, school_year, sum(CAST(n_oss + n_iss > 0 AS INTEGER)) AS n_students_suspended,
             count(*) AS n_students_enrolled
      FROM (SELECT s.k_student, s.k_school, s.school_year,
                   sum(coalesce(CAST(d.is_oss AS INTEGER), 0)) AS n_oss,
                   sum(coalesce(CAST(d.is_iss AS INTEGER), 0)) AS n_iss
            FROM (SELECT *, date_diff('day', entry_date,
                                      coalesce(exit_withdraw_date, make_date(school_year, 6, 30))) AS n_days_enrolled
                  FROM o_fct_enrollment WHERE is_primary_school
                  QUALIFY row_number() OVER (PARTITION BY k_student
                                             ORDER BY n_days_enrolled DESC NULLS FIRST,
                                                      exit_withdraw_date DESC NULLS FIRST, k_school ASC) = 1) s
            LEFT JOIN o_fct_discipline_actions d ON s.k_student = d.k_student AND s.k_school = d.k_school
            GROUP BY 1, 2, 3) t
      GROUP BY 1, 2) u""", "o_fct_enrollment", "o_fct_discipline_actions")

cte("o_q9", """
SELECT a.k_student, a.school_year, a.k_program, p.program_type, p.program_id, p.program_name,
       a.program_enroll_begin_date, a.program_enroll_end_date, s.program_service, s.service_begin_date,
       s.service_end_date
FROM o_fct_program_assoc a
JOIN o_dim_program p ON a.k_program = p.k_program
LEFT JOIN o_fct_program_service s
  ON a.k_student = s.k_student AND a.k_program = s.k_program
 AND a.program_enroll_begin_date = s.program_enroll_begin_date""",
    "o_fct_program_assoc", "o_dim_program", "o_fct_program_service")

# ---------------------------------------------------------------- assessments
_NS = "'uri://rollcall.example/assessment'"

def _asmt(t: str = "", *more: str, subjects: int = 1) -> str:
    """Key of an assessment, or with more parts of what belongs to it."""
    return K(f"{t}tenant_code", "2024", *["lower('Mathematics')"] * subjects, f"lower({t}o_orderpriority)", f"lower({_NS})", *more)


def _stu_asmt(t: str = "") -> str:
    return _asmt(t, f"lower(CAST({t}o_orderkey AS VARCHAR))", f"lower(CAST({t}o_custkey AS VARCHAR))")


cte("assessment_orders", """
SELECT tenant_code, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, begin_date, school_year
FROM orders_home
UNION ALL
SELECT t.tenant_code, o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderpriority, o.begin_date, o.school_year
FROM orders_home o JOIN student_transfers t ON o.o_custkey = t.c_custkey WHERE o.o_orderkey % 5 = 0""",
    "orders_home", "student_transfers")

cte("stg_assessments", f"""
SELECT tenant_code, 2024 AS api_year, {_asmt()} AS k_assessment,
       o_orderpriority AS assessment_identifier, {_NS} AS namespace,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Screener' ELSE 'Benchmark' END AS assessment_family,
       'Assessment ' || o_orderpriority AS assessment_title, 'Mathematics' AS academic_subject
FROM (SELECT DISTINCT tenant_code, o_orderpriority FROM assessment_orders) t""", "assessment_orders")

cte("o_dim_assessment", """
SELECT a.k_assessment, a.tenant_code, a.api_year AS school_year, a.assessment_identifier, a.namespace,
       a.assessment_title, a.academic_subject, a.assessment_family,
       ['Percentile', 'Raw Score', 'Scale Score'] AS scores_array,
       [{'performance_level_name': 'Approaching', 'performance_level_value': '2'},
        {'performance_level_name': 'Below', 'performance_level_value': '1'},
        {'performance_level_name': 'Proficient', 'performance_level_value': '3'}] AS performance_levels_array,
       ['Fourth grade', 'Third grade'] AS grades_array
FROM stg_assessments a""", "stg_assessments")

cte("stg_student_assessments", f"""
SELECT tenant_code, 2024 AS api_year, school_year, {_stu_asmt()} AS k_student_assessment,
       {_asmt()} AS k_assessment, CAST(o_custkey AS VARCHAR) AS student_unique_id, o_orderpriority, o_orderkey, o_custkey,
       {K('tenant_code', 'o_custkey', 'school_year')} AS k_student, {K('tenant_code', 'o_custkey')} AS k_student_xyear,
       CAST(o_orderkey AS VARCHAR) AS student_assessment_identifier, o_orderpriority AS assessment_identifier,
       {_NS} AS namespace, begin_date AS administration_date,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Third grade' ELSE 'Fourth grade' END AS when_assessed_grade_level
FROM assessment_orders""", "assessment_orders")

cte("o_long_results", f"""
WITH stacked AS (
  SELECT o.tenant_code, 2024 AS api_year, {_stu_asmt('o.')} AS k_student_assessment,
         {_asmt('o.')} AS k_assessment, o.o_orderpriority AS assessment_identifier,
         {_NS} AS namespace,
         CASE l.l_linenumber % 3 WHEN 0 THEN 'Scale Score' WHEN 1 THEN 'Raw Score' ELSE 'Percentile' END AS score_name,
         CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS score_result
  FROM lineitem l JOIN assessment_orders o ON l.l_orderkey = o.o_orderkey
  UNION ALL
  SELECT tenant_code, 2024, {_stu_asmt()}, {_asmt()},
         o_orderpriority, {_NS}, 'Proficiency',
         CASE o_orderstatus WHEN 'F' THEN 'Proficient' WHEN 'O' THEN 'Approaching' ELSE 'Below' END
  FROM assessment_orders
  UNION ALL
  SELECT tenant_code, 2024, {_stu_asmt()}, {_asmt()},
         o_orderpriority, {_NS}, 'Scale Score', 'Z'
  FROM assessment_orders WHERE o_orderkey % 5 = 0
), deduped AS (
  SELECT * FROM stacked
  QUALIFY row_number() OVER (PARTITION BY k_student_assessment, score_name ORDER BY score_result DESC NULLS FIRST) = 1
)
SELECT d.tenant_code, d.api_year, d.k_student_assessment, d.score_name AS original_score_name,
       coalesce(x.n, 'other') AS normalized_score_name, d.score_result
FROM deduped d
LEFT JOIN o_dim_assessment f ON d.k_assessment = f.k_assessment
LEFT JOIN (VALUES (NULL, {_NS}, NULL, 'Scale Score', 'scale_score'),
                  ('1-URGENT', {_NS}, NULL, 'Raw Score', 'raw_score'),
                  (NULL, {_NS}, 'Benchmark', 'Raw Score', 'raw_score'),
                  (NULL, {_NS}, NULL, 'Proficiency', 'performance_level')) x(i, ns, fam, s, n)
  ON d.namespace = x.ns AND d.score_name = x.s
 AND coalesce(x.i, '1') = CASE WHEN x.i IS NULL THEN '1' ELSE d.assessment_identifier END
 AND coalesce(x.fam, '1') = CASE WHEN x.fam IS NULL THEN '1' ELSE f.assessment_family END""",
    "assessment_orders", "o_dim_assessment")

cte("o_asmt_scores", """
SELECT k.k_student_assessment, w.performance_level, w.raw_score, w.scale_score, o.v_other_results
FROM (SELECT DISTINCT k_student_assessment FROM o_long_results) k
LEFT JOIN (SELECT k_student_assessment,
                  max(CASE WHEN normalized_score_name = 'performance_level' THEN score_result END) AS performance_level,
                  max(CASE WHEN normalized_score_name = 'raw_score' THEN score_result END) AS raw_score,
                  max(CASE WHEN normalized_score_name = 'scale_score' THEN score_result END) AS scale_score
           FROM o_long_results WHERE normalized_score_name <> 'other' GROUP BY 1) w
  ON k.k_student_assessment = w.k_student_assessment
LEFT JOIN (SELECT k_student_assessment,
                  array_to_string(list_sort(list(original_score_name || '=' || score_result)), ',') AS v_other_results
           FROM o_long_results WHERE normalized_score_name = 'other' GROUP BY 1) o
  ON k.k_student_assessment = o.k_student_assessment""", "o_long_results")

cte("o_fct_student_assessment", """
SELECT a.k_student_assessment, a.k_assessment, s.k_student, a.k_student_xyear, a.tenant_code,
       a.student_assessment_identifier, a.school_year, a.administration_date, a.when_assessed_grade_level,
       f.performance_level, f.raw_score, f.scale_score, f.v_other_results
FROM stg_student_assessments a
LEFT JOIN o_dim_student s ON a.k_student = s.k_student
LEFT JOIN o_asmt_scores f ON a.k_student_assessment = f.k_student_assessment
WHERE a.k_student_xyear IN (SELECT k_student_xyear FROM o_dim_student)""",
    "stg_student_assessments", "o_dim_student", "o_asmt_scores")

cte("o_q10", """
SELECT a.k_student_assessment, s.k_student, a.school_year, TRY_CAST(l.score_result AS INTEGER) AS percentile
FROM stg_student_assessments a
LEFT JOIN o_dim_student s ON a.k_student = s.k_student
LEFT JOIN (SELECT * FROM o_long_results WHERE normalized_score_name = 'other' AND original_score_name = 'Percentile') l
  ON a.k_student_assessment = l.k_student_assessment
WHERE a.k_student_xyear IN (SELECT k_student_xyear FROM o_dim_student)""",
    "stg_student_assessments", "o_dim_student", "o_long_results")

# ---------------------------------------------------------------- sections and staff
cte("stg_student_sections", f"""
SELECT hs.tenant_code, 2024 AS school_year, {K('hs.tenant_code', 'o.o_custkey', '2024')} AS k_student,
       {K('hp.tenant_code', 'l.l_partkey', "'S1'")} AS k_course_section,
       DATE '2024-01-01' + CAST(l.l_orderkey % 10 AS INTEGER) AS begin_date,
       CASE WHEN l.l_linestatus = 'F' THEN DATE '2024-01-01' + CAST(l.l_orderkey % 10 AS INTEGER) + 15 END AS end_date,
       l.l_linenumber = 1 AS is_homeroom
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN home_school hs ON o.o_custkey % (SELECT count(*) FROM supplier) = hs.school_index
JOIN home_school hp ON l.l_partkey % (SELECT count(*) FROM supplier) = hp.school_index""", "home_school")

_ACTIVE_SEC = f"""CASE WHEN x.school_year = max(x.school_year) OVER (PARTITION BY x.tenant_code)
                 AND (x.end_date IS NULL OR x.end_date >= {AS_OF}) AND x.begin_date <= {AS_OF}
            THEN true ELSE false END"""

cte("o_fct_student_section", f"""
SELECT x.k_student, s.k_student_xyear, c.k_school, x.k_course_section, x.tenant_code, x.school_year, x.begin_date,
       x.end_date, x.is_homeroom, {_ACTIVE_SEC} AS is_active_enrollment
FROM stg_student_sections x
JOIN o_dim_student s ON x.k_student = s.k_student
JOIN o_dim_course_section c ON x.k_course_section = c.k_course_section""",
    "stg_student_sections", "o_dim_student", "o_dim_course_section")

cte("staff_home", """
SELECT *, 'T' || CAST(c_custkey AS VARCHAR) AS staff_unique_id FROM customer_home""",
    "customer_home")

cte("stg_staff_emails", f"""
SELECT tenant_code, {K('tenant_code', 'staff_unique_id')} AS k_staff, t AS email_type, e AS email_address
FROM (SELECT tenant_code, staff_unique_id, 'Work' AS t,
             lower(staff_unique_id) || '@school' || CAST(home_school_id AS VARCHAR) || '.edu' AS e FROM staff_home
      UNION ALL SELECT tenant_code, staff_unique_id, 'Personal', lower(staff_unique_id) || '@gmail.com'
      FROM staff_home WHERE c_custkey % 2 = 0
      UNION ALL SELECT tenant_code, staff_unique_id, 'Work', lower(staff_unique_id) || ' at school'
      FROM staff_home WHERE c_custkey % 3 = 0
      UNION ALL SELECT tenant_code, staff_unique_id, 'Other', lower(staff_unique_id) || '@district.org'
      FROM staff_home WHERE c_custkey % 5 = 0) u""", "staff_home")

cte("o_staff_emails", f"""
SELECT *, regexp_matches(email_address, '^[a-zA-Z0-9_.''\\-]+[+]?[a-zA-Z0-9.-]*@[a-zA-Z0-9.\\-]+[.][a-zA-Z0-9]{{2,9}}') AS is_valid_email
FROM (SELECT tenant_code, k_staff, CAST(NULL AS VARCHAR) AS k_lea, CAST(NULL AS VARCHAR) AS k_school, email_type,
             email_address
      FROM stg_staff_emails
      UNION ALL
      SELECT tenant_code, {K('tenant_code', 'staff_unique_id')}, {K('tenant_code', 'home_nationkey')},
             {K('tenant_code', 'home_school_id')}, 'Work', lower(staff_unique_id) || '@district2024.org'
      FROM staff_home) u""", "stg_staff_emails", "staff_home")

cte("o_staff_official_emails", """
SELECT tenant_code, k_staff, email_type, email_address FROM o_staff_emails
WHERE is_valid_email AND email_type IN ('Work')
  AND split_part(email_address, '@', 2) NOT IN (
    'aim.com', 'aol.com', 'att.net', 'gmail.com', 'yahoo.com', 'hotmail.com', 'msn.com', 'live.com', 'charter.net',
    'earthlink.net', 'verizon.net', 'comcast.net', 'outlook.com')
QUALIFY row_number() OVER (PARTITION BY k_staff, email_address ORDER BY email_type ASC NULLS LAST) = 1""",
    "o_staff_emails")

cte("o_dim_staff", f"""
SELECT {K('s.tenant_code', 's.staff_unique_id')} AS k_staff, s.tenant_code, s.staff_unique_id,
       'Di' || s.staff_unique_id AS district_staff_id, 'St' || s.staff_unique_id AS state_staff_id,
       s.c_name AS first_name, CASE WHEN s.c_custkey % 3 = 0 THEN 'Lee' END AS middle_name,
       upper(left(s.c_mktsegment, 1)) || lower(substr(s.c_mktsegment, 2)) AS last_name,
       upper(left(s.c_mktsegment, 1)) || lower(substr(s.c_mktsegment, 2)) || ', ' || s.c_name AS display_name,
       upper(left(s.c_mktsegment, 1)) || lower(substr(s.c_mktsegment, 2)) || ', ' || s.c_name || ' (' || s.staff_unique_id || ')'
         AS safe_display_name,
       e.email_address, e.email_type, r.race_ethnicity
FROM staff_home s
LEFT JOIN o_staff_race r ON {K('s.tenant_code', 's.staff_unique_id')} = r.k_staff
LEFT JOIN (SELECT * FROM o_staff_emails
           QUALIFY row_number() OVER (PARTITION BY k_staff
                                      ORDER BY (email_type = 'Work') DESC NULLS LAST, email_type ASC NULLS LAST,
                                               email_address ASC NULLS LAST) = 1) e
  ON {K('s.tenant_code', 's.staff_unique_id')} = e.k_staff""", "staff_home", "o_staff_emails", "o_staff_race")

cte("o_fct_staff_section", f"""
SELECT x.k_staff, x.k_course_section, c.k_school, x.tenant_code, x.school_year, x.begin_date, x.end_date,
       x.classroom_position, {_ACTIVE_SEC} AS is_active_assignment
FROM (SELECT s.tenant_code, 2024 AS school_year, {K('s.tenant_code', 's.staff_unique_id')} AS k_staff,
             {K('p.tenant_code', 'p.p_partkey', "'S1'")} AS k_course_section, DATE '2024-01-01' AS begin_date,
             CASE WHEN s.c_custkey % 5 = 0 THEN DATE '2024-01-20' END AS end_date,
             'Teacher of Record' AS classroom_position
      FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS staff_index FROM staff_home) s JOIN part_home p
        ON s.staff_index = p.p_partkey % (SELECT count(*) FROM customer) AND p.p_size < 45) x
JOIN o_dim_staff d ON x.k_staff = d.k_staff
JOIN o_dim_course_section c ON x.k_course_section = c.k_course_section""",
    "staff_home", "part_home", "o_dim_staff", "o_dim_course_section")

cte("o_sections_per_enrollment", """
SELECT e.tenant_code, e.k_school, e.k_student, e.school_year, e.entry_date, count(s.k_course_section) AS n_sections
FROM o_fct_enrollment e
LEFT JOIN o_fct_student_section s
  ON e.k_student = s.k_student AND e.k_school = s.k_school
 AND ((s.begin_date >= e.entry_date AND (e.exit_withdraw_date IS NULL OR s.begin_date <= e.exit_withdraw_date))
      OR (s.end_date >= e.entry_date AND (e.exit_withdraw_date IS NULL OR s.end_date <= e.exit_withdraw_date)))
GROUP BY 1, 2, 3, 4, 5""", "o_fct_enrollment", "o_fct_student_section")

cte("o_dq_d18", """
SELECT k_school, k_student, school_year, entry_date, n_sections FROM o_sections_per_enrollment WHERE n_sections = 0""",
    "o_sections_per_enrollment")

cte("o_dq_d22", """
SELECT *, ((20000 * n_enrollments_without_sections + n_enrollments) // (2 * n_enrollments)) / 10000.0
            AS p_enrollments_without_sections
FROM (SELECT k_school, school_year, count(*) AS n_enrollments,
             count_if(n_sections = 0) AS n_enrollments_without_sections
      FROM o_sections_per_enrollment GROUP BY 1, 2) t
WHERE n_enrollments_without_sections > 0""", "o_sections_per_enrollment")

cte("o_dq_d23", """
SELECT c.* FROM o_dim_course_section c
WHERE c.k_course_section NOT IN (SELECT k_course_section FROM o_fct_staff_section)""",
    "o_dim_course_section", "o_fct_staff_section")

cte("o_dq_d24", """
SELECT c.* FROM o_dim_course_section c
WHERE c.k_course_section NOT IN (SELECT k_course_section FROM o_fct_student_section)""",
    "o_dim_course_section", "o_fct_student_section")

# ---------------------------------------------------------------- contacts
cte("contact_home", """
SELECT c.*, r.role, r.role || CAST(c.c_custkey AS VARCHAR) AS contact_unique_id
FROM customer_home c JOIN (VALUES ('P'), ('G')) r(role) ON r.role = 'P' OR c.c_custkey % 4 = 0""", "customer_home")

cte("o_parent_wide_emails", f"""
SELECT k_parent, tenant_code,
       max(CASE WHEN n = 'home' THEN e END) AS home_email_address,
       max(CASE WHEN n = 'work' THEN e END) AS work_email_address
FROM (SELECT {K('tenant_code', 'contact_unique_id')} AS k_parent, tenant_code, x.n, u.e
      FROM (SELECT *, 'Home' AS t, lower(contact_unique_id) || '@mail.example' AS e FROM contact_home
            UNION ALL SELECT *, 'Work', lower(contact_unique_id) || '@work.example' FROM contact_home
            WHERE c_custkey % 3 = 0
            UNION ALL SELECT *, 'Other', lower(contact_unique_id) || '@other.example' FROM contact_home
            WHERE c_custkey % 5 = 0) u
      JOIN (VALUES ('Home', 'home'), ('Work', 'work')) x(o, n) ON u.t = x.o) v
GROUP BY 1, 2""", "contact_home")

cte("o_parent_wide_phones", f"""
SELECT k_parent, tenant_code,
       max(CASE WHEN n = 'home' THEN p END) AS home_phone_number,
       max(CASE WHEN n = 'mobile' THEN p END) AS mobile_phone_number
FROM (SELECT {K('tenant_code', 'contact_unique_id')} AS k_parent, tenant_code, x.n, u.p
      FROM (SELECT *, 'Mobile' AS t, '555-0' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS p FROM contact_home
            UNION ALL SELECT *, 'Home', '555-1' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') FROM contact_home
            WHERE c_custkey % 2 = 0) u
      JOIN (VALUES ('Mobile', 'mobile'), ('Home', 'home')) x(o, n) ON u.t = x.o) v
GROUP BY 1, 2""", "contact_home")

cte("o_dim_parent", f"""
SELECT {K('c.tenant_code', 'c.contact_unique_id')} AS k_parent, c.tenant_code, 2024 AS school_year,
       c.contact_unique_id AS parent_unique_id,
       upper(left(c.c_mktsegment, 1)) || lower(substr(c.c_mktsegment, 2)) || ', '
         || CASE WHEN c.role = 'P' THEN 'Parent' ELSE 'Guardian' END AS display_name,
       CASE WHEN c.role = 'P' THEN 'Parent' ELSE 'Guardian' END AS first_name,
       upper(left(c.c_mktsegment, 1)) || lower(substr(c.c_mktsegment, 2)) AS last_name,
       p.home_phone_number, p.mobile_phone_number, e.home_email_address, e.work_email_address,
       CAST(c.c_custkey AS VARCHAR) || ' ' || CASE WHEN c.c_custkey % 7 = 0 THEN 'Mailing' ELSE 'Home' END || ' Ave'
         AS full_address
FROM contact_home c
LEFT JOIN o_parent_wide_phones p ON {K('c.tenant_code', 'c.contact_unique_id')} = p.k_parent
LEFT JOIN o_parent_wide_emails e ON {K('c.tenant_code', 'c.contact_unique_id')} = e.k_parent""",
    "contact_home", "o_parent_wide_phones", "o_parent_wide_emails")

cte("o_fct_student_parent", f"""
SELECT d.k_student, d.k_student_xyear, p.k_parent, a.tenant_code, a.school_year, a.contact_priority,
       a.relation_type, a.is_emergency_contact, a.is_primary_contact
FROM (SELECT c.tenant_code, y.sy AS school_year, {K('c.tenant_code', 'c.c_custkey', 'y.sy')} AS k_student,
             {K('c.tenant_code', 'c.c_custkey')} AS k_student_xyear,
             {K('c.tenant_code', 'c.contact_unique_id')} AS k_contact,
             CASE WHEN c.role = 'P' THEN 1 ELSE 2 END AS contact_priority,
             CASE WHEN c.role = 'P' THEN 'Parent' ELSE 'Guardian' END AS relation_type,
             (c.role = 'P' OR c.c_custkey % 8 = 0) AS is_primary_contact, c.role = 'P' AS is_emergency_contact
      FROM contact_home c CROSS JOIN (VALUES (2024), (2023)) y(sy)
      WHERE y.sy = 2024 OR (c.c_custkey % 2 = 0 AND c.role = 'P')) a
JOIN (SELECT k_student FROM o_dim_student WHERE is_latest_record) l ON a.k_student = l.k_student
JOIN o_dim_student d ON a.k_student_xyear = d.k_student_xyear
JOIN o_dim_parent p ON a.k_contact = p.k_parent""", "contact_home", "o_dim_student", "o_dim_parent")

cte("o_dq_d14", """
SELECT tenant_code, school_year, k_student, sum(CAST(is_primary_contact AS INTEGER)) AS n_primary_contacts
FROM o_fct_student_parent GROUP BY 1, 2, 3 HAVING sum(CAST(is_primary_contact AS INTEGER)) > 1""",
    "o_fct_student_parent")

cte("o_dq_d21", """
SELECT tenant_code, k_student_xyear, k_parent, count(DISTINCT school_year) AS n_school_years
FROM o_fct_student_parent GROUP BY 1, 2, 3 HAVING count(DISTINCT school_year) > 1""", "o_fct_student_parent")

# ---------------------------------------------------------------- other names, indicators
_PARTS = {"personal_title_prefix": "CASE WHEN c.c_custkey % 6 = 0 THEN 'Dr.' END",
          "first_name": "substring(c.c_name, 1, 3) || '-' || left(x.t, 1)",
          "middle_name": "CASE WHEN c.c_custkey % 4 = 0 THEN 'Lou' END", "last_surname": "upper(c.c_mktsegment)",
          "generation_code_suffix": "CASE WHEN c.c_custkey % 9 = 0 THEN 'Jr.' END"}
cte("o_other_names", f"""
SELECT tenant_code, api_year, k_student, k_student_xyear,
       {", ".join(f"min(CASE WHEN t = '{t}' THEN {p} END) AS {t.lower().replace(' ', '_')}_{p}"
                  for t in ("Alias", "Previous Legal Name") for p in _PARTS)}
FROM (SELECT c.tenant_code, 2024 AS api_year, {K('c.tenant_code', 'c.c_custkey', '2024')} AS k_student,
             {K('c.tenant_code', 'c.c_custkey')} AS k_student_xyear, x.t,
             {", ".join(f"{sql} AS {p}" for p, sql in _PARTS.items())}
      FROM customer_home c JOIN (VALUES ('Alias'), ('Previous Legal Name')) x(t)
        ON x.t = 'Alias' OR c.c_custkey % 3 = 0) o
GROUP BY 1, 2, 3, 4""", "customer_home")

_TRUE = "('yes', 'y', 'true', 't', '1', '1.0')"
_FALSE = "('no', 'n', 'false', 'f', '0', '0.0')"

cte("o_student_indicators", f"""
SELECT tenant_code, api_year, k_student, k_student_xyear, ed_org_id,
       CASE WHEN lower(has_iep) IN {_TRUE} THEN true WHEN lower(has_iep) IN {_FALSE} THEN false END AS has_iep,
       TRY_CAST(reading_level AS INTEGER) AS reading_level
FROM (SELECT c.tenant_code, 2024 AS api_year, {K('c.tenant_code', 'c.c_custkey', '2024')} AS k_student,
             {K('c.tenant_code', 'c.c_custkey')} AS k_student_xyear, CAST(c.home_school_id AS VARCHAR) AS ed_org_id,
             min(CASE WHEN i.n = 'has_iep' THEN i.v END) AS has_iep,
             min(CASE WHEN i.n = 'reading_level' THEN i.v END) AS reading_level
      FROM customer_home c
      JOIN (SELECT c_custkey AS k, 'has_iep' AS n,
                   CASE c_custkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'false' WHEN 2 THEN 'maybe' ELSE '1.0' END AS v
            FROM customer_home
            UNION ALL
            SELECT c_custkey, 'reading_level',
                   CASE WHEN c_custkey % 9 = 0 THEN 'high' ELSE CAST(c_custkey % 6 AS VARCHAR) END
            FROM customer_home) i ON c.c_custkey = i.k
      GROUP BY 1, 2, 3, 4, 5) w""", "customer_home")

# ---------------------------------------------------------------- class periods, cohorts


def _repair(t: str) -> str:
    h = f"TRY_CAST(left({t}, 2) AS INTEGER)"
    return f"(CASE WHEN {h} BETWEEN 1 AND 6 THEN lpad(CAST({h} + 12 AS VARCHAR), 2, '0') || substr({t}, 3) ELSE {t} END)"


cte("o_class_periods_raw", f"""
SELECT s.tenant_code, 2024 AS school_year, s.k_school, {K('s.tenant_code', 's.school_id', 'p.n')} AS k_class_period,
       p.n AS class_period_name, p.n = 'Period 1' AS is_official_attendance_period,
       CASE WHEN s.school_id % 5 = 0 THEN 2 ELSE 1 END AS n_meeting_times,
       {_repair('p.a')} AS first_start_time, {_repair('p.b')} AS first_end_time,
       CASE WHEN s.school_id % 5 <> 0 THEN {_repair('p.a')} END AS start_time,
       CASE WHEN s.school_id % 5 <> 0 THEN {_repair('p.b')} END AS end_time
FROM stg_schools s
JOIN o_dim_school d ON s.k_school = d.k_school
CROSS JOIN (VALUES ('Period 1', '08:00:00', '08:50:00'), ('Period 2', '11:30:00', '12:20:00'),
                   ('Period 3', '01:00:00', '01:50:00'), ('Period 4', '12:30:00', '01:15:00')) p(n, a, b)""",
    "stg_schools", "o_dim_school")

cte("o_dim_class_period", """
SELECT *, date_diff('minute', CAST('1970-01-01 ' || first_start_time AS TIMESTAMP),
                    CASE WHEN CAST('1970-01-01 ' || first_start_time AS TIMESTAMP) > CAST('1970-01-01 ' || first_end_time AS TIMESTAMP)
                         THEN CAST('1970-01-01 ' || first_end_time AS TIMESTAMP) + INTERVAL 12 HOUR
                         ELSE CAST('1970-01-01 ' || first_end_time AS TIMESTAMP) END) AS class_duration,
       date_diff('minute', CAST('1970-01-01 ' || start_time AS TIMESTAMP),
                    CASE WHEN CAST('1970-01-01 ' || start_time AS TIMESTAMP) > CAST('1970-01-01 ' || end_time AS TIMESTAMP)
                         THEN CAST('1970-01-01 ' || end_time AS TIMESTAMP) + INTERVAL 12 HOUR
                         ELSE CAST('1970-01-01 ' || end_time AS TIMESTAMP) END) AS period_duration
FROM o_class_periods_raw""", "o_class_periods_raw")

cte("o_dim_cohort", f"""
SELECT {K('s.tenant_code', 's.school_id', 'c.id')} AS k_cohort, s.k_lea, s.k_school, s.tenant_code, 2024 AS school_year,
       c.id AS cohort_id, c.id || ' at school ' || CAST(s.school_id AS VARCHAR) AS cohort_description,
       'Graduating Class' AS cohort_type, 'School' AS cohort_scope
FROM stg_schools s CROSS JOIN (VALUES ('Class of 2030'), ('Class of 2031')) c(id)""", "stg_schools")

cte("o_fct_cohort", f"""
SELECT a.k_student, s.k_student_xyear, a.k_cohort, a.tenant_code, a.school_year, a.cohort_begin_date,
       a.cohort_end_date,
       CASE WHEN a.school_year = max(a.school_year) OVER (PARTITION BY a.tenant_code)
                 AND a.cohort_begin_date <= {AS_OF}
                 AND (a.cohort_end_date IS NULL OR a.cohort_end_date >= {AS_OF}) THEN true ELSE false END AS is_active_cohort_association
FROM (SELECT tenant_code, 2024 AS school_year, {K('tenant_code', 'c_custkey', '2024')} AS k_student,
             {K('tenant_code', 'home_school_id', "CASE WHEN c_custkey % 2 = 0 THEN 'Class of 2030' ELSE 'Class of 2031' END")}
               AS k_cohort,
             DATE '2024-01-01' + CAST(c_custkey % 20 AS INTEGER) AS cohort_begin_date,
             CASE WHEN c_custkey % 3 = 0 THEN DATE '2024-01-26' END AS cohort_end_date
      FROM customer_home) a
JOIN o_dim_student s ON a.k_student = s.k_student
JOIN o_dim_cohort c ON a.k_cohort = c.k_cohort""", "customer_home", "o_dim_student", "o_dim_cohort")

# ---------------------------------------------------------------- academic records
cte("academic_home", """
SELECT c.*, y.sy AS school_year, t.term AS academic_term
FROM customer_home c
JOIN (VALUES (2024), (2023), (2022)) y(sy) ON y.sy = 2024 OR (y.sy = 2023 AND c.c_custkey % 2 = 0)
                                           OR (y.sy = 2022 AND c.c_custkey % 3 = 0)
CROSS JOIN (VALUES ('Fall'), ('Spring')) t(term)""", "customer_home")

cte("stg_academic_records", f"""
SELECT tenant_code, school_year AS api_year, school_year, academic_term,
       {K('tenant_code', 'c_custkey', 'school_year', 'academic_term')} AS k_student_academic_record,
       {K('tenant_code', 'c_custkey')} AS k_student_xyear,
       CASE WHEN c_custkey % 4 <> 0 THEN {K('tenant_code', 'home_school_id')} END AS k_school,
       CASE WHEN c_custkey % 2 = 1 THEN {K('tenant_code', "'district'", 'c_custkey % 3')} END AS k_lea,
       (c_custkey % 400) / 100.0 AS cumulative_gpa,
       CASE WHEN c_custkey % 5 <> 0 THEN (c_custkey % 300) / 100.0 END AS session_gpa,
       c_custkey % 30 AS cumulative_earned_credits, c_custkey
FROM academic_home""", "academic_home")

cte("o_fct_academic_record", """
SELECT r.k_student_academic_record, s.k_student, r.k_student_xyear, coalesce(r.k_lea, d.k_lea) AS k_lea, r.k_school,
       r.tenant_code, r.school_year, r.academic_term, r.cumulative_earned_credits
FROM stg_academic_records r
LEFT JOIN o_dim_school d ON r.k_school = d.k_school
LEFT JOIN o_dim_student s ON r.k_student_xyear = s.k_student_xyear AND r.school_year = s.school_year""",
    "stg_academic_records", "o_dim_school", "o_dim_student")

cte("o_combine_gpas", """
SELECT tenant_code, api_year, k_student_academic_record, 'Cumulative, weighted' AS gpa_type,
       (c_custkey % 450) / 100.0 AS gpa_value, true AS is_cumulative, 4.5 AS max_gpa_value
FROM stg_academic_records WHERE school_year = 2024
UNION ALL
SELECT tenant_code, api_year, k_student_academic_record, 'Cumulative, unknown weighting', cumulative_gpa, true,
       CAST(NULL AS DOUBLE)
FROM stg_academic_records
UNION ALL
SELECT tenant_code, api_year, k_student_academic_record, 'Non-cumulative, unknown weighting', session_gpa, false,
       CAST(NULL AS DOUBLE)
FROM stg_academic_records""", "stg_academic_records")

cte("o_fct_gpa", """
SELECT g.k_student_academic_record, g.gpa_type, g.gpa_value, g.is_cumulative, g.max_gpa_value, r.k_student,
       r.k_student_xyear, r.k_lea, r.k_school, r.tenant_code, r.school_year, r.academic_term
FROM o_combine_gpas g JOIN o_fct_academic_record r ON g.k_student_academic_record = r.k_student_academic_record""",
    "o_combine_gpas", "o_fct_academic_record")

cte("o_diplomas", """
SELECT a.k_student_academic_record, 'Regular Diploma' AS diploma_type,
       make_date(a.school_year, 6, 1) AS diploma_award_date, 'Diploma ' || a.academic_term AS diploma_description,
       r.tenant_code, r.k_student, r.k_student_xyear, r.k_lea, r.k_school, r.school_year, r.academic_term
FROM stg_academic_records a
JOIN o_fct_academic_record r ON a.k_student_academic_record = r.k_student_academic_record""",
    "stg_academic_records", "o_fct_academic_record")

cte("o_fct_diploma", """
SELECT * EXCLUDE (academic_term) FROM o_diplomas
QUALIFY row_number() OVER (PARTITION BY k_student, k_student_xyear, school_year, k_lea, k_school, diploma_type,
                                        diploma_award_date
                           ORDER BY academic_term ASC NULLS LAST, k_student_academic_record ASC NULLS LAST) = 1""",
    "o_diplomas")

cte("o_dq_d27", """
SELECT * FROM (
  SELECT *,
         count(*) OVER (PARTITION BY k_student, k_student_xyear, school_year, k_lea, k_school, diploma_type,
                                     diploma_award_date) AS n_duplicates,
         row_number() OVER (PARTITION BY k_student, k_student_xyear, school_year, k_lea, k_school, diploma_type,
                                         diploma_award_date
                            ORDER BY academic_term ASC NULLS LAST, k_student_academic_record ASC NULLS LAST) = 1
           AS is_kept_in_fct_student_diploma
  FROM o_diplomas) t
WHERE n_duplicates > 1""", "o_diplomas")

cte("o_q8", """
SELECT g.k_student_academic_record, g.k_student_xyear, g.school_year, g.academic_term, g.gpa_type, g.gpa_value,
       s.k_student AS latest_k_student, s.display_name, s.grade_level
FROM o_fct_gpa g
LEFT JOIN (SELECT * FROM o_dim_student WHERE is_latest_record) s ON g.k_student_xyear = s.k_student_xyear""",
    "o_fct_gpa", "o_dim_student")

cte("o_q8_transcripts", """
SELECT t.k_course, t.k_student_academic_record, t.k_student_xyear, t.school_year, t.academic_term, t.course_title,
       t.course_attempt_result, t.earned_credits, t.final_letter_grade_earned,
       s.k_student AS latest_k_student, s.display_name, s.grade_level
FROM o_fct_transcripts t
LEFT JOIN (SELECT * FROM o_dim_student WHERE is_latest_record) s ON t.k_student_xyear = s.k_student_xyear""",
    "o_fct_transcripts", "o_dim_student")

cte("o_q8_records", """
SELECT r.k_student_academic_record, r.k_student_xyear, r.school_year, r.academic_term, r.cumulative_earned_credits,
       s.k_student AS latest_k_student, s.display_name, s.grade_level
FROM o_fct_academic_record r
LEFT JOIN (SELECT * FROM o_dim_student WHERE is_latest_record) s ON r.k_student_xyear = s.k_student_xyear""",
    "o_fct_academic_record", "o_dim_student")

# ---------------------------------------------------------------- staff school assignments
cte("o_fct_staff_school", f"""
SELECT {K('tenant_code', 'school_year', 'begin_date', 'k_staff', 'k_school', 'program_assignment',
          'staff_classification')} AS k_staff_school_association, *,
       CASE WHEN school_year = max(school_year) OVER (PARTITION BY tenant_code)
                 AND (end_date IS NULL OR end_date >= {AS_OF}) AND begin_date <= {AS_OF}
            THEN true ELSE false END AS is_active_assignment
FROM (
  SELECT st.k_staff, d.k_lea, d.k_school, c.k_school_calendar, ss.tenant_code, ss.school_year, ss.program_assignment,
         CASE WHEN sa.k IS NOT NULL THEN 'Teacher' WHEN la.k IS NOT NULL THEN 'Staff' END AS position_title,
         CASE WHEN sa.k IS NOT NULL THEN sa.begin_date WHEN la.k IS NOT NULL THEN DATE '2023-08-01' END AS begin_date,
         CASE WHEN sa.k IS NOT NULL THEN sa.end_date END AS end_date,
         CASE WHEN sa.k IS NOT NULL THEN 1.0 WHEN la.k IS NOT NULL THEN 0.5 END AS full_time_equivalency,
         CASE WHEN sa.k IS NOT NULL THEN 1 WHEN la.k IS NOT NULL THEN 2 END AS order_of_assignment,
         CASE WHEN sa.k IS NOT NULL THEN 'Teacher' WHEN la.k IS NOT NULL THEN 'Instructional Staff' END AS staff_classification
  FROM (SELECT h.tenant_code, 2024 AS school_year, {K('h.tenant_code', 'h.staff_unique_id')} AS k_staff,
               {K('h.tenant_code', 'h.home_school_id')} AS k_school,
               CASE WHEN h.c_custkey % 3 <> 0 THEN {K('h.tenant_code', 'h.home_school_id', '2024', "'main'")} END
                 AS k_school_calendar, p.prog AS program_assignment, h.home_nationkey
        FROM staff_home h JOIN (VALUES ('Regular Education'), ('Special Education')) p(prog)
          ON p.prog = 'Regular Education' OR h.c_custkey % 2 = 0) ss
  JOIN o_dim_school d ON ss.k_school = d.k_school
  JOIN o_dim_staff st ON ss.k_staff = st.k_staff
  LEFT JOIN (SELECT {K('tenant_code', 'staff_unique_id')} AS k, {K('tenant_code', 'home_nationkey')} AS k_lea
             FROM staff_home) la ON ss.k_staff = la.k AND d.k_lea = la.k_lea
  LEFT JOIN (SELECT {K('tenant_code', 'staff_unique_id')} AS k, {K('tenant_code', 'home_school_id')} AS k_school,
                    DATE '2023-08-15' + CAST(c_custkey % 10 AS INTEGER) AS begin_date,
                    CASE WHEN c_custkey % 5 = 0 THEN DATE '2024-01-20' END AS end_date
             FROM staff_home WHERE c_custkey % 4 <> 0) sa ON ss.k_staff = sa.k AND d.k_school = sa.k_school
  LEFT JOIN o_dim_school_calendar c ON ss.k_school_calendar = c.k_school_calendar
) t""", "staff_home", "o_dim_school", "o_dim_staff", "o_dim_school_calendar")

cte("o_q7", """
SELECT st.staff_unique_id, st.email_address, st.display_name, d.school_id, d.school_name, a.position_title,
       a.staff_classification, a.begin_date, a.end_date
FROM (SELECT * FROM o_fct_staff_school WHERE is_active_assignment
      QUALIFY row_number() OVER (PARTITION BY k_staff
                                 ORDER BY end_date DESC NULLS FIRST, begin_date DESC NULLS FIRST,
                                          order_of_assignment ASC NULLS LAST, k_school ASC NULLS LAST,
                                          program_assignment ASC NULLS LAST) = 1) a
JOIN o_dim_staff st ON a.k_staff = st.k_staff
JOIN o_dim_school d ON a.k_school = d.k_school""", "o_fct_staff_school", "o_dim_staff", "o_dim_school")

# ---------------------------------------------------------------- course extras
cte("o_course_char_long", f"""
SELECT DISTINCT tenant_code, 2024 AS api_year, k_course_section, ch AS course_level_characteristic FROM (
  SELECT tenant_code, {K('tenant_code', 'p_partkey', "'S1'")} AS k_course_section,
         CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 9 = 0 THEN 'Dual Credit'
              WHEN p_partkey % 4 = 0 THEN 'Honors' END AS ch
  FROM part_home
  UNION ALL
  SELECT tenant_code, {K('tenant_code', 'p_partkey', "'S1'")}, CASE WHEN p_size > 40 THEN 'Honors' END
  FROM part_home
  UNION ALL
  SELECT tenant_code, {K('tenant_code', 'p_partkey', "'S1'")},
         CASE WHEN p_partkey % 10 = 0 THEN 'AP' WHEN p_partkey % 6 = 0 THEN 'Honors' END
  FROM part_home) t
WHERE ch IS NOT NULL""", "part_home")

cte("o_course_char_wide", """
SELECT tenant_code, api_year, k_course_section, list_sort(list(course_level_characteristic)) AS course_level_characteristics_array,
       bool_or(coalesce(course_level_characteristic = 'AP', false)) AS is_ap,
       bool_or(coalesce(course_level_characteristic = 'Dual Credit', false)) AS is_dual_credit,
       bool_or(coalesce(course_level_characteristic = 'Honors', false)) AS is_honors
FROM o_course_char_long GROUP BY 1, 2, 3""", "o_course_char_long")

cte("o_course_subject", f"""
SELECT p.tenant_code, 2024 AS api_year, {K('p.tenant_code', 'p.p_partkey')} AS k_course, s.subjects AS subject_array,
       coalesce(CASE WHEN len(s.subjects) = 1 THEN s.subjects[1] WHEN len(s.subjects) > 1 THEN 'Multiple' END,
                upper(left(p.p_type, 1)) || lower(substr(p.p_type, 2))) AS academic_subject
FROM part_home p
LEFT JOIN (SELECT k, list_sort(list(subj)) AS subjects FROM (
             SELECT {K('tenant_code', 'p_partkey')} AS k, upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS subj
             FROM part_home WHERE p_partkey % 5 = 0 OR p_partkey % 7 <> 0
             UNION ALL
             SELECT {K('tenant_code', 'p_partkey')}, 'Science' FROM part_home WHERE p_partkey % 5 = 0) u
           GROUP BY 1) s ON {K('p.tenant_code', 'p.p_partkey')} = s.k""", "part_home")

cte("o_wide_ids_course", f"""
SELECT tenant_code, 2024 AS api_year, {K('tenant_code', 'p_partkey')} AS k_course,
       p_name AS lea_course_code, 'S' || CAST(p_partkey % 100 AS VARCHAR) AS sced_course_code
FROM part_home""", "part_home")

cte("o_brg_section_program", f"""
SELECT c.k_course_section, p.k_program, b.tenant_code
FROM (SELECT tenant_code, {K('tenant_code', 'p_partkey', "'S1'")} AS k_course_section,
             {K('tenant_code', 'home_school_id', "(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW', '6-UNKNOWN'])"
                "[CAST(p_partkey % 6 AS INTEGER) + 1]")} AS k_program
      FROM part_home) b
JOIN o_dim_course_section c ON b.k_course_section = c.k_course_section
JOIN o_dim_program p ON b.k_program = p.k_program""", "part_home", "o_dim_course_section", "o_dim_program")

# ---------------------------------------------------------------- educator preparation
cte("candidate_home", """
SELECT *, 'C' || CAST(c_custkey AS VARCHAR) AS candidate_id FROM customer_home""",
    "customer_home")

cte("stg_candidates", f"""
SELECT c.tenant_code, y.sy AS school_year, y.sy AS api_year, {K('c.tenant_code', 'c.candidate_id', 'y.sy')} AS k_candidate,
       {K('c.tenant_code', 'c.candidate_id')} AS k_candidate_xyear, {K('c.tenant_code', 'c.candidate_id')} AS k_person,
       c.candidate_id, c.c_name AS first_name,
       CASE WHEN y.sy = 2023 THEN 'Earlier' ELSE upper(left(c.c_mktsegment, 1)) || lower(substr(c.c_mktsegment, 2)) END
         AS last_name,
       CASE WHEN c.c_custkey % 3 = 0 THEN 'Rae' END AS middle_name,
       CASE WHEN c.c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
       (c.c_custkey % 9 = 0) AS has_hispanic_latino_ethnicity, (c.c_custkey % 4 = 0) AS is_economic_disadvantaged,
       c.c_custkey
FROM candidate_home c JOIN (VALUES (2024), (2023)) y(sy) ON y.sy = 2024 OR c.c_custkey % 2 = 0""", "candidate_home")

cte("o_candidate_race", """
SELECT c.k_candidate, r.race_array, c.has_hispanic_latino_ethnicity,
       CASE WHEN coalesce(c.has_hispanic_latino_ethnicity, false) THEN 'Latinx'
            WHEN coalesce(len(r.race_array), 0) > 1 THEN 'Multiple'
            WHEN coalesce(len(r.race_array), 0) = 1 THEN r.race_array[1] ELSE 'Unknown' END AS race_ethnicity
FROM stg_candidates c
LEFT JOIN (SELECT k_candidate, list_sort(list(race)) AS race_array FROM (
             SELECT k_candidate, 'White' AS race FROM stg_candidates WHERE c_custkey % 5 IN (0, 1)
             UNION ALL SELECT k_candidate, 'Asian' FROM stg_candidates WHERE c_custkey % 5 = 1) u
           GROUP BY 1) r ON c.k_candidate = r.k_candidate""", "stg_candidates")

cte("o_immutable_candidate_demos", """
SELECT * FROM (
  SELECT c.k_candidate, c.k_candidate_xyear, c.tenant_code, c.school_year, c.first_name, c.middle_name, c.last_name,
         c.last_name || ', ' || c.first_name || coalesce(' ' || left(c.middle_name, 1), '') AS display_name,
         c.last_name || ', ' || c.first_name || coalesce(' ' || left(c.middle_name, 1), '') || ' (' || c.candidate_id
           || ')' AS safe_display_name,
         c.gender, r.race_ethnicity, r.race_array, c.has_hispanic_latino_ethnicity
  FROM stg_candidates c LEFT JOIN o_candidate_race r ON c.k_candidate = r.k_candidate) t
QUALIFY row_number() OVER (PARTITION BY k_candidate ORDER BY school_year DESC NULLS FIRST) = 1""",
    "stg_candidates", "o_candidate_race")

cte("o_dim_candidate", """
SELECT c.k_candidate, c.k_candidate_xyear, c.k_person, c.tenant_code, c.school_year, c.candidate_id,
       c.is_economic_disadvantaged, d.first_name, d.middle_name, d.last_name, d.display_name, d.safe_display_name,
       d.gender, d.race_ethnicity, d.race_array, d.has_hispanic_latino_ethnicity,
       left(c.first_name, 2) || '-A' AS alias_first_name, upper(c.last_name) AS alias_last_surname
FROM stg_candidates c JOIN o_immutable_candidate_demos d ON c.k_candidate = d.k_candidate""",
    "stg_candidates", "o_immutable_candidate_demos")

cte("o_dim_epp", f"""
SELECT {K('t.tenant_code', 'p.pt')} AS k_educator_preparation_program, t.tenant_code, 'EPP-' || p.pt AS program_id,
       p.pt || ' Preparation' AS program_name, p.pt AS program_type
FROM (SELECT DISTINCT tenant_code FROM nation_tenant) t
CROSS JOIN (VALUES ('Traditional'), ('Alternative')) p(pt)""", "nation_tenant")

cte("o_fct_candidate_epp", f"""
SELECT d.k_candidate, d.k_candidate_xyear, e.k_educator_preparation_program, s.tenant_code, s.school_year,
       s.begin_date, s.end_date, s.program_type
FROM (SELECT tenant_code, 2024 AS school_year, {K('tenant_code', 'candidate_id', '2024')} AS k_candidate,
             {K('tenant_code', "CASE WHEN c_custkey % 2 = 0 THEN 'Traditional' ELSE 'Alternative' END")} AS k_epp,
             DATE '2023-09-01' AS begin_date, CASE WHEN c_custkey % 3 = 0 THEN DATE '2024-05-30' END AS end_date,
             CASE WHEN c_custkey % 2 = 0 THEN 'Traditional' ELSE 'Alternative' END AS program_type
      FROM candidate_home) s
JOIN o_dim_epp e ON s.k_epp = e.k_educator_preparation_program
JOIN o_dim_candidate d ON s.k_candidate = d.k_candidate""", "candidate_home", "o_dim_epp", "o_dim_candidate")

cte("o_dim_cert_exam", f"""
SELECT t.tenant_code, 2024 AS school_year, {K('t.tenant_code', 'e.x')} AS k_certification_exam,
       upper(replace(e.x, ' ', '_')) AS certification_exam_id, e.x AS certification_exam_title,
       'Licensure' AS certification_exam_type
FROM (SELECT DISTINCT tenant_code FROM nation_tenant) t
CROSS JOIN (VALUES ('Praxis Core'), ('Praxis Subject')) e(x)""", "nation_tenant")

cte("o_fct_cert_result", f"""
SELECT c.tenant_code, 2024 AS school_year, {K('c.tenant_code', 'c.candidate_id', 'e.x', '1')} AS k_certification_exam_result,
       {K('c.tenant_code', 'c.candidate_id')} AS k_person, {K('c.tenant_code', 'e.x')} AS k_certification_exam,
       DATE '2024-01-10' AS certification_exam_date, 1 AS attempt_number,
       CASE WHEN (c.c_custkey + length(e.x)) % 200 >= 100 THEN 'Pass' ELSE 'Fail' END
         AS certification_exam_pass_indicator,
       CAST((c.c_custkey + length(e.x)) % 200 AS VARCHAR) AS certification_exam_score
FROM candidate_home c CROSS JOIN (VALUES ('Praxis Core'), ('Praxis Subject')) e(x)""", "candidate_home")

cte("o_fct_candidate_staff", f"""
SELECT s.k_candidate, s.k_staff, s.tenant_code, s.api_year, s.begin_date, s.staff_to_candidate_relationship
FROM (SELECT tenant_code, 2024 AS api_year, {K('tenant_code', 'candidate_id', '2024')} AS k_candidate,
             {K('tenant_code', "'T' || CAST(c_custkey AS VARCHAR)")} AS k_staff, DATE '2023-09-01' AS begin_date,
             'Mentor' AS staff_to_candidate_relationship
      FROM candidate_home) s
JOIN o_dim_candidate c ON s.k_candidate = c.k_candidate
JOIN o_dim_staff st ON s.k_staff = st.k_staff""", "candidate_home", "o_dim_candidate", "o_dim_staff")

# ---------------------------------------------------------------- config-injected columns
cte("o_stu_grade_custom", """
SELECT g.tenant_code, g.k_student, g.school_year, g.entry_grade_level, x.grade_level_integer
FROM (SELECT g0.tenant_code, g0.k_student, g0.school_year,
             coalesce(CASE WHEN i.reading_level >= 4 THEN 'Fourth grade' END, g0.entry_grade_level) AS entry_grade_level
      FROM o_stu_grade g0 LEFT JOIN o_student_indicators i ON g0.k_student = i.k_student) g
LEFT JOIN xwalk_grade_levels x ON g.entry_grade_level = x.grade_level""",
    "o_stu_grade", "o_student_indicators", "xwalk_grade_levels")

cte("o_dq_d19", """
SELECT k_student, count(*) AS n_records FROM o_student_indicators GROUP BY 1 HAVING count(*) > 1""",
    "o_student_indicators")

cte("o_dim_school_custom", """
SELECT d.*, 2024 AS api_year, d.school_category = 'Elementary School' AS is_elementary FROM o_dim_school d""",
    "o_dim_school")

cte("o_dq_d17", """
SELECT k_student, count(*) AS n_records, 'bld_student_indicators' AS data_source
FROM o_student_indicators GROUP BY 1 HAVING count(*) > 1""", "o_student_indicators")

# ---------------------------------------------------------------- networks
cte("o_dim_network", f"""
SELECT {K('t.tenant_code', 'n.name')} AS k_network, t.tenant_code, upper(replace(n.name, ' ', '_')) AS network_id,
       n.name AS network_name, n.purpose AS network_purpose
FROM (SELECT DISTINCT tenant_code FROM nation_tenant) t
CROSS JOIN (VALUES ('Region Network', 'Shared Services'), ('Charter Network', 'Charter Management')) n(name, purpose)""",
    "nation_tenant")

cte("o_wide_network", f"""
SELECT k_school, tenant_code,
       min(CASE WHEN network_type = 'charter' THEN k_network END) AS k_network__charter,
       min(CASE WHEN network_type = 'region' THEN k_network END) AS k_network__region
FROM (SELECT a.*, x.network_type FROM (
        SELECT s.tenant_code, s.k_school, {K('s.tenant_code', 'v.n')} AS k_network, v.b AS begin_date, v.e AS end_date,
               d.network_purpose
        FROM stg_schools s
        JOIN (VALUES ('Region Network', DATE '2020-07-01', CAST(NULL AS DATE), 1),
                     ('Region Network', DATE '2018-07-01', DATE '2020-06-30', 3),
                     ('Charter Network', DATE '2022-07-01', DATE '2023-06-30', 4)) v(n, b, e, m)
          ON v.m = 1 OR s.school_id % v.m = 0
        JOIN o_dim_network d ON {K('s.tenant_code', 'v.n')} = d.k_network
        QUALIFY row_number() OVER (PARTITION BY s.k_school, d.network_purpose
                                   ORDER BY v.e DESC NULLS FIRST, v.b DESC NULLS FIRST,
                                            {K('s.tenant_code', 'v.n')} ASC) = 1) a
      JOIN (VALUES ('region', 'Shared Services'), ('charter', 'Charter Management')) x(network_type, purpose)
        ON a.network_purpose = x.purpose) w
GROUP BY k_school, tenant_code""", "stg_schools", "o_dim_network")

# ---------------------------------------------------------------- participation statuses, budgets
cte("o_fct_budgets", f"""
SELECT s.*, a.k_school,
       row_number() OVER (PARTITION BY s.k_local_account
                          ORDER BY s.as_of_date DESC, s.k_local_budget_snapshot ASC) = 1 AS is_latest_snapshot
FROM (SELECT tenant_code, o_orderstatus AS budget_status, {K('tenant_code', "'budget'", 'o_orderkey')} AS k_local_budget_snapshot,
             {K('tenant_code', 'o_custkey')} AS k_local_account, o_totalprice AS amount, begin_date AS as_of_date,
             CAST(home_school_id AS VARCHAR) AS ed_org_id, o_orderpriority AS financial_collection,
             year(begin_date) AS fiscal_year, CAST(o_custkey AS VARCHAR) AS local_account_identifier
      FROM orders_home) s
JOIN o_dim_local_account a ON s.k_local_account = a.k_local_account""", "orders_home", "o_dim_local_account")

# ---------------------------------------------------------------- section attendance events
cte("stg_section_events", f"""
SELECT hu.tenant_code, 2024 AS school_year, {K('hu.tenant_code', 'e.user_id', '2024')} AS k_student,
       {K('hp.tenant_code', 'p.p_partkey', "'S1'")} AS k_course_section,
       CAST(e.ts AS DATE) AS attendance_event_date,
       CASE WHEN e.event_type = 'view' THEN 'Tardy' ELSE e.event_type END AS attendance_event_category,
       CAST(e.event_id AS VARCHAR) AS attendance_event_reason
FROM events e
JOIN home_school hu ON e.user_id % (SELECT count(*) FROM supplier) = hu.school_index
JOIN (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS section_index FROM part) p
  ON e.event_id % (SELECT count(*) FROM part) = p.section_index
JOIN home_school hp ON p.p_partkey % (SELECT count(*) FROM supplier) = hp.school_index""", "home_school")

cte("o_fct_section_events", """
SELECT e.k_student, s.k_student_xyear, e.k_course_section, c.k_school, e.tenant_code, e.school_year,
       e.attendance_event_date, e.attendance_event_category, e.attendance_event_reason, x.is_absent,
       x.attendance_excusal_status
FROM stg_section_events e
JOIN o_dim_student s ON e.k_student = s.k_student
JOIN o_dim_course_section c ON e.k_course_section = c.k_course_section
JOIN xwalk_attendance_events x ON e.attendance_event_category = x.attendance_event_descriptor""",
    "stg_section_events", "o_dim_student", "o_dim_course_section", "xwalk_attendance_events")

cte("o_dq_d10", """
SELECT DISTINCT s.tenant_code, s.school_year AS api_year, s.attendance_event_category
FROM stg_section_events s LEFT JOIN xwalk_attendance_events x ON s.attendance_event_category = x.attendance_event_descriptor
WHERE x.is_absent IS NULL""", "stg_section_events", "xwalk_attendance_events")

cte("o_dq_d2", """
SELECT DISTINCT f.tenant_code, f.school_year, d.assessment_identifier, d.assessment_family
FROM o_fct_student_assessment f
JOIN o_dim_assessment d ON f.k_assessment = d.k_assessment
LEFT JOIN (VALUES (NULL, NULL), ('1-URGENT', NULL), (NULL, 'Benchmark'), (NULL, NULL)) x(i, fam)
  ON coalesce(x.i, '1') = CASE WHEN x.i IS NULL THEN '1' ELSE d.assessment_identifier END
 AND coalesce(x.fam, '1') = CASE WHEN x.fam IS NULL THEN '1' ELSE d.assessment_family END
WHERE x.i IS NULL AND x.fam IS NULL""", "o_fct_student_assessment", "o_dim_assessment")

# ---------------------------------------------------------------- transcripts, chart of accounts, ESC
cte("o_fct_transcripts", f"""
SELECT t.k_course, t.k_student_academic_record, r.k_student, r.k_student_xyear, r.tenant_code, r.school_year,
       r.academic_term, t.course_attempt_result, coalesce(t.course_title, c.course_title) AS course_title,
       t.earned_credits, t.final_letter_grade_earned
FROM (SELECT {K('hp.tenant_code', 'l.l_partkey')} AS k_course,
             {K('hu.tenant_code', 'o.o_custkey', '2024',
                "CASE WHEN l.l_linenumber % 2 = 1 THEN 'Fall' ELSE 'Spring' END")} AS k_student_academic_record,
             CASE WHEN l.l_returnflag = 'R' THEN 'Fail' ELSE 'Pass' END AS course_attempt_result,
             CASE WHEN l.l_linenumber % 3 <> 0 THEN 'Transcript ' || CAST(l.l_partkey AS VARCHAR) END AS course_title,
             l.l_quantity / 10.0 AS earned_credits, l.l_returnflag AS final_letter_grade_earned
      FROM lineitem l
      JOIN orders o ON l.l_orderkey = o.o_orderkey
      JOIN home_school hu ON o.o_custkey % (SELECT count(*) FROM supplier) = hu.school_index
      JOIN home_school hp ON l.l_partkey % (SELECT count(*) FROM supplier) = hp.school_index) t
JOIN o_fct_academic_record r ON t.k_student_academic_record = r.k_student_academic_record
JOIN o_dim_course c ON t.k_course = c.k_course""", "home_school", "o_fct_academic_record", "o_dim_course")

_DIMS = [("fund", 5), ("function", 7), ("object", 11), ("program", 13), ("project", 3), ("source", 4),
         ("operational_unit", 6), ("balance_sheet", 9)]

cte("o_dim_chart_of_account", "SELECT a.*, " + ", ".join(
    f"d{i}.{d}_dimension_code, d{i}.{d}_dimension_code_name" for i, (d, _m) in enumerate(_DIMS)) + f"""
FROM (SELECT tenant_code, 2024 AS fiscal_year, {K('tenant_code', "'coa'", 'p_partkey')} AS k_chart_of_account,
             CAST(p_partkey AS VARCHAR) AS chart_of_account_identifier, p_name AS chart_of_account_name,
             {K('tenant_code', 'home_school_id')} AS k_school, """ + ", ".join(
    f"{K('tenant_code', repr(d), f'p_size % {m}')} AS k_{d}_dimension" for d, m in _DIMS) + """
      FROM part_home) a
""" + "\n".join(
    f"""LEFT JOIN (SELECT {K('t.tenant_code', repr(d), 'c.code')} AS k, CAST(c.code AS VARCHAR) AS {d}_dimension_code,
                  '{d.replace('_', ' ').title()} ' || CAST(c.code AS VARCHAR) AS {d}_dimension_code_name
           FROM (SELECT DISTINCT tenant_code FROM nation_tenant) t
           CROSS JOIN (SELECT range AS code FROM range(0, {m - 1})) c) d{i} ON a.k_{d}_dimension = d{i}.k"""
    for i, (d, m) in enumerate(_DIMS)), "part_home", "nation_tenant")

cte("o_dim_esc", f"""
SELECT e.*, a.address_type, a.street_address, a.city, a.postal_code
FROM (SELECT r_name AS tenant_code, {K('r_name', "'esc'")} AS k_esc, CAST(r_regionkey AS VARCHAR) AS esc_id,
             array_to_string(list_transform(string_split(lower(r_name), ' '),
                                            lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') || ' Service Center' AS esc_name
      FROM region) e
LEFT JOIN (SELECT {K('r_name', "'esc'")} AS k_esc, t.t AS address_type, t.t || ' Way ' || CAST(r_regionkey AS VARCHAR) AS street_address,
                  array_to_string(list_transform(string_split(lower(r_name), ' '),
                                                 lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') AS city,
                  lpad(CAST(r_regionkey AS VARCHAR), 5, '0') AS postal_code
           FROM region JOIN (VALUES ('Mailing'), ('Physical'), ('Billing')) t(t)
             ON t.t = 'Mailing' OR (t.t = 'Physical' AND r_regionkey % 2 = 0 AND r_regionkey <> 2)
             OR (t.t = 'Billing' AND r_regionkey % 2 = 1)
           QUALIFY row_number() OVER (PARTITION BY r_name ORDER BY (t.t = 'Physical') DESC, t.t) = 1) a ON e.k_esc = a.k_esc""")

cte("o_dim_objective_assessment", f"""
SELECT {_asmt('a.', 'lower(c.code)', subjects=2)} AS k_objective_assessment, a.k_assessment,
       a.tenant_code, a.api_year AS school_year, a.assessment_identifier, a.namespace,
       c.code AS objective_assessment_identification_code, 'Objective ' || c.code AS objective_assessment_description,
       CASE c.code WHEN 'OBJ-A' THEN 100 ELSE 50 END AS max_raw_score, 'Strand' AS nomenclature,
       CASE c.code WHEN 'OBJ-A' THEN 60 ELSE 40 END AS percent_of_assessment, a.academic_subject,
       ['Mastery', 'Raw Score'] AS scores_array,
       [{{'performance_level_name': 'Met', 'performance_level_value': '1'}},
        {{'performance_level_name': 'Not Met', 'performance_level_value': '0'}}] AS performance_levels_array
FROM (SELECT *, assessment_identifier AS o_orderpriority FROM stg_assessments) a
CROSS JOIN (VALUES ('OBJ-A'), ('OBJ-B')) c(code)""", "stg_assessments")

cte("stg_student_objective", f"""
SELECT o.tenant_code, 2024 AS api_year, o.school_year,
       {_asmt('o.', 'lower(c.code)', 'CAST(o.o_orderkey AS VARCHAR)')} AS k_student_objective_assessment,
       {_asmt('o.', 'lower(c.code)', subjects=2)} AS k_objective_assessment,
       {_stu_asmt('o.')} AS k_student_assessment, {_asmt('o.')} AS k_assessment,
       {K('o.tenant_code', 'o.o_custkey', 'o.school_year')} AS k_student, {K('o.tenant_code', 'o.o_custkey')} AS k_student_xyear,
       o.o_orderpriority AS assessment_identifier, 'uri://rollcall.example/assessment' AS namespace,
       c.code AS objective_assessment_identification_code, o.begin_date AS administration_date,
       o.o_totalprice, o.o_orderkey, o.o_orderpriority
FROM assessment_orders o CROSS JOIN (VALUES ('OBJ-A'), ('OBJ-B')) c(code)""", "assessment_orders")

cte("o_obj_long", """
WITH stacked AS (
  SELECT tenant_code, k_student_objective_assessment, assessment_identifier, namespace,
         objective_assessment_identification_code, 'Raw Score' AS score_name,
         CAST(CAST(floor(o_totalprice) AS BIGINT) % 100 AS VARCHAR) AS score_result
  FROM stg_student_objective
  UNION ALL
  SELECT tenant_code, k_student_objective_assessment, assessment_identifier, namespace,
         objective_assessment_identification_code, 'Mastery', CASE WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE 'N' END
  FROM stg_student_objective
  UNION ALL
  SELECT tenant_code, k_student_objective_assessment, assessment_identifier, namespace,
         objective_assessment_identification_code, 'Objective Level',
         CASE WHEN objective_assessment_identification_code = 'OBJ-A' THEN 'Met' ELSE 'Not Met' END
  FROM stg_student_objective
), deduped AS (
  SELECT * FROM stacked
  QUALIFY row_number() OVER (PARTITION BY k_student_objective_assessment, score_name
                             ORDER BY score_result DESC NULLS FIRST) = 1
)
SELECT d.tenant_code, d.k_student_objective_assessment, d.score_name AS original_score_name,
       coalesce(x.n, 'other') AS normalized_score_name, d.score_result
FROM deduped d
LEFT JOIN (VALUES ('1-URGENT', 'uri://rollcall.example/assessment', 'OBJ-A', 'Raw Score', 'raw_score'),
                  ('2-HIGH', 'uri://rollcall.example/assessment', 'OBJ-A', 'Raw Score', 'raw_score'),
                  ('1-URGENT', 'uri://rollcall.example/assessment', 'OBJ-B', 'Objective Level', 'performance_level'))
     x(i, ns, c, s, n)
  ON d.assessment_identifier = x.i AND d.namespace = x.ns AND d.objective_assessment_identification_code = x.c
 AND d.score_name = x.s""", "stg_student_objective")

cte("o_obj_scores", """
SELECT k_student_objective_assessment,
       max(CASE WHEN normalized_score_name = 'performance_level' THEN score_result END) AS performance_level,
       max(CASE WHEN normalized_score_name = 'raw_score' THEN score_result END) AS raw_score,
       array_to_string(list_sort(list(original_score_name || '=' || score_result)
                                 FILTER (normalized_score_name = 'other')), ',') AS v_other_results
FROM o_obj_long GROUP BY 1""", "o_obj_long")

cte("o_fct_student_objective", """
SELECT a.k_student_objective_assessment, a.k_objective_assessment, a.k_student_assessment, a.k_assessment,
       s.k_student, a.k_student_xyear, a.tenant_code, a.school_year, a.administration_date,
       f.performance_level, f.raw_score, f.v_other_results
FROM stg_student_objective a
LEFT JOIN o_dim_student s ON a.k_student = s.k_student
LEFT JOIN o_obj_scores f ON a.k_student_objective_assessment = f.k_student_objective_assessment
WHERE a.k_student_xyear IN (SELECT k_student_xyear FROM o_dim_student)""",
    "stg_student_objective", "o_dim_student", "o_obj_scores")

# ---------------------------------------------------------------- copies across tenants (custom config)
cte("o_active_students", """
WITH p AS (
  SELECT DISTINCT e.school_year, e.tenant_code, e.k_student, e.k_student_xyear, s.student_unique_id, s.birth_date,
         s.first_name, s.last_name
  FROM o_fct_enrollment e JOIN o_dim_student s ON e.k_student = s.k_student WHERE e.is_active_enrollment)
SELECT school_year, tenant_code, k_student, k_student_xyear, student_unique_id FROM p
WHERE student_unique_id IN (
  SELECT student_unique_id FROM p GROUP BY 1
  HAVING count(DISTINCT birth_date) <= 1
      OR (count(DISTINCT birth_date) + count(DISTINCT lower(first_name)) + count(DISTINCT lower(last_name)) <= 5
          AND count(DISTINCT tenant_code) > 1))""", "o_fct_enrollment", "o_dim_student")

cte("o_asmt_copies", f"""
SELECT * FROM (
  SELECT DISTINCT a.tenant_code, a.school_year, a.api_year, a.k_student, a.k_student_xyear, a.k_assessment, a.k_student_assessment,
         a.k_student_assessment AS k_student_assessment__original, a.k_assessment AS k_assessment__original,
         a.student_unique_id, a.student_assessment_identifier, true AS is_original_record, a.tenant_code AS original_tenant_code
  FROM stg_student_assessments a JOIN o_active_students e ON a.student_unique_id = e.student_unique_id
  UNION ALL
  SELECT e.tenant_code, a.school_year, a.api_year, e.k_student, e.k_student_xyear,
         {K('e.tenant_code', 'a.api_year', "lower('Mathematics')", 'lower(a.assessment_identifier)', 'lower(a.namespace)')},
         {K('e.tenant_code', 'a.api_year', "lower('Mathematics')", 'lower(a.assessment_identifier)', 'lower(a.namespace)',
            'lower(a.student_assessment_identifier)', 'lower(a.student_unique_id)')},
         a.k_student_assessment, a.k_assessment, a.student_unique_id, a.student_assessment_identifier, false, a.tenant_code
  FROM stg_student_assessments a JOIN o_active_students e
    ON a.student_unique_id = e.student_unique_id AND a.tenant_code <> e.tenant_code)
QUALIFY row_number() OVER (PARTITION BY k_student_assessment
                           ORDER BY is_original_record DESC, original_tenant_code, k_student_assessment__original) = 1""",
    "stg_student_assessments", "o_active_students")

cte("o_objective_copies", f"""
SELECT {K('c.tenant_code', 'c.api_year', "lower('Mathematics')", 'lower(o.assessment_identifier)', 'lower(o.namespace)',
          'lower(o.objective_assessment_identification_code)', 'lower(CAST(o.o_orderkey AS VARCHAR))')}
         AS k_student_objective_assessment,
       {K('c.tenant_code', 'c.api_year', "lower('Mathematics')", "lower('Mathematics')", 'lower(o.assessment_identifier)',
          'lower(o.namespace)', 'lower(o.objective_assessment_identification_code)')} AS k_objective_assessment,
       o.k_student_objective_assessment AS k_student_objective_assessment__original,
       o.k_objective_assessment AS k_objective_assessment__original,
       c.k_student_assessment, c.k_student_assessment__original, c.k_student, c.k_student_xyear, c.k_assessment,
       c.k_assessment__original, c.tenant_code, c.school_year, c.api_year, c.is_original_record, c.original_tenant_code
FROM stg_student_objective o JOIN o_asmt_copies c ON o.k_student_assessment = c.k_student_assessment__original
QUALIFY row_number() OVER (PARTITION BY {K('c.tenant_code', 'c.api_year', "lower('Mathematics')", 'lower(o.assessment_identifier)',
                                           'lower(o.namespace)', 'lower(o.objective_assessment_identification_code)',
                                           'lower(CAST(o.o_orderkey AS VARCHAR))')}
                           ORDER BY c.is_original_record DESC, c.original_tenant_code, o.k_student_objective_assessment) = 1""",
    "stg_student_objective", "o_asmt_copies")

cte("o_dim_assessment_copied", """
SELECT coalesce(c.k_assessment, d.k_assessment) AS k_assessment, coalesce(c.tenant_code, d.tenant_code) AS tenant_code,
       coalesce(c.school_year, d.school_year) AS school_year, d.* EXCLUDE (k_assessment, tenant_code, school_year)
FROM o_dim_assessment d
LEFT JOIN (SELECT * FROM o_asmt_copies
           QUALIFY row_number() OVER (PARTITION BY k_assessment ORDER BY tenant_code, school_year, k_assessment__original) = 1) c
  ON d.k_assessment = c.k_assessment__original
QUALIFY row_number() OVER (PARTITION BY coalesce(c.k_assessment, d.k_assessment)
                           ORDER BY coalesce(c.tenant_code, d.tenant_code), coalesce(c.school_year, d.school_year)) = 1""",
    "o_dim_assessment", "o_asmt_copies")

cte("o_dim_objective_copied", """
SELECT coalesce(c.k_objective_assessment, d.k_objective_assessment) AS k_objective_assessment,
       coalesce(c.k_assessment, d.k_assessment) AS k_assessment, coalesce(c.tenant_code, d.tenant_code) AS tenant_code,
       coalesce(c.school_year, d.school_year) AS school_year,
       d.* EXCLUDE (k_objective_assessment, k_assessment, tenant_code, school_year)
FROM o_dim_objective_assessment d
LEFT JOIN (SELECT * FROM o_objective_copies
           QUALIFY row_number() OVER (PARTITION BY k_objective_assessment
                                      ORDER BY tenant_code, school_year, k_objective_assessment__original) = 1) c
  ON d.k_objective_assessment = c.k_objective_assessment__original
QUALIFY row_number() OVER (PARTITION BY coalesce(c.k_objective_assessment, d.k_objective_assessment)
                           ORDER BY coalesce(c.tenant_code, d.tenant_code), coalesce(c.school_year, d.school_year)) = 1""",
    "o_dim_objective_assessment", "o_objective_copies")

# the plain facts are the copied ones' originals, with what their scores are found by
cte("o_fct_student_assessment_copied", """
WITH a AS (
  SELECT coalesce(c.k_student_assessment, s.k_student_assessment) AS k_student_assessment,
         coalesce(c.k_assessment, s.k_assessment) AS k_assessment, coalesce(c.k_student, s.k_student) AS k_student,
         coalesce(c.k_student_xyear, s.k_student_xyear) AS k_student_xyear, coalesce(c.tenant_code, s.tenant_code) AS tenant_code,
         s.student_assessment_identifier, coalesce(c.school_year, s.school_year) AS school_year, s.administration_date,
         s.when_assessed_grade_level, s.k_student_assessment AS k_student_assessment__original,
         coalesce(c.is_original_record, true) AS is_original_record,
         coalesce(c.original_tenant_code, s.tenant_code) AS original_tenant_code
  FROM stg_student_assessments s LEFT JOIN o_asmt_copies c ON s.k_student_assessment = c.k_student_assessment__original)
SELECT a.* REPLACE (d.k_student AS k_student), f.performance_level, f.raw_score, f.scale_score, f.v_other_results
FROM a
LEFT JOIN o_dim_student d ON a.k_student = d.k_student
LEFT JOIN o_asmt_scores f ON a.k_student_assessment__original = f.k_student_assessment
WHERE a.k_student_xyear IN (SELECT k_student_xyear FROM o_dim_student)""",
    "stg_student_assessments", "o_asmt_copies", "o_dim_student", "o_asmt_scores")

cte("o_fct_student_objective_copied", """
WITH a AS (
  SELECT coalesce(c.k_student_objective_assessment, s.k_student_objective_assessment) AS k_student_objective_assessment,
         coalesce(c.k_objective_assessment, s.k_objective_assessment) AS k_objective_assessment,
         coalesce(c.k_student_assessment, s.k_student_assessment) AS k_student_assessment,
         coalesce(c.k_assessment, s.k_assessment) AS k_assessment, coalesce(c.k_student, s.k_student) AS k_student,
         coalesce(c.k_student_xyear, s.k_student_xyear) AS k_student_xyear, coalesce(c.tenant_code, s.tenant_code) AS tenant_code,
         coalesce(c.school_year, s.school_year) AS school_year, s.administration_date,
         s.k_student_objective_assessment AS k_student_objective_assessment__original,
         coalesce(c.is_original_record, true) AS is_original_record,
         coalesce(c.original_tenant_code, s.tenant_code) AS original_tenant_code
  FROM stg_student_objective s
  LEFT JOIN o_objective_copies c ON s.k_student_objective_assessment = c.k_student_objective_assessment__original)
SELECT a.* REPLACE (d.k_student AS k_student), f.performance_level, f.raw_score, f.v_other_results
FROM a
LEFT JOIN o_dim_student d ON a.k_student = d.k_student
LEFT JOIN o_obj_scores f ON a.k_student_objective_assessment__original = f.k_student_objective_assessment
WHERE a.k_student_xyear IN (SELECT k_student_xyear FROM o_dim_student)
QUALIFY row_number() OVER (PARTITION BY a.k_student_objective_assessment ORDER BY a.is_original_record DESC, a.school_year DESC) = 1""",
    "stg_student_objective", "o_objective_copies", "o_dim_student", "o_obj_scores")

cte("o_dq_d9", """
SELECT DISTINCT f.tenant_code, f.school_year, d.assessment_identifier, d.objective_assessment_identification_code
FROM o_fct_student_objective f
JOIN o_dim_objective_assessment d ON f.k_objective_assessment = d.k_objective_assessment
LEFT JOIN (SELECT DISTINCT * FROM (VALUES ('1-URGENT', 'OBJ-A'), ('2-HIGH', 'OBJ-A'), ('1-URGENT', 'OBJ-B')) v(i, c)) x
  ON d.assessment_identifier = x.i AND d.objective_assessment_identification_code = x.c
WHERE x.c IS NULL""", "o_fct_student_objective", "o_dim_objective_assessment")

cte("o_actions_summary", """
WITH link AS (
  SELECT k_student, k_student_xyear, discipline_action_id, discipline_date, incident_id, school_id,
         link_behavior_type AS behavior_type
  FROM stg_discipline_actions
), arrays AS (
  SELECT l.k_student, l.k_student_xyear, l.discipline_action_id, l.discipline_date,
         list_sort(list(b.behavior_type)) AS behavior_types_array,
         list_sort(list(DISTINCT b.incident_id)) AS incident_id_array
  FROM link l JOIN o_fct_incident_behaviors b
    ON l.k_student = b.k_student AND l.k_student_xyear = b.k_student_xyear AND l.school_id = b.school_id
   AND l.incident_id = b.incident_id AND coalesce(l.behavior_type, '1') =
       CASE WHEN l.behavior_type IS NULL THEN '1' ELSE b.behavior_type END
  GROUP BY 1, 2, 3, 4
), acts AS (
  SELECT k_student, k_student_xyear, k_discipline_actions_event, list_sort(list(discipline_action)) AS discipline_actions_array
  FROM o_fct_discipline_actions GROUP BY 1, 2, 3
)
SELECT a.k_student, a.k_student_xyear, a.k_discipline_actions_event, a.tenant_code, a.school_year,
       ar.behavior_types_array, ar.incident_id_array, ac.discipline_actions_array,
       CASE WHEN b.severity_order IS NOT NULL AND a.severity_order IS NOT NULL THEN b.behavior_type END
         AS most_severe_behavior_type,
       CASE WHEN b.severity_order IS NOT NULL AND a.severity_order IS NOT NULL THEN a.discipline_action END
         AS most_severe_discipline_action
FROM o_fct_discipline_actions a
LEFT JOIN link l
  ON a.k_student = l.k_student AND a.k_student_xyear = l.k_student_xyear
 AND a.discipline_action_id = l.discipline_action_id AND a.discipline_date = l.discipline_date
LEFT JOIN o_fct_incident_behaviors b
  ON l.k_student = b.k_student AND l.k_student_xyear = b.k_student_xyear AND l.school_id = b.school_id
 AND l.incident_id = b.incident_id AND coalesce(l.behavior_type, '1') =
     CASE WHEN l.behavior_type IS NULL THEN '1' ELSE b.behavior_type END
JOIN acts ac ON a.k_student = ac.k_student AND a.k_student_xyear = ac.k_student_xyear
            AND a.k_discipline_actions_event = ac.k_discipline_actions_event
LEFT JOIN arrays ar ON a.k_student = ar.k_student AND a.k_student_xyear = ar.k_student_xyear
                   AND a.discipline_action_id = ar.discipline_action_id AND a.discipline_date = ar.discipline_date
QUALIFY row_number() OVER (PARTITION BY a.k_student, a.k_discipline_actions_event
                           ORDER BY a.severity_order DESC NULLS LAST, b.severity_order DESC NULLS LAST,
                                    a.discipline_action ASC NULLS LAST, b.behavior_type ASC NULLS LAST,
                                    l.incident_id ASC NULLS LAST) = 1""",
    "stg_discipline_actions", "o_fct_incident_behaviors", "o_fct_discipline_actions")

cte("o_wide_ids_student", f"""
SELECT tenant_code, 2024 AS api_year, {K('tenant_code', 'c_custkey', '2024')} AS k_student,
       {K('tenant_code', 'c_custkey')} AS k_student_xyear, CAST(home_school_id AS VARCHAR) AS ed_org_id,
       'D' || CAST(c_custkey AS VARCHAR) AS district_student_id, 'ST' || CAST(c_custkey AS VARCHAR) AS state_student_id
FROM customer_home""", "customer_home")

cte("o_wide_ids_staff", f"""
SELECT tenant_code, 2024 AS api_year, {K('tenant_code', 'staff_unique_id')} AS k_staff,
       'Di' || staff_unique_id AS district_staff_id, 'St' || staff_unique_id AS state_staff_id
FROM staff_home""", "staff_home")

cte("o_staff_race", f"""
SELECT {K('tenant_code', 'staff_unique_id')} AS k_staff,
       CASE WHEN c_custkey % 3 = 0 THEN ['Asian', 'White'] ELSE ['Black - African American'] END AS race_array,
       CASE WHEN c_custkey % 9 = 0 THEN 'Latinx' WHEN c_custkey % 3 = 0 THEN 'Multiple'
            ELSE 'Black - African American' END AS race_ethnicity
FROM staff_home WHERE c_custkey % 3 IN (0, 1)""", "staff_home")
cte("o_incident_summary", """
WITH link AS (
  SELECT k_student, k_student_xyear, discipline_action_id, discipline_date, incident_id, school_id,
         link_behavior_type AS behavior_type
  FROM stg_discipline_actions
), dis AS (
  SELECT k_student, discipline_action_id, discipline_date, first_action AS discipline_type FROM stg_discipline_actions
  UNION ALL
  SELECT k_student, discipline_action_id, discipline_date, 'Warning' FROM stg_discipline_actions WHERE has_warning
), barr AS (
  SELECT k_student, k_student_xyear, k_discipline_incident, list_sort(list(behavior_type)) AS behavior_types_array
  FROM o_fct_incident_behaviors GROUP BY 1, 2, 3
), aarr AS (
  SELECT l.k_student, l.k_student_xyear, l.incident_id,
         list_sort(list_distinct(list(d.discipline_type))) AS discipline_actions_array
  FROM link l JOIN dis d ON l.k_student = d.k_student AND l.discipline_action_id = d.discipline_action_id
                         AND l.discipline_date = d.discipline_date
  GROUP BY 1, 2, 3
)
SELECT b.k_student, b.k_student_xyear, b.k_discipline_incident, b.tenant_code, b.school_year,
       ba.behavior_types_array, aa.discipline_actions_array,
       CASE WHEN b.severity_order IS NOT NULL AND a.severity_order IS NOT NULL THEN b.behavior_type END
         AS most_severe_behavior_type,
       CASE WHEN b.severity_order IS NOT NULL AND a.severity_order IS NOT NULL THEN a.discipline_action END
         AS most_severe_discipline_action
FROM o_fct_incident_behaviors b
LEFT JOIN link l
  ON b.k_student = l.k_student AND b.k_student_xyear = l.k_student_xyear AND b.school_id = l.school_id
 AND b.incident_id = l.incident_id
 AND coalesce(l.behavior_type, '1') = CASE WHEN l.behavior_type IS NULL THEN '1' ELSE b.behavior_type END
LEFT JOIN o_fct_discipline_actions a
  ON l.k_student = a.k_student AND l.k_student_xyear = a.k_student_xyear
 AND l.discipline_action_id = a.discipline_action_id AND l.discipline_date = a.discipline_date
JOIN barr ba ON b.k_student = ba.k_student AND b.k_student_xyear = ba.k_student_xyear
            AND b.k_discipline_incident = ba.k_discipline_incident
LEFT JOIN aarr aa ON b.k_student = aa.k_student AND b.k_student_xyear = aa.k_student_xyear
                 AND b.incident_id = aa.incident_id
QUALIFY row_number() OVER (PARTITION BY b.k_student, b.k_discipline_incident
                           ORDER BY a.severity_order DESC NULLS LAST, b.severity_order DESC NULLS LAST,
                                    b.behavior_type ASC NULLS LAST, a.discipline_action ASC NULLS LAST,
                                    l.discipline_action_id ASC NULLS LAST) = 1""",
    "stg_discipline_actions", "o_fct_incident_behaviors", "o_fct_discipline_actions")

cte("o_non_offenders", f"""
SELECT s.k_student, s.k_student_xyear, s.k_school, s.k_discipline_incident, s.tenant_code, s.school_id, s.incident_id,
       false AS is_offender, c.codes[1] AS participation_code, c.codes AS participation_codes_array
FROM (SELECT tenant_code, {K('tenant_code', 'user_id + 7', '2024')} AS k_student,
             {K('tenant_code', 'user_id + 7')} AS k_student_xyear,
             {K('tenant_code', 'home_school_id', 'event_id')} AS k_discipline_incident,
             {K('tenant_code', 'home_school_id')} AS k_school, CAST(home_school_id AS VARCHAR) AS school_id,
             CAST(event_id AS VARCHAR) AS incident_id, event_id
      FROM error_events) s
JOIN (SELECT k_student, k_discipline_incident, list_sort(list(code)) AS codes FROM (
        SELECT {K('tenant_code', 'user_id + 7', '2024')} AS k_student,
               {K('tenant_code', 'home_school_id', 'event_id')} AS k_discipline_incident, 'Witness' AS code
        FROM error_events
        UNION ALL
        SELECT {K('tenant_code', 'user_id + 7', '2024')}, {K('tenant_code', 'home_school_id', 'event_id')}, 'Reporter'
        FROM error_events WHERE event_id % 2 = 0) u
      GROUP BY 1, 2) c ON s.k_student = c.k_student AND s.k_discipline_incident = c.k_discipline_incident
JOIN o_dim_student d ON s.k_student = d.k_student
JOIN o_dim_school sc ON s.k_school = sc.k_school
JOIN o_dim_discipline_incident i ON s.k_discipline_incident = i.k_discipline_incident""",
    "error_events", "o_dim_student", "o_dim_school", "o_dim_discipline_incident")

# ---------------------------------------------------------------- small dimensions
cte("o_dim_classroom", f"""
SELECT {K('s.tenant_code', 's.school_id', 'r.code')} AS k_classroom, s.k_school, s.tenant_code,
       r.code AS classroom_id_code, 20 + s.school_id % 10 AS maximum_seating
FROM stg_schools s JOIN (VALUES ('R101', 1), ('R102', 1), ('R103', 2)) r(code, m) ON s.school_id % r.m = 0
JOIN o_dim_school d ON s.k_school = d.k_school""", "stg_schools", "o_dim_school")

cte("o_dim_graduation_plan", f"""
SELECT n.tenant_code, 2024 AS school_year, {K('n.tenant_code', 'n.n_nationkey', 'g.t', '2024')} AS k_graduation_plan,
       {K('n.tenant_code', 'n.n_nationkey')} AS k_lea, g.t AS graduation_plan_type, g.c AS total_required_credits,
       '[{{"subject": "Mathematics", "credits": ' || CAST(CAST(g.c / 5 AS INTEGER) AS VARCHAR) || '}}]'
         AS v_credits_by_subjects
FROM nation_tenant n CROSS JOIN (VALUES ('Standard', 22), ('Distinguished', 26)) g(t, c)""", "nation_tenant")

cte("o_dim_learning_standard", f"""
SELECT tenant_code, {K('tenant_code', "'LS'", 'p_type')} AS k_learning_standard, 'LS-' || p_type AS learning_standard_id,
       upper(left(p_type, 1)) || lower(substr(p_type, 2)) || ' standard' AS learning_standard_description
FROM (SELECT DISTINCT tenant_code, p_type FROM part_home) t""", "part_home")

cte("o_fct_ls_grades", f"""
SELECT g.* FROM (
  SELECT hs.tenant_code, {K('hs.tenant_code', 'o.o_custkey', '2024')} AS k_student,
         {K('hs.tenant_code', 'hs.home_school_id')} AS k_school,
         {K('hp.tenant_code', 'l.l_partkey', "'S1'")} AS k_course_section,
         {K('hs.tenant_code', 'hs.home_school_id', '2024',
            "CASE WHEN l.l_linenumber % 2 = 0 THEN 'Third Quarter' ELSE 'Fourth Quarter' END")} AS k_grading_period,
         {K('hp.tenant_code', "'LS'", 'p.p_type')} AS k_learning_standard,
         CASE WHEN l.l_linestatus = 'F' THEN 'Final' ELSE 'Grading Period' END AS grade_type,
         l.l_returnflag AS learning_standard_letter_grade_earned
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
  JOIN home_school hs ON o.o_custkey % (SELECT count(*) FROM supplier) = hs.school_index
  JOIN home_school hp ON l.l_partkey % (SELECT count(*) FROM supplier) = hp.school_index) g
JOIN o_dim_student s ON g.k_student = s.k_student
JOIN o_dim_school sc ON g.k_school = sc.k_school
JOIN o_dim_course_section c ON g.k_course_section = c.k_course_section
JOIN o_dim_grading_period gp ON g.k_grading_period = gp.k_grading_period
JOIN o_dim_learning_standard ls ON g.k_learning_standard = ls.k_learning_standard""",
    "home_school", "o_dim_student", "o_dim_school", "o_dim_course_section", "o_dim_grading_period",
    "o_dim_learning_standard")

cte("o_cohort_years", f"""
SELECT tenant_code, 2024 AS api_year, {K('tenant_code', 'c_custkey', '2024')} AS k_student,
       list_sort(list({{'cohort_year_type': t, 'school_year': y, 'academic_term': m}})) AS cohort_year_array
FROM (SELECT tenant_code, c_custkey, 'Ninth grade' AS t, CAST(2027 + c_custkey % 3 AS INTEGER) AS y, 'Fall' AS m
      FROM customer_home
      UNION ALL
      SELECT tenant_code, c_custkey, 'Graduation', 2030, CAST(NULL AS VARCHAR) FROM customer_home
      WHERE c_custkey % 2 = 0) u
GROUP BY 1, 2, 3""", "customer_home")

cte("o_wide_ids_lea", f"""
SELECT n.tenant_code, 2024 AS api_year, {K('n.tenant_code', 'n.n_nationkey')} AS k_lea,
       CAST(NULL AS VARCHAR) AS local_lea_code, 'N' || CAST(n.n_nationkey AS VARCHAR) AS nces_lea_code,
       'S' || CAST(n.n_nationkey AS VARCHAR) AS state_lea_code
FROM nation_tenant n JOIN o_dim_lea l ON {K('n.tenant_code', 'n.n_nationkey')} = l.k_lea""",
    "nation_tenant", "o_dim_lea")

cte("o_objective_scores", f"""
SELECT a.tenant_code, a.api_year, {_asmt('a.', 'lower(c.code)', subjects=2)} AS k_objective_assessment,
       ['Mastery', 'Raw Score'] AS scores_array
FROM (SELECT *, assessment_identifier AS o_orderpriority FROM stg_assessments) a
CROSS JOIN (VALUES ('OBJ-A'), ('OBJ-B')) c(code)""", "stg_assessments")

cte("o_objective_pls", f"""
SELECT a.tenant_code, a.api_year, {_asmt('a.', 'lower(c.code)', subjects=2)} AS k_objective_assessment,
       list_sort([{{'performance_level_name': 'Met', 'performance_level_value': '1'}},
                  {{'performance_level_name': 'Not Met', 'performance_level_value': '0'}}]) AS performance_levels_array
FROM (SELECT *, assessment_identifier AS o_orderpriority FROM stg_assessments) a
CROSS JOIN (VALUES ('OBJ-A'), ('OBJ-B')) c(code)""", "stg_assessments")

# ---------------------------------------------------------------- builds registered on their own
cte("o_assessment_scores", """
SELECT tenant_code, api_year, k_assessment, ['Percentile', 'Raw Score', 'Scale Score'] AS scores_array
FROM stg_assessments""", "stg_assessments")

cte("o_assessment_grade_levels", """
SELECT tenant_code, api_year, k_assessment, ['Fourth grade', 'Third grade'] AS grades_array FROM stg_assessments""",
    "stg_assessments")

cte("o_candidate_other_names", """
SELECT tenant_code, api_year, k_candidate, k_candidate_xyear, left(first_name, 2) || '-A' AS alias_first_name,
       upper(last_name) AS alias_last_surname
FROM stg_candidates""", "stg_candidates")

cte("o_dim_course_section_custom", """
SELECT c.*, coalesce(w.is_honors, false) AS is_honors_section
FROM o_dim_course_section c LEFT JOIN o_course_char_wide w ON c.k_course_section = w.k_course_section""",
    "o_dim_course_section", "o_course_char_wide")

cte("o_dq_d15", """
SELECT k_course_section, count(*) AS n_records, 'bld_course_char__combined_wide' AS data_source
FROM o_course_char_wide GROUP BY 1 HAVING count(*) > 1""", "o_course_char_wide")

cte("o_fct_grades_custom", """
SELECT g.k_student, g.k_course_section, g.k_school, g.k_grading_period, g.grade_type, g.tenant_code, g.school_year,
       g.letter_grade_earned, g.numeric_grade_earned, x.unweighted_gpa_points, x.exclude_from_gpa, x.is_dorf,
       x.grade_sort_index, CASE WHEN g.l_linenumber = 7 THEN NULL WHEN g.l_linenumber % 2 = 0 THEN 'A-F' ELSE '1-4' END AS grading_scale,
       nullif(g.l_linenumber, 7) AS attempt
FROM stg_grades g
JOIN o_dim_student s ON g.k_student = s.k_student
JOIN o_dim_school d ON g.k_school = d.k_school
JOIN o_dim_grading_period p ON g.k_grading_period = p.k_grading_period
JOIN o_dim_course_section c ON g.k_course_section = c.k_course_section
LEFT JOIN xwalk_letter_grades x ON lower(g.letter_grade_earned) = x.letter_grade""",
    "stg_grades", "o_dim_student", "o_dim_school", "o_dim_grading_period", "o_dim_course_section", "xwalk_letter_grades")

cte("o_fct_homeless_program_custom", """
SELECT *, '1-URGENT' AS program_name FROM o_fct_homeless_program""", "o_fct_homeless_program")

_BY_TERM = """PARTITION BY k_student, k_student_xyear, school_year, k_lea, k_school, diploma_type, diploma_award_date
                  ORDER BY CASE academic_term WHEN 'Spring' THEN 1 WHEN 'Fall' THEN 2 END ASC NULLS LAST, k_student_academic_record"""
cte("o_fct_diploma_custom", f"""
SELECT * EXCLUDE (academic_term) FROM o_diplomas QUALIFY row_number() OVER ({_BY_TERM}) = 1""", "o_diplomas")
cte("o_dq_d27_custom", f"""
SELECT *, count(*) OVER (PARTITION BY k_student, k_student_xyear, school_year, k_lea, k_school, diploma_type, diploma_award_date)
            AS n_duplicates,
       row_number() OVER ({_BY_TERM}) = 1 AS is_kept_in_fct_student_diploma
FROM o_diplomas QUALIFY n_duplicates > 1""", "o_diplomas")

cte("o_dq_d16", """
SELECT k_course, count(*) AS n_records, 'bld_course_subject' AS data_source
FROM o_course_subject GROUP BY 1 HAVING count(*) > 1""", "o_course_subject")
