"""DuckDB oracle: the staging derivation and datasets written as plain SQL.

Each relation is a named CTE with its dependencies; ``assemble`` emits a
``WITH`` chain holding only what a final query needs.  The SQL is written
independently of the Spark code (same rules, different formulation) so the
differential check means something.  Run date is pinned to the test config.
"""

from __future__ import annotations

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}

AS_OF = "DATE '2024-01-30'"


def K(*exprs: str) -> str:
    """Surrogate key: md5 over the NULL-sentinel text forms joined by '-'."""
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), '_rc_null_')" for e in exprs)
    return f"md5(concat_ws('-', {parts}))"


def RATE(a: str, b: str) -> str:
    """round(100 * a / b, 2) half-up, exactly, for 2-decimal inputs; NULL when b = 0."""
    a100 = f"CAST(({a}) * 100 AS BIGINT)"
    b100 = f"CAST(({b}) * 100 AS BIGINT)"
    return (f"(CASE WHEN {b100} = 0 THEN NULL "
            f"ELSE ((20000 * {a100} + {b100}) // (2 * {b100})) / 100.0 END)")


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, tuple(deps))


def assemble(final_sql: str, *needs: str) -> str:
    order: list[str] = []
    seen: set[str] = set()

    def visit(n: str) -> None:
        if n in seen:
            return
        seen.add(n)
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final_sql
    body = ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final_sql}"


# ---------------------------------------------------------------- seeds
cte("xwalk_attendance_events", """
SELECT d AS attendance_event_descriptor, CAST(a AS DECIMAL(3,2)) AS is_absent, s AS attendance_excusal_status
FROM (VALUES ('error', 1.00, 'Unexcused'), ('signup', 1.00, 'Excused'), ('click', 0.50, 'Excused'),
             ('view', 0.00, NULL), ('purchase', 0.00, NULL)) t(d, a, s)""")
cte("xwalk_calendar_events", """
SELECT d AS calendar_event_descriptor, b AS is_school_day
FROM (VALUES ('Instructional Day', true), ('Holiday', false), ('Teacher Only Day', false), ('Weekend', false)) t(d, b)""")
cte("xwalk_grade_levels", """
SELECT g AS grade_level, CAST(i AS INTEGER) AS grade_level_integer
FROM (VALUES ('Kindergarten', 0), ('First grade', 1), ('Second grade', 2), ('Third grade', 3),
             ('Fourth grade', 4), ('Fifth grade', 5)) t(g, i)""")
cte("xwalk_student_characteristics", """
SELECT d AS characteristic_descriptor, n AS indicator_name
FROM (VALUES ('Economic Disadvantaged', 'is_economic_disadvantaged'), ('Gifted', 'is_gifted'),
             ('Homeless', 'is_homeless_characteristic')) t(d, n)""")

# ---------------------------------------------------------------- staging
cte("nation_tenant", """
SELECT n.n_nationkey, n.n_name, r.r_name AS tenant_code
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("stg_leas", f"""
SELECT tenant_code, 2024 AS api_year, {K('tenant_code', 'n_nationkey')} AS k_lea,
       CAST(n_nationkey AS VARCHAR) AS lea_id, n_name AS lea_name, 'Independent' AS lea_category
FROM nation_tenant""", "nation_tenant")

cte("stg_schools", f"""
SELECT nt.tenant_code, 2024 AS api_year, {K('nt.tenant_code', 's.s_suppkey')} AS k_school,
       {K('nt.tenant_code', 's.s_nationkey')} AS k_lea, s.s_suppkey AS school_id, s.s_name AS school_name,
       CASE s.s_suppkey % 3 WHEN 0 THEN 'Elementary School' WHEN 1 THEN 'Middle School' ELSE 'High School' END
         AS school_category
FROM supplier s JOIN nation_tenant nt ON s.s_nationkey = nt.n_nationkey""", "nation_tenant")

cte("home_school", """
SELECT s.s_suppkey AS home_school_id, nt.tenant_code, s.s_nationkey AS home_nationkey,
       row_number() OVER (ORDER BY s.s_suppkey) - 1 AS school_index
FROM supplier s JOIN nation_tenant nt ON s.s_nationkey = nt.n_nationkey
""", "nation_tenant")

cte("stg_calendars", f"""
SELECT tenant_code, k_school, school_id, c.calendar_code, 2024 AS school_year,
       {K('tenant_code', 'school_id', '2024', 'c.calendar_code')} AS k_school_calendar,
       CASE WHEN c.calendar_code = 'alt' THEN 'Student Specific' ELSE 'IEP' END AS calendar_type
FROM stg_schools CROSS JOIN (VALUES ('main'), ('alt')) c(calendar_code)
WHERE c.calendar_code = 'main' OR school_id % 4 = 0""", "stg_schools")

cte("stg_calendar_grade_levels", """
SELECT tenant_code, k_school_calendar, g.grade_level
FROM stg_calendars CROSS JOIN (VALUES ('Kindergarten'), ('First grade'), ('Second grade'), ('Third grade'),
                                      ('Fourth grade'), ('Fifth grade')) g(grade_level)
WHERE calendar_code = 'main' OR g.grade_level = 'Kindergarten'""", "stg_calendars")

cte("stg_calendar_dates", f"""
SELECT c.tenant_code, c.k_school_calendar, c.school_year, d.calendar_date,
       {K('c.k_school_calendar', 'd.calendar_date')} AS k_calendar_date
FROM stg_calendars c CROSS JOIN
     (SELECT CAST(range AS DATE) AS calendar_date
      FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01', INTERVAL 1 DAY)) d""", "stg_calendars")

cte("stg_calendar_events", """
SELECT tenant_code, k_calendar_date, 2024 AS api_year,
       CASE WHEN calendar_date = DATE '2024-01-01' THEN 'Holiday'
            WHEN calendar_date = DATE '2024-01-02' THEN 'Teacher Only Day'
            WHEN dayofweek(calendar_date) IN (0, 6) THEN 'Weekend'
            ELSE 'Instructional Day' END AS calendar_event
FROM stg_calendar_dates
UNION ALL
SELECT tenant_code, k_calendar_date, 2024,
       CASE WHEN calendar_date = DATE '2024-01-15' THEN 'Holiday' ELSE 'Unmapped Event' END
FROM stg_calendar_dates WHERE calendar_date IN (DATE '2024-01-15', DATE '2024-01-31')""", "stg_calendar_dates")

cte("stg_sessions", f"""
SELECT tenant_code, k_school, {K('tenant_code', 'school_id', '2024', 's.n')} AS k_session, 2024 AS school_year,
       s.n AS session_name, s.n AS academic_term, s.b AS session_begin_date, s.e AS session_end_date,
       s.t AS total_instructional_days
FROM stg_schools CROSS JOIN (VALUES ('Year Round', DATE '2024-01-01', DATE '2024-01-31', 21),
                                    ('Half 1', DATE '2024-01-01', DATE '2024-01-15', 9),
                                    ('Half 2', DATE '2024-01-16', DATE '2024-01-31', 12)) s(n, b, e, t)""",
    "stg_schools")

cte("customer_home", """
SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, h.home_school_id,
       h.tenant_code, h.home_nationkey, h.school_index
FROM customer c JOIN home_school h ON c.c_custkey % (SELECT count(*) FROM supplier) = h.school_index""", "home_school")

cte("student_transfers", """
SELECT c.c_custkey, n.tenant_code, n.home_school_id, c.c_name, c.c_mktsegment, c.c_custkey % 3 AS kind
FROM customer_home c JOIN home_school n ON (c.school_index + 1) % (SELECT count(*) FROM home_school) = n.school_index
WHERE c.c_custkey % 23 = 5 AND n.tenant_code <> c.tenant_code""", "customer_home", "home_school")

cte("stg_students", f"""
SELECT tenant_code, sy AS api_year, sy AS school_year, {K('tenant_code', 'c_custkey', 'sy')} AS k_student,
       {K('tenant_code', 'c_custkey')} AS k_student_xyear, CAST(c_custkey AS VARCHAR) AS student_unique_id,
       CASE WHEN kind = 2 THEN 'Other ' ELSE '' END || c_name AS first_name,
       CASE WHEN sy = 2023 THEN 'Former ' WHEN kind = 2 THEN 'Other ' ELSE '' END
         || upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS last_name,
       CASE WHEN c_custkey % 3 = 0 THEN 'Quinn' END AS middle_name,
       DATE '2012-01-01' + CAST(c_custkey % 2000 + (CASE WHEN kind > 0 THEN 1 ELSE 0 END) AS INTEGER) AS birth_date,
       'US' AS birth_country
FROM (SELECT tenant_code, c_custkey, c_name, c_mktsegment, 0 AS kind, y.sy
      FROM customer_home CROSS JOIN (VALUES (2024), (2023)) y(sy) WHERE y.sy = 2024 OR c_custkey % 2 = 0
      UNION ALL
      SELECT tenant_code, c_custkey, c_name, c_mktsegment, kind, 2024 FROM student_transfers)""",
    "customer_home", "student_transfers")

cte("stg_edorg_assoc", f"""
SELECT tenant_code, sy AS api_year, {K('tenant_code', 'c_custkey', 'sy')} AS k_student,
       {K('tenant_code', 'c_custkey')} AS k_student_xyear, CAST(home_school_id AS VARCHAR) AS ed_org_id,
       'School' AS ed_org_type, CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
       CASE WHEN c_custkey % 14 = 0 THEN 'Nonbinary' END AS gender_identity,
       (c_custkey % 9 = 0) AS has_hispanic_latino_ethnicity,
       CASE WHEN c_custkey % 6 = 0 THEN 'Limited' END AS lep_code
FROM (SELECT tenant_code, c_custkey, home_school_id, y.sy
      FROM customer_home CROSS JOIN (VALUES (2024), (2023)) y(sy) WHERE y.sy = 2024 OR c_custkey % 2 = 0
      UNION ALL
      SELECT tenant_code, c_custkey, home_school_id, 2024 FROM student_transfers)""", "customer_home", "student_transfers")

cte("stg_races", f"""
SELECT {K('tenant_code', 'c_custkey', '2024')} AS k_student, CAST(home_school_id AS VARCHAR) AS ed_org_id, r.race
FROM customer_home JOIN (VALUES (0, 'White'), (1, 'Black - African American'), (2, 'White'), (2, 'Asian'),
                                (3, 'Asian')) r(m, race) ON c_custkey % 5 = r.m""", "customer_home")

cte("stg_characteristics", f"""
SELECT tenant_code, 2024 AS api_year, {K('tenant_code', 'c_custkey', '2024')} AS k_student,
       {K('tenant_code', 'c_custkey')} AS k_student_xyear, CAST(home_school_id AS VARCHAR) AS ed_org_id,
       ch.c AS student_characteristic
FROM customer_home JOIN (VALUES ('Economic Disadvantaged', 4, 0), ('Gifted', 6, 1), ('Homeless', 10, 3),
                                ('Unmapped Characteristic', 15, 2)) ch(c, m, r)
  ON c_custkey % ch.m = ch.r""", "customer_home")

cte("enr_raw", f"""
SELECT tenant_code, c_custkey, home_school_id, 1 AS enrollment_seq,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE {K('tenant_code', 'home_school_id', '2024', "'main'")} END
         AS k_school_calendar,
       DATE '2024-01-01' + CAST(c_custkey % 7 AS INTEGER) AS entry_date,
       CASE WHEN c_custkey % 5 = 0
            THEN DATE '2024-01-01' + CAST(c_custkey % 7 AS INTEGER) + CAST(c_custkey % 17 - 2 AS INTEGER) END
         AS exit_withdraw_date,
       CASE WHEN c_custkey % 13 = 0 THEN 'No show' WHEN c_custkey % 5 = 0 THEN 'Transferred' END
         AS exit_withdraw_type,
       (['Kindergarten', 'First grade', 'Second grade', 'Third grade', 'Fourth grade', 'Fifth grade',
         'Sixth grade'])[CAST(c_custkey % 7 AS INTEGER) + 1] AS entry_grade_level
FROM customer_home
UNION ALL
SELECT tenant_code, c_custkey, home_school_id, seq,
       {K('tenant_code', 'home_school_id', '2024', "'main'")},
       DATE '2024-01-03' + CAST(c_custkey % 5 AS INTEGER), NULL, NULL,
       (['Kindergarten', 'First grade', 'Second grade', 'Third grade', 'Fourth grade', 'Fifth grade',
         'Sixth grade'])[CAST(c_custkey % 7 AS INTEGER) + 1]
FROM (SELECT tenant_code, c_custkey, home_school_id, 2 AS seq FROM customer_home WHERE c_custkey % 11 = 0
      UNION ALL SELECT tenant_code, c_custkey, home_school_id, 1 FROM student_transfers)""", "customer_home", "student_transfers")

cte("stg_enrollments", f"""
SELECT tenant_code, 2024 AS school_year, {K('tenant_code', 'c_custkey', '2024')} AS k_student,
       {K('tenant_code', 'home_school_id')} AS k_school, k_school_calendar, entry_date, exit_withdraw_date,
       exit_withdraw_type, entry_grade_level, enrollment_seq, enrollment_seq = 1 AS is_primary_school,
       'Regular' AS enrollment_type
FROM enr_raw""", "enr_raw")

cte("stg_att_events", f"""
SELECT h.tenant_code, 2024 AS api_year, 2024 AS school_year, {K('h.tenant_code', 'e.user_id', '2024')} AS k_student,
       {K('h.tenant_code', 'h.home_school_id')} AS k_school,
       {K('h.tenant_code', 'h.home_school_id', '2024',
          "CASE WHEN e.event_id % 4 = 0 THEN 'Year Round' WHEN dayofmonth(CAST(e.ts AS DATE)) <= 15 "
          "THEN 'Half 1' ELSE 'Half 2' END")} AS k_session,
       CAST(e.ts AS DATE) AS attendance_event_date, e.event_type AS attendance_event_category,
       e.props AS attendance_event_reason, e.value AS event_duration,
       CAST(NULL AS DOUBLE) AS school_attendance_duration, strftime(e.ts, '%H:%M:%S') AS arrival_time,
       CAST(NULL AS VARCHAR) AS departure_time, 'Classroom' AS educational_environment
FROM events e JOIN home_school h ON e.user_id % (SELECT count(*) FROM supplier) = h.school_index""", "home_school")
