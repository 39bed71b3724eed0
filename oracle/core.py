"""Oracle SQL for organizations, calendars, students, enrollment and attendance."""

from __future__ import annotations

from .base import AS_OF, RATE, K, cte

#: columns of dim_student by the build they come from
CHARACTERISTICS = ["is_economic_disadvantaged", "is_gifted", "is_homeless_characteristic"]
INDICATORS = ["has_iep", "reading_level"]
GENERIC_PROGRAMS = ["is_high_support_active", "is_high_support_annual", "is_medium_support_annual", "is_medium_support_ever",
                    "is_urgent_support_active", "is_urgent_support_annual", "is_urgent_support_ever"]
OTHER_NAMES = [f"{t}_{p}" for t in ("alias", "previous_legal_name") for p in (
    "personal_title_prefix", "first_name", "middle_name", "last_surname", "generation_code_suffix")]
_PROGRAMS = {"special_education": "special_education", "language_instruction": "english_language_learner", "homeless": "homeless",
             "title_i_part_a": "title_i", "cte": "cte", "food_services": "food_service", "migrant_education": "migrant_education"}
PROGRAM_FLAGS = [f"is_{flag}_{t}" for flag in _PROGRAMS.values() for t in ("annual", "active")]

cte("o_tenant_lea_ownership", """
SELECT DISTINCT s.tenant_code, s.k_lea
FROM stg_calendars c JOIN stg_schools s ON c.tenant_code = s.tenant_code AND c.k_school = s.k_school""",
    "stg_calendars", "stg_schools")

cte("o_dim_lea", f"""
SELECT l.k_lea, {K('l.tenant_code', "'esc'")} AS k_esc, l.tenant_code, l.lea_id, l.lea_name, l.lea_category,
       a.address_type, a.street_address, a.city, a.postal_code
FROM stg_leas l
LEFT JOIN (SELECT n.tenant_code, CAST(n.n_nationkey AS VARCHAR) AS lea_id, t.t AS address_type,
                  t.t || ' Ave ' || CAST(n.n_nationkey AS VARCHAR) AS street_address,
                  array_to_string(list_transform(string_split(lower(n.n_name), ' '),
                                                 lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') AS city,
                  lpad(CAST(n.n_nationkey AS VARCHAR), 5, '0') AS postal_code
           FROM nation_tenant n JOIN (VALUES ('Mailing'), ('Physical'), ('Billing')) t(t)
             ON t.t = 'Mailing' OR (n.n_nationkey % 3 <> 0 AND t.t = CASE n.n_nationkey % 2 WHEN 0 THEN 'Physical' ELSE 'Billing' END)
           QUALIFY row_number() OVER (PARTITION BY n.tenant_code, n.n_nationkey ORDER BY (t.t = 'Physical') DESC, t.t) = 1) a
  ON l.tenant_code = a.tenant_code AND l.lea_id = a.lea_id
WHERE EXISTS (SELECT 1 FROM o_tenant_lea_ownership o WHERE o.tenant_code = l.tenant_code AND o.k_lea = l.k_lea)""",
    "stg_leas", "nation_tenant", "o_tenant_lea_ownership")

cte("o_school_address", """
SELECT s.k_school, t.address_type, t.address_type || ' Rd ' || CAST(s.school_id AS VARCHAR) AS street_address,
       'City ' || CAST(s.school_id % 50 AS VARCHAR) AS city, lpad(CAST(s.school_id % 100000 AS VARCHAR), 5, '0') AS postal_code
FROM stg_schools s
JOIN (VALUES ('Physical'), ('Mailing'), ('Home')) t(address_type)
  ON (t.address_type = 'Physical' AND s.school_id % 3 <> 0 AND s.school_id % 4 <> 1) OR t.address_type = 'Mailing'
  OR (t.address_type = 'Home' AND s.school_id % 2 = 0)
QUALIFY row_number() OVER (PARTITION BY s.k_school ORDER BY (t.address_type = 'Physical') DESC, t.address_type ASC) = 1""",
    "stg_schools")

cte("stg_school_ids", """
SELECT s.tenant_code, s.k_school, t.id_system, left(t.id_system, 1) || CAST(s.school_id AS VARCHAR) AS id_code
FROM stg_schools s
JOIN (VALUES ('NCES'), ('State'), ('Local'), ('Federal')) t(id_system)
  ON t.id_system IN ('NCES', 'State') OR (t.id_system = 'Local' AND s.school_id % 2 = 0)
  OR (t.id_system = 'Federal' AND s.school_id % 7 = 0)""", "stg_schools")

cte("o_wide_ids_school", """
SELECT i.tenant_code, i.k_school,
       min(CASE WHEN x.id_name = 'local' THEN i.id_code END) AS local_school_code,
       min(CASE WHEN x.id_name = 'nces' THEN i.id_code END) AS nces_school_code,
       min(CASE WHEN x.id_name = 'state' THEN i.id_code END) AS state_school_code
FROM stg_school_ids i
JOIN (VALUES ('NCES', 'nces'), ('State', 'state'), ('Local', 'local')) x(id_system, id_name)
  ON i.id_system = x.id_system
GROUP BY i.tenant_code, i.k_school""", "stg_school_ids")

cte("o_dim_school", """
SELECT s.k_school, s.k_lea, n.k_network__charter, n.k_network__region, s.tenant_code, s.school_id,
       w.local_school_code, w.nces_school_code, w.state_school_code, s.school_name, l.lea_name, l.lea_id, s.school_category,
       a.address_type, a.street_address, a.city, a.postal_code
FROM stg_schools s JOIN o_dim_lea l ON s.k_lea = l.k_lea
LEFT JOIN o_school_address a ON s.k_school = a.k_school
LEFT JOIN o_wide_ids_school w ON s.k_school = w.k_school
LEFT JOIN o_wide_network n ON s.k_school = n.k_school""",
    "stg_schools", "o_dim_lea", "o_school_address", "o_wide_ids_school", "o_wide_network")

cte("o_dim_school_calendar", """
SELECT c.k_school_calendar, c.k_school, c.tenant_code, c.school_year, c.calendar_code, c.calendar_type,
       g.grades AS applicable_grade_levels_array
FROM stg_calendars c
JOIN o_dim_school s ON c.k_school = s.k_school
LEFT JOIN (SELECT k_school_calendar, list_sort(list(grade_level)) AS grades
           FROM stg_calendar_grade_levels GROUP BY k_school_calendar) g
  ON c.k_school_calendar = g.k_school_calendar""", "stg_calendars", "o_dim_school", "stg_calendar_grade_levels")

cte("o_cal_events_summary", """
SELECT e.k_calendar_date,
       sum(CAST(x.is_school_day AS INTEGER)) >= 1 AS is_school_day,
       list_sort(list(e.calendar_event)) AS calendar_events_array
FROM stg_calendar_events e JOIN xwalk_calendar_events x ON e.calendar_event = x.calendar_event_descriptor
GROUP BY e.k_calendar_date""", "stg_calendar_events", "xwalk_calendar_events")

cte("o_cal_aug", """
SELECT d.k_calendar_date, d.k_school_calendar, c.k_school, d.tenant_code, c.calendar_code, d.school_year,
       d.calendar_date,
       CASE WHEN len(s.calendar_events_array) = 1 THEN s.calendar_events_array[1]
            WHEN len(s.calendar_events_array) > 1 THEN 'Multiple' END AS calendar_event,
       s.calendar_events_array, s.is_school_day,
       row_number() OVER (PARTITION BY d.k_school_calendar, s.is_school_day ORDER BY d.calendar_date)
         AS day_of_school_year,
       strftime(d.calendar_date, '%a') AS week_day,
       weekofyear(d.calendar_date) AS week_of_calendar_year
FROM stg_calendar_dates d
JOIN o_dim_school_calendar c ON d.k_school_calendar = c.k_school_calendar
JOIN o_cal_events_summary s ON d.k_calendar_date = s.k_calendar_date""",
    "stg_calendar_dates", "o_dim_school_calendar", "o_cal_events_summary")

cte("o_dim_calendar_date", """
SELECT k_calendar_date, k_school_calendar, k_school, tenant_code, calendar_code, school_year, calendar_date, calendar_event,
       calendar_events_array, is_school_day, CASE WHEN is_school_day THEN day_of_school_year END AS day_of_school_year,
       week_day, week_of_calendar_year,
       CASE WHEN NOT is_school_day THEN NULL
            WHEN week_of_calendar_year >= start_week_offset THEN week_of_calendar_year - start_week_offset
            ELSE week_of_calendar_year + 52 - start_week_offset END AS week_of_school_year
FROM (SELECT *, min(CASE WHEN is_school_day AND day_of_school_year = 1 THEN week_of_calendar_year - 1 END)
                  OVER (PARTITION BY k_school_calendar) AS start_week_offset
      FROM o_cal_aug)
WHERE start_week_offset IS NOT NULL""", "o_cal_aug")

cte("o_school_calendar_windows", """
SELECT tenant_code, k_school, school_year, k_school_calendar,
       min(calendar_date) AS first_school_day, max(calendar_date) AS last_school_day
FROM o_dim_calendar_date WHERE is_school_day
GROUP BY GROUPING SETS ((tenant_code, k_school, school_year), (tenant_code, k_school, school_year, k_school_calendar))""",
    "o_dim_calendar_date")

cte("o_dim_session", """
SELECT s.k_session, s.k_school, s.tenant_code, s.school_year, s.session_name, s.academic_term,
       s.session_begin_date, s.session_end_date, s.total_instructional_days
FROM stg_sessions s JOIN o_dim_school d ON s.k_school = d.k_school""", "stg_sessions", "o_dim_school")

# ---------------------------------------------------------------- students
cte("o_choose_stu_demos", """
SELECT * FROM stg_edorg_assoc
QUALIFY row_number() OVER (PARTITION BY k_student
                           ORDER BY ed_org_type ASC NULLS LAST, ed_org_id ASC NULLS LAST, api_year DESC NULLS FIRST) = 1""",
    "stg_edorg_assoc")

cte("o_stu_race", """
SELECT d.k_student, d.ed_org_id, d.has_hispanic_latino_ethnicity, r.race_array,
       CASE WHEN coalesce(d.has_hispanic_latino_ethnicity, false) THEN 'Latinx'
            WHEN coalesce(len(r.race_array), 0) > 1 THEN 'Multiple'
            WHEN coalesce(len(r.race_array), 0) = 1 THEN r.race_array[1]
            ELSE 'Unknown' END AS race_ethnicity
FROM stg_edorg_assoc d
LEFT JOIN (SELECT k_student, ed_org_id, list_sort(list(race)) AS race_array FROM stg_races GROUP BY 1, 2) r
  ON d.k_student = r.k_student AND d.ed_org_id = r.ed_org_id""", "stg_edorg_assoc", "stg_races")

cte("o_stu_grade", """
SELECT g.tenant_code, g.k_student, g.school_year, g.entry_grade_level, x.grade_level_integer
FROM (SELECT * FROM stg_enrollments
      QUALIFY row_number() OVER (PARTITION BY k_student, school_year
                                 ORDER BY entry_date DESC NULLS FIRST, exit_withdraw_date DESC NULLS FIRST,
                                          entry_grade_level DESC NULLS FIRST) = 1) g
LEFT JOIN xwalk_grade_levels x ON g.entry_grade_level = x.grade_level""", "stg_enrollments", "xwalk_grade_levels")

cte("o_stu_chars", """
SELECT c.tenant_code, c.api_year, c.k_student, c.k_student_xyear, c.ed_org_id,
       bool_or(coalesce(x.indicator_name = 'is_economic_disadvantaged', false)) AS is_economic_disadvantaged,
       bool_or(coalesce(x.indicator_name = 'is_gifted', false)) AS is_gifted,
       bool_or(coalesce(x.indicator_name = 'is_homeless_characteristic', false)) AS is_homeless_characteristic
FROM stg_characteristics c LEFT JOIN xwalk_student_characteristics x
  ON c.student_characteristic = x.characteristic_descriptor
GROUP BY 1, 2, 3, 4, 5""", "stg_characteristics", "xwalk_student_characteristics")

cte("o_immutable_stu_demos", """
SELECT s.k_student, s.k_student_xyear, s.tenant_code, s.api_year AS school_year, d.ed_org_id, s.first_name, s.middle_name, s.last_name,
       s.last_name || ', ' || s.first_name || coalesce(' ' || left(s.middle_name, 1), '') AS display_name,
       s.last_name || ', ' || s.first_name || coalesce(' ' || left(s.middle_name, 1), '')
         || ' (' || s.student_unique_id || ')' AS safe_display_name,
       s.birth_date, s.birth_country, d.gender, d.gender_identity, r.race_ethnicity, r.race_array, r.has_hispanic_latino_ethnicity
FROM stg_students s
JOIN o_choose_stu_demos d ON s.k_student = d.k_student
LEFT JOIN o_stu_race r ON d.k_student = r.k_student AND d.ed_org_id = r.ed_org_id""",
    "stg_students", "o_choose_stu_demos", "o_stu_race")


def _dim_student(programs: dict[str, tuple[str, tuple[str, ...]]], others: list[str], grade: str, more: str = "") -> tuple:
    """SQL of the dimension and what it needs; ``programs``: relation -> (flag, taken columns)."""
    def columns(alias, names, default=None):
        return "".join(f", coalesce({alias}.{n}, {default}) AS {n}" if default else f", {alias}.{n}" for n in names)
    flags = "".join(columns(f"p_{rel}", [f"is_{flag}_{t}" if "_" not in t else t for t in taken], "false")
                    for rel, (flag, taken) in programs.items())
    joins = "".join(f"\nLEFT JOIN o_program_{rel} p_{rel} ON s.k_student = p_{rel}.k_student" for rel in programs)
    return f"""
SELECT s.k_student, s.k_student_xyear, s.tenant_code, s.api_year AS school_year, s.student_unique_id, i.district_student_id,
       i.state_student_id, m.first_name, m.middle_name, m.last_name, m.display_name, m.birth_date, m.birth_country, d.lep_code,
       m.gender, m.gender_identity, g.entry_grade_level AS grade_level, g.grade_level_integer, m.race_ethnicity,
       m.has_hispanic_latino_ethnicity{flags}{columns('c', CHARACTERISTICS, 'false')}{columns('n', INDICATORS)}
       {columns('q', GENERIC_PROGRAMS, 'false')}{columns('o', others)}{more},
       s.school_year = max(s.school_year) OVER (PARTITION BY s.k_student_xyear) AS is_latest_record,
       m.race_array, y.cohort_year_array, m.safe_display_name, d.ed_org_id
FROM stg_students s
JOIN o_choose_stu_demos d ON s.k_student = d.k_student
JOIN o_immutable_stu_demos m ON d.k_student = m.k_student AND d.ed_org_id = m.ed_org_id
LEFT JOIN o_wide_ids_student i ON d.k_student = i.k_student AND d.ed_org_id = i.ed_org_id
LEFT JOIN o_stu_chars c ON d.k_student = c.k_student AND d.ed_org_id = c.ed_org_id
LEFT JOIN o_student_indicators n ON d.k_student = n.k_student AND d.ed_org_id = n.ed_org_id
LEFT JOIN o_student_programs q ON d.k_student = q.k_student AND d.ed_org_id = q.ed_org_id
LEFT JOIN {grade} g ON d.k_student = g.k_student AND s.api_year = g.school_year
LEFT JOIN o_cohort_years y ON d.k_student = y.k_student
LEFT JOIN o_other_names o ON d.k_student = o.k_student{joins}""", (
        "stg_students", "o_choose_stu_demos", "o_immutable_stu_demos", "o_wide_ids_student", "o_stu_chars", "o_student_indicators",
        "o_student_programs", grade, "o_cohort_years", "o_other_names", *(f"o_program_{rel}" for rel in programs))


_sql, _needs = _dim_student({b: (f, ("annual", "active")) for b, f in _PROGRAMS.items()}, OTHER_NAMES, "o_stu_grade")
cte("o_dim_student", _sql, *_needs)
# custom config: no food services, homeless flags without one program and with ever, an aggregate of title I, one other name
_custom = {b: (f, ("annual", "active")) for b, f in _PROGRAMS.items() if b != "food_services"}
_custom = {"homeless_custom" if b == "homeless" else "title_i_part_a_custom" if b == "title_i_part_a" else b: v for b, v in _custom.items()}
_custom["homeless_custom"] = ("homeless", ("annual", "active", "ever"))
_custom["title_i_part_a_custom"] = ("title_i", ("annual", "active", "has_open_title_i"))
_sql, _needs = _dim_student(
    _custom, [n for n in OTHER_NAMES if n.startswith("alias")], "o_stu_grade_custom",
    ", (m.gender = 'Female' AND coalesce(c.is_gifted, false)) AS is_female_gifted, coalesce(n.has_iep, false) AS iep_on_file, "
    "coalesce(g.grade_level_integer >= 3, false) AS is_upper_grade")
cte("o_dim_student_custom", _sql, *_needs)

# ---------------------------------------------------------------- enrollment
cte("o_single_calendar_schools", """
SELECT * FROM o_dim_school_calendar
QUALIFY count(*) OVER (PARTITION BY k_school, school_year) = 1""", "o_dim_school_calendar")

cte("o_enr_formatted", f"""
SELECT st.k_student, st.k_student_xyear, sc.k_lea, sc.k_school,
       coalesce(dc.k_school_calendar, sg.k_school_calendar) AS k_school_calendar,
       e.tenant_code, e.school_year, e.entry_date, e.exit_withdraw_date, e.is_primary_school, e.enrollment_type,
       CASE WHEN e.school_year = max(e.school_year) OVER (PARTITION BY e.tenant_code)
                 AND e.entry_date <= {AS_OF}
                 AND (e.exit_withdraw_date IS NULL OR {AS_OF} <= e.exit_withdraw_date)
            THEN true ELSE false END AS is_active_enrollment,
       e.entry_grade_level, x.grade_level_integer, e.exit_withdraw_type,
       e.entry_date = max(e.entry_date) OVER (PARTITION BY e.k_student, e.k_school) AS is_latest_annual_entry,
       w.first_school_day
FROM stg_enrollments e
JOIN o_dim_student st ON e.k_student = st.k_student
JOIN o_dim_school sc ON e.k_school = sc.k_school
LEFT JOIN o_dim_school_calendar dc ON e.k_school_calendar = dc.k_school_calendar
LEFT JOIN o_single_calendar_schools sg ON e.k_school = sg.k_school AND e.school_year = sg.school_year
LEFT JOIN o_school_calendar_windows w
  ON e.k_school = w.k_school AND e.school_year = w.school_year
 AND dc.k_school_calendar IS NOT DISTINCT FROM w.k_school_calendar
LEFT JOIN xwalk_grade_levels x ON e.entry_grade_level = x.grade_level
WHERE ((e.exit_withdraw_date IS NULL OR w.first_school_day <= e.exit_withdraw_date) OR w.first_school_day IS NULL)
  AND (e.exit_withdraw_date IS NULL OR e.exit_withdraw_date >= e.entry_date)
  AND (e.exit_withdraw_type NOT IN ('No show', 'Invalid enrollment') OR e.exit_withdraw_type IS NULL)""",
    "stg_enrollments", "o_dim_student", "o_dim_school", "o_dim_school_calendar", "o_single_calendar_schools",
    "o_school_calendar_windows", "xwalk_grade_levels")

cte("o_fct_enrollment", """
SELECT * EXCLUDE (first_school_day) FROM o_enr_formatted""", "o_enr_formatted")

# ---------------------------------------------------------------- attendance
cte("o_att_event", f"""
SELECT * FROM (
  SELECT st.k_student, st.k_student_xyear, sc.k_school, cd.k_calendar_date, ds.k_session, a.tenant_code,
         a.school_year, cd.calendar_date, a.attendance_event_category, a.attendance_event_reason, x.is_absent,
         x.attendance_excusal_status, a.event_duration, a.school_attendance_duration, a.arrival_time,
         a.departure_time, a.educational_environment,
         date_diff('day', e.entry_date, coalesce(e.exit_withdraw_date, {AS_OF}) + 1) AS enrollment_length,
         e.entry_date, e.exit_withdraw_date
  FROM stg_att_events a
  JOIN o_dim_student st ON a.k_student = st.k_student
  JOIN o_dim_school sc ON a.k_school = sc.k_school
  JOIN o_dim_session ds ON a.k_session = ds.k_session
  JOIN o_fct_enrollment e ON a.k_student = e.k_student AND a.k_school = e.k_school
  JOIN o_dim_calendar_date cd
    ON e.k_school_calendar = cd.k_school_calendar AND a.attendance_event_date = cd.calendar_date
   AND cd.calendar_date >= e.entry_date AND cd.calendar_date <= coalesce(e.exit_withdraw_date, {AS_OF})
  JOIN xwalk_attendance_events x ON a.attendance_event_category = x.attendance_event_descriptor
) j
QUALIFY row_number() OVER (PARTITION BY k_student, k_school, k_calendar_date
                           ORDER BY enrollment_length DESC NULLS FIRST, entry_date DESC NULLS FIRST,
                                    exit_withdraw_date DESC NULLS FIRST, attendance_event_category ASC NULLS LAST,
                                    k_session ASC NULLS LAST, attendance_event_reason ASC NULLS LAST,
                                    event_duration ASC NULLS LAST, arrival_time ASC NULLS LAST) = 1""",
    "stg_att_events", "o_dim_student", "o_dim_school", "o_dim_session", "o_fct_enrollment", "o_dim_calendar_date",
    "xwalk_attendance_events")

cte("o_fct_att_event", """
SELECT * EXCLUDE (enrollment_length, entry_date, exit_withdraw_date) FROM o_att_event""", "o_att_event")

cte("o_attendance_sessions", """
SELECT DISTINCT a.k_school, d.k_session, a.tenant_code, d.session_begin_date, d.session_end_date,
       d.total_instructional_days
FROM o_fct_att_event a JOIN o_dim_session d ON a.k_session = d.k_session""", "o_fct_att_event", "o_dim_session")

cte("o_daily_fill", f"""
SELECT c.k_student, c.k_student_xyear, c.k_school, c.k_calendar_date, c.school_year,
       coalesce(f.k_session, s.k_session) AS k_session,
       coalesce(ds.total_instructional_days, s.total_instructional_days) AS total_instructional_days,
       c.tenant_code, c.calendar_date, f.attendance_event_reason,
       CASE WHEN c.exit_withdraw_date IS NULL OR c.calendar_date <= c.exit_withdraw_date
            THEN CAST(1 AS DECIMAL(3,2)) ELSE CAST(0 AS DECIMAL(3,2)) END AS is_enrolled,
       f.attendance_event_category AS ev_category, f.is_absent AS ev_absent,
       f.attendance_excusal_status AS ev_excusal, f.event_duration, f.school_attendance_duration
FROM (SELECT e.k_student, e.k_student_xyear, e.k_school, e.tenant_code, e.entry_date, e.exit_withdraw_date,
             ac.k_calendar_date, ac.school_year, ac.calendar_date
      FROM o_fct_enrollment e
      JOIN (SELECT cd.k_school_calendar, cd.k_calendar_date, cd.school_year, cd.calendar_date
            FROM o_dim_calendar_date cd
            JOIN (SELECT c2.k_school, c2.school_year, max(c2.calendar_date) AS max_date_by_school
                  FROM o_fct_att_event a2 JOIN o_dim_calendar_date c2 ON a2.k_calendar_date = c2.k_calendar_date
                  GROUP BY 1, 2) sub ON cd.k_school = sub.k_school AND cd.school_year = sub.school_year
            JOIN (SELECT k_school, school_year, max(calendar_date) AS max_calendar_date
                  FROM o_dim_calendar_date GROUP BY 1, 2) mc
              ON cd.k_school = mc.k_school AND cd.school_year = mc.school_year
            WHERE cd.is_school_day
              AND ((cd.calendar_date <= {AS_OF} AND cd.calendar_date <= sub.max_date_by_school)
                   OR mc.max_calendar_date <= {AS_OF})) ac
        ON e.k_school_calendar = ac.k_school_calendar
      WHERE ac.calendar_date >= e.entry_date) c
LEFT JOIN o_fct_att_event f
  ON c.k_student = f.k_student AND c.k_school = f.k_school AND c.k_calendar_date = f.k_calendar_date
LEFT JOIN o_dim_session ds ON f.k_session = ds.k_session
LEFT JOIN o_attendance_sessions s
  ON f.k_session IS NULL AND c.k_school = s.k_school
 AND c.calendar_date BETWEEN s.session_begin_date AND s.session_end_date""",
    "o_fct_enrollment", "o_dim_calendar_date", "o_fct_att_event", "o_dim_session", "o_attendance_sessions")

cte("o_daily_rows", """
SELECT k_student, k_student_xyear, k_school, k_calendar_date, school_year, k_session, total_instructional_days,
       tenant_code, calendar_date, attendance_event_reason, is_enrolled,
       CASE WHEN is_enrolled = 0 THEN 'Not Enrolled' ELSE coalesce(ev_category, 'In Attendance') END
         AS attendance_event_category,
       coalesce(CASE WHEN is_enrolled = 1 THEN ev_absent ELSE CAST(0 AS DECIMAL(3,2)) END, CAST(0 AS DECIMAL(3,2)))
         AS is_absent,
       CAST(1 AS DECIMAL(3,2)) - coalesce(CASE WHEN is_enrolled = 1 THEN ev_absent ELSE CAST(1 AS DECIMAL(3,2)) END,
                                          CAST(0 AS DECIMAL(3,2))) AS is_present,
       CASE WHEN is_enrolled = 0 THEN 'Not Enrolled'
            WHEN coalesce(ev_absent, 0) = 0 THEN 'Not Absent'
            ELSE coalesce(ev_excusal, 'Unknown Excusal Status') END AS attendance_excusal_status,
       event_duration, school_attendance_duration
FROM o_daily_fill""", "o_daily_fill")

cte("o_daily_dedup", """
SELECT * FROM o_daily_rows
QUALIFY row_number() OVER (PARTITION BY k_student, k_school, calendar_date
                           ORDER BY is_enrolled DESC NULLS FIRST, total_instructional_days ASC NULLS LAST,
                                    attendance_event_category ASC NULLS LAST, k_session ASC NULLS LAST,
                                    attendance_event_reason ASC NULLS LAST, event_duration ASC NULLS LAST) = 1""",
    "o_daily_rows")

cte("o_daily_streaks", """
SELECT *, dense_rank() OVER (PARTITION BY k_student, k_school, streak_id, attendance_excusal_status
                             ORDER BY calendar_date) AS consecutive_days_by_excusal_status
FROM (SELECT *, dense_rank() OVER (PARTITION BY k_student, k_school ORDER BY calendar_date)
              - dense_rank() OVER (PARTITION BY k_student, k_school, attendance_excusal_status ORDER BY calendar_date)
                AS streak_id
      FROM o_daily_dedup) t""", "o_daily_dedup")

cte("o_daily_cum", f"""
SELECT *, {RATE('cumulative_days_attended', 'cumulative_days_enrolled')} AS cumulative_attendance_rate
FROM (SELECT *,
             sum(is_enrolled) OVER (PARTITION BY k_student, k_school) AS total_days_enrolled,
             sum(is_absent) OVER (PARTITION BY k_student, k_school ORDER BY calendar_date) AS cumulative_days_absent,
             sum(is_present) OVER (PARTITION BY k_student, k_school ORDER BY calendar_date) AS cumulative_days_attended,
             sum(is_enrolled) OVER (PARTITION BY k_student, k_school ORDER BY calendar_date) AS cumulative_days_enrolled
      FROM o_daily_streaks) t""", "o_daily_streaks")


def band_sql(rate: str, enrolled: str) -> str:
    return f"""{enrolled} >= 20 AS meets_enrollment_threshold,
       ({rate} <= 90 AND {enrolled} >= 20) AS is_chronic_absentee,
       CASE WHEN {enrolled} >= 20 THEN
         CASE WHEN {rate} > 0 AND {rate} <= 80 THEN 1 WHEN {rate} > 80 AND {rate} <= 90 THEN 2
              WHEN {rate} > 90 AND {rate} <= 95 THEN 3 WHEN {rate} > 95 AND {rate} <= 100 THEN 4 END
       END AS absentee_category_rank,
       CASE WHEN {enrolled} >= 20 THEN
         CASE WHEN {rate} > 0 AND {rate} <= 80 THEN 'Severe Chronic Absence'
              WHEN {rate} > 80 AND {rate} <= 90 THEN 'Moderate Chronic Absence'
              WHEN {rate} > 90 AND {rate} <= 95 THEN 'At Risk'
              WHEN {rate} > 95 AND {rate} <= 100 THEN 'Satisfactory Attendance' END
       END AS absentee_category_label"""


cte("o_fct_daily", f"""
SELECT k_student, k_student_xyear, k_school, k_calendar_date, school_year, calendar_date, k_session, tenant_code,
       attendance_event_category, attendance_event_reason, is_absent, is_present, is_enrolled,
       attendance_excusal_status, consecutive_days_by_excusal_status, total_days_enrolled, cumulative_days_absent,
       cumulative_days_attended, cumulative_days_enrolled, cumulative_attendance_rate,
       {band_sql('cumulative_attendance_rate', 'cumulative_days_enrolled')},
       event_duration, school_attendance_duration
FROM o_daily_cum""", "o_daily_cum")

cte("o_msr_cum", f"""
SELECT *, {band_sql('attendance_rate', 'days_enrolled')}
FROM (SELECT *, {RATE('days_attended', 'days_enrolled')} AS attendance_rate
      FROM (SELECT d.k_student, d.k_student_xyear, d.k_school, c.school_year, min(d.tenant_code) AS tenant_code,
                   sum(d.is_absent) AS days_absent, sum(d.is_present) AS days_attended,
                   sum(d.is_enrolled) AS days_enrolled
            FROM o_fct_daily d JOIN o_dim_calendar_date c ON d.k_calendar_date = c.k_calendar_date
            GROUP BY 1, 2, 3, 4) a) b""", "o_fct_daily", "o_dim_calendar_date")
