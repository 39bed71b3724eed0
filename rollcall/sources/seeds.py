"""Seed crosswalks: small, user-edited lookup tables.

They are data the warehouse owner maintains (codes -> meaning), so they live
here as literal rows.  Each becomes a typed DataFrame; joins against them are
broadcast because their size is fixed by this file.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal as D

from pyspark.sql import DataFrame, SparkSession

# fixed values: attendance event codes -> absence share and excusal status
ATTENDANCE_EVENTS = [
    ("error", D("1.00"), "Unexcused"),
    ("signup", D("1.00"), "Excused"),
    ("click", D("0.50"), "Excused"),
    ("view", D("0.00"), None),
    ("purchase", D("0.00"), None),
]

# fixed values: calendar event codes -> counts as a school day
CALENDAR_EVENTS = [
    ("Instructional Day", True),
    ("Holiday", False),
    ("Teacher Only Day", False),
    ("Weekend", False),
]

# fixed values: absentee bands (lower exclusive, upper inclusive, rank, label)
ABSENTEE_CATEGORIES = [
    (D("0"), D("80"), 1, "Severe Chronic Absence"),
    (D("80"), D("90"), 2, "Moderate Chronic Absence"),
    (D("90"), D("95"), 3, "At Risk"),
    (D("95"), D("100"), 4, "Satisfactory Attendance"),
]

# fixed values: grade level text -> integer
GRADE_LEVELS = [
    ("Kindergarten", 0),
    ("First grade", 1),
    ("Second grade", 2),
    ("Third grade", 3),
    ("Fourth grade", 4),
    ("Fifth grade", 5),
]

# fixed values: letter grades -> points, exclusion, D-or-F flag, sort index
LETTER_GRADES = [
    ("a", D("4.00"), False, False, 1),
    ("n", D("1.00"), False, True, 2),
]

# fixed values: ed-org identification systems -> column name stem
ID_TYPES_ED_ORG = [
    ("NCES", "nces"),
    ("State", "state"),
    ("Local", "local"),
]

# fixed values: subgroup category display names
SUBGROUP_CATEGORY_NAMES = [
    ("gender", "Gender"),
    ("race_ethnicity", "Race and Ethnicity"),
    ("grade_level", "Grade Level"),
]

# fixed values: subgroup value display names
SUBGROUP_VALUE_NAMES = [
    ("gender", "Female", "Female students"),
    ("gender", "Male", "Male students"),
    ("is_gifted", "true", "Gifted"),
]

# fixed values: student program names -> indicator and which flags to emit
STUDENT_PROGRAMS = [
    ("1-URGENT", "urgent_support", True, True, True),
    ("2-HIGH", "high_support", True, True, False),
    ("3-MEDIUM", "medium_support", False, True, True),
]

# fixed values: discipline behaviors -> severity order (the highest is most severe), and a column of the district's own
DISCIPLINE_BEHAVIORS = [
    ("Major", 3, "Safety"),
    ("Moderate", 2, "Conduct"),
    ("Minor", 1, "Conduct"),
]

# fixed values: discipline actions -> severity and suspension/expulsion flags
DISCIPLINE_ACTIONS = [
    ("Suspension", 2, True, False, False, False),
    ("Detention", 1, False, True, False, False),
]

# fixed values: assessment score crosswalk (NULL identifier / family match any)
ASSESSMENT_SCORES = [
    (None, "uri://rollcall.example/assessment", None, "Scale Score", "scale_score"),
    ("1-URGENT", "uri://rollcall.example/assessment", None, "Raw Score", "raw_score"),
    (None, "uri://rollcall.example/assessment", "Benchmark", "Raw Score", "raw_score"),
    (None, "uri://rollcall.example/assessment", None, "Proficiency", "performance_level"),
]

# fixed values: contact e-mail and phone types -> column stems
PARENT_EMAIL_TYPES = [("Home", "home"), ("Work", "work")]
PARENT_PHONE_TYPES = [("Mobile", "mobile"), ("Home", "home")]

# fixed values: student indicators -> dimension column and type
STUDENT_INDICATORS = [
    ("Has IEP", "has_iep", "boolean"),
    ("Reading Level", "reading_level", "int"),
]

# fixed values: course level characteristics -> indicator columns
COURSE_LEVEL_CHARACTERISTICS = [("Honors", "is_honors"), ("Dual Credit", "is_dual_credit"), ("AP", "is_ap")]

# fixed values: course identification systems -> column stems
ID_TYPES_COURSE = [("LEA course code", "lea"), ("SCED course code", "sced")]

# fixed values: network association types (association, network type, purpose)
NETWORK_ASSOCIATION_TYPES = [
    ("school", "region", "Shared Services"),
    ("school", "charter", "Charter Management"),
    ("lea", "region", "Shared Services"),
]

# fixed values: objective assessment score crosswalk (identifier, namespace, objective, original, normalized)
OBJECTIVE_ASSESSMENT_SCORES = [
    ("1-URGENT", "uri://rollcall.example/assessment", "OBJ-A", "Raw Score", "raw_score"),
    ("2-HIGH", "uri://rollcall.example/assessment", "OBJ-A", "Raw Score", "raw_score"),
    ("1-URGENT", "uri://rollcall.example/assessment", "OBJ-B", "Objective Level", "performance_level"),
]

# fixed values: student and staff identification systems -> column stems
ID_TYPES_STUDENT = [("State", "state"), ("District", "district")]
ID_TYPES_STAFF = [("State", "state"), ("District", "district")]

# fixed values: assessment school-year windows (identifier, namespace, school year, start, end)
ASSESSMENT_SCHOOL_YEAR_DATES = [
    ("1-URGENT", "uri://rollcall.example/assessment", 2023, _dt.date(2022, 8, 1), _dt.date(2023, 7, 31)),
    ("1-URGENT", "uri://rollcall.example/assessment", 2024, _dt.date(2023, 7, 15), _dt.date(2024, 7, 31)),
    ("2-HIGH", None, 2023, _dt.date(2022, 8, 1), _dt.date(2023, 7, 31)),
    ("2-HIGH", None, 2024, _dt.date(2023, 8, 1), _dt.date(2024, 7, 31)),
]

# fixed values: student characteristic descriptors -> indicator column names
STUDENT_CHARACTERISTICS = [
    ("Economic Disadvantaged", "is_economic_disadvantaged"),
    ("Gifted", "is_gifted"),
    ("Homeless", "is_homeless_characteristic"),
]

_SCHEMAS = {
    "xwalk_attendance_events": "attendance_event_descriptor string, is_absent decimal(3,2), attendance_excusal_status string",
    "xwalk_calendar_events": "calendar_event_descriptor string, is_school_day boolean",
    "absentee_categories": "threshold_lower decimal(5,2), threshold_upper decimal(5,2), level_numeric int, level_label string",
    "xwalk_grade_levels": "grade_level string, grade_level_integer int",
    "xwalk_letter_grades": "letter_grade string, unweighted_gpa_points decimal(3,2), exclude_from_gpa boolean, is_dorf boolean, grade_sort_index int",
    "xwalk_id_types_ed_org": "id_system string, id_name string",
    "xwalk_subgroup_category_display_names": "subgroup_category string, subgroup_category_display_name string",
    "xwalk_subgroup_value_display_names": "subgroup_category string, subgroup_value string, subgroup_value_display_name string",
    "xwalk_student_programs": "program_name string, indicator_name string, is_active boolean, is_annual boolean, is_ever boolean",
    "xwalk_discipline_behaviors": "behavior_type string, severity_order int, behavior_group string",
    "xwalk_assessment_school_year_dates": "assessment_identifier string, namespace string, school_year int, start_date date, end_date date",
    "xwalk_id_types_student": "id_system string, id_name string",
    "xwalk_id_types_staff": "id_system string, id_name string",
    "xwalk_objective_assessment_scores": "assessment_identifier string, namespace string, objective_assessment_identification_code string, original_score_name string, normalized_score_name string",
    "xwalk_network_association_types": "association_type string, network_type string, network_purpose string",
    "xwalk_course_level_characteristics": "characteristic_descriptor string, indicator_name string",
    "xwalk_id_types_course": "id_system string, id_name string",
    "xwalk_student_indicators": "original_indicator_name string, dim_stu_name string, type string",
    "xwalk_parent_email_types": "original_email_type string, normalized_email_type string",
    "xwalk_parent_phone_number_types": "original_phone_number_type string, normalized_phone_number_type string",
    "xwalk_assessment_scores": "assessment_identifier string, namespace string, assessment_family string, original_score_name string, normalized_score_name string",
    "xwalk_discipline_actions": "discipline_action string, severity_order int, is_oss boolean, is_iss boolean, is_exp boolean, is_minor boolean",
    "xwalk_student_characteristics": "characteristic_descriptor string, indicator_name string",
}

_ROWS = {
    "xwalk_attendance_events": ATTENDANCE_EVENTS,
    "xwalk_calendar_events": CALENDAR_EVENTS,
    "absentee_categories": ABSENTEE_CATEGORIES,
    "xwalk_grade_levels": GRADE_LEVELS,
    "xwalk_letter_grades": LETTER_GRADES,
    "xwalk_id_types_ed_org": ID_TYPES_ED_ORG,
    "xwalk_subgroup_category_display_names": SUBGROUP_CATEGORY_NAMES,
    "xwalk_subgroup_value_display_names": SUBGROUP_VALUE_NAMES,
    "xwalk_student_programs": STUDENT_PROGRAMS,
    "xwalk_discipline_behaviors": DISCIPLINE_BEHAVIORS,
    "xwalk_assessment_school_year_dates": ASSESSMENT_SCHOOL_YEAR_DATES,
    "xwalk_id_types_student": ID_TYPES_STUDENT,
    "xwalk_id_types_staff": ID_TYPES_STAFF,
    "xwalk_objective_assessment_scores": OBJECTIVE_ASSESSMENT_SCORES,
    "xwalk_network_association_types": NETWORK_ASSOCIATION_TYPES,
    "xwalk_course_level_characteristics": COURSE_LEVEL_CHARACTERISTICS,
    "xwalk_id_types_course": ID_TYPES_COURSE,
    "xwalk_student_indicators": STUDENT_INDICATORS,
    "xwalk_parent_email_types": PARENT_EMAIL_TYPES,
    "xwalk_parent_phone_number_types": PARENT_PHONE_TYPES,
    "xwalk_assessment_scores": ASSESSMENT_SCORES,
    "xwalk_discipline_actions": DISCIPLINE_ACTIONS,
    "xwalk_student_characteristics": STUDENT_CHARACTERISTICS,
}

NAMES = tuple(_ROWS)


def seed(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame(_ROWS[name], _SCHEMAS[name])
