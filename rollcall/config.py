"""One frozen configuration object drives every dataset.

Every "today" in the warehouse is ``Config.as_of``; leaving it ``None`` means
``current_date()`` at run time.  Tests and the differential checks pin it so
results are repeatable.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ProgramSpec:
    """Per-program settings (seven program domains share one builder)."""

    domain: str  # its switch in ``Config.domains``
    stage: str  # its key in the staging of programs
    flag: str  # flags are named is_{flag}_{agg_type}
    attributes: tuple[str, ...]  # stage columns taken as the maximum over a student's enrollments
    begin_column: str = "program_enroll_begin_date"
    exit_column: str = "program_enroll_end_date"
    excluded_program_names: tuple[str, ...] = ()
    agg_types: tuple[str, ...] = ("annual", "active")  # those that dim_student takes
    custom_aggregates: tuple[tuple[str, str], ...] = ()  # (boolean column, SQL aggregate expression)


# fixed values: program domains, with what their flags are called and the attributes kept
PROGRAMS = {
    "special_education": ProgramSpec("special_ed", "special_education", "special_education",
                                     ("is_idea_eligible", "is_multiply_disabled")),
    "language_instruction": ProgramSpec("language_instruction", "language_instruction", "english_language_learner",
                                        ("has_english_learner_participation",)),
    "homeless": ProgramSpec("homeless", "homeless", "homeless", (
        "is_awaiting_foster_care", "is_homeless_unaccompanied_youth", "homeless_primary_nighttime_residence")),
    "title_i_part_a": ProgramSpec("title_i", "title_i_part_a", "title_i", ("title_i_part_a_participant_status",)),
    "cte": ProgramSpec("cte", "cte", "cte", ("non_traditional_gender_status", "private_cte_program")),
    "food_services": ProgramSpec("food_service", "food_service", "food_service",
                                 ("direct_certification", "served_outside_of_regular_session")),
    "migrant_education": ProgramSpec("migrant_education", "migrant_education", "migrant_education",
                                     ("priority_for_service", "continuation_of_services_reason")),
}


@dataclass(frozen=True)
class Config:
    # run date; None -> current_date()
    as_of: _dt.date | None = None

    # fixed values: defaults of the reference's configuration (attendance
    # threshold 90, 20 enrolled days, one school-day event, excluded withdraw
    # codes 'No show' and 'Invalid enrollment', inclusive exit dates)
    # attendance
    in_attendance_code: str = "In Attendance"
    chronic_absence_threshold: Decimal = Decimal("90")
    chronic_absence_min_days: int = 20
    num_school_day_calendar_events: int = 1
    daily_attendance_source: str = "fct_student_school_attendance_event"
    excusal_status_expr: str | None = None

    # enrollment
    exit_withdraw_date_inclusive: bool = True
    first_day_exit_date_inclusive: bool | None = None
    exclude_exit_before_first_day: bool = True
    exclude_withdraw_codes: tuple[str, ...] = ("No show", "Invalid enrollment")
    year_end_active_buffer_days: int | None = None
    exclude_cross_year_enrollments: bool = False

    # demographics labels
    race_multiple_code: str = "Multiple"
    hispanic_code: str = "Latinx"
    race_unknown_code: str = "Unknown"
    immutable_demos: bool = False
    display_name_expr: str | None = None
    intersection_groups: tuple[tuple[str, str], ...] = ()  # (name, boolean SQL expression)
    # (source relation, SQL expression over it) replacing the enrolled grade when not NULL
    grade_level_override: tuple[str, str] | None = None

    # staff
    preferred_staff_email: str = "Work"
    official_email_types: tuple[str, ...] = ("Work",)
    # fixed values: personal e-mail domains, matched as they are written
    banned_email_domains: tuple[str, ...] = (
        "aim.com", "aol.com", "att.net", "gmail.com", "yahoo.com", "hotmail.com", "msn.com", "live.com", "charter.net",
        "earthlink.net", "verizon.net", "comcast.net", "outlook.com")

    # assessments: copy results to all tenants a student is enrolled in; a relation with the k_student of
    # students left out of it (then the identity guard is off)
    cross_tenant_assessments: bool = False
    removed_students_source: str | None = None

    # programs: domain build -> changed settings of its ProgramSpec
    programs: dict = field(default_factory=dict)

    # other-name types that become columns of students and of candidates
    other_name_types: tuple[str, ...] = ("Alias", "Previous Legal Name")
    candidate_name_types: tuple[str, ...] = ("Alias",)

    # academic terms in their order, as (term, place); without, terms are ordered by name
    academic_terms: tuple[tuple[str, int], ...] = ()

    # domain switches: a domain left out is neither read nor a column of any dataset
    domains: tuple[str, ...] = (
        "assessment", "cohort", "discipline", "esc", "homeless", "language_instruction",
        "special_ed", "title_i", "cte", "food_service", "migrant_education",
    )

    # config-injected columns: dataset -> ((source relation or None, column name, SQL expression), ...)
    custom_columns: dict = field(default_factory=dict)
    # extension passthrough columns: staging relation -> (column, ...)
    extensions: dict = field(default_factory=dict)

    def today(self) -> Column:
        """The run date as a Column (``F9``)."""
        if self.as_of is None:
            return F.current_date()
        return F.lit(self.as_of)

    def enabled(self, domain: str) -> bool:
        return domain in self.domains

    def program(self, build: str) -> ProgramSpec:
        return replace(PROGRAMS[build], **self.programs.get(build, {}))

    def enabled_programs(self) -> dict[str, ProgramSpec]:
        return {build: self.program(build) for build, spec in PROGRAMS.items() if self.enabled(spec.domain)}

    @property
    def first_day_inclusive(self) -> bool:
        if self.first_day_exit_date_inclusive is None:
            return self.exit_withdraw_date_inclusive
        return self.first_day_exit_date_inclusive


# The pinned configuration used by the registered queries and the tests.
TEST_CONFIG = Config(as_of=_dt.date(2024, 1, 30))

# The same run date with configured extras: an intersection group (P7),
# expression columns over an extra source and over the row itself (P6), and
# an extension passthrough column.
CUSTOM_CONFIG = Config(
    as_of=_dt.date(2024, 1, 30),
    intersection_groups=(("is_female_gifted", "gender = 'Female' AND is_gifted"),),
    custom_columns={
        "dim_student": (("bld_student_indicators", "iep_on_file", "coalesce(bld_student_indicators.has_iep, false)"),
                        (None, "is_upper_grade", "coalesce(grade_level_integer >= 3, false)")),
        "dim_calendar_date": ((None, "is_month_end", "calendar_date = last_day(calendar_date)"),),
        "dim_class_period": ((None, "is_long_period", "coalesce(period_duration > 45, false)"),),
        "dim_staff": ((None, "has_email", "email_address IS NOT NULL"),),
        "dim_course": (("bld_course_subject", "has_several_subjects", "coalesce(size(bld_course_subject.subject_array), 0) > 1"),),
        "dim_school": ((None, "is_elementary", "school_category = 'Elementary School'"),),
        "dim_course_section": (("bld_course_char__combined_wide", "is_honors_section",
                                "coalesce(bld_course_char__combined_wide.is_honors, false)"),),
    },
    extensions={"stg_ef3__schools": ("api_year",),
                "stg_ef3__grades": (("grading_scale", "$.grading.scale", "string"), ("attempt", "$.attempts[0]", "int")),
                "stg_ef3__student_homeless_program_associations": ("program_name",)},
    cross_tenant_assessments=True,
    domains=("assessment", "cohort", "discipline", "esc", "homeless", "language_instruction", "special_ed", "title_i", "cte",
             "migrant_education"),
    programs={"homeless": {"excluded_program_names": ("1-URGENT",), "agg_types": ("annual", "active", "ever")},
              "title_i_part_a": {"custom_aggregates": (("has_open_title_i", "max(program_enroll_end_date IS NULL)"),)}},
    other_name_types=("Alias",),
    academic_terms=(("Spring", 1), ("Fall", 2)),
    grade_level_override=("bld_student_indicators", "CASE WHEN reading_level >= 4 THEN 'Fourth grade' END"),
)
