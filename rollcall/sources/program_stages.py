"""Staging relations of the student programs, one set per program domain.

Every domain has its enrollments, their services and their participation
statuses, with columns of its own.  All are derived from orders: an enrollment
of a domain is an order that meets the domain's filter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key as key


@dataclass(frozen=True)
class ProgramStage:
    """How a domain's staging is derived from orders."""

    associations: str  # relation of its enrollments
    short: str  # its name in the service and status relations
    where: str
    attributes: tuple[tuple[str, str], ...]  # (column, SQL over orders)
    services: tuple[str, str]  # for every enrollment; for even order keys
    status: tuple[str, str | None]  # status, who designated it
    service_extra: tuple[tuple[str, str], ...] = ()
    has_service_end: bool = True
    has_status_end: bool = True


_COMMON = (("is_served_outside_regular_session", "o_orderkey % 3 = 0"), ("participation_status", "o_orderstatus"),
           ("participation_status_designated_by", "CASE WHEN o_orderkey % 4 = 0 THEN 'Counselor' END"),
           ("participation_status_begin_date", "begin_date"),
           ("participation_status_end_date", "CASE WHEN o_orderstatus = 'F' THEN date_add(begin_date, 90) END"),
           ("reason_exited", "CASE WHEN o_orderstatus = 'F' THEN 'Completed' END"))

# fixed values: shape of the derived program stages
PROGRAM_STAGES = {
    "special_education": ProgramStage(
        "stg_ef3__student_special_education_program_associations", "spec_ed", "o_orderpriority = '3-MEDIUM'",
        (("is_idea_eligible", "o_orderkey % 2 = 0"), ("iep_begin_date", "begin_date"), ("iep_end_date", "date_add(begin_date, 365)"),
         ("iep_review_date", "date_add(begin_date, 180)"), ("last_evaluation_date", "date_add(begin_date, -30)"),
         ("is_medically_fragile", "o_orderkey % 13 = 0"), ("is_multiply_disabled", "o_orderkey % 5 = 0"),
         ("school_hours_per_week", "35"), ("spec_ed_hours_per_week", "int(o_orderkey % 10)"),
         ("special_education_setting", "'Inside regular class'"), *_COMMON),
        ("Speech Therapy", "Occupational Therapy"), ("Evaluated", None),
        (("v_providers", "concat('[{\"staffUniqueId\": \"T', string(o_custkey), '\"}]')"),)),
    "language_instruction": ProgramStage(
        "stg_ef3__student_language_instruction_program_associations", "lang_instr", "o_orderpriority = '2-HIGH'",
        (("has_english_learner_participation", "o_orderkey % 3 = 0"), ("intervention_duration_min", "int(o_orderkey % 60)"), *_COMMON),
        ("Newcomer", "Dual Language"), ("Limited", "Teacher")),
    "homeless": ProgramStage(
        "stg_ef3__student_homeless_program_associations", "homeless", "o_orderpriority = '1-URGENT'",
        (("is_awaiting_foster_care", "o_orderkey % 6 = 0"), ("is_homeless_unaccompanied_youth", "o_orderkey % 7 = 0"),
         ("homeless_primary_nighttime_residence", "CASE WHEN o_orderkey % 2 = 0 THEN 'Shelters' ELSE 'Doubled-up' END"), *_COMMON),
        ("Transportation", "School Supplies"), ("Eligible", "Counselor"), has_service_end=False, has_status_end=False),
    "title_i_part_a": ProgramStage(
        "stg_ef3__student_title_i_part_a_program_associations", "title_i_part_a", "o_orderpriority = '4-NOT SPECIFIED'",
        (("title_i_part_a_participant_status", "CASE WHEN o_orderkey % 2 = 0 THEN 'Targeted' ELSE 'Schoolwide' END"), *_COMMON),
        ("Reading", "Mathematics"), ("Served", None)),
    "cte": ProgramStage(
        "stg_ef3__student_cte_program_associations", "cte", "o_orderpriority = '5-LOW'",
        (("non_traditional_gender_status", "o_orderkey % 4 = 0"), ("private_cte_program", "o_orderkey % 9 = 0"),
         ("served_outside_of_regular_session", "o_orderkey % 3 = 0"), ("technical_skills_assessment", "'Passed'"),
         ("reason_exited", "CASE WHEN o_orderstatus = 'F' THEN 'Completed' END")),
        ("Mentoring", "Internship"), ("Concentrator", "Teacher"), (("cip_code", "concat('12.', string(o_orderkey % 50))"),)),
    "migrant_education": ProgramStage(
        "stg_ef3__student_migrant_education_program_associations", "migrant_edu", "o_orderstatus = 'P'",
        (("priority_for_service", "o_orderkey % 2 = 0"), ("last_qualifying_move", "date_add(begin_date, -60)"),
         ("us_initial_entry", "date_add(begin_date, -400)"), ("us_most_recent_entry", "date_add(begin_date, -90)"),
         ("us_initial_school_entry", "date_add(begin_date, -380)"), ("qualifying_arrival_date", "date_add(begin_date, -58)"),
         ("state_residency_date", "date_add(begin_date, -50)"), ("eligibility_expiration_date", "date_add(begin_date, 1000)"),
         ("continuation_of_services_reason", "CASE WHEN o_orderkey % 5 = 0 THEN 'Unfinished term' END")),
        ("Migrant Counseling", "Summer School"), ("Migrant", None)),
    "food_service": ProgramStage(
        "stg_ef3__student_school_food_service_program_association", "school_food_service", "o_orderstatus = 'F'",
        (("direct_certification", "o_orderkey % 2 = 0"), ("served_outside_of_regular_session", "o_orderkey % 8 = 0")),
        ("Lunch", "Breakfast"), ("Free", "District")),
}
GENERIC = ProgramStage("stg_ef3__student_program_associations", "program", "true", (), ("Tutoring", "Counseling"), ("", None))


class ProgramStaging:
    """The relations of ``PROGRAM_STAGES``, by name; mixed into ``Staging``."""

    def program_relation(self, name: str) -> DataFrame | None:
        for stage in (GENERIC, *PROGRAM_STAGES.values()):
            if name == stage.associations and stage is not GENERIC:
                return self._enrollments(stage)
            if name == f"stg_ef3__stu_{stage.short}__program_services":
                return self._services(stage)
            if name == f"stg_ef3__stu_{stage.short}__program_participation_statuses":
                return self._statuses(stage)
        return None

    def _program_orders(self, stage: ProgramStage) -> DataFrame:
        return self("orders_home").filter(F.expr(stage.where))

    @staticmethod
    def _keys() -> list:
        return ["tenant_code", F.col("school_year").alias("api_year"), "school_year",
                key("tenant_code", "o_custkey", "o_orderkey").alias("k_student_program"),
                key("tenant_code", "o_custkey", "school_year").alias("k_student"),
                key("tenant_code", "o_custkey").alias("k_student_xyear"),
                key("tenant_code", "home_school_id", "o_orderpriority").alias("k_program"),
                key("tenant_code", "home_nationkey").alias("k_lea"), key("tenant_code", "home_school_id").alias("k_school"),
                F.col("begin_date").alias("program_enroll_begin_date")]

    @staticmethod
    def _end():
        return F.when(F.col("o_orderstatus") == "F", F.date_add("begin_date", 90))

    def _enrollments(self, stage: ProgramStage) -> DataFrame:
        return self._program_orders(stage).select(
            *self._keys(), self._end().alias("program_enroll_end_date"), F.col("o_orderpriority").alias("program_name"),
            *[F.expr(sql).alias(name) for name, sql in stage.attributes])

    def _services(self, stage: ProgramStage) -> DataFrame:
        first, second = (F.lit(s) for s in stage.services)
        each = F.when(F.col("o_orderkey") % 2 == 0, F.array(first, second)).otherwise(F.array(first))
        s = self._program_orders(stage).select("*", F.explode(each).alias("program_service"))
        end = [self._end().alias("service_end_date")] if stage.has_service_end else []
        return s.select(*self._keys(), "program_service", (F.col("program_service") == first).alias("primary_indicator"),
                        F.col("begin_date").alias("service_begin_date"), *end,
                        *[F.expr(sql).alias(name) for name, sql in stage.service_extra])

    def _statuses(self, stage: ProgramStage) -> DataFrame:
        status, by = stage.status
        end = [self._end().alias("status_end_date")] if stage.has_status_end else []
        return self._program_orders(stage).select(
            *self._keys(), (F.lit(status) if status else F.col("o_orderstatus")).alias("participation_status"),
            F.col("begin_date").alias("status_begin_date"), *end, *([F.lit(by).alias("designated_by")] if by else []))
