"""Rules that were once wrong, each with the values expected worked out by hand."""

import datetime as dt
import re
import shutil

import pytest

from rollcall import Config, Warehouse, load_all
from rollcall.operators.windows import running_sum, streaks
from rollcall.plans.custom import add_extensions

D = dt.date


def warehouse(spark, tables, **config):
    load_all()
    wh = Warehouse(spark, tables.__getitem__, Config(as_of=D(2024, 1, 30), **config))
    for name, df in tables.items():
        if not name.startswith(("stg_", "xwalk_")):
            wh.override(name, df)
    return wh


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_class_period_times_only_for_one_meeting(spark):
    def meetings(*times):
        return "[" + ", ".join(f'{{"startTime": "{a}", "endTime": "{b}"}}' for a, b in times) + "]"
    rows = [("one", meetings(("01:10:00", "02:00:00"))), ("late", meetings(("11:30:00", "12:20:00"))),
            ("two", meetings(("08:00:00", "08:50:00"), ("09:00:00", "09:50:00"))), ("none", "[]"), ("null", None), ("bad", "[{")]
    stg = spark.createDataFrame([(k, "s", "t", 2024, k, True, v) for k, v in rows],
                                "k_class_period string, k_school string, tenant_code string, school_year int, class_period_name string, "
                                "is_official_attendance_period boolean, v_meeting_times string")
    got = by(warehouse(spark, {"stg_ef3__class_periods": stg, "dim_school": spark.createDataFrame([("s",)], "k_school string")})(
        "dim_class_period"), "k_class_period")
    assert (got["one"].start_time, got["one"].end_time, got["one"].period_duration) == ("13:10:00", "14:00:00", 50)
    assert (got["late"].start_time, got["late"].end_time, got["late"].period_duration) == ("11:30:00", "12:20:00", 50)
    for k in ("two", "none", "null", "bad"):
        assert (got[k].start_time, got[k].end_time, got[k].period_duration) == (None, None, None), k


def test_incident_behaviors_are_objects_and_the_flag_counts_the_list(spark):
    inc = [("one", '[{"behaviorDescriptor": "Minor"}]'), ("same twice", '[{"b": "Minor"}, {"b": "Minor"}]'), ("none", None), ("empty", "[]")]
    incidents = spark.createDataFrame([(k, "s", "t", 2024, k, D(2024, 1, 5), 1.0, False, v) for k, v in inc],
                                      "k_discipline_incident string, k_school string, tenant_code string, school_year int, incident_id string, "
                                      "incident_date date, incident_cost double, was_reported_to_law_enforcement boolean, v_behaviors string")
    behaviors = spark.createDataFrame([("one", "Minor", "ran"), ("same twice", "Minor", None), ("same twice", "Minor", "again")],
                                      "k_discipline_incident string, behavior_type string, behavior_detailed_description string")
    got = by(warehouse(spark, {"stg_ef3__discipline_incidents": incidents, "stg_ef3__discipline_incidents__behaviors": behaviors,
                               "dim_school": spark.createDataFrame([("s",)], "k_school string")})("dim_discipline_incident"),
             "k_discipline_incident")
    assert {k: r.has_multiple_behaviors for k, r in got.items()} == {"one": False, "same twice": True, "none": False, "empty": False}
    assert [tuple(b) for b in got["same twice"].behavior_array] == [("Minor", None), ("Minor", "again")]
    assert got["none"].behavior_array is None


def test_behavior_severity_codes_and_offender(spark):
    rows = [("a", "Minor"), ("a", "Major"), ("b", "Unlisted")]
    stg = spark.createDataFrame([("st", "sx", i, "s", "t", 2024, "1", i, b, None) for i, b in rows],
                                "k_student string, k_student_xyear string, k_discipline_incident string, k_school string, tenant_code string, "
                                "school_year int, school_id string, incident_id string, behavior_type string, behavior_detailed_description string")
    codes = spark.createDataFrame([("st", "sx", "a", c) for c in ("Witness", "Perpetrator", "Witness")],
                                  "k_student string, k_student_xyear string, k_discipline_incident string, participation_code string")
    a = "stg_ef3__student_discipline_incident_behavior_associations"
    wh = warehouse(spark, {a: stg, f"{a}__participation_codes": codes, "dim_student": spark.createDataFrame([("st",)], "k_student string"),
                           "dim_school": spark.createDataFrame([("s",)], "k_school string"),
                           "dim_discipline_incident": spark.createDataFrame([("a",), ("b",)], "k_discipline_incident string"),
                           "xwalk_discipline_behaviors": spark.createDataFrame([("Major", 3, "Safety"), ("Minor", 1, "Conduct")],
                                                                               "behavior_type string, severity_order int, behavior_group string")})
    got = by(wh("fct_student_discipline_incident_behaviors"), "behavior_type")
    assert {k: r.is_most_severe_behavior for k, r in got.items()} == {"Major": True, "Minor": False, "Unlisted": None}
    assert (got["Major"].participation_code, got["Major"].participation_codes_array) == ("Perpetrator", ["Perpetrator", "Witness"])
    assert (got["Unlisted"].participation_code, got["Unlisted"].behavior_group) == (None, None)
    assert all(r.is_offender for r in got.values()) and got["Major"].behavior_group == "Safety"


@pytest.mark.parametrize("email,valid", [
    ("ann.lee@school.org", True), ("o'neil@school.org", True), ("a+b.c@x-y.example", True), ("a@b.c", False), ("a@school.org and more", True),
    (" a@b.org", False), ("a%b@c.org", False), ("a at b.org", False), ("@b.org", False), (None, None)])
def test_email_shape(spark, email, valid):
    emails = spark.createDataFrame([("t", "k", "Work", email)], "tenant_code string, k_staff string, email_type string, email_address string")
    none = spark.createDataFrame([], "tenant_code string, k_staff string, k_lea string, k_school string, contact_title string, "
                                 "email_address string, api_year int")
    wh = warehouse(spark, {"stg_ef3__staffs__emails": emails, "stg_ef3__staff_education_organization_contact_associations": none,
                           "stg_ef3__staffs": spark.createDataFrame([("k", 2024)], "k_staff string, api_year int")})
    assert wh("bld_staff_emails").first().is_valid_email is valid


def test_official_emails_leave_out_personal_domains_as_written(spark):
    rows = [("a@gmail.com", "Work", True), ("a@GMAIL.com", "Work", True), ("a@comcast.net", "Work", True), ("a@school.org", "Work", True),
            ("b@school.org", "Home", True), ("bad", "Work", False)]
    emails = spark.createDataFrame([("t", "k", None, None, kind, e, ok) for e, kind, ok in rows],
                                   "tenant_code string, k_staff string, k_lea string, k_school string, email_type string, email_address string, "
                                   "is_valid_email boolean")
    wh = warehouse(spark, {"bld_staff_emails": emails})
    assert {r.email_address for r in wh("bld_staff_official_emails").collect()} == {"a@GMAIL.com", "a@school.org"}


def test_staff_take_the_preferred_email_valid_or_not(spark):
    staff = spark.createDataFrame([("k", "t", "T1", "Ann", "Lee", "Q")],
                                  "k_staff string, tenant_code string, staff_unique_id string, first_name string, last_name string, middle_name string")
    emails = spark.createDataFrame([("k", "Home", "a@b.org", True), ("k", "Work", "not one", False)],
                                   "k_staff string, email_type string, email_address string, is_valid_email boolean")
    wh = warehouse(spark, {"stg_ef3__staffs": staff, "bld_staff_emails": emails,
                           "bld_wide_ids_staff": spark.createDataFrame([("t", 2024, "k", "7")], "tenant_code string, api_year int, k_staff string, "
                                                                       "state_staff_id string"),
                           "bld_staff_race_ethnicity": spark.createDataFrame([("k", "White")], "k_staff string, race_ethnicity string")})
    r = wh("dim_staff").first()
    assert (r.email_address, r.display_name, r.safe_display_name, r.state_staff_id, r.race_ethnicity) == (
        "not one", "Lee, Ann", "Lee, Ann (T1)", "7", "White")


def test_ended_addresses_are_not_chosen(spark):
    rows = [("a", "Physical", D(2023, 1, 1)), ("a", "Mailing", None), ("a", "Billing", None), ("b", "Physical", None), ("b", "Billing", None),
            ("c", "Physical", D(2023, 1, 1))]
    stg = spark.createDataFrame([(k, t, "street", "city", "1", e) for k, t, e in rows],
                                "k_school string, address_type string, street_address string, city string, postal_code string, address_end_date date")
    got = by(warehouse(spark, {"stg_ef3__schools__addresses": stg})("bld_school_address"), "k_school")
    assert {k: r.address_type for k, r in got.items()} == {"a": "Billing", "b": "Physical"}


def test_codes_are_reported_per_tenant_and_year(spark):
    from rollcall.plans.checks import CHECKS
    rows = [("t1", 2024, "odd"), ("t1", 2024, "odd"), ("t2", 2024, "odd"), ("t2", 2023, "odd"), ("t1", 2024, "known"), ("t1", 2024, "no share")]
    wh = warehouse(spark, {
        "stg_ef3__student_school_attendance_events": spark.createDataFrame(rows, "tenant_code string, api_year int, attendance_event_category string"),
        "xwalk_attendance_events": spark.createDataFrame([("known", 1.0), ("no share", None)], "attendance_event_descriptor string, is_absent double")})
    assert sorted(tuple(r) for r in CHECKS["d4_attendance_event_codes"].fn(wh).collect()) == [
        ("t1", 2024, "no share"), ("t1", 2024, "odd"), ("t2", 2023, "odd"), ("t2", 2024, "odd")]


def test_extension_columns_by_path(spark):
    rows = [('{"a": {"b": "x"}, "c": [7, 8]}',), ('{"a": 1}',), ("not json",), (None,)]
    stg = spark.createDataFrame(rows, "v_ext string")
    wh = warehouse(spark, {}, extensions={"stg_x": (("b", "$.a.b", "string"), ("c", "$.c[1]", "int"))})
    assert [(r.b, r.c) for r in add_extensions(wh, "stg_x", stg).collect()] == [("x", 8), (None, None), (None, None), (None, None)]


def test_streaks_share_the_order_of_the_totals(spark):
    rows = [("k", d, s, 1) for d, s in enumerate(["A", "A", None, None, "A", "B", "B", "B"])] + [("j", 0, "B", 1)]
    df = spark.createDataFrame(rows, "k string, d int, s string, n int").repartition("k")
    out = streaks(df, ["k"], "s", "d", "c").withColumn("total", running_sum("n", ["k"], "d"))
    assert [(r.c, r.total) for r in sorted(out.filter("k = 'k'").collect(), key=lambda r: r.d)] == [
        (1, 1), (2, 2), (1, 3), (2, 4), (1, 5), (1, 6), (2, 7), (3, 8)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bSort \[", plan)) == 1, plan


def test_class_period_keeps_the_count_and_the_first_of_several_meetings(spark):
    several = '[{"startTime": "01:10:00", "endTime": "02:00:00"}, {"startTime": "09:00:00", "endTime": "09:50:00"}]'
    stg = spark.createDataFrame([("two", "s", "t", 2024, "two", True, several), ("none", "s", "t", 2024, "none", True, "[]")],
                                "k_class_period string, k_school string, tenant_code string, school_year int, class_period_name string, "
                                "is_official_attendance_period boolean, v_meeting_times string")
    got = by(warehouse(spark, {"stg_ef3__class_periods": stg, "dim_school": spark.createDataFrame([("s",)], "k_school string")})(
        "dim_class_period"), "k_class_period")
    r = got["two"]
    assert (r.n_meeting_times, r.first_start_time, r.first_end_time, r.class_duration) == (2, "13:10:00", "14:00:00", 50)
    assert (r.start_time, r.end_time, r.period_duration) == (None, None, None)
    assert (got["none"].n_meeting_times, got["none"].first_start_time, got["none"].class_duration) == (0, None, None)


def test_title_i_reads_the_enrollments_of_all_programs(spark):
    from rollcall.sources.program_stages import GENERIC, PROGRAM_STAGES
    schema = ("k_student string, k_student_xyear string, tenant_code string, program_name string, program_enroll_begin_date date, "
              "program_enroll_end_date date")
    rows = [("a1", "a", "t", "1-URGENT", D(2024, 1, 1), None), ("a1", "a", "t", "5-LOW", D(2024, 1, 1), D(2024, 1, 9)),
            ("a2", "a", "t", "1-URGENT", D(2024, 1, 1), None), ("b1", "b", "t", "4-NOT SPECIFIED", D(2024, 1, 1), None),
            ("c1", "c", "t", "1-URGENT", D(2024, 1, 1), None)]
    own = spark.createDataFrame([(*r, "Targeted") for r in rows if r[3] == "4-NOT SPECIFIED"],
                                schema + ", title_i_part_a_participant_status string")
    wh = warehouse(spark, {GENERIC.associations: spark.createDataFrame(rows, schema),
                           PROGRAM_STAGES["title_i_part_a"].associations: own})
    got = by(wh("bld_student_program__title_i_part_a__all_programs"), "k_student")
    assert {k: (r.n_title_i_enrollments, r.is_title_i_part_a_active, r.is_title_i_part_a_annual, r.is_title_i_part_a_ever)
            for k, r in got.items()} == {"a1": (2, False, True, True), "a2": (1, False, False, True), "b1": (1, True, True, True),
                                         "c1": (1, False, False, False)}
    assert {k: (r.is_title_i_active, r.is_title_i_annual, r.is_title_i_ever, r.title_i_part_a_participant_status)
            for k, r in got.items() if k != "b1"} == dict.fromkeys(("a1", "a2", "c1"), (False, False, False, None))
    assert (got["b1"].is_title_i_active, got["b1"].title_i_part_a_participant_status) == (True, "Targeted")


def test_keys_are_packed_and_come_back(spark):
    from pyspark.sql import functions as F

    from rollcall.functions.keys import packed, unpacked
    md5 = "00ff" * 8
    keys = [md5, md5.upper(), md5[:-1], md5 + "0", "", "k1", "a" * 16, "\u00e9" * 8, md5 + "\n", None]
    got = (spark.createDataFrame([(k,) for k in keys], "k string").withColumn("p", packed("k"))
           .select("k", "p", unpacked("p").alias("back"), F.octet_length("p").alias("n")).collect())
    assert [r.back for r in got] == keys
    assert [r.k for r in got if r.n == 16] == [md5]
    assert len({bytes(r.p) for r in got if r.k is not None}) == len(keys) - 1


def test_sections_meet_enrollments_and_associations_by_any_key(spark):
    from rollcall.plans import sections
    day = D(2024, 1, 10)
    enr = spark.createDataFrame([("t", "c", k, 2024, D(2024, 1, 1), None) for k in ("s1", "0f" * 16, "0F" * 16)],
                                "tenant_code string, k_school string, k_student string, school_year int, entry_date date, "
                                "exit_withdraw_date date")
    assoc = spark.createDataFrame([("0f" * 16, "c", "x", day, None), ("0f" * 16, "c", None, day, None), ("s1", "d", "y", day, None),
                                   ("s1", "c", "0f" * 16, day, None)],
                                  "k_student string, k_school string, k_course_section string, begin_date date, end_date date")
    sec = spark.createDataFrame([("x",), ("0f" * 16,), ("0F" * 16,), (None,)], "k_course_section string")
    wh = warehouse(spark, {"fct_student_school_association": enr, "fct_student_section_association": assoc,
                           "dim_course_section": sec})
    assert {r.k_student: r.n_sections for r in sections.sections_per_enrollment(wh).collect()} == {
        "s1": 1, "0f" * 16: 1, "0F" * 16: 0}
    assert {r.k_course_section for r in sections.sections_without_students(wh).collect()} == {"0F" * 16, None}
    plan = sections.sections_per_enrollment(wh)._jdf.queryExecution().optimizedPlan().toString()
    joined = plan.split("Join", 1)[1]
    assert "__s_known" in joined and "unhex" in joined


def test_bucketed_tables_hold_any_key_and_are_dealt_packed(spark, tmp_path):
    from rollcall.sources import sinks
    keys = ["00ff" * 8, "00FF" * 8, "k1", "", None, "00ff" * 8]
    df = spark.createDataFrame([(k, k, i) for i, k in enumerate(keys)], "k_student string, k_student_xyear string, n int")
    table = sinks.materialize_bucketed(df, str(tmp_path / "t"), "k_student", 4)
    assert table.columns == df.columns
    assert sorted((r.n, r.k_student, r.k_student_xyear) for r in table.collect()) == [(i, k, k) for i, k in enumerate(keys)]
    plan = table.join(table.select(table.k_student, table.n.alias("m")).hint("merge"), "k_student")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count() == 2 * 2 + 3  # a repeated key meets both its rows, a NULL none
    dealt = sinks.dealt(df, "k_student", 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex" in dealt.split("RepartitionByExpression", 1)[1]


def test_ever_holds_for_all_years_of_a_student_in_one_exchange_more(spark):
    from rollcall.plans.programs import program_flags
    from rollcall.config import ProgramSpec
    from rollcall.sources.program_stages import GENERIC
    day = D(2024, 1, 1)
    st = spark.createDataFrame([("a1", "a", "t", "P", day, None), ("a2", "a", "t", "X", day, None), ("b1", "b", "t", "X", day, None),
                                ("n1", None, "t", "P", day, None)],
                               "k_student string, k_student_xyear string, tenant_code string, program_name string, "
                               "program_enroll_begin_date date, program_enroll_end_date date")
    spec = ProgramSpec("p", "program", "title_i_part_a", (), excluded_program_names=("X",))
    df = program_flags(warehouse(spark, {GENERIC.associations: st}), spec, GENERIC)
    assert df.columns[:3] == ["k_student_xyear", "k_student", "tenant_code"]
    assert {r.k_student: tuple(r[f"is_{spec.flag}_{t}"] for t in ("active", "annual", "ever")) for r in df.collect()} == {
        "a1": (True, True, True), "a2": (False, False, True), "b1": (False, False, False), "n1": (True, True, None)}
    assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_the_latest_year_of_a_tenant_deals_no_rows_by_tenant(spark):
    from rollcall.operators.windows import flag_partition_max
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame([("t", 2023), ("t", 2024), (None, 2024)], "tenant_code string, school_year int")
        df = flag_partition_max(rows, ["tenant_code"], "school_year", "latest", few_partitions=True)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1, plan  # that of the maxima
    assert {(r.tenant_code, r.school_year, r.latest) for r in df.collect()} == {
        ("t", 2023, False), ("t", 2024, True), (None, 2024, None)}


def _exchanged(df):
    """Columns that the exchanges of a plan deal rows by, and the text of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((\w+)#", plan), plan


MD5 = "0123456789abcdef" * 2


def test_transcripts_meet_on_packed_keys(spark):
    rows = [(MD5, "r1", "Pass", None), ("c2", MD5, "Pass", "own"), ("c2", None, "Pass", "no record"), (None, "r1", "Pass", "no course"),
            (MD5.upper(), "r1", "Pass", "other key"), (MD5, "r1", "Pass", None)]
    stg = spark.createDataFrame([("t", c, r, a, t, 1.0, "A") for c, r, a, t in rows],
                                "tenant_code string, k_course string, k_student_academic_record string, course_attempt_result string, "
                                "course_title string, earned_credits double, final_letter_grade_earned string")
    records = spark.createDataFrame([("r1", None, "x1"), (MD5, "s2", MD5)], "k_student_academic_record string, k_student string, k_student_xyear string")
    records = records.selectExpr("*", "'t' tenant_code", "2024 school_year", "'Fall' academic_term")
    students = spark.createDataFrame([(MD5, "s2", "Two", "First grade", True), ("x1", "old", "One", "First grade", False)],
                                     "k_student_xyear string, k_student string, display_name string, grade_level string, is_latest_record boolean")
    wh = warehouse(spark, {"stg_ef3__course_transcripts": stg, "fct_student_academic_record": records, "dim_student": students,
                           "dim_course": spark.createDataFrame([(MD5, "Art"), ("c2", "Music")], "k_course string, course_title string")})
    made = wh("fct_course_transcripts")
    got = sorted((r.k_course, r.k_student_academic_record, r.k_student, r.k_student_xyear, r.course_title) for r in made.collect()
                 if r.k_student) + [r.course_title for r in made.collect() if not r.k_student]
    assert got == [("c2", MD5, "s2", MD5, "own"), "Art", "Art"]
    assert "unhex" in _exchanged(made)[1]
    from rollcall.plans.analyst import with_latest_student
    late = with_latest_student(wh, made.select("k_course", "k_student_xyear", "course_title"))
    assert late.columns == ["k_student_xyear", "k_course", "course_title", "latest_k_student", "display_name", "grade_level"]
    assert sorted(map(tuple, late.collect()), key=str) == [
        (MD5, "c2", "own", "s2", "Two", "First grade"), *[("x1", MD5, "Art", None, None, None)] * 2]
    assert "unhex" in _exchanged(late)[1]


def test_grades_meet_on_packed_keys(spark):
    rows = [(MD5, "s", "g", "x"), ("st", "s", "g", MD5), (None, "s", "g", "x"), ("st", None, "g", "x"), ("st", "s", "g", "lost")]
    stg = spark.createDataFrame([(*r, "t", 2024, "Final", "a", 1.0) for r in rows],
                                "k_student string, k_school string, k_grading_period string, k_course_section string, tenant_code string, "
                                "school_year int, grade_type string, letter_grade_earned string, numeric_grade_earned double")
    one = lambda k, *v: spark.createDataFrame([(x,) for x in v], f"{k} string")
    letters = spark.createDataFrame([("a", 4.0, False, False, 1)], "letter_grade string, unweighted_gpa_points double, exclude_from_gpa boolean, "
                                                                   "is_dorf boolean, grade_sort_index int")
    made = warehouse(spark, {"stg_ef3__grades": stg, "dim_student": one("k_student", MD5, "st"), "dim_school": one("k_school", "s"),
                             "dim_grading_period": one("k_grading_period", "g"), "dim_course_section": one("k_course_section", "x", MD5),
                             "xwalk_letter_grades": letters})("fct_student_grades")
    assert sorted((r.k_student, r.k_school, r.k_grading_period, r.k_course_section) for r in made.collect()) == [
        (MD5, "s", "g", "x"), ("st", "s", "g", MD5)]
    assert "unhex" in _exchanged(made)[1]


def test_scores_of_a_result_are_dealt_once(spark, tmp_path):
    from rollcall.plans.assessments import _results
    key = "k_student_assessment"
    base = "string, ".join(("tenant_code ", f"{key} ", "k_assessment ", "assessment_identifier ", "namespace ")) + "string, api_year int, "
    scores = spark.createDataFrame([("t", "k1", "a", "i", "n", 2024, s, v) for s, v in (("Raw", "5"), ("Raw", None), ("Raw", "7"), ("Odd", "1"))],
                                   base + "score_name string, score_result string")
    levels = spark.createDataFrame([("t", "k2", "a", "i", "n", 2024, "Raw", "9")], base + "performance_level_name string, performance_level_result string")
    xw = spark.createDataFrame([(None, "n", None, "Raw", "raw")], "assessment_identifier string, namespace string, assessment_family string, "
                                                                  "original_score_name string, normalized_score_name string")
    # written, so that its size is known and it is broadcast
    spark.createDataFrame([("a", "f")], "k_assessment string, assessment_family string").write.parquet(f"{tmp_path}/dim")
    long = warehouse(spark, {"stg_ef3__student_assessments__score_results": scores, "stg_ef3__student_assessments__performance_levels": levels,
                             "dim_assessment": spark.read.parquet(f"{tmp_path}/dim"), "xwalk_assessment_scores": xw})("bld_student_assessments_long_results")
    made = _results(long, key, ["raw"])
    assert _exchanged(made)[0] == [key]
    assert sorted((r[key], r.raw) for r in made.collect()) == [("k1", None), ("k2", "9")]


def test_references_meet_on_packed_keys(spark):
    from rollcall.plans import constraints
    dims = {"dim_course": spark.createDataFrame([(MD5,), ("c",)], "k_course string"),
            "dim_course_section": spark.createDataFrame([("1", MD5), ("2", "c"), ("3", "lost"), ("4", MD5.upper()), ("5", None), ("6", "lost")],
                                                        "k_course_section string, k_course string")}
    wh = warehouse(spark, dims)
    bad = constraints.reference_violations(wh, ["dim_course_section"])
    assert sorted((r.key, r.n_records) for r in bad.collect()) == [(MD5.upper(), 1), ("lost", 2)]
    r = constraints.reference_summary(wh, ["dim_course_section"])
    assert [(x.n_keys, x.n_rows, x.n_orphan_keys, x.n_orphan_rows) for x in r.collect()] == [(4, 5, 2, 3)]
    assert "unhex" in _exchanged(r)[1]


@pytest.mark.parametrize("name,folder", [("customer_home", "staging-customer-home"), ("stg_ef3__schools", "staging-schools")])
def test_rows_that_others_grow_from_are_spread_over_files(spark, tmp_path, name, folder):
    """However few row groups a driver table has, its readers get several files."""
    from rollcall.sources.staging import Staging
    for t in ("region", "nation"):
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", tmp_path / f"{t}.parquet")
    spark.range(0, 200, 1, 1).selectExpr("id c_custkey", "concat('c', id) c_name", "1 c_nationkey", "1.5D c_acctbal", "'X' c_mktsegment").write.parquet(
        str(tmp_path / "customer.parquet"))
    spark.range(0, 50, 1, 1).selectExpr("id s_suppkey", "concat('s', id) s_name", "cast(id % 25 as int) s_nationkey").write.parquet(
        str(tmp_path / "supplier.parquet"))
    df = Staging(spark, str(tmp_path))(name)
    files = df.inputFiles()
    assert len(files) > 1 and all(folder in f for f in files), files
    assert df.count() == (200 if name == "customer_home" else 50)


def test_joined_bucketed_tables_are_not_sorted_again(spark, tmp_path):
    from rollcall.sources import sinks
    rows = spark.range(0, 300, 1, 3).selectExpr("if(id % 50 = 0, null, md5(cast(id % 100 as string))) k_student", "id n")
    one, two = (sinks.materialize_bucketed(rows, str(tmp_path / x), "k_student", 4) for x in "ab")
    joined = one.join(two.selectExpr("k_student", "n m").hint("merge"), "k_student", "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Sort [" not in plan and "Exchange" not in plan, plan
    # 98 keys of three rows each that all meet, and six rows without a key that meet none
    assert joined.count() == 98 * 9 + 6 and joined.where("m is null").count() == 6
