"""Plan-shape regression tests for the scale design (checked with the executed plan)."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wh(spark):
    # a private warehouse: the shared one may already hold these datasets as written tables
    from rollcall import TEST_CONFIG, Warehouse, load_all
    from rollcall.sources.staging import Staging
    load_all()
    return Warehouse(spark, Staging(spark, SF), TEST_CONFIG)


def test_daily_attendance_shuffles_the_big_table_once(wh):
    plan = _plan(wh("fct_student_daily_attendance"))
    big = re.findall(r"Exchange hashpartitioning\(k_student#\d+, k_school#\d+, \d+\)", plan)
    assert len(big) == 1, plan
    # no exchange keyed on the school alone or on the calendar date for the big table
    assert not re.search(r"Exchange hashpartitioning\(k_student#\d+, k_school#\d+, (k_calendar_date|calendar_date)", plan)


def test_latest_snapshot_flag_uses_aggregate_not_window(wh):
    plan = _plan(wh("fct_local_actual_snapshots"))
    # min over a struct of sort keys: a (partial + final) aggregate, never a window over the account
    assert "Window" not in plan and "Aggregate" in plan


def test_enrollment_tenant_max_is_not_a_window_over_tenant(wh):
    plan = _plan(wh("fct_student_school_association"))
    windows = re.findall(r"Window \[.*?windowspecdefinition\((.*?)\)", plan)
    assert all("tenant_code" not in w for w in windows), windows


def test_filters_and_columns_reach_the_scan(spark):
    from rollcall.sources.staging import Staging
    st = Staging(spark, SF)
    df = st("stg_ef3__student_school_attendance_events").select("k_student", "attendance_event_date")
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "events" in line][0]
    read = re.search(r"ReadSchema: struct<(.*?)>", scan)[1]
    assert {c.split(":")[0] for c in read.split(",")} == {"ts", "user_id"}, scan


def test_daily_attendance_sorts_the_big_table_once(wh):
    """The day's event, the dedupe, the streaks and the running totals all go by
    student, school and day."""
    plan = wh("fct_student_daily_attendance")._jdf.queryExecution().executedPlan().toString()
    above = plan[:re.search(r"Exchange hashpartitioning\(k_student#\d+, k_school#\d+, \d+\)", plan).start()]
    assert len(re.findall(r"\bSort \[", above)) == 1, above


def test_attendance_events_are_combined_before_they_are_dealt(wh):
    from rollcall.plans.registry import DATASETS
    plan = DATASETS["fct_student_school_attendance_event"].fn(wh)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "row_number" not in plan, plan
