"""Trap tests: the semantic decisions of SURVEY §2.15, on tiny frames."""

import datetime as dt

from pyspark.sql import functions as F

from rollcall.functions import dates, metrics
from rollcall.operators import dedupe, joins, windows
from rollcall.sources.seeds import ABSENTEE_CATEGORIES

D = dt.date


def test_trap1_desc_puts_nulls_first_when_asked(spark):
    df = spark.createDataFrame([(1, None), (1, D(2024, 1, 1))], "k int, end_date date")
    out = dedupe.deduplicate(df, ["k"], [F.col("end_date").desc_nulls_first()])
    assert out.collect()[0].end_date is None


def test_trap3_day_count_honors_exclusive_flag(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), D(2024, 1, 3))], "b date, e date")
    today = F.lit(D(2024, 1, 10))
    row = df.select(dates.day_count_in_range("b", "e", today, True).alias("i"),
                    dates.day_count_in_range("b", "e", today, False).alias("x")).first()
    assert (row.i, row.x) == (3, 2)


def test_trap4_coalesce_to_today_ignores_inclusive_and_keeps_future_end(spark):
    df = spark.createDataFrame([(D(2024, 1, 20), D(2024, 2, 1))], "d date, e date")
    row = df.select(dates.within_end_date("d", "e", inclusive=False, coalesce_to=F.lit(D(2024, 1, 10))).alias("x")).first()
    assert row.x is True


def test_trap6_null_safe_window_match(spark):
    enr = spark.createDataFrame([("s", None)], "k_school string, cal string")
    win = spark.createDataFrame([("s", None, "school-level"), ("s", "c1", "calendar-level")],
                                "k_school string, wcal string, level string")
    j = enr.join(win, (enr.k_school == win.k_school) & enr.cal.eqNullSafe(win.wcal))
    assert [r.level for r in j.collect()] == ["school-level"]


def test_trap13_chronic_is_at_or_under_threshold(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(Decimal("90.00"), 20), (Decimal("90.01"), 20), (Decimal("50"), 19)],
                               "r decimal(5,2), n int")
    out = df.select(metrics.chronic_absentee("r", "n", Decimal("90"), 20).alias("c"))
    assert [r.c for r in out.collect()] == [True, False, False]


def test_trap9_band_rate_zero_has_no_band(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(Decimal("0.00"),)], "r decimal(5,2)")
    assert df.select(metrics.band_lookup("r", ABSENTEE_CATEGORIES, 1).alias("b")).first().b is None


def test_trap_tenant_max_uses_aggregate_not_window(spark):
    df = spark.createDataFrame([("t1", 2023), ("t1", 2024), ("t2", 2023)], "tenant_code string, school_year int")
    out = windows.flag_partition_max(df, ["tenant_code"], "school_year", "latest", few_partitions=True)
    assert sorted(tuple(r) for r in out.collect()) == [("t1", 2023, False), ("t1", 2024, True), ("t2", 2023, True)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_unambiguous_only_keeps_single_calendar_schools(spark):
    cal = spark.createDataFrame([("s1", 2024, "a"), ("s2", 2024, "b"), ("s2", 2024, "c")],
                                "k_school string, school_year int, k_school_calendar string")
    out = joins.unambiguous_only(cal, ["k_school", "school_year"])
    assert [r.k_school_calendar for r in out.collect()] == ["a"]


def test_d1_overlapping_assessment_windows_across_years(spark):
    import __spark_entry__ as E
    from rollcall.plans.checks import CHECKS
    wh = E.warehouse(spark, "/root/testdata/sf0.001")
    rows = CHECKS["d1_assessment_school_year_overlapping_dates"].fn(wh).collect()
    # only the 1-URGENT pair overlaps (2023 ends 2023-07-31, 2024 starts 2023-07-15); the NULL namespace pair
    # is matched null-safely but does not overlap
    assert [(r.assessment_identifier, r.school_year, r.overlapping_school_year) for r in rows] == [("1-URGENT", 2023, 2024)]
