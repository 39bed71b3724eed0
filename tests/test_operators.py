"""Operator tests on tiny hand-made frames (worked examples of FIXTURES.md §2)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from rollcall.functions import columns, dates, keys, metrics
from rollcall.operators import dedupe, joins, reshape, sets, windows
from rollcall.sources.seeds import ABSENTEE_CATEGORIES

D = dt.date


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect()) if cols else sorted(tuple(r) for r in df.collect())


def test_flag_pivot_with_null_as_false(spark):
    df = spark.createDataFrame([(1, "Economic Disadvantaged"), (1, "Gifted"), (2, "Economic Disadvantaged"),
                                (3, "Homeless"), (4, None)], "id int, c string")
    pairs = [("Economic Disadvantaged", "is_ed"), ("Gifted", "is_gifted"), ("Homeless", "is_homeless")]
    out = reshape.pivot_flags(df, ["id"], "c", pairs)
    assert rows(out, "id", "is_ed", "is_gifted", "is_homeless") == [
        (1, True, True, False), (2, True, False, False), (3, False, False, True), (4, False, False, False)]


def test_count_pivot(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "red"), ("M", "red")], "size string, color string")
    out = reshape.pivot_counts(df, ["size"], "color", ["red", "blue"])
    assert rows(out, "size", "red", "blue") == [("M", 1, 0), ("S", 2, 1)]


def test_pivot_values_names_are_slugified(spark):
    df = spark.createDataFrame([(1, "State ID", "a"), (1, "Local-Code", "b"), (1, "State ID", "0")],
                               "k int, sys string, code string")
    out = reshape.pivot_values(df, ["k"], "sys", ["Local-Code", "State ID"], "code", suffix="_code")
    assert set(out.columns) == {"k", "local_code_code", "state_id_code"}
    assert rows(out, "k", "state_id_code", "local_code_code") == [(1, "0", "b")]


def test_unpivot_keeps_nulls(spark):
    df = spark.createDataFrame([(1, "F", None, True)], "k int, gender string, lep string, flag boolean")
    out = reshape.unpivot(df, ["k"], name_col="c", value_col="v")
    assert rows(out) == [(1, "flag", "true"), (1, "gender", "F"), (1, "lep", None)]


def test_within_end_date(spark):
    df = spark.createDataFrame([(D(2024, 1, 5), None), (D(2024, 1, 5), D(2024, 1, 5)), (D(2024, 1, 6), D(2024, 1, 5))],
                               "d date, e date")
    out = df.select(dates.within_end_date("d", "e", True).alias("inc"), dates.within_end_date("d", "e", False).alias("exc"))
    assert [tuple(r) for r in out.collect()] == [(True, True), (True, False), (False, False)]
    out2 = df.select(dates.within_end_date("d", "e", coalesce_to=F.lit(D(2024, 1, 5))).alias("x"))
    assert [r.x for r in out2.collect()] == [True, True, False]


def test_day_count_open_end_counts_today(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), None), (D(2024, 1, 1), D(2024, 1, 10))], "b date, e date")
    today = F.lit(D(2024, 1, 5))
    out = df.select(dates.day_count_in_range("b", "e", today, True).alias("inc"),
                    dates.day_count_in_range("b", "e", today, False).alias("exc"))
    assert [tuple(r) for r in out.collect()] == [(5, 5), (10, 9)]


def test_race_label_precedence(spark):
    df = spark.createDataFrame([(True, ["White"]), (False, ["White", "Asian"]), (False, ["Asian"]), (None, None)],
                               "h boolean, r array<string>")
    out = df.select(columns.race_label("h", "r", "Latinx", "Multiple", "Unknown").alias("x"))
    assert [r.x for r in out.collect()] == ["Latinx", "Multiple", "Asian", "Unknown"]


def test_recode_boolean(spark):
    df = spark.createDataFrame([("Y",), ("true",), ("1.0",), ("N",), ("f",), ("maybe",), (None,)], "v string")
    assert [r.x for r in df.select(columns.recode_boolean("v").alias("x")).collect()] == [
        True, True, True, False, False, None, None]


def test_not_in_list(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert [r.x for r in df.select(columns.not_in("v", ["a"]).alias("x")).collect()] == [False, True, None]
    assert [r.x for r in df.select(columns.not_in("v", []).alias("x")).collect()] == [True, True, True]


def test_row_pluck_prefers_then_alphabetical(spark):
    df = spark.createDataFrame([(1, "Home"), (1, "Physical"), (1, "Mailing"), (2, "Home"), (2, "Mailing")],
                               "k int, t string")
    out = dedupe.row_pluck(df, "k", "t", "Physical")
    assert rows(out, "k", "t", "is_preferred") == [(1, "Physical", True), (2, "Home", False)]


def test_deduplicate_null_placement(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, D(2024, 1, 1), "y")], "k int, d date, v string")
    assert rows(dedupe.deduplicate(df, ["k"], [F.col("d").desc_nulls_first()]), "v") == [("x",)]
    assert rows(dedupe.deduplicate(df, ["k"], [F.col("d").desc_nulls_last()]), "v") == [("y",)]


def test_flag_first_by_key_matches_window(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 2), "b"), (1, D(2024, 1, 2), "a"), (1, D(2024, 1, 1), "c"),
                                (2, D(2024, 1, 1), "d")], "k int, d date, id string")
    neg = -F.datediff("d", F.lit(D(1970, 1, 1)))
    out = dedupe.flag_first_by_key(df, "latest", ["k"], neg, "id")
    assert rows(out, "id", "latest") == [("a", True), ("b", False), ("c", False), ("d", True)]


def test_streak_counter(spark):
    status = ["Unexcused"] * 5 + ["Not Absent", "Unexcused"]
    df = spark.createDataFrame([(1, D(2024, 1, i + 1), s) for i, s in enumerate(status)], "k int, d date, s string")
    out = windows.streaks(df, ["k"], "s", "d", "n")
    assert [r.n for r in out.orderBy("d").collect()] == [1, 2, 3, 4, 5, 1, 1]


def test_running_and_partition_sum(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), 1), (1, D(2024, 1, 2), 0), (1, D(2024, 1, 3), 1)],
                               "k int, d date, v int")
    out = df.select("d", windows.running_sum("v", ["k"], "d").alias("run"), windows.partition_sum("v", ["k"]).alias("tot"))
    assert [(r.run, r.tot) for r in out.orderBy("d").collect()] == [(1, 2), (1, 2), (2, 2)]


def test_absentee_bands_lower_exclusive(spark):
    df = spark.createDataFrame([(Decimal("80.00"),), (Decimal("90.00"),), (Decimal("0.00"),), (Decimal("96.50"),)],
                               "r decimal(5,2)")
    out = df.select(metrics.band_lookup("r", ABSENTEE_CATEGORIES, 0).alias("rank"))
    assert [r.rank for r in out.collect()] == [1, 2, None, 4]


def test_rate_is_exact_half_up_and_zero_safe(spark):
    df = spark.createDataFrame([(Decimal("0.50"), Decimal("16.00")), (Decimal("1"), Decimal("0"))],
                               "a decimal(5,2), b decimal(5,2)")
    assert [r.x for r in df.select(metrics.rate_pct("a", "b").alias("x")).collect()] == [Decimal("3.13"), None]


def test_surrogate_key_null_vs_empty(spark):
    df = spark.createDataFrame([(None,), ("",)], "v string")
    ks = [r.k for r in df.select(keys.surrogate_key("v", F.lit(1)).alias("k")).collect()]
    assert ks[0] != ks[1] and all(len(k) == 32 for k in ks)


def test_wildcard_join(spark):
    left = spark.createDataFrame([("A", "x"), ("A", "y")], "a string, b string")
    xw = spark.createDataFrame([("A", None, "any"), ("A", "y", "only-y")], "a string, b string, label string")
    out = joins.wildcard_join(left, xw, ["a"], ["b"], "left")
    assert rows(out, "a", "b", "label") == [("A", "x", "any"), ("A", "y", "any"), ("A", "y", "only-y")]


def test_union_missing_columns_and_source(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2,)], "k int")
    out = sets.union_all([a, b], allow_missing=True, source_col="src", names=["a", "b"])
    assert rows(out, "k", "v", "src") == [(1, "x", "a"), (2, None, "b")]


def test_distinct_count_per_partition(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c")], "k int, v string")
    out = windows.count_distinct_per(df, ["k"], "v", "n")
    assert rows(out, "k", "n") == [(1, 2), (1, 2), (1, 2), (2, 1)]


def test_single_or_multiple(spark):
    df = spark.createDataFrame([(["a"],), (["a", "b"],), ([],)], "x array<string>")
    assert [r.y for r in df.select(columns.single_or_multiple("x").alias("y")).collect()] == ["a", "Multiple", None]


def test_time_repair_and_duration(spark):
    df = spark.createDataFrame([("01:30:00", "02:15:00"), ("11:00:00", "01:00:00")], "s string, e string")
    out = df.select(columns.repair_time("s").alias("s2"), columns.minutes_between("s", "e").alias("m"))
    assert [tuple(r) for r in out.collect()] == [("13:30:00", 45), ("11:00:00", 120)]
