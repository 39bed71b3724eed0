"""Copies of assessment results across tenants, with rows worked out by hand."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rollcall import Config, Warehouse, load_all
from rollcall.functions.keys import surrogate_key
from rollcall.operators.dedupe import deduplicate, first_along, first_by
from rollcall.plans.cross_tenant import same_person

D = dt.date


def test_identity_guard_is_a_or_b_and_c(spark):
    people = [
        # one birth date: kept whatever the names, in one tenant too (A)
        ("one", D(2010, 1, 1), "Ann", "Lee", "t1"), ("one", D(2010, 1, 1), "Bea", "Ray", "t2"), ("one", D(2010, 1, 1), "Cy", "Fox", "t3"),
        ("alone", D(2010, 1, 1), "Ann", "Lee", "t1"),
        # two dates, 2 + 1 + 2 = 5 in two tenants: kept (B and C); case doesn't count
        ("five", D(2010, 1, 1), "ann", "Lee", "t1"), ("five", D(2010, 1, 2), "Ann", "Ray", "t2"),
        # two dates, 2 + 2 + 2 = 6: another person
        ("six", D(2010, 1, 1), "Ann", "Lee", "t1"), ("six", D(2010, 1, 2), "Bea", "Ray", "t2"),
        # two dates, few names, but one tenant (B without C)
        ("same tenant", D(2010, 1, 1), "Ann", "Lee", "t1"), ("same tenant", D(2010, 1, 2), "Ann", "Lee", "t1"),
        # unknown dates count as none (A)
        ("unknown", None, "Ann", "Lee", "t1"), ("unknown", None, "Bea", "Ray", "t2"),
    ]
    df = spark.createDataFrame(people, "student_unique_id string, birth_date date, first_name string, last_name string, tenant_code string")
    assert {r[0] for r in same_person(df).collect()} == {"one", "alone", "five", "unknown"}


def key_of(spark, *parts):
    return spark.range(1).select(surrogate_key(*[F.lit(p) for p in parts])).first()[0]


@pytest.fixture(scope="module")
def relations(spark):
    """Two tenants; student 7 is enrolled in both, 8 in t1, 9 in neither."""
    def asmt(tenant, student, ident):
        base = (tenant, "2024", "math", "exam", "ns")
        return (tenant, 2024, 2024, f"{tenant}-{student}", f"x{tenant}-{student}", key_of(spark, *base),
                key_of(spark, *base, ident, student), student, ident, "Math", "Exam", "NS")

    rows = [asmt("t1", "7", "a"), asmt("t1", "8", "b"), asmt("t1", "9", "c"), asmt("t2", "7", "d"),
            asmt("t1", "7", "both"), asmt("t2", "7", "both")]
    columns = ("tenant_code string, school_year int, api_year int, k_student string, k_student_xyear string, k_assessment string, "
               "k_student_assessment string, student_unique_id string, student_assessment_identifier string, "
               "academic_subject string, assessment_identifier string, namespace string")
    people = [("t1-7", "xt1-7", "t1", "7"), ("t2-7", "xt2-7", "t2", "7"), ("t1-8", "xt1-8", "t1", "8"), ("t1-9", "xt1-9", "t1", "9")]
    enrolled = [("t1-7", "xt1-7", "t1", 2024, True), ("t1-7", "xt1-7", "t1", 2024, True), ("t2-7", "xt2-7", "t2", 2024, True),
                ("t1-8", "xt1-8", "t1", 2024, True), ("t1-9", "xt1-9", "t1", 2024, False)]
    return {
        "stg_ef3__student_assessments": spark.createDataFrame(rows, columns),
        "dim_student": spark.createDataFrame([(*p, D(2010, 1, 1), "Ann", "Lee") for p in people],
                                             "k_student string, k_student_xyear string, tenant_code string, student_unique_id string, "
                                             "birth_date date, first_name string, last_name string"),
        "fct_student_school_association": spark.createDataFrame(
            enrolled, "k_student string, k_student_xyear string, tenant_code string, school_year int, is_active_enrollment boolean"),
        "removed": spark.createDataFrame([("t2-7",)], "k_student string"),
    }


def warehouse(spark, relations, **config):
    load_all()
    wh = Warehouse(spark, relations.__getitem__, Config(cross_tenant_assessments=True, **config))
    for name in ("dim_student", "fct_student_school_association"):
        wh.override(name, relations[name])
    return wh


def copies(wh):
    return {(r.student_assessment_identifier, r.tenant_code, r.k_student, r.is_original_record, r.original_tenant_code)
            for r in wh("bld_student_assessment_cross_tenant").collect()}


def test_copies_go_to_every_tenant_and_own_records_win(spark, relations):
    assert copies(warehouse(spark, relations)) == {
        ("a", "t1", "t1-7", True, "t1"), ("a", "t2", "t2-7", False, "t1"), ("b", "t1", "t1-8", True, "t1"),
        ("d", "t2", "t2-7", True, "t2"), ("d", "t1", "t1-7", False, "t2"),
        # both tenants have it: no copy takes the place of their own record; 9 isn't enrolled
        ("both", "t1", "t1-7", True, "t1"), ("both", "t2", "t2-7", True, "t2")}


def test_removed_students_neither_share_nor_receive(spark, relations):
    assert copies(warehouse(spark, relations, removed_students_source="removed")) == {
        ("a", "t1", "t1-7", True, "t1"), ("b", "t1", "t1-8", True, "t1"), ("d", "t2", "t2-7", True, "t2"),
        ("both", "t1", "t1-7", True, "t1"), ("both", "t2", "t2-7", True, "t2")}


def test_off_is_an_empty_relation_of_the_same_columns(spark, relations):
    load_all()
    off = Warehouse(spark, relations.__getitem__, Config())
    for name in ("bld_student_assessment_cross_tenant", "bld_student_objective_assessment_cross_tenant"):
        assert off(name).count() == 0
    assert off("bld_student_assessment_cross_tenant").columns == warehouse(spark, relations)("bld_student_assessment_cross_tenant").columns


@pytest.mark.parametrize("order", [
    [("n", "desc nulls first"), ("s", "asc nulls last"), ("i", "asc nulls first")],
    [("s", "desc nulls first"), ("d", "asc nulls first"), ("i", "desc nulls last")],
    [("b", "desc nulls last"), ("d", "desc nulls first"), ("i", "asc nulls last")],
])
def test_first_by_is_deduplicate(spark, order):
    r = random.Random(1)
    rows = [(r.randrange(9), r.choice([None, 1.5, 2.5]), r.choice([None, "a", "b", ""]), r.choice([None, D(2020, 1, 1), D(1960, 1, 1)]),
             r.choice([None, True, False]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, n double, s string, d date, b boolean, i int")
    by = [getattr(F.col(c), how.replace(" ", "_"))() for c, how in order]
    got = first_by(df, ["k"], order)
    assert sorted(map(str, got.collect())) == sorted(map(str, deduplicate(df, ["k"], by).collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_m" in plan and "Window" not in plan


@pytest.mark.parametrize("order", [
    [("n", "desc nulls first"), ("s", "asc nulls last")], [("s", "desc nulls first"), ("d", "asc nulls first")]])
def test_first_along_is_deduplicate(spark, order):
    r = random.Random(2)
    rows = [(r.randrange(9), r.choice([None, 1.5, 2.5]), r.choice([None, "a", "b"]), r.choice([None, D(2020, 1, 1), D(1960, 1, 1)]), i)
            for i in range(200)]
    df = spark.createDataFrame(rows + rows, "k int, n double, s string, d date, i int")
    got = [tuple(x) for x in first_along(df, ["k"], order, "i").drop("i").collect()]
    by = [getattr(F.col(c), how.replace(" ", "_"))() for c, how in order]
    want = deduplicate(df, ["k"], [*by, F.col("i")]).drop("i").collect()
    keys = [0, *[df.columns.index(c) for c, _ in order]]
    assert len(got) == 9 and sorted(str([x[j] for j in keys]) for x in got) == sorted(str([x[j] for j in keys]) for x in want)


def test_first_by_refuses_text_both_ways(spark):
    df = spark.createDataFrame([(1, "a", "b")], "k int, s string, t string")
    with pytest.raises(ValueError):
        first_by(df, ["k"], [("s", "asc nulls first"), ("t", "desc nulls first")])
