"""Keys, references and optional keys, with rows worked out by hand."""

import json

import pytest
from pyspark.sql import functions as F

from rollcall import CUSTOM_CONFIG, Config, Warehouse, load_all
from rollcall.operators.joins import optional_key_join
from rollcall.plans import constraints
from rollcall.plans.custom import custom_source_duplicates
from rollcall.plans.registry import DATASETS


@pytest.fixture
def wh(spark):
    """Grades with a repeated key, one with a NULL, and two that lack a parent."""
    load_all()
    wh = Warehouse(spark, lambda name: None, Config())
    grades = [("s1", "c1", "g1", "Final"), ("s1", "c1", "g1", "Final"), ("s1", "c1", "g1", "Final"), ("s2", "c1", "g1", None),
              ("s3", "c9", "g1", "Final"), ("s3", "c9", "g1", "Grading Period"), ("s1", None, "g1", "Final")]
    wh.override("fct_student_grades", spark.createDataFrame(
        grades, "k_student string, k_course_section string, k_grading_period string, grade_type string"))
    wh.override("dim_student", spark.createDataFrame([("s1",), ("s2",)], "k_student string"))
    wh.override("dim_course_section", spark.createDataFrame([("c1", "s9")], "k_course_section string, k_student string"))
    wh.override("dim_grading_period", spark.createDataFrame([("g1",), ("g2",)], "k_grading_period string"))
    return wh


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_keys(wh):
    assert rows(constraints.key_summary(wh, ["fct_student_grades", "dim_student"])) == [
        ("dim_student", "k_student", 2, 2, 0, 0),
        ("fct_student_grades", "k_student,k_course_section,k_grading_period,grade_type", 7, 5, 1, 2)]
    broken = constraints.key_violations(wh, ["fct_student_grades", "dim_student"]).collect()
    assert {(r.constraint_name, json.loads(r.key_json)["k_student"], json.loads(r.key_json)["grade_type"], r.n_records) for r in broken} == {
        ("unique", "s1", "Final", 3), ("not_null", "s2", None, 1), ("not_null", "s1", "Final", 1)}


@pytest.mark.parametrize("values", [1, 2, 3])
def test_keys_whose_hashes_collide_are_told_apart(wh, values):
    few = lambda *grain: F.pmod(F.xxhash64(*grain), F.lit(values))
    assert rows(constraints.key_summary(wh, ["fct_student_grades", "dim_student"], few)) == [
        ("dim_student", "k_student", 2, 2, 0, 0),
        ("fct_student_grades", "k_student,k_course_section,k_grading_period,grade_type", 7, 5, 1, 2)]


def test_keys_are_dealt_as_hashes(wh, spark):
    """No exchange holds the keys of a table without repeated ones; those that repeat come with their rows."""
    plan = constraints.key_summary(wh, ["dim_student"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in plan and "Scan" not in plan, plan
    from rollcall.plans.checks import grain_violations
    assert rows(grain_violations(wh, "fct_student_grades")) == [("s1", "c1", "g1", "Final", 3)]
    assert grain_violations(wh, "dim_student").count() == 0


def test_references(wh):
    assert rows(constraints.reference_summary(wh, ["fct_student_grades"])) == [
        ("fct_student_grades", "k_course_section", "dim_course_section", 2, 6, 1, 2),
        ("fct_student_grades", "k_grading_period", "dim_grading_period", 1, 7, 0, 0),
        ("fct_student_grades", "k_student", "dim_student", 3, 7, 1, 2)]
    assert rows(constraints.reference_violations(wh, ["fct_student_grades", "dim_course_section"])) == [
        ("dim_course_section", "k_student", "dim_student", "s9", 1),
        ("fct_student_grades", "k_course_section", "dim_course_section", "c9", 2), ("fct_student_grades", "k_student", "dim_student", "s3", 2)]


def test_a_parent_is_read_once_for_all_its_children(wh, spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = dict(constraints._met(wh, ["fct_student_grades", "dim_course_section"]))["dim_student"]
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert plan.count("SortMergeJoin") == 1 and plan.count("Union") == 1


def test_the_rule_finds_the_references_of_the_tables():
    load_all()
    known = constraints.parents()
    assert known["k_student"] == "dim_student" and known["k_course_section"] == "dim_course_section"
    assert all(DATASETS[p].grain == (c,) for c, p in known.items())


def test_optional_keys(spark):
    left = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), (None, "x"), ("c", None)], "i string, f string")
    xwalk = spark.createDataFrame([("a", None, 1), (None, "x", 2), ("b", "x", 3), ("b", "z", 4), (None, "q", 5)], "xi string, xf string, v int")
    got = rows(optional_key_join(left, xwalk, [("i", "xi"), ("f", "xf")], ["v"]).na.fill("-"))
    assert got == sorted([("a", "x", 1), ("a", "x", 2), ("a", "y", 1), ("b", "x", 2), ("b", "x", 3), ("-", "x", 2), ("c", "-", None)], key=str) \
        or set(got) == {("a", "x", 1), ("a", "x", 2), ("a", "y", 1), ("b", "x", 2), ("b", "x", 3), ("-", "x", 2), ("c", "-", None)}
    assert len(got) == 7
    every = optional_key_join(left, xwalk.union(spark.createDataFrame([(None, None, 9)], xwalk.schema)), [("i", "xi"), ("f", "xf")], ["v"])
    assert every.count() == 6 + 5  # the row without keys matches all, so none is left over


def test_no_nested_loop_over_the_fact(spark):
    import __spark_entry__ as E
    from rollcall.plans import checks
    wh = E.warehouse(spark, "/root/testdata/sf0.001")
    for name in ("d2_assessments_without_score_mapping", "d9_objective_assessments_without_score_mapping"):
        plan = checks.CHECKS[name].fn(wh)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastNestedLoopJoin" not in plan and "Cartesian" not in plan, plan


def test_custom_sources_that_repeat_a_course(spark):
    load_all()
    source = spark.createDataFrame([("k1",), ("k1",), ("k2",)], "k_course string")
    wh = Warehouse(spark, {"mine": source}.__getitem__, Config(custom_columns={"dim_course": (("mine", "x", "true"),)}))
    assert rows(custom_source_duplicates(wh, "dim_course", ["k_course"])) == [("k1", 2, "mine")]
    from rollcall.plans.checks import CHECKS
    assert rows(CHECKS["d16_custom_course_sources_unique"].fn(wh)) == [("k1", 2, "mine")]
    assert CUSTOM_CONFIG.cross_tenant_assessments
