"""Staging on keys that are not 0..n-1, and the plans of its school lookup."""

import shutil

import pytest
from pyspark.sql import functions as F

from rollcall.operators.numbering import dense_index
from rollcall.sources.sinks import materialize, table_root
from rollcall.sources.staging import Staging

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def gapped(spark, tmp_path_factory):
    """The tables with supplier, part and customer keys that start at 7 and have gaps."""
    out = tmp_path_factory.mktemp("gapped")
    for t in ("region", "nation", "events"):
        shutil.copy(f"{SF}/{t}.parquet", out / f"{t}.parquet")
    columns = {"supplier": ["s_suppkey"], "part": ["p_partkey"], "customer": ["c_custkey"], "orders": ["o_custkey"],
               "lineitem": ["l_partkey", "l_suppkey"]}
    for t, keys in columns.items():
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        for k in keys:
            df = df.withColumn(k, F.col(k) * 3 + 7)
        df.write.parquet(f"{out}/{t}.parquet")
    return Staging(spark, str(out))


def test_no_row_is_lost_on_gapped_keys(spark, gapped):
    for relation, table in (("customer_home", "customer"), ("part_home", "part"), ("orders_home", "orders"),
                            ("stg_ef3__grades", "lineitem"), ("stg_ef3__student_section_associations", "lineitem"),
                            ("stg_ef3__course_transcripts", "lineitem"), ("stg_ef3__student_section_attendance_events", "events"),
                            ("stg_ef3__student_school_attendance_events", "events")):
        assert gapped(relation).count() == gapped.t(table).count(), relation
    teachers = gapped("stg_ef3__staff_section_associations")
    assert teachers.count() == gapped.t("part").filter("p_size < 45").count()
    assert teachers.join(gapped("stg_ef3__staffs"), "k_staff", "left_anti").isEmpty()
    sections = gapped("stg_ef3__student_section_attendance_events")
    assert sections.join(gapped("stg_ef3__sections"), "k_course_section", "left_anti").isEmpty()


def test_every_school_has_students_on_gapped_keys(gapped):
    assert gapped("customer_home").select("home_school_id").distinct().count() == gapped.t("supplier").count()


def test_dense_index(spark):
    df = spark.createDataFrame([(x * x - 50,) for x in range(400)], "k long").repartition(7).repartitionByRange(5, "k")
    root = table_root(spark)
    got = dense_index(df, "k", "i", lambda d, what: materialize(d, f"{root}/{what}")).collect()
    assert [r.k for r in sorted(got, key=lambda r: r.i)] == sorted(x * x - 50 for x in range(400))
    assert sorted(r.i for r in got) == list(range(400))


def test_grades_are_not_dealt_by_school(spark):
    """The orders are too big to broadcast here, the lookup of schools is not."""
    limits = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in limits:
        spark.conf.set(k, "6KB")
    try:
        df = Staging(spark, SF)("stg_ef3__grades")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in limits.items():
            spark.conf.set(k, v)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and all("l_orderkey" in e for e in exchanges), plan


def test_budgets_have_every_status(spark):
    st = Staging(spark, SF)
    assert {r[0] for r in st("stg_ef3__local_budgets").select("budget_status").distinct().collect()} == {"F", "O", "P"}
