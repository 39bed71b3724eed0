"""The student dimension's plan, and its domain switches."""

import datetime as dt
import re

import pytest

from rollcall import Config, Warehouse, load_all
from rollcall.config import PROGRAMS
from rollcall.sources.staging import Staging

SF = "/root/testdata/sf0.001"


def warehouse(spark, **config):
    load_all()
    return Warehouse(spark, Staging(spark, SF), Config(as_of=dt.date(2024, 1, 30), **config))


@pytest.fixture(scope="module")
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    was = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def test_star_deals_the_students_once(spark, no_broadcast):
    plan = warehouse(spark)("dim_student")._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#\d+[L,]", plan)
    # the others are of the staging's school lookup, which is broadcast otherwise
    assert exchanges.count("k_student") == 1 and exchanges.count("k_student_xyear") == 1, plan
    assert plan.count("Bucketed: true") == 16 and "BroadcastHashJoin" not in plan, plan


def test_a_domain_that_is_off_is_neither_read_nor_a_column(spark):
    off = warehouse(spark, domains=("homeless",))
    read = []
    off.sources = lambda name, sources=off.sources: read.append(name) or sources(name)
    stu = off("dim_student")
    assert "is_homeless_annual" in stu.columns
    for build, spec in PROGRAMS.items():
        if spec.domain != "homeless":
            assert not [c for c in stu.columns if spec.flag in c and "characteristic" not in c], spec
            assert not [r for r in read if f"student_{build[:6]}" in r], read
    plan = stu._jdf.queryExecution().analyzed().toString()
    assert "special_education" not in plan and "is_cte" not in plan
    services = off("fct_student_program_service")
    assert "cip_code" not in services.columns and "v_providers" in services.columns
    shorts = [r for r in read if r.endswith("program_services")]
    assert sorted(shorts) == ["stg_ef3__stu_homeless__program_services", "stg_ef3__stu_program__program_services"]


def test_homeless_flags_are_of_the_stages_students(spark):
    wh = warehouse(spark)
    flagged = {r[0] for r in wh("dim_student").filter("is_homeless_annual").select("k_student").collect()}
    known = {r[0] for r in wh("dim_student").select("k_student").collect()}
    stage = {r[0] for r in wh("stg_ef3__student_homeless_program_associations").select("k_student").collect()}
    assert flagged == stage & known and flagged != known


def test_immutable_demographics_take_the_latest_year(spark):
    wh = warehouse(spark, immutable_demos=True)
    stu = {(r.student_unique_id, r.tenant_code, r.school_year): r for r in wh("dim_student").collect()}
    plain = {(r.student_unique_id, r.tenant_code, r.school_year): r for r in warehouse(spark)("dim_student").collect()}
    assert stu.keys() == plain.keys()
    two = [k for k in stu if (k[0], k[1], 2023) in stu and k[2] == 2024]
    assert two
    for uid, tenant, _ in two:
        old, new = stu[uid, tenant, 2023], stu[uid, tenant, 2024]
        # names of the prior year began with "Former"
        assert plain[uid, tenant, 2023].last_name.startswith("Former") and old.last_name == new.last_name
        assert old.display_name == new.display_name and old.race_array == new.race_array and old.gender == new.gender
        assert old.grade_level == plain[uid, tenant, 2023].grade_level
