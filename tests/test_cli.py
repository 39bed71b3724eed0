"""The command line: refreshes that swap, clustered tables, and audit rows of a run."""

import argparse
import os

import pytest
from pyspark.sql import functions as F

from rollcall import cli
from rollcall.plans.registry import DATASETS
from rollcall.sources.store import Store

SF = "/root/testdata/sf0.001"


def args(out, *select):
    return argparse.Namespace(sf_dir=SF, out=str(out), as_of="2024-01-30", master=None, select=list(select) or None)


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("warehouse")
    cli.run(args(out, "msr_student_cumulative_attendance"))
    return out


def test_dependencies_are_kept_like_the_table_asked_for(spark, out):
    tables = Store(spark, str(out)).tables()
    assert {"msr_student_cumulative_attendance", "fct_student_daily_attendance", "dim_school"} <= set(tables)
    for name in ("msr_student_cumulative_attendance", "fct_student_daily_attendance", "fct_student_school_association"):
        assert any(d.startswith("school_year=") for d in os.listdir(out / tables[name])), name
    msr = Store(spark, str(out)).read("msr_student_cumulative_attendance")
    assert msr.count() > 0 and dict(msr.dtypes)["school_year"] == "int"


def test_a_failed_refresh_leaves_the_old_tables(spark, out, monkeypatch):
    store = Store(spark, str(out))
    before, rows = store.tables(), store.read("dim_school").count()

    def broken(wh):
        raise RuntimeError("midway")
    monkeypatch.setitem(DATASETS, "dim_esc", DATASETS["dim_esc"].__class__(**{**DATASETS["dim_esc"].__dict__, "fn": broken}))
    with pytest.raises(RuntimeError, match="midway"):
        cli.run(args(out, "dim_school", "dim_esc"))
    assert store.tables() == before and store.read("dim_school").count() == rows


def test_a_null_in_the_grain_is_not_taken_over(spark, out, monkeypatch):
    before = Store(spark, str(out)).tables()
    esc = DATASETS["dim_esc"]
    monkeypatch.setitem(DATASETS, "dim_esc", esc.__class__(**{
        **esc.__dict__, "fn": lambda wh: esc.fn(wh).withColumn("k_esc", F.lit(None).cast("string"))}))
    with pytest.raises(SystemExit, match="k_esc"):
        cli.run(args(out, "dim_esc"))
    assert Store(spark, str(out)).tables() == before


def test_the_next_refresh_swaps_and_removes(spark, tmp_path):
    cli.run(args(tmp_path, "dim_lea"))
    first = Store(spark, str(tmp_path)).tables()
    cli.run(args(tmp_path, "dim_lea"))
    second = Store(spark, str(tmp_path)).tables()
    assert first.keys() == second.keys() and first["dim_lea"] != second["dim_lea"]
    assert (tmp_path / first["dim_lea"]).exists()  # readers of the last run can finish
    cli.run(args(tmp_path, "dim_lea"))
    assert not (tmp_path / first["dim_lea"]).exists() and (tmp_path / second["dim_lea"]).exists()


def scanned(df) -> int:
    """Rows that the scan hands on after skipping row groups."""
    run = df._jdf.queryExecution()
    run.toRdd().count()
    return run.executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_a_tenant_and_year_are_found_without_reading_all(spark, tmp_path):
    """A third of all rows is one tenant's: its files are several, others aren't read."""
    from rollcall.sources.sinks import write_table
    from rollcall.sources.store import layout
    rows = spark.range(60_000).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("k_row"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), (F.col("id") % 20).cast("string"))).alias("tenant_code"),
        (F.lit(2020) + F.col("id") % 4).cast("int").alias("school_year")).repartition(6)
    by = layout(rows.columns, ("k_row",))
    assert by == ("tenant_code", "school_year", "k_row")
    plain, clustered = f"{tmp_path}/plain", f"{tmp_path}/clustered"
    write_table(rows, plain)
    # (small files here would be one after coalescing)
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_table(rows, clustered, cluster_by=by)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    want = (F.col("tenant_code") == "t7") & (F.col("school_year") == 2023)
    found = {p: spark.read.parquet(p).filter(want) for p in (plain, clustered)}
    assert found[plain].count() == found[clustered].count() > 0
    assert scanned(found[plain]) == 60_000 and scanned(found[clustered]) <= 20_000
    files = spark.read.parquet(clustered).filter("tenant_code = 'hot'").select(F.input_file_name()).distinct().count()
    assert files > 1


def test_counts_are_of_the_run(spark, tmp_path):
    once = cli.test(args(tmp_path, "d6_calendar_event_codes"))
    again = cli.test(args(tmp_path, "d6_calendar_event_codes"))
    assert once == again and once["d6_calendar_event_codes"] > 0
    rows = spark.read.parquet(f"{tmp_path}/_audit")
    assert rows.count() == 2 * once["d6_calendar_event_codes"] and rows.select("run_id").distinct().count() == 2
    assert {(r.check_name, r.severity) for r in rows.collect()} == {("d6_calendar_event_codes", "warn")}


def test_a_cluster_needs_a_shared_folder(spark):
    from rollcall.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host"

        @staticmethod
        def getConf():
            return {}

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)
