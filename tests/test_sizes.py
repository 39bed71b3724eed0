"""Sizes Spark plans with: what it takes to be small it broadcasts, through the driver."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollcall import TEST_CONFIG, Warehouse
from rollcall.session import IN_MEMORY, size_tables_in_memory
from rollcall.sources.sinks import materialize
from rollcall.sources.staging import Staging

FACTOR = "spark.sql.sources.fileCompressionFactor"


def planned(df) -> int:
    """Bytes that Spark takes the rows for."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@pytest.fixture(scope="module")
def schools(spark, tmp_path_factory):
    """A folder with 400 schools, 100 of them with two calendars."""
    d = str(tmp_path_factory.mktemp("schools"))
    spark.createDataFrame([(0, "AFRICA")], "r_regionkey int, r_name string").write.parquet(f"{d}/region.parquet")
    spark.createDataFrame([(0, "KENYA", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{d}/nation.parquet")
    spark.range(400).select(F.col("id").alias("s_suppkey"), F.lit("S").alias("s_name"), F.lit(0).alias("s_nationkey"),
                            F.lit(0.0).alias("s_acctbal")).coalesce(1).write.parquet(f"{d}/supplier.parquet")
    return d


def test_calendar_days_are_not_taken_for_their_calendars(spark, schools):
    days = Staging(spark, schools)("stg_ef3__calendar_dates")
    got = days.groupBy("k_school_calendar").agg(F.countDistinct("k_calendar_date").alias("n"), F.count("*").alias("rows"),
                                                F.min("calendar_date").alias("a"), F.max("calendar_date").alias("b")).collect()
    assert len(got) == 500
    assert {tuple(r)[1:] for r in got} == {(31, 31, dt.date(2024, 1, 1), dt.date(2024, 1, 31))}
    # 28 bytes are what Spark counts for a row of one text
    assert planned(days.select("k_calendar_date")) >= 500 * 31 * 28


def test_tables_are_planned_by_their_size_in_memory(spark, schools, tmp_path):
    before = spark.conf.get(FACTOR)
    try:
        spark.conf.set(FACTOR, "1.0")
        Warehouse(spark, Staging(spark, schools), TEST_CONFIG)
        keys = spark.range(20000).select(F.md5(F.col("id").cast("string")).alias("k"), F.lit(True).alias("flag"))
        table = materialize(keys, str(tmp_path / "keys"))
        assert planned(table.select("k")) >= 20000 * 28
        # a factor of the deployment's own stays
        spark.conf.set(FACTOR, "9")
        size_tables_in_memory(spark)
        assert spark.conf.get(FACTOR) == "9"
        spark.conf.set(FACTOR, "1.0")
        size_tables_in_memory(spark)
        assert spark.conf.get(FACTOR) == IN_MEMORY
    finally:
        spark.conf.set(FACTOR, before)
