"""Stages of the pipeline and the operators under them on odd and empty tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rollcall.llm import bpe, quality
from rollcall.llm.common import with_row_ids
from rollcall.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, kept string"


def good(name, n=80):
    return " ".join(f"{name}{i}" for i in range(n)) + "."


ROWS = [(1, good("a"), "en", "s", 5, "r", "k"), (2, good("a").upper(), "en", "s", 5, "r", "k"), (None, good("b"), None, None, None, None, None),
        (3, None, None, "t", None, None, None), (4, "", "en", "t", 0, "r", "k"), (5, " \t\n", "en", "s", 3, "r", "k"),
        (5, good("c", 9000), "en", "s", 3, "r", "k"), (None, None, None, None, None, None, None), (1, good("a"), "en", "s", 5, "r", "k")]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("stages")
    spark.createDataFrame(ROWS, SCHEMA).coalesce(2).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (4, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    empty = tmp_path_factory.mktemp("none")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    return str(out), str(empty)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_odd_and_empty_tables(spark, tables, name, stage):
    full, empty = tables
    for folder, docs in ((full, spark.read.parquet(f"{full}/documents.parquet")), (full, spark.createDataFrame(ROWS, SCHEMA))):
        got = stage(spark, docs, folder)
        rows = got.collect()
        if name != "tokens":
            assert got.columns == corpus_pipeline.COLUMNS
        if name == "exact_dedup":
            texts = sorted((r.text or "").lower() for r in rows)
            assert texts == sorted({(r[1] or "").lower() for r in ROWS}) and len(rows) == 5
            assert [r.doc_id for r in rows if (r.text or "").lower() == good("a")] == [2]
        if name == "near_dedup":
            assert sorted(r.text for r in rows if r.text and r.text.strip()) == sorted(
                [good("a"), good("b"), good("c", 9000)])
        if name == "tokens":
            assert len(rows) == len(ROWS)
    none = stage(spark, spark.read.parquet(f"{empty}/documents.parquet"), empty)
    assert none.collect() == []


def test_no_labels_no_network(spark, tables):
    empty = spark.read.parquet(f"{tables[1]}/documents.parquet")
    assert quality.fit(empty, spark.read.parquet(f"{tables[1]}/labels.parquet"), F.lit(True)) is None
    assert bpe.round_trip_digests(empty, tokenizer_path()).collect() == []


def test_row_ids_tell_rows_apart_and_stay(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    whole = {r.id: hashlib.sha256(repr(r[:-1]).encode()).hexdigest() for r in with_row_ids(docs, "id").collect()}
    assert len(whole) == len(ROWS)
    some = with_row_ids(docs.where("doc_id is not null").select("text", "doc_id"), "id").select("id").collect()
    assert {r.id for r in some} < set(whole) and len(some) == len(ROWS) - 2
    twice = with_row_ids(docs.unionByName(docs), "id")
    assert twice.select("id").distinct().count() == 2 * len(ROWS)
    again = with_row_ids(docs.withColumn("x", F.explode(F.array(F.lit(1), F.lit(2)))), "id")
    assert again.select("id").distinct().count() == 2 * len(ROWS)
