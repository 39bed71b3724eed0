"""A corpus cleaned and mixed for training, as stages of the training-data operators.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next one's documents.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import bpe, exact_dedup, jaccard_join, language, mixing, quality
from rollcall.llm.common import read, with_row_ids, written
from rollcall.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones (operator 7), learned
    from labels outside the held-out fold."""
    network = quality.fit(docs, read(spark, sf_dir, "labels"), ~language.held_out(F.col("doc_id"), 3, 1))
    return quality.score(docs.select(*COLUMNS), network).where("score >= 0.5").select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts (operator 2), decided on row ids: the
    documents themselves are read once more and go on as they are."""
    rows = with_row_ids(docs.select(*COLUMNS), "row")
    gone = exact_dedup.exact_dedup(rows, [F.col("row")]).where("not kept").select("row")
    return rows.join(written(gone, "copies"), "row", "left_anti").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of the n-gram Jaccard join (operator 6): that
    with the smallest doc_id, null ids last, and of these the first.  Rows have
    ids of their own for this, as they may share a doc_id or have none."""
    docs = with_row_ids(docs.select(*COLUMNS), "row")
    near = written(jaccard_join.jaccard_components(docs, id_column="row").select("row", "component_id")
                   .join(docs.select("row", "doc_id"), "row"), "near-rows")
    place = F.struct(F.col("doc_id").isNull().alias("nulls"), "doc_id", "row")
    first = (near.groupBy("component_id").agg(F.min(place)["row"].alias("first"), F.count("*").alias("k"))
             .where("k > 1").select("component_id", "first"))
    gone = near.join(first, "component_id").where("row != first").select("row")
    return docs.join(written(gone, "near-copies"), "row", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (operator 3)."""
    return mixing.repeated(mixing.mix(docs.select(*COLUMNS)), COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text of the mix (operator 5)."""
    return bpe.round_trip_digests(docs, tokenizer_path())


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("tokens", tokenize),
]

#: The quality model and the tokenizer can't be expressed in SQL; tests/llm
#: holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
