"""Exact dedup by progressive refinement, with DataFrame functions only.

Texts are equal when identical after lower-casing A-Z.  Rows are told apart by
length, then by a hash of a prefix, and only rows that still share both get a
hash of their full content.  Lower-casing A-Z keeps the byte length, so the
first two steps touch little text.

Texts are never dealt.  Which rows still need their full hash is looked up in a
table of at most ``FILTER_BUCKETS`` buckets of (length, prefix hash); a row that
meets one by chance is hashed in vain and told apart by its hash.

Each step counts its keys with partial aggregation and keeps the keys that
occur twice or more, so a text copied into a third of all rows is one counted
key; joins with the key tables leave skew to AQE, and no step holds a group.

Edge cases: null texts count as empty; the largest doc_id stays, null ids
come last; among rows that share text and id one row stays; an empty table
gives an empty result; columns of the input with the names of the result give
way to it, and the operator's own work columns start with ``_dedup_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written

PREFIX = 128
#: buckets of the filter over suspected lengths and prefixes; its table is bounded by this
FILTER_BUCKETS = 1 << 20
RESULT = ("keep_id", "group_size", "kept")


def normalised(text: Column) -> Column:
    """The text that equality is about."""
    return ascii_lower(F.coalesce(text, F.lit("")))


def _raw(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def exact_dedup(docs: DataFrame, kept_columns: list[Column] | None = None, id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """``kept_columns`` (default: all) of every row, then ``keep_id``,
    ``group_size`` and ``kept``."""
    text, doc = F.col(text_column), F.col(id_column)
    length = F.octet_length(_raw(text)).alias("_dedup_length")
    prefix = F.xxhash64(ascii_lower(F.substring(_raw(text), 1, PREFIX))).alias("_dedup_prefix")

    own_key = F.xxhash64("_dedup_length", "_dedup_prefix")
    bucket = F.pmod(own_key, F.lit(FILTER_BUCKETS)).cast("int").alias("_dedup_bucket")
    keys = docs.select(length, prefix).groupBy("_dedup_length", "_dedup_prefix").agg(F.count("*").alias("n"))
    several = (docs.select(length).groupBy("_dedup_length").agg(F.count("*").alias("n")).where("n > 1").select("_dedup_length"))
    suspects = keys.where("n > 1").join(several, "_dedup_length", "left_semi").select(bucket).distinct()
    # at most FILTER_BUCKETS rows of four bytes
    suspects = F.broadcast(written(suspects, "exact-suspects").withColumn("_dedup_suspect", F.lit(True)))

    columns = [F.col(c) for c in docs.columns if c not in RESULT] if kept_columns is None else kept_columns
    own = docs.select(*columns).columns
    wide = docs.select(*columns, doc.alias("_dedup_id"), text.alias("_dedup_text"), length, prefix)
    rows = written(
        wide.select("*", bucket).join(suspects, "_dedup_bucket", "left")
        .select(*own, "_dedup_id", F.when(F.col("_dedup_suspect"), F.sha2(normalised(F.col("_dedup_text")), 256)).alias("_dedup_hash"),
                F.monotonically_increasing_id().alias("_dedup_row")), "exact-dedup")

    # null ids sort before all others in max(); of one id the first row written stays
    best = F.max(F.struct("_dedup_id", (-F.col("_dedup_row")).alias("_dedup_row")))
    groups = (rows.where(F.col("_dedup_hash").isNotNull()).groupBy("_dedup_hash")
              .agg(best.alias("_dedup_best"), F.count("*").alias("_dedup_n")).where("_dedup_n > 1"))
    # rows told apart earlier have no hash and take no part in the join
    hashed = rows.where(F.col("_dedup_hash").isNotNull()).join(groups, "_dedup_hash", "left")
    alone = rows.where(F.col("_dedup_hash").isNull()).select(
        *own, F.col("_dedup_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    grouped = F.col("_dedup_n").isNotNull()
    return hashed.select(
        *own,
        F.when(grouped, F.col("_dedup_best._dedup_id")).otherwise(F.col("_dedup_id")).alias("keep_id"),
        F.coalesce("_dedup_n", F.lit(1)).cast("long").alias("group_size"),
        F.when(grouped, F.col("_dedup_best._dedup_row") == -F.col("_dedup_row")).otherwise(F.lit(True)).alias("kept")).unionByName(alone)
