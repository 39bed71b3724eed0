"""Mixing sources to target weights by hash-threshold histograms, with
DataFrame functions only.

Each source has a target number of words.  All its documents are taken
``floor(target / size)`` times; the rest of the budget goes to the documents
with the smallest hashes, once each.  The hash is read as levels of
``LEVEL_BITS`` bits: words are summed by source and bucket of the first level,
running sums show in which bucket the budget runs out, and only that bucket is
refined by the next level, until one row is left, which is taken if that comes
nearer to the target.  Taking is then a comparison of a row's levels with its
source's thresholds: no document is sorted.

The hash covers doc_id and text, so results don't depend on the layout of the
files.  Rows with one id and text share it; their order among themselves comes
from levels of a hash of the row number, and as they are alike, it only
matters how many of them are taken.

Buckets are counted with partial aggregation and a source has at most
``2 ** LEVEL_BITS`` of them per level, so a source with a third of all rows is
no burden on a task.  Targets take one row per source through one task.

Edge cases: null and empty texts have size 0 and take nothing; null sources
are one source, last in the order; a null doc_id is a value like any other; an
empty table gives an empty result; extra columns are carried as they are, those with
the names of the result give way to it, and the operator's work columns start
with ``_mix_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import with_row_ids, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MOST_COPIES = (3, 1, 2), 1.5, 2
RESULT = ("size", "source_size", "target", "copies", "taken")
LEVEL_BITS, HASH_LEVELS, ROW_LEVELS = 16, 4, 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Orders like the source by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def targets(sizes: DataFrame) -> DataFrame:
    """``_mix_source, source_size`` to ``+ target``: sources share ``SHARE``
    of all words by weight, each at most ``MOST_COPIES`` times its size.  With
    sources in order of cap / weight those that hit their cap come first, so
    one pass of running sums finds the level at which the rest share."""
    everything = Window.partitionBy(F.lit(0))
    by_source = Window.orderBy("_mix_source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                          ((F.row_number().over(by_source) - 1) % len(WEIGHTS) + 1).cast("int"))
    cap = F.lit(float(MOST_COPIES)) * F.col("source_size")
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "_mix_source").rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.lit(SHARE) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(filling), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0.0))))
    capped = F.col("cap") / F.col("weight") <= F.col("level")
    return (sizes.withColumn("weight", weight).withColumn("cap", cap).withColumn("level", level)
            .withColumn("level", F.max(F.when(~capped, F.col("level"))).over(everything))
            # of those not capped the first has the highest level, which is the one that holds
            .withColumn("target", F.when(F.col("level").isNull(), F.col("cap"))
                        .otherwise(F.least("cap", F.col("weight") * F.col("level"))))
            .select("_mix_source", "source_size", "target"))


def _levels() -> list[Column]:
    """The levels of a row: its whole hash, then 48 bits of the hash of its number."""
    def parts(h: Column, n: int) -> list[Column]:
        return [F.shiftrightunsigned(h, 64 - LEVEL_BITS * (i + 1)).bitwiseAND((1 << LEVEL_BITS) - 1).cast("int")
                for i in range(n)]
    both = parts(F.col("_mix_hash"), HASH_LEVELS) + parts(F.xxhash64("_mix_row"), ROW_LEVELS)
    return [c.alias(f"_mix_{i}") for i, c in enumerate(both)]


def mix(docs: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """The carried columns (default: all) of every row, then ``size,
    source_size, target, copies, taken``."""
    carried = [c for c in (docs.columns if carried is None else carried) if c not in RESULT]
    rows = with_row_ids(docs, "_mix_row").select(
        *carried, n_words(F.col("text")).alias("size"), source_key(F.col("source")).alias("_mix_source"),
        F.xxhash64("doc_id", "text").alias("_mix_hash"), "_mix_row")
    # read again by every level; texts are not copied for it, their words counted once more at the end instead
    if "text" in carried:
        narrow = written(rows.select("_mix_source", "size", *_levels()), "mix-levels")
    else:
        rows = written(rows, "mix-rows")
        narrow = rows.select("_mix_source", "size", *_levels())
    names = [f"_mix_{i}" for i in range(HASH_LEVELS + ROW_LEVELS)]

    sizes = rows.groupBy("_mix_source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = written(targets(sizes).withColumn("_mix_all", whole)
                   .withColumn("_mix_left", F.col("target") - F.col("_mix_all") * F.col("source_size")), "mix-targets")

    at = plan.select("_mix_source", "_mix_left")
    running = Window.partitionBy("_mix_source")
    for i, name in enumerate(names):
        fixed = ["_mix_source", *names[:i]]
        inside = narrow.join(at, fixed) if i else narrow.join(at, "_mix_source")
        buckets = inside.groupBy(*fixed, "_mix_left", name).agg(F.sum("size").alias("words"))
        before = (F.sum("words").over(running.orderBy(name)) - F.col("words"))
        at = (buckets.withColumn("before", before)
              # the last bucket that begins within the budget, or the first
              .where((F.col("before") < F.col("_mix_left")) | (F.col("before") == 0))
              .groupBy(*fixed).agg(F.max(F.struct(name, "before", "words", "_mix_left")).alias("b"))
              .select(*fixed, f"b.{name}", (F.col("b._mix_left") - F.col("b.before")).alias("_mix_left"),
                      F.col("b.words").alias("_mix_words")))
        at = written(at, f"mix-level-{i}")
        if i + 1 < len(names):
            at = at.drop("_mix_words")

    # one row per source, written so that its size is known where the rows meet it
    borders = written(plan.select("_mix_source", "source_size", "target", "_mix_all").join(
        at.select("_mix_source", F.struct(*names).alias("_mix_border"),
                  # the border row itself, if that comes nearer to the target
                  (F.col("_mix_left") * 2 >= F.col("_mix_words")).alias("_mix_last")), "_mix_source"), "mix-borders")
    place = F.struct(*_levels())
    once_more = (place < F.col("_mix_border")) | ((place == F.col("_mix_border")) & F.col("_mix_last"))
    copies = F.least(F.col("_mix_all") + F.when(once_more, 1).otherwise(0), F.lit(MOST_COPIES)).cast("long")
    return (rows.join(borders, "_mix_source").withColumn("copies", copies)
            .select(*carried, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix as a corpus: each row as often as it is taken."""
    return (mixed.withColumn("_mix_copy", F.explode(F.expr("array_repeat(1, cast(copies as int))")))
            .select(*columns))
