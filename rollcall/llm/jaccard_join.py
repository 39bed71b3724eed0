"""N-gram Jaccard join: a blocked sparse product of the document by n-gram
incidence matrix with itself.

Columns of the matrix are distinct word n-grams, as 64-bit hashes.  The product
is cut down by bounds before overlaps are counted:

* rows with the same set are one row (a class);
* columns are put in one order for all documents, rare ones first.  Rarity is
  the total of the column's bucket among ``BUCKETS`` totals over all
  documents; any common order gives the same result, this one keeps very
  common n-grams out of the blocks below;
* with sets of size n, two documents can only reach the similarity if they
  meet among their first ``n - ceil(t n) + 1`` columns, so only these are
  multiplied, one block per column;
* a row leaves a block in which no other row's size is near enough to its own.
  For each block one 64-bit mask holds the size bands met, so this needs no
  pairs; a pair that can be similar stays in all the blocks it shares;
* within a block a pair is dropped if its sizes, or the columns that either
  has left from the meeting point on, cannot reach the overlap needed (a
  similar pair passes in the block of the first column it shares);
* a pair is also dropped if the number of columns its prefixes share, with all
  that may follow, cannot reach the overlap.

Overlaps of the remaining pairs are counted over the whole sets.

All pairs of a block would be too many where thousands of documents are near
copies.  The aim is the components, so a block first links each member only
with ``LEADERS`` members chosen by hash; then pairs are formed only between
members whose components still differ.  No link between components is lost.

Edge cases: null and empty texts have an empty set and stand alone; texts with
fewer than n words are one n-gram; equal sets are one component whatever their
number; rows may share a doc_id or have a null one (a component of nulls only
has a null id); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER_BYTES, arrow_rows, text_bytes, written
from .graph import components

WORDS, PERCENT, LEADERS = 5, 80, 2
BUCKET_BITS = 19
BUCKETS = 1 << BUCKET_BITS
#: size bands for each factor of e; bands are counted modulo the 64 bits of a mask
BANDS = 6
#: bits of the filter that tells which texts may have to be read again
FILTER_BITS = 1 << 20
_LOW = np.uint64((1 << (64 - BUCKET_BITS)) - 1)
_SHIFT = np.uint64(64 - BUCKET_BITS)
_SEEDS = np.random.default_rng(6).integers(1, 2**63, size=64, dtype=np.uint64) | np.uint64(1)


def shingles(text: bytes, size: int = WORDS) -> np.ndarray:
    """Distinct word n-grams of a text (UTF-8) as sorted 64-bit hashes; words
    are runs of bytes other than ASCII white space."""
    words = text.translate(LOWER_BYTES).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(size, len(words))
    n = len(words) - k + 1
    g = h[:n] * _SEEDS[0]
    for i in range(1, k):
        g += h[i:i + n] * _SEEDS[i]
    # sets of texts with fewer words must differ from those of longer ones
    g ^= np.uint64(k)
    g ^= g >> np.uint64(32)
    g *= np.uint64(0xD6E8FEB86659FD93)
    g ^= g >> np.uint64(29)
    g.sort()
    return g[np.concatenate(([True], g[1:] != g[:-1]))]


def bucket_totals(docs: DataFrame, text_column: str, size: int) -> np.ndarray:
    """How many documents' columns fall into each bucket: ``BUCKETS`` numbers
    whatever the size of the corpus."""
    def count(batches):
        total = np.zeros(BUCKETS, dtype=np.int64)
        for b in batches:
            for t in text_bytes(b, text_column):
                np.add.at(total, (shingles(t, size) >> _SHIFT).astype(np.int64), 1)
        full = np.flatnonzero(total)
        yield {"bucket": full.astype(np.int32), "n": total[full]}

    rows = arrow_rows(docs.select(text_column), "bucket int, n bigint", count).groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, dtype=np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def ordered(g: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The same columns renamed (one to one) so that rare ones come first, sorted."""
    keys = (rank[(g >> _SHIFT).astype(np.int64)] << _SHIFT) | (g & _LOW)
    keys.sort()
    return keys


def _list_array(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _needed(a: Column, b: Column, percent: int) -> Column:
    """The overlap o reaches the similarity iff o * (100 + percent) >= this."""
    return F.lit(percent) * (a + b)


def _bits(name: str, value: Column, by: Column) -> Column:
    return F.call_function(name, value, by)


def _band(n: Column) -> Column:
    """The bit of a size's band."""
    return _bits("shiftleft", F.lit(1).cast("long"), F.pmod(F.floor(F.log(n) * BANDS).cast("int"), F.lit(64)))


def _near_bands(n: Column, percent: int) -> Column:
    """Bits of all bands whose sizes can reach the similarity with a set of n."""
    reach, slack = math.log(100 / percent) * BANDS, 1e-6
    if 2 * reach + 2 > 62:
        return F.lit(-1).cast("long")
    low = F.floor(F.log(n) * BANDS - reach - slack).cast("int")
    width = F.floor(F.log(n) * BANDS + reach + slack).cast("int") - low + 1
    run = _bits("shiftleft", F.lit(1).cast("long"), width) - 1
    turn = F.pmod(low, F.lit(64))  # a shift by 64 is none, so no turn leaves the run as it is
    return _bits("shiftleft", run, turn).bitwiseOR(_bits("shiftrightunsigned", run, 64 - turn))


def _crowded(n: Column, percent: int) -> Column:
    """Has the block (its ``k`` members, the ``bands`` met and the ``odd``
    ones, met an odd number of times) a second member near size n?  May say
    yes where there is none, never the reverse."""
    own, twice = _band(n), F.col("bands").bitwiseAND(F.bitwise_not("odd"))
    others = F.col("bands").bitwiseAND(_near_bands(n, percent)).bitwiseAND(F.bitwise_not(own))
    # members not explained by one for each band and one more for each even one: some band has three
    many = F.col("k") > F.bit_count("bands") + F.bit_count(twice)
    return (others != 0) | (twice.bitwiseAND(own) != 0) | many


def _id_bucket(c: Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)).cast("int")


def jaccard_components(docs: DataFrame, size: int = WORDS, percent: int = PERCENT, id_column: str = "doc_id",
                       text_column: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id)``, one row per document."""
    kind = docs.schema[id_column].dataType.simpleString()
    src = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    totals = bucket_totals(src, "text", size)
    rank = np.empty(BUCKETS, dtype=np.uint64)
    rank[np.argsort(totals, kind="stable")] = np.arange(BUCKETS, dtype=np.uint64)

    def prefixes(batches):
        at = TaskContext.get().partitionId() << 33
        for b in batches:
            sets = [ordered(shingles(t, size), rank) for t in text_bytes(b)]
            yield {"doc_id": b.column(0), "row": np.arange(at, at + len(sets)),
                   "n": [len(s) for s in sets], "sig": [xxhash.xxh3_128_digest(s) for s in sets],
                   "prefix": _list_array([s[:len(s) + (-percent * len(s) // 100) + 1] if len(s) else s for s in sets])}
            at += len(sets)

    rows = written(arrow_rows(src, f"doc_id {kind}, row bigint, n bigint, sig binary, prefix array<bigint>", prefixes), "sets")
    turned = F.element_at("prefix", -1).bitwiseXOR(F.lit(-1 << 63))
    classes = written(rows.where("n > 0").groupBy("sig").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("low"), F.min_by("doc_id", "row").alias("of"), F.min("n").alias("n"),
        F.min_by("prefix", "row").alias("prefix"))
        .withColumn("tip", F.struct(turned.alias("end"), F.size("prefix").alias("p"))), "classes")

    # dealt by column once: the same exchange serves the aggregate and the join
    posts = (classes.select("node", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "col"))
             .select("col", "node", "n", "pos").repartition("col"))
    met = posts.groupBy("col").agg(F.count("*").alias("k"), F.bit_or(_band(F.col("n"))).alias("bands"),
                                   F.bit_xor(_band(F.col("n"))).alias("odd")).where("k > 1")
    blocks = written(posts.join(met, "col").where(_crowded(F.col("n"), percent)).select("col", "node", "n", "pos"), "blocks")

    def whole(wanted_buckets):
        def run(batches):
            for b in batches:
                b = b.filter(pa.array(wanted_buckets[b.column("bucket").to_numpy()]))
                sets = [ordered(shingles(t, size), rank) for t in text_bytes(b)]
                yield {"sig": [xxhash.xxh3_128_digest(s) for s in sets], "cols": _list_array(sets)}
        return run

    # (columns are ordered as unsigned numbers, so tip.end has its sign bit turned)
    def promising(pairs: DataFrame) -> DataFrame:
        """Pairs that can reach the overlap by the columns their prefixes share.
        The prefix that ends first in the common order has no columns left that
        the rest of the other could hold, so all its matches are counted."""
        common = (pairs.join(blocks.select(F.col("node").alias("a"), "col"), "a")
                  .join(blocks.select(F.col("node").alias("b"), "col"), ["b", "col"]).groupBy("a", "b").agg(F.count("*").alias("common")))
        one, two = (classes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("tip.end").alias(f"e{x}"),
                                   F.col("tip.p").alias(f"p{x}")) for x in "ab")
        rest = F.when(F.col("ea") <= F.col("eb"), F.col("na") - F.col("pa")).otherwise(F.col("nb") - F.col("pb"))
        return (common.join(one, "a").join(two, "b")
                .where((F.col("common") + rest) * (100 + percent) >= _needed(F.col("na"), F.col("nb"), percent)).select("a", "b"))

    def sets_of(pairs: DataFrame) -> DataFrame:
        """Whole sets of the classes in the pairs, read again from their texts.
        A filter of ``FILTER_BITS`` bits over the ids keeps most other texts
        out; the join by the set's digest is the exact check."""
        wanted = written(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(classes, "node")
                         .select("node", "sig", "of"), "wanted")
        buckets = np.zeros(FILTER_BITS, dtype=bool)
        buckets[wanted.select(_id_bucket(F.col("of")).alias("bucket")).distinct().toArrow().column("bucket").to_numpy()] = True
        again = src.select("text", _id_bucket(F.col("doc_id")).alias("bucket"))
        return written(arrow_rows(again, "sig binary, cols array<bigint>", whole(buckets)).join(wanted, "sig")
                       .select("node", "cols").dropDuplicates(["node"]), "columns")

    def reachable(pairs: DataFrame) -> DataFrame:
        """Pairs of a block (a, na, pa, b, nb, pb) that the bounds leave."""
        n_a, n_b, p_a, p_b = (F.col(c) for c in ("na", "nb", "pa", "pb"))
        most = F.least(n_a - p_a, n_b - p_b)  # where a pair first meets, this is all it can still share
        return (pairs.where((F.lit(100) * F.least(n_a, n_b) >= F.lit(percent) * F.greatest(n_a, n_b))
                            & (most * (100 + percent) >= _needed(n_a, n_b, percent)))
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def linked(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b) those whose whole sets overlap enough."""
        sets = sets_of(pairs)
        left, right = sets.select(F.col("node").alias("a"), F.col("cols").alias("x")), \
            sets.select(F.col("node").alias("b"), F.col("cols").alias("y"))
        overlap = F.size(F.array_intersect("x", "y"))
        return (pairs.join(left, "a").join(right, "b")
                .where(overlap * (100 + percent) >= _needed(F.size("x"), F.size("y"), percent)).select("a", "b"))

    # members that meet the block early have few rare columns of their own, so
    # they are the most central of near copies: half of the leaders are such
    leaders = blocks.groupBy("col").agg(F.array_distinct(F.array(*[
        F.min_by(F.struct("node", "n", "pos"), F.struct(*([F.col("pos")] if i % 2 else []), F.xxhash64("node", F.lit(i))))
        for i in range(LEADERS)])).alias("heads"))
    stars = (blocks.join(leaders, "col").select("node", "n", "pos", F.explode("heads").alias("head"))
             .select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"),
                     F.col("head.node").alias("b"), F.col("head.n").alias("nb"), F.col("head.pos").alias("pb"))
             .where("a != b"))
    tried = written(promising(written(reachable(stars), "star-pairs")), "star-candidates")
    links = written(linked(tried), "star-links")
    part = components(links)

    # blocks whose members are not all in one component yet; of these, pairs across components not tried yet
    own = written(blocks.join(part, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "open-blocks")
    open_cols = own.groupBy("col").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("col")
    own = own.join(open_cols, "col", "left_semi")
    one = own.select("col", F.col("node").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("comp").alias("ca"))
    two = own.select("col", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("comp").alias("cb"))
    rest = reachable(one.join(two, "col").where("a > b and ca != cb")).join(tried, ["a", "b"], "left_anti")
    more = linked(written(promising(written(rest, "cross-pairs")), "cross-candidates"))
    final = components(links.unionByName(more))

    labels = classes.select("sig", "node", "low").join(final, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    lows = labels.groupBy("comp").agg(F.min("low").alias("component_id"))
    named = labels.join(lows, "comp").select("sig", "component_id")
    alone = rows.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return (rows.where("n > 0").join(named, "sig").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
            .unionByName(alone).withColumnRenamed("doc_id", id_column))
