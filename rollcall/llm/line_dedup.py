"""Line dedup by an exact set-similarity join, with DataFrame functions only.

A line is the set of its distinct words (A-Z lower-cased).  It goes if an
earlier line of the corpus, by doc_id and line number, reaches ``PERCENT``
Jaccard similarity.  Lines of fewer than ``min_words`` distinct words are left
out; ``op9`` sets it to 1, so every line that isn't blank takes part.

* Words are put in one order for all lines, rare ones first.  Rarity is the
  total of the word's hash bucket over all lines; any common order gives the
  same result, and the table of ``BUCKETS`` ranks is of fixed size.
* Lines with the same set are one class; its earliest line counts.  Sets so
  small that one word more or less ends the similarity (1 to 3 words) can only
  equal each other, so their classes meet no others.
* Prefix filter: similar lines meet among their first ``n - ceil(t n) + 1``
  words, so only these are joined.  Positional filter: where two lines first
  meet, the words either has left must still reach the overlap, and so must
  the words that their prefixes share with all that may follow.  Length
  filter: so must the lengths.  Parity filter: each of 64 bits in which the
  parities of two lines differ takes a word that only one of them has, so
  where too many differ the pair is dropped as it meets.  From ``LONG`` words
  on there are 128 bits.
Lines that repeat as they are, however often, are one class and meet no one;
blocks are joined with both sides dealt by the word, so a common word's block
can be split.  Words are compared by 63-bit hashes.

Edge cases: null and empty texts have one empty line; blank lines stay; equal
doc_ids are ordered by the row's number, null ids come last; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written

PERCENT, MIN_WORDS = 80, 5
BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
RANKS = 1 << 10
LONG = 64
#: white space within a line, besides the blank
OTHER_SPACE = "\t\x0b\f\r"


def text_lines(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep`` and, for each line of ``text``, its number ``line`` and
    words ``t``, lower-cased with blanks for other white space.  A line is
    lower-cased by itself, as most have ASCII only."""
    text = F.coalesce("text", F.lit(""))
    blanks = F.when(text.rlike(r"[\x09\x0B-\x0D]"), F.translate(text, OTHER_SPACE, " " * len(OTHER_SPACE))).otherwise(text)
    return (docs.select(*keep, blanks.alias("text")).select(*keep, F.posexplode(F.split("text", "\n")).alias("line", "t"))
            .withColumn("t", ascii_lower(F.col("t"))))


def rarity_ranks(docs: DataFrame) -> Column:
    """Rank (up to ``RANKS``) of each bucket by the words in it over all texts:
    ``BUCKETS`` small numbers at any size, passed on as a constant."""
    bucket = F.shiftrightunsigned(F.xxhash64("w"), 64 - BUCKET_BITS).cast("int").alias("bucket")
    totals = (text_lines(docs).select(F.explode(F.split("t", " ")).alias("w")).where("w != ''")
              .groupBy(bucket).agg(F.count("*").alias("n")).toArrow())
    found = dict(zip(totals.column("bucket").to_pylist(), totals.column("n").to_pylist(), strict=True))
    ranks = [0] * BUCKETS
    for place, b in enumerate(sorted(range(BUCKETS), key=lambda b: (found.get(b, 0), b))):
        ranks[b] = place * RANKS // BUCKETS
    return F.split(F.lit(",".join(map(str, ranks))), ",").cast("array<int>")


def ordered_words(line: Column, ranks: Column) -> Column:
    """Distinct words of a line as sorted numbers, rare words first: the rank
    of the word's bucket above the lower bits of its hash."""
    rank_bits = RANKS.bit_length() - 1
    low = (1 << (63 - rank_bits)) - 1

    def number(h: Column) -> Column:
        rank = F.element_at(ranks, F.shiftrightunsigned(h, 64 - BUCKET_BITS).cast("int") + 1).cast("long")
        return F.shiftleft(rank, 63 - rank_bits).bitwiseOR(h.bitwiseAND(F.lit(low)))

    hashes = F.array_distinct(F.transform(F.array_remove(F.split(line, " "), ""), lambda w: F.xxhash64(w)))
    return F.sort_array(F.transform(hashes, number))


def _parities(words: Column) -> Column:
    """64 bits: is the number of words that fall on each of them odd?"""
    def turn(bits: Column, w: Column) -> Column:
        return bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), w.bitwiseAND(F.lit(63)).cast("int")))

    return F.aggregate(words, F.lit(0).cast("long"), turn)


def _half(words: Column) -> Column:
    """The same of about half of the words, for long lines, in which 64 bits
    say too little: it and its difference from the whole make 128."""
    return F.when(F.size(words) >= LONG, _parities(F.filter(words, lambda w: w.bitwiseAND(F.lit(64)) != 0))).otherwise(0)


def _signature(words: Column) -> Column:
    return F.struct(F.xxhash64(words).alias("s1"), _parities(words).alias("bits"), _half(words).alias("half"), F.size(words).alias("n"))


def removed_lines(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_removed, removed_lines``
    (numbers of the lines that go, from 0)."""
    src = docs.select("doc_id", "text")
    ranks = rarity_ranks(src)
    prefix = F.slice("words", 1, (F.size("words") - F.ceil(F.size("words") * percent / 100) + 1).cast("int"))
    lines = written(
        text_lines(src.withColumn("row", F.monotonically_increasing_id()), "doc_id", "row")
        .select("doc_id", "row", "line", ordered_words(F.col("t"), ranks).alias("words"))
        .select("doc_id", "row", "line", F.when(F.size("words") >= min_words, _signature(F.col("words"))).alias("sig"),
                F.when(F.size("words") >= min_words, prefix).alias("prefix")), "lines")
    # earlier lines have smaller places; null ids last
    place = F.struct(F.col("doc_id").isNull().alias("nulls"), "doc_id", "row", "line")
    classes = written(lines.where("sig is not null").groupBy("sig")
                      .agg(F.min(place).alias("first"), F.count("*").alias("k"), F.min_by("prefix", place).alias("prefix"))
                      .withColumn("c", F.monotonically_increasing_id()), "line-classes")
    info = classes.select("c", "sig", "first", F.element_at("prefix", -1).alias("end"), F.size("prefix").alias("p"))
    # one word more is the least that another set can differ by
    posts = classes.where(F.col("sig.n") * 100 >= (F.col("sig.n") + 1) * percent).select("c", F.col("sig.n").alias("n"), F.col("sig.bits").alias("bits"), F.col("sig.half").alias("half"),
                           F.posexplode("prefix").alias("pos", "col"))

    def possible(met: DataFrame) -> DataFrame:
        """Pairs (later a, earlier b) that the filters leave.  ``met``: one row
        for each word of both prefixes that two classes share."""
        whole, half = (F.col(f"{x}_a").bitwiseXOR(F.col(f"{x}_b")) for x in ("bits", "half"))
        differ = (F.when(F.least("na", "nb") >= LONG, F.bit_count(whole.bitwiseXOR(half)) + F.bit_count(half))
                  .otherwise(F.bit_count(whole)))
        # what two lines can share up to a word that both have, and from it on
        most = F.least("pa", "pb") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
        pairs = (met.where((F.col("a") > F.col("b")) & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
                           & (differ * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))
                           & (most * (100 + percent) >= (F.col("na") + F.col("nb")) * percent))
                 .groupBy("a", "b").agg(F.count("*").alias("common"), F.min("na").alias("na"), F.min("nb").alias("nb"),
                                        F.min("pa").alias("pa"), F.min("pb").alias("pb"))
                 .where(F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) * (100 + percent) >= (F.col("na") + F.col("nb")) * percent))
        one, two = (info.select(F.col("c").alias(x), F.col("first").alias(f"f{x}"), F.col("end").alias(f"e{x}"),
                                F.col("p").alias(f"l{x}")) for x in "ab")
        # the prefix that ends first has no words left that the other's rest could hold
        rest = F.when(F.col("ea") <= F.col("eb"), F.col("na") - F.col("la")).otherwise(F.col("nb") - F.col("lb"))
        kept = (pairs.join(one, "a").join(two, "b")
                .where((F.col("common") + rest) * (100 + percent) >= (F.col("na") + F.col("nb")) * percent))
        later = F.col("fa") > F.col("fb")
        return kept.select(F.when(later, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(later, F.col("b")).otherwise(F.col("a")).alias("b"))

    one = posts.select("col", F.col("c").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("bits").alias("bits_a"),
                       F.col("half").alias("half_a"))
    two = posts.select("col", F.col("c").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("bits").alias("bits_b"),
                       F.col("half").alias("half_b"))

    def sets_of(pairs: DataFrame) -> DataFrame:
        """Words of the classes in the pairs, read again from their first lines."""
        wanted = (pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct().join(info, "c")
                  .select("c", "sig", F.col("first.doc_id").alias("id"), F.col("first.line").alias("line")))
        found = written(text_lines(src, "doc_id").alias("l")
                        .join(wanted.alias("w"), F.col("l.doc_id").eqNullSafe(F.col("w.id")) & (F.col("l.line") == F.col("w.line")))
                        .select("c", "sig", ordered_words(F.col("t"), ranks).alias("words")), "line-words")
        # rows may share a doc_id, so a line found by it must be the right one
        return found.where(_signature(F.col("words")) == F.col("sig")).select("c", "words").dropDuplicates(["c"])

    def matched(pairs: DataFrame) -> DataFrame:
        """Classes ``a`` whose words overlap enough with those of an earlier ``b``."""
        sets = sets_of(pairs)
        x, y = sets.select(F.col("c").alias("a"), F.col("words").alias("x")), sets.select(F.col("c").alias("b"), F.col("words").alias("y"))
        overlap = F.size(F.array_intersect("x", "y"))
        return (pairs.join(x, "a").join(y, "b").where(overlap * (100 + percent) >= (F.size("x") + F.size("y")) * percent)
                .select("a").distinct())

    gone = matched(written(possible(one.join(two, "col")), "line-pairs")).select(F.col("a").alias("c"), F.lit(True).alias("gone"))

    # a line goes if its class has an earlier match or it isn't the first of its class
    repeats = classes.join(gone, "c", "left").where("gone or k > 1").select("sig", "gone", "first")
    out = (lines.join(repeats, "sig", "left")
           .withColumn("goes", F.coalesce("gone", F.lit(False)) | F.coalesce(~place.eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))))
    return (out.groupBy("doc_id", "row").agg(F.count("*").alias("n_lines"), F.count_if("goes").alias("n_removed"),
                                             F.sort_array(F.collect_list(F.when(F.col("goes"), F.col("line")))).alias("removed_lines"))
            .drop("row"))


def without_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """The documents with their removed lines taken out; ids must be unique."""
    keep = F.array_join(F.transform(F.filter(
        F.transform(F.split("text", "\n"), lambda t, i: F.struct(t.alias("t"), i.alias("i"))),
        lambda x: ~F.array_contains(F.coalesce("removed_lines", F.array().cast("array<int>")), x["i"])), lambda x: x["t"]), "\n")
    return (docs.join(removed.where("n_removed > 0").select("doc_id", "removed_lines"), "doc_id", "left")
            .withColumn("text", keep).select(*docs.columns))
