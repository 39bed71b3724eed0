"""Repeated passages across documents by their windows at shared minimisers.

Every position of a text starts a window of ``MIN_WORDS`` words; a repeat is a
run of windows that some other row has too.  Which windows can be shared is
found from few positions first: the positions of the smallest word k-mer hash
in each run of ``WINDOW`` k-mers.  Two copies of a passage select the same
positions in it, whatever stands around them.

1. Each selected suffix is keyed by its first ``KEY`` words; keys that one row
   alone has are gone.
2. The first ``WINDOW`` k-mers of a window select one position in it, with
   ``KEY`` words of the window to the right, so a window that two rows share
   has a key that is left.  The windows whose key is left are hashed, and those
   that follow each other at one position are one run.
3. Where all runs of a key are equal, all their windows are repeats.  The runs
   of other keys are taken apart: windows with equal key and hash are one group,
   and one with two rows is a repeat in each of them.  Keys and groups are held
   as their smallest and largest row and doc_id (partial aggregates, so a
   passage that a third of all documents share is spread over many tasks); no
   neighbours are chosen and none are left out.
4. Windows that touch are joined, so longer passages come out whole.

Words are runs of bytes other than ASCII white space, A-Z lower-cased; windows
are compared by 128-bit hashes (of the key and of the whole).

Edge cases: null, empty and short texts have no repeats; repeats within one
row don't count; equal rows repeat each other; rows may share a doc_id or have
a null one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_BYTES, arrow_rows, text_bytes, written

MIN_WORDS, K = 50, 5
WINDOW = MIN_WORDS // 2
KEY = MIN_WORDS - WINDOW + 1
_SEEDS = np.random.default_rng(4).integers(1, 2**63, size=64, dtype=np.uint64) | np.uint64(1)


def word_hashes(text: bytes) -> np.ndarray:
    words = text.translate(LOWER_BYTES).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def minimisers(h: np.ndarray) -> np.ndarray:
    """For each run of ``WINDOW`` k-mers the position of the smallest one."""
    if len(h) < MIN_WORDS:
        return np.zeros(0, np.int64)
    n = len(h) - K + 1
    g = h[:n] * _SEEDS[0]
    for i in range(1, K):
        g += h[i:i + n] * _SEEDS[i]
    g = _mixed(g)
    return sliding_window_view(g, WINDOW).argmin(axis=1) + np.arange(n - WINDOW + 1)


def selected(h: np.ndarray) -> np.ndarray:
    """Positions of the minimisers that have ``KEY`` words from there on."""
    at = np.unique(minimisers(h))
    return at[at + KEY <= len(h)]


def keys(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the ``KEY`` words from each position."""
    return _mixed((h[at[:, None] + np.arange(KEY)] * _SEEDS[K:K + KEY]).sum(axis=1, dtype=np.uint64)).view(np.int64)


def windows(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows of ``MIN_WORDS`` words whose minimiser is one of
    ``at``, their minimisers and a hash of each."""
    low = minimisers(h)[:max(0, len(h) - MIN_WORDS + 1)]
    start = np.flatnonzero(np.isin(low, at))
    if not len(start):
        return start, start, start.astype(np.uint64)
    # sums over the first and the last words of a window, which meet or overlap in its middle
    size, seeds = MIN_WORDS - WINDOW, _SEEDS[K + KEY:]
    n = len(h) - size + 1
    part = h[:n] * seeds[0]
    for i in range(1, size):
        part += h[i:i + n] * seeds[i]
    u, v = part[start], _mixed(part[start + WINDOW])
    return start, low[start], _mixed(_mixed(u * seeds[size]) + v * seeds[size + 1])


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per repeated passage: ``doc_id, row, first_word, end_word,
    n_words, match_doc_id`` (the smallest document that shares part of it; where
    that is the document itself, another one) and ``pieces``: the runs of its
    windows (``first_word, end_word``, which may overlap) whose smallest document,
    itself included, is ``first_doc_id``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    src = docs.select("doc_id", "text")

    def sample(batches):
        row = TaskContext.get().partitionId() << 33
        for b in batches:
            ids, rows, pos, key = [], [], [], []
            for doc, t in zip(b.column(0).to_pylist(), text_bytes(b), strict=True):
                h = word_hashes(t)
                at = selected(h)
                ids += [doc] * len(at)
                rows.append(np.full(len(at), row))
                pos.append(at)
                key.append(keys(h, at))
                row += 1
            yield {"doc_id": ids, "row": np.concatenate(rows), "pos": np.concatenate(pos).astype(np.int32), "key": np.concatenate(key)} \
                if rows else {"doc_id": [], "row": [], "pos": [], "key": []}

    suffixes = written(arrow_rows(src, f"doc_id {kind}, row bigint, pos int, key bigint", sample), "suffixes")
    again = suffixes.groupBy("key").agg(F.min("row").alias("lo"), F.max("row").alias("hi")).where("lo < hi").select("key")
    # one row per document, positions in it
    places = (suffixes.join(again, "key", "left_semi").groupBy(F.col("doc_id").alias("id"), "row")
              .agg(F.sort_array(F.collect_list(F.struct("pos", "key"))).alias("at")))

    def hashed(batches):
        for b in batches:
            of, starts, sizes, names, hashes = [], [], [], [], []
            for i, (at, t) in enumerate(zip(b.column("at").to_pylist(), text_bytes(b), strict=True)):
                h = word_hashes(t)
                at = [x for x in at if x["pos"] + KEY <= len(h)]
                pos, key = (np.array([x[n] for x in at], dtype=np.int64) for n in ("pos", "key"))
                # rows may share a doc_id; only the text that was sampled has these keys there
                if len(pos):
                    same = keys(h, pos) == key
                    pos, key = pos[same], key[same]
                start, low, found = windows(h, pos)
                # windows of one minimiser follow each other
                new = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1]))) if len(low) else start
                of.append(np.full(len(new), i))
                starts.append(start[new])
                sizes.append(np.diff(np.append(new, len(low))))
                names.append(key[np.searchsorted(pos, low[new])] if len(new) else key[:0])
                hashes.append(found.view(np.int64))
            if of:
                of, sizes = pa.array(np.concatenate(of)), np.concatenate(sizes)
                ends = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
                yield {"doc_id": b.column("doc_id").take(of), "row": b.column("row").take(of),
                       "start": pa.array(np.concatenate(starts).astype(np.int32)), "n": pa.array(sizes.astype(np.int32)),
                       "key": pa.array(np.concatenate(names)), "h": pa.ListArray.from_arrays(ends, pa.array(np.concatenate(hashes)))}

    joined = src.join(places, src["doc_id"].eqNullSafe(places["id"])).drop("id")
    runs = written(arrow_rows(joined, f"doc_id {kind}, row bigint, start int, n int, key bigint, h array<bigint>", hashed)
                   .withColumn("whole", F.xxhash64("h")), "window-runs")
    held = [F.min("row").alias("lo"), F.max("row").alias("hi"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")]
    by_key = written(runs.groupBy("key").agg(*held, (F.min("whole") != F.max("whole")).alias("differ")).where("lo < hi")
                     .select("key", "first", "last", "differ"), "window-keys")
    other = F.when(F.col("doc_id") == F.col("first"), F.col("last")).otherwise(F.col("first")).alias("other")
    parts = ["doc_id", "row", "start", "n", "first", other]
    equal = (runs.select("doc_id", "row", "start", "n", "key").join(by_key.where("not differ"), "key")
             .select(*parts))
    single = written(runs.join(by_key.where("differ").select("key"), "key", "left_semi")
                     .select("doc_id", "row", "key", "start", F.posexplode("h").alias("i", "w"))
                     .select("doc_id", "row", (F.col("start") + F.col("i")).alias("start"), "key", "w"), "windows")
    shared = single.groupBy("key", "w").agg(*held).where("lo < hi").select("key", "w", "first", "last")
    some = single.join(shared, ["key", "w"]).withColumn("n", F.lit(1)).select(*parts)
    by_doc = (equal.unionByName(some).groupBy("doc_id", "row")
              .agg(F.sort_array(F.collect_list(F.struct("start", "n", "first", "other"))).alias("at")))

    def join_up(batches):
        for b in batches:
            out: dict[str, list] = {n: [] for n in ("doc_id", "row", "first_word", "end_word", "n_words", "match_doc_id", "pieces")}
            for doc, row, at in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                merged: list[list] = []
                for x in at:
                    lo, hi, match = x["start"], x["start"] + x["n"] - 1 + MIN_WORDS, x["other"]
                    if merged and lo <= merged[-1][1]:
                        last = merged[-1]
                        last[1] = max(last[1], hi)
                        if match is not None and (last[2] is None or match < last[2]):
                            last[2] = match
                        piece = last[3][-1]
                        if x["first"] == piece["first_doc_id"] and lo <= piece["end_word"] - MIN_WORDS + 1:
                            piece["end_word"] = max(piece["end_word"], hi)
                            continue
                    else:
                        merged.append([lo, hi, match, []])
                    merged[-1][3].append({"first_word": lo, "end_word": hi, "first_doc_id": x["first"]})
                for lo, hi, match, pieces in merged:
                    for n, v in zip(out, (doc, row, lo, hi, hi - lo, match, pieces), strict=True):
                        out[n].append(v)
            yield out

    return arrow_rows(by_doc, f"doc_id {kind}, row bigint, first_word int, end_word int, n_words int, match_doc_id {kind}, "
                      f"pieces array<struct<first_word:int,end_word:int,first_doc_id:{kind}>>", join_up)


def without_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``doc_id`` and the words of each text outside its repeated passages but
    for the copy in the smallest doc_id; ids must be unique.  Every window of
    ``MIN_WORDS`` words stays whole in the smallest document that has it, so
    words that two passages share go only if neither has its first copy here."""
    later = (passages.select("doc_id", F.explode("pieces").alias("p")).groupBy("doc_id")
             .agg(F.collect_list(F.when(F.col("p.first_doc_id") < F.col("doc_id"), F.col("p"))).alias("spans"),
                  F.collect_list(F.when(F.col("p.first_doc_id") == F.col("doc_id"), F.col("p"))).alias("own"))
             .where(F.size("spans") > 0))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def inside(spans: str, x):
        return F.exists(F.col(spans), lambda s: (x["i"] >= s["first_word"]) & (x["i"] < s["end_word"]))

    kept = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                    lambda x: inside("own", x) | ~inside("spans", x))
    return docs.join(later, "doc_id", "left").select(
        "doc_id", F.when(F.col("spans").isNull(), F.col("text")).otherwise(
            F.array_join(F.transform(kept, lambda x: x["w"]), " ")).alias("text"))
