"""Repeated passages by seed and extend: winnowed anchors, extended both ways.

A window is ``MIN_WORDS`` words of one text; it is a repeat if its words also
start at any other place, in the same text or in another.

1. **Seeds.**  Of the k-mers of ``K`` words in a window the one with the least
   hash is its anchor (winnowing), so two copies of a window have the same
   anchor at the same place in it, and the ``MARGIN`` words to each side of an
   anchor hold all windows that may be repeats because of it.
2. **Classes.**  Places with equal anchor and equal words to both sides are one
   class, counted by partial aggregation; where a class has two places all its
   windows are repeats.  One place of each class stands for it from here on, so
   copies of one passage are never paired with each other.
3. **Extension.**  All classes of an anchor are joined with one of them, the
   head, and the match is extended to the left (l words) and to the right (r).
   Windows inside l + K + r words are repeats, in the class and in the head.
   What else a class may share, it shares with classes that leave the head at
   the same place with the same word: windows that reach further left than l go
   into the group (left, l, next word), the others into (right, r, next word).
   Each window goes one way only and every group has a head of its own, until
   no group with two classes is left.  So a group of n classes makes n pairs a
   round and no link is lost; no partner is chosen, capped or left out.
4. **Maximal repeats.**  Windows that touch or overlap in a text are joined.

A key may hold a third of all places: it is counted before it is dealt, and
joins on it have one row a group on the other side, so skewed ones are split.

Words are runs of bytes other than ASCII white space, unchanged, compared by
64-bit hashes, a class by 128 bits.

Edge cases: null, empty and short texts have no repeats; rows may share an id or
have none, equal rows repeat each other; a text that repeats itself loses all
copies; texts of any length are read whole; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, removed, text_bytes, written

MIN_WORDS, K = 35, 8
MARGIN = MIN_WORDS - K
ALL = (1 << (MARGIN + 1)) - 1
_SEEDS = np.random.default_rng(12).integers(1, 2**63, size=2 * MARGIN + 2 * K + 8, dtype=np.uint64) | np.uint64(1)
_PAD = np.uint64(0x9E3779B97F4A7C15)
_SPANS = "array<struct<first_word:int,end_word:int>>"


def words_of(text: bytes) -> list[bytes]:
    return text.split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _run_hash(h: np.ndarray, at: np.ndarray, size: int, seeds: np.ndarray) -> np.ndarray:
    """Hash of the ``size`` words from each place."""
    total = np.zeros(len(at), dtype=np.uint64)
    for i in range(size):
        total += h[at + i] * seeds[i]
    return _mixed(total)


def _padded(h: np.ndarray) -> np.ndarray:
    edge = np.full(MARGIN, _PAD)
    return np.concatenate((edge, h, edge))


def anchors(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the anchors, their hashes, and hashes of the words around them
    (text ends included)."""
    if len(h) < MIN_WORDS:
        none = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), none, none
    n = len(h) - K + 1
    grams = _run_hash(h, np.arange(n), K, _SEEDS)
    at = np.unique(sliding_window_view(grams, MARGIN + 1).argmin(axis=1) + np.arange(n - MARGIN))
    return at, grams[at], _run_hash(_padded(h), at, 2 * MARGIN + K, _SEEDS[K:])


def _row_hashes() -> dict[str, Column]:
    return {"rid": F.xxhash64("doc_id", "text"), "rid2": F.xxhash64(F.lit("again"), "doc_id", "text")}


def _signed(parts: list[np.ndarray]) -> pa.Array:
    return pa.array(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64))


def _seeds(batches):
    for b in batches:
        of, pos, key, around = [], [], [], []
        for i, t in enumerate(text_bytes(b)):
            at, k, w = anchors(word_hashes(words_of(t)))
            of.append(np.full(len(at), i))
            pos.append(at.astype(np.int32))
            key.append(k)
            around.append(w)
        if of:
            of = pa.array(np.concatenate(of))
            yield {"rid": b.column("rid").take(of), "rid2": b.column("rid2").take(of), "pos": pa.array(np.concatenate(pos)),
                   "key": _signed(key), "around": _signed(around)}


def _contexts(batches):
    """The words around the anchors of the classes wanted of a text."""
    for b in batches:
        wanted = b.column("wanted")
        ends = np.cumsum(np.concatenate(([0], pc.list_value_length(wanted).to_numpy(zero_copy_only=False)))).astype(np.int64)
        flat = wanted.flatten()
        want_key, want_around, want_n = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        out = {n: [] for n in ("key", "around", "n", "nl", "nr", "left", "right")}
        for i, t in enumerate(text_bytes(b)):
            h = word_hashes(words_of(t))
            at, key, around = anchors(h)
            mine = slice(ends[i], ends[i + 1])
            n_of = {(k, w): n for k, w, n in zip(want_key[mine].tolist(), want_around[mine].tolist(), want_n[mine].tolist(), strict=True)}
            padded = _padded(h)
            for p, k, w in zip(at.tolist(), key.view(np.int64).tolist(), around.view(np.int64).tolist(), strict=True):
                n = n_of.pop((k, w), None)
                if n is None:
                    continue
                out["key"].append(k)
                out["around"].append(w)
                out["n"].append(n)
                out["nl"].append(min(p, MARGIN))
                out["nr"].append(min(len(h) - p - K, MARGIN))
                out["left"].append(padded[p:p + MARGIN][::-1].tobytes())
                out["right"].append(padded[p + MARGIN + K:p + 2 * MARGIN + K].tobytes())
        yield out


def _matrix(column: pa.Array) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype=np.uint64).reshape(len(column), MARGIN)


def _matched(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words two rows share from the anchor on."""
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), MARGIN)


def _bits(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return np.where(lo <= hi, (1 << (np.maximum(hi, 0) + 1)) - (1 << np.minimum(lo, MARGIN + 1)), 0)


_STATE = "g bigint, lo int, hi int, key bigint, around bigint, n bigint, nl int, nr int, left binary, right binary, mask int"


def _extend(batches):
    """Extends each class of a group against the head; gives out repeats
    (``mask``: the windows by how many words they start left of the anchor) and
    the groups that the rest goes into."""
    for b in batches:
        if not b.num_rows:
            continue
        num = {c: b.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
               for c in ("g", "lo", "hi", "key", "around", "n", "nl", "nr", "head_around", "head_nl", "head_nr")}
        left, right = _matrix(b.column("left")), _matrix(b.column("right"))
        lo, hi = num["lo"], num["hi"]
        l = np.minimum.reduce([_matched(left, _matrix(b.column("head_left"))), num["nl"], num["head_nl"]])
        r = np.minimum.reduce([_matched(right, _matrix(b.column("head_right"))), num["nr"], num["head_nr"]])
        mask = _bits(np.maximum(lo, MARGIN - r), np.minimum(hi, l))
        hit = np.flatnonzero(mask)
        for of in ("around", "head_around"):
            yield _state(len(hit), key=num["key"][hit], around=num[of][hit], mask=mask[hit])
        turns = ((0, left, l, np.maximum(lo, l + 1), hi), (1, right, r, lo, np.minimum.reduce([hi, MARGIN - r - 1, l])))
        for side, words, met, low, high in turns:
            on = np.flatnonzero(low <= high)
            group = _mixed(num["g"][on].view(np.uint64) * _SEEDS[0] + words[on, met[on]] * _SEEDS[1]
                           + (2 * met[on] + side + 1).astype(np.uint64) * _SEEDS[2]).view(np.int64)
            take = pa.array(on)
            yield _state(len(on), g=group, lo=low[on], hi=high[on], left=b.column("left").take(take), right=b.column("right").take(take),
                         **{c: num[c][on] for c in ("key", "around", "n", "nl", "nr")})


def _state(size: int, **given) -> dict:
    names = [part.split()[0] for part in _STATE.split(", ")]
    return {c: given[c] if isinstance(given.get(c), pa.Array) else pa.array(given[c].astype(np.int64 if c in ("g", "key", "around", "n") else np.int32))
            if c in given else [None] * size for c in names}


def _merged(marks: DataFrame) -> DataFrame:
    return marks.groupBy("key", "around").agg(F.bit_or("mask").alias("mask"))


def _repeats(contexts: DataFrame) -> list[DataFrame]:
    """Tables ``key, around, mask`` of the windows that several classes share;
    ``contexts`` and all other tables of the rounds are removed."""
    found = []
    state = written(contexts.select(
        F.col("key").alias("g"), F.greatest(F.lit(0), MARGIN - F.col("nr")).alias("lo"), F.col("nl").alias("hi"), "*",
        F.lit(None).cast("int").alias("mask")).where("lo <= hi"), "substring-round")
    removed(contexts)
    while True:
        rows = state.where("g is not null").drop("mask")
        groups = written(rows.groupBy("g").agg(F.min("around").alias("around"), F.count("*").alias("k"), F.min("n").alias("least"))
                         .where("k > 1 and least = 1").select("g", "around"), "substring-groups")
        if groups.isEmpty():
            removed(groups, state)
            return found
        heads = written(rows.join(groups, ["g", "around"]).select("g", *(F.col(c).alias(f"head_{c}") for c in (
            "around", "nl", "nr", "left", "right"))), "substring-heads")
        pairs = rows.join(heads, "g").where("around != head_around")
        after = written(arrow_rows(pairs, _STATE, _extend), "substring-round")
        found.append(written(_merged(after.where("mask is not null")), "substring-marks"))
        del rows, pairs
        removed(groups, heads, state)
        state = after


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Every row's ``doc_id, text, n_words, spans``: its maximal repeats
    (``first_word, end_word``, words from 0), null if none."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    src = docs.select("doc_id", "text").withColumns(_row_hashes())
    places = written(arrow_rows(src, "rid bigint, rid2 bigint, pos int, key bigint, around bigint", _seeds), "substring-places")
    classes = written(places.groupBy("key", "around").agg(F.count("*").alias("n"), F.min("rid").alias("rid")), "substring-classes")
    copies = written(classes.where("n > 1").select("key", "around", F.lit(ALL).alias("mask")), "substring-marks")
    # anchors with several classes, one of which has a single place
    open_keys = classes.groupBy("key").agg(F.count("*").alias("k"), F.min("n").alias("least")).where("k > 1 and least = 1").select("key")
    wanted = written(classes.join(open_keys, "key").groupBy("rid")
                     .agg(F.collect_list(F.struct("key", "around", "n")).alias("wanted")), "substring-wanted")
    del open_keys
    removed(classes)
    contexts = written(arrow_rows(src.select("rid", "text").join(wanted, "rid").select("text", "wanted"),
                                  "key bigint, around bigint, n bigint, nl int, nr int, left binary, right binary", _contexts)
                       .dropDuplicates(["key", "around"]), "substring-contexts")
    removed(wanted)
    parts = [copies, *_repeats(contexts)]
    del contexts
    marks = written(_merged(reduce(DataFrame.unionByName, parts)), "substring-marks")
    removed(*parts)
    by_row = (places.join(marks, ["key", "around"]).groupBy(F.col("rid").alias("r"), F.col("rid2").alias("r2"))
              .agg(F.collect_set(F.struct("pos", "mask")).alias("at")))
    joined = src.join(by_row, (F.col("rid") == F.col("r")) & (F.col("rid2") == F.col("r2")), "left").select("doc_id", "text", "at")

    def join_up(batches):
        for b in batches:
            sizes, spans = [], []
            for t, at in zip(text_bytes(b), b.column("at"), strict=True):
                n = len(words_of(t))
                sizes.append(n)
                spans.append(_spans(n, at.values) if at.is_valid else None)
            yield {"doc_id": b.column("doc_id"), "text": b.column("text"), "n_words": sizes, "spans": spans}

    return arrow_rows(joined, f"doc_id {kind}, text string, n_words bigint, spans {_SPANS}", join_up)


def _spans(n: int, at: pa.StructArray) -> list[dict] | None:
    pos, mask = (at.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
    edges = np.zeros(n + 1, np.int64)
    for d in range(MARGIN + 1):
        start = pos[(mask >> d & 1) == 1] - d
        start = start[(start >= 0) & (start + MIN_WORDS <= n)]
        np.add.at(edges, start, 1)
        np.add.at(edges, start + MIN_WORDS, -1)
    inside = np.concatenate(([0], np.cumsum(edges[:n]) > 0, [0])).astype(np.int8)
    turns = np.diff(inside)
    return [{"first_word": a, "end_word": b} for a, b in
            zip(np.flatnonzero(turns == 1).tolist(), np.flatnonzero(turns == -1).tolist(), strict=True)] or None


def without_repeats(spans: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed`` and ``kept``: the words outside all spans
    of ``repeated_spans``, joined by one space."""
    kind = spans.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            total, gone, kept = [], [], []
            for t, own in zip(text_bytes(b), b.column("spans").to_pylist(), strict=True):
                words = words_of(t)
                total.append(len(words))
                for s in reversed(own or []):
                    del words[s["first_word"]:s["end_word"]]
                gone.append(total[-1] - len(words))
                kept.append(b" ".join(words))
            yield {"doc_id": b.column("doc_id"), "n_words": total, "n_removed": gone,
                   "kept": pa.array(kept, type=pa.binary()).cast(pa.string())}

    return arrow_rows(spans, f"doc_id {kind}, n_words bigint, n_removed bigint, kept string", run)
