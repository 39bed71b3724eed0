"""Training-data operators against brute force, round trips and held-out accuracy."""

import hashlib
import random
import zlib
from itertools import pairwise

import pytest
from pyspark.sql import functions as F

from rollcall.llm import (bpe, exact_dedup, fingerprints, jaccard_join, language, licenses, line_dedup, mixing, quality,
                          suffix_dedup)
from rollcall.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, size string, node string"


def words(seed, n):
    r = random.Random(seed)
    return [f"w{r.randrange(400)}" for _ in range(n)]


def corpus():
    base = words(1, 120)
    near = [*base[:60], "changed", *base[61:]]
    texts = [" ".join(base), " ".join(base), " ".join(base).upper(), " ".join(near), None, "", "   ", "one two", "one two",
             "Ünder ÉTÉ", "ünder été", "\n".join(" ".join(words(9, 8)) for _ in range(3)) + "\n" + " ".join(words(3, 30)),
             " ".join(words(5, 60) + base[20:80] + words(6, 30)), " ".join(words(7, 4000)), "a" * 5000,
             "text under the MIT license. Apache License, Version 2! cc-by-nc",
             "SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH x) AND ISC", "x <|endoftext|> y 日本 \u0085\t 's"]
    rows = [(i, t, "en", ["a", None, "b"][i % 3], None, "k", "s", "n") for i, t in enumerate(texts)]
    return [*rows, rows[0], (None, "null id", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r.doc_id: r for r in df.collect() if r.doc_id is not None}


def lower(t):
    return (t or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))


def unique(spark, docs):
    return docs.where("doc_id is not null").dropDuplicates(["doc_id"])


def test_licenses(docs):
    got = by_id(licenses.scan_licenses(docs))
    assert (got[15].n_base, got[15].first_word, got[15].last_word) == (3, 1, 9)
    assert got[15].base_labels == "apache-2,cc-by-nc,mit"
    assert got[16].labels == "gpl-2.0-only,isc,mit" and got[16].accepted and got[16].n_base == 0
    assert (got[4].n_words, got[4].labels, got[4].score, got[4].first_word) == (0, "", 0.0, None)
    assert got[9].n_words == 2


@pytest.mark.parametrize("text,value", [("MIT", True), ("GPL", False), ("MIT or GPL and GPL", True), ("(MIT or GPL) and GPL", False),
                                        ("MIT with x", True), ("MIT or", False), ("(MIT", False), ("MIT ISC", False)])
def test_expressions(text, value):
    assert licenses.accepted(licenses.postfix(text)) is value


def test_exact_dedup(docs, empty):
    rows = exact_dedup.exact_dedup(docs).collect()
    assert len(rows) == len(corpus())
    groups = {}
    for r in rows:
        groups.setdefault(lower(r[1]), []).append(r)
    for g in groups.values():
        best = max((r[0] for r in g if r[0] is not None), default=None)
        assert {r[-3] for r in g} == {best} and {r.group_size for r in g} == {len(g)}
        assert [r[0] for r in g if r.kept] == [best]
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_mixing(spark, docs, empty):
    many = spark.createDataFrame([(i, "w " * (i % 7), "x", f"s{i % 4}" if i % 5 else None, 1, "", "", "") for i in range(3000)]
                                 + [(1, "t t t", "x", "s1", 1, "", "", "")] * 900, SCHEMA)
    for table in (many, docs):
        rows = mixing.mix(table.select("doc_id", "text", "source"), ["doc_id", "source"]).collect()
        assert all(r.taken <= 2 * r["size"] for r in rows)
        sources = sorted({r.source for r in rows}, key=lambda s: (s is None, s or ""))
        size = {s: sum(r["size"] for r in rows if r.source == s) for s in sources}
        weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
        target, free, left = {}, set(sources), 1.5 * sum(size.values())
        while True:
            share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
            over = {s for s in free if share[s] > 2 * size[s]}
            if not over:
                target |= share
                break
            target |= {s: 2.0 * size[s] for s in over}
            left -= sum(target[s] for s in over)
            free -= over
            if not free:
                break
        for s in sources:
            mine = [r for r in rows if r.source == s]
            assert {r.source_size for r in mine} == {size[s]}
            assert all(abs(r.target - target[s]) < 1e-6 for r in mine)
            assert abs(sum(r.taken for r in mine) - target[s]) <= max(r["size"] for r in mine)
    assert mixing.mix(empty).count() == 0
    again = mixing.mix(many.repartition(7), ["doc_id", "text"]).groupBy("doc_id").agg(F.sum("taken").alias("n"))
    first = mixing.mix(many, ["doc_id", "text"]).groupBy("doc_id").agg(F.sum("taken").alias("n"))
    assert first.where("doc_id != 1").exceptAll(again).count() == 0


def test_suffix_dedup(spark, docs, empty):
    table = unique(spark, docs)
    got = {(r.doc_id, r.first_word, r.end_word) for r in suffix_dedup.repeated_passages(table).collect()}
    texts = {r.doc_id: lower(r.text).split() for r in table.collect()}
    seen = {}
    for d, w in texts.items():
        for i in range(len(w) - 49):
            seen.setdefault(tuple(w[i:i + 50]), set()).add(d)
    want = set()
    for d, w in texts.items():
        starts = [i for i in range(len(w) - 49) if len(seen[tuple(w[i:i + 50])]) > 1]
        spans = []
        for i in starts:
            if spans and i <= spans[-1][1]:
                spans[-1][1] = i + 50
            else:
                spans.append([i, i + 50])
        want |= {(d, *s) for s in spans}
    assert got == want and {d for d, *_ in got} >= {0, 1, 2, 3, 12}
    assert suffix_dedup.repeated_passages(empty).count() == 0


def test_bpe_matches_the_library(docs):
    tokenizers = pytest.importorskip("tokenizers")
    ref = tokenizers.Tokenizer.from_file(tokenizer_path())
    for r, (_, t, *_) in zip(bpe.round_trip_digests(docs.coalesce(1), tokenizer_path()).collect(), corpus(), strict=True):
        ids = ref.encode(t or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(ref.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = bpe.decode(bpe.encode(docs, tokenizer_path()), tokenizer_path())
    assert sorted(r.text for r in back.collect()) == sorted(t or "" for _, t, *_ in corpus())


def test_jaccard_components(spark, docs, empty):
    table = unique(spark, docs).unionByName(spark.createDataFrame(
        [(100 + i, " ".join([*words(50, 90)[:i], f"edit{i}", *words(50, 90)[i:]]), *[None] * 6) for i in range(40)], SCHEMA))
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(table).collect()}
    sets = {}
    for r in table.collect():
        w = lower(r.text).split()
        sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    label = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a, x in sets.items():
            for b, y in sets.items():
                if x and y and 100 * len(x & y) >= 80 * len(x | y) and label[b] < label[a]:
                    label[a], changed = label[b], True
    assert got == {(d, len(s), label[d]) for d, s in sets.items()}
    assert jaccard_join.jaccard_components(empty).count() == 0
    assert jaccard_join.jaccard_components(docs).count() == len(corpus())


def test_quality(spark, sf_dir, empty):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held = language.held_out(F.col("doc_id"), 3, 1)
    net = quality.fit(docs, labels, ~held)
    rows = quality.score(docs, net, ["doc_id"]).join(labels, "doc_id").where(held).collect()
    assert sum((r.score >= 0.5) == bool(r.quality) for r in rows) >= 0.9 * len(rows)
    assert quality.score(empty, net).count() == 0
    assert {r.score for r in quality.score(docs, None).select("score").collect()} == {0.5}


def test_language(spark, sf_dir, docs, empty):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    net = language.fit(table, ~language.held_out(F.col("doc_id"), 4, 2))
    rows = [r for r in language.predict(table, net, F.col("lang")).collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.9 * len(rows)
    own = by_id(language.predict(docs, net))
    assert own[4].lang_pred == own[5].lang_pred == own[6].lang_pred == "und" and 0 <= own[13].score <= 1
    assert language.fit(empty, F.lit(True)) is None
    assert {r.lang_pred for r in language.predict(docs, None).collect()} == {"und"}


def test_line_dedup(spark, docs, empty):
    table = unique(spark, docs).unionByName(spark.createDataFrame(
        [(200 + i, "\n".join([" ".join([*words(70, 20)[:i], f"e{i}", *words(70, 20)[i + 1:]]), "", "short line", " ".join(words(80, 9))]),
          *[None] * 6) for i in range(12)], SCHEMA))
    got = {r.doc_id: (r.n_lines, r.removed_lines) for r in line_dedup.removed_lines(table).collect()}
    earlier, want = [], {}
    for r in sorted(table.collect(), key=lambda r: r.doc_id):
        lines, gone = lower(r.text).split(b"\n"), []
        for i, line in enumerate(lines):
            x = set(line.split())
            if len(x) >= 5:
                if any(100 * len(x & y) >= 80 * len(x | y) for y in earlier):
                    gone.append(i)
                earlier.append(x)
        want[r.doc_id] = (len(lines), gone)
    assert got == want
    assert line_dedup.removed_lines(empty).count() == 0
    assert line_dedup.removed_lines(docs).count() == len(corpus())


def test_fingerprints(spark, docs, empty):
    table = unique(spark, docs)
    got = by_id(fingerprints.with_edited(table.repartition(5)))
    order = sorted(table.collect(), key=lambda r: -r.doc_id)
    for r, after in pairwise([*order, order[0]]):
        t, nxt = r.text or "", after.text or ""
        half = len(t) // 2
        changed = t[:len(t) - half] + nxt[:half]
        mine = got[r.doc_id]
        assert mine.n_chars == len(t) and mine.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        f, g, h = (fingerprints.fingerprint(x) for x in (t, changed, nxt))
        assert (mine.fingerprint, mine.edited_fingerprint) == (fingerprints.as_text(f), fingerprints.as_text(g))
        assert (mine.near_edited, mine.near_next) == (fingerprints.likeness(f, g), fingerprints.likeness(f, h))
    assert got[0].fingerprint == got[1].fingerprint and got[4].fingerprint == got[5].fingerprint
    assert fingerprints.with_edited(empty).count() == 0
    assert fingerprints.with_edited(docs).count() == len(corpus())


def test_pipeline(spark, sf_dir):
    import corpus_pipeline
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns, name
        ids, left = {r.doc_id for r in docs.select("doc_id").collect()}, [r.doc_id for r in after.select("doc_id").collect()]
        assert left and set(left) <= ids and (name == "mix" or len(left) == len(set(left)))
        if name == "exact_dedup":
            texts = [lower(r.text) for r in after.collect()]
            assert len(texts) == len(set(texts))
        if name == "near_dedup":
            comps = jaccard_join.jaccard_components(after)
            assert comps.where("component_id != doc_id").count() == 0
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
