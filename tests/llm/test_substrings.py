"""Repeated windows against a count of all windows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np

from rollcall.llm import substrings
from rollcall.llm.queries import op12_substring_dedup

SCHEMA = "doc_id long, text string, rid string, at string, spans string, n_words string"


def expected(texts):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in texts]
    count = Counter(tuple(w[i:i + 35]) for w in split for i in range(len(w) - 34))
    out = []
    for (doc, _), w in zip(texts, split, strict=True):
        gone = set()
        for i in range(len(w) - 34):
            if count[tuple(w[i:i + 35])] > 1:
                gone.update(range(i, i + 35))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, texts):
    docs = spark.createDataFrame([(d, t, "x", "y", "z", "u") for d, t in texts], SCHEMA).repartition(3)
    rows = substrings.without_repeats(substrings.repeated_spans(docs)).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in rows), key=str)


def check(spark, texts):
    assert found(spark, texts) == expected(texts)


def test_quotes_near_copies_and_boundaries(spark):
    r = random.Random(12)
    source = [f"s{i}" for i in range(300)]
    texts = []
    for d in range(150):
        n = r.randrange(33, 60)
        lo = r.randrange(len(source) - n)
        texts.append((d, " ".join([f"a{d}x{i}" for i in range(r.randrange(30))] + source[lo:lo + n] + [f"b{d}x{i}" for i in range(9)])))
    base = [f"n{i}" for i in range(150)]
    texts += [(200 + d, " \n".join(f"{w}e{r.randrange(3)}" if r.random() < 1 / 18 else w for w in base)) for d in range(250)]
    check(spark, texts)


def test_few_words(spark):
    """Texts of two or three words, where anchors and windows are alike everywhere."""
    r = random.Random(3)
    texts = [(d, " ".join(r.choice("ab" if d % 2 else "aaab") for _ in range(r.randrange(30, 140)))) for d in range(60)]
    texts += [(100, "a " * 35), (101, "c " * 36), (102, "x y " * 200)]
    check(spark, texts)


def test_edges(spark):
    p = [f"p{i}" for i in range(60)]
    whole, upper = " ".join(p), " ".join(p).upper()
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, whole), (5, whole), (None, whole + " tail"), (None, None), (None, upper),
             (6, " ".join(p[:34])), (7, "q " + " ".join(p[:35]) + " r"), (8, "\u0085   日本 " + " ".join(p[20:58]) + "\x0b\x0cé"),
             (9, " ".join([f"z{i}" for i in range(40)] * 2)), (10, " ".join(f"u{i}" for i in range(35))), (11, "w" * 200_000),
             (12, " ".join(f"l{i % 5000}" for i in range(60_000)))]
    check(spark, texts)
    check(spark, texts[:4])
    assert found(spark, []) == []


def test_equal_rows_without_ids(spark):
    text = " ".join(f"w{i}" for i in range(100))
    check(spark, [(None, text)] * 300 + [(None, None)] * 300 + [(None, text + " more")])


def test_documents(spark):
    texts = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in op12_substring_dedup(spark, "/root/testdata/sf0.01").collect()), key=str)
    assert got == expected(texts)


def test_copies_share_anchors():
    r = np.random.default_rng(5)
    p = r.integers(0, 2**63, 35).astype(np.uint64)
    for _ in range(50):
        sides = [r.integers(0, 2**63, n).astype(np.uint64) for n in r.integers(0, 90, 4)]
        a, b = (substrings.anchors(np.concatenate((x, p, y))) for x, y in (sides[:2], sides[2:]))
        first, second = ({(q - len(s), k) for q, k in zip(x[0].tolist(), x[1].tolist(), strict=True)} for s, x in ((sides[0], a), (sides[2], b)))
        assert any(0 <= q <= 27 for q, _ in first & second)
