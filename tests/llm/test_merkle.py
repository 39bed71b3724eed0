"""The Merkle manifest against a plain tree of lists."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rollcall.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, path string, grp string, node string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return h(*(field(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def tree(nodes):
    """Root, and for each node the siblings before and after on every level."""
    paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, joined = [], []
        for i in range(0, len(nodes), 8):
            run = nodes[i:i + 8]
            for j, own in enumerate(members[i:i + 8]):
                for m in own:
                    paths[m].append(("".join(run[:j]), "".join(run[j + 1:])))
            above.append(h(*run))
            joined.append([m for own in members[i:i + 8] for m in own])
        nodes, members = above, joined
    return nodes[0], paths


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    ordered = {n: sorted(groups[n], key=lambda x: x[:3]) for n in names}
    below = {n: tree([x[2] for x in ordered[n]]) for n in names}
    root, above = tree([below[n][0] for n in names])
    out = []
    for n, top in zip(names, above, strict=True):
        subroot, paths = below[n]
        for (_, _, node, r), path in zip(ordered[n], paths, strict=True):
            path = path + top
            now = node
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = r["text"] and r["text"].encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).decode()
                now = leaf(r, text)
            for a, b in path:
                now = h(a, now, b)
            out.append((r["doc_id"], node, subroot, root, h(*(x for p in path for x in p)), now, now == root))
    return sorted(out, key=str)


def found(docs):
    return sorted((tuple(r) for r in merkle.verified(docs).collect()), key=str)


def some(sizes):
    rows, at = [], 0
    for lang, n in sizes.items():
        for i in range(n):
            rows.append({"doc_id": at, "text": [f"Text {i} ÄB", None, "", "lower"][i % 4], "lang": lang,
                         "source": [None, "s", "ü"][i % 3], "n_chars": [None, i][i % 2]})
            at += 7
    return rows


def frame(spark, rows):
    return spark.createDataFrame([{**r, "leaf": "x", "path": "y", "grp": "z", "node": "w"} for r in rows], SCHEMA)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, None: 9}, {"en": 200, "zz": 64, "ä": 65, None: 1, "": 7},
                                   {f"l{i}": 1 + i % 3 for i in range(70)}], ids=str)
def test_tree(spark, sizes):
    rows = some(sizes)
    assert found(frame(spark, rows).repartition(5)) == expected(rows)


def test_repeated_rows_null_ids_and_long_texts(spark):
    rows = some({"en": 20})
    rows += rows[:9] + [{**r, "doc_id": None} for r in rows[:10]] + [{**rows[3], "text": "Aé" * 200_000}] + [{**rows[5], "doc_id": 21}] * 3
    got = found(frame(spark, rows))
    assert got == expected(rows)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_empty(spark):
    assert found(frame(spark, [])) == []


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(docs) == expected([r.asDict() for r in docs.collect()])


def test_proofs_lead_to_the_root(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = merkle.manifest(docs).select("leaf", "root", "tampered", merkle.folded(F.col("leaf"), F.col("path")).alias("again")).collect()
    assert len(rows) == docs.count() and all(r.again == r.root and r.tampered is None for r in rows)
