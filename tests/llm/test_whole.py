"""Places where the training-data operators once did less than the whole job."""

import random

import pytest

from rollcall.llm import fingerprints, licenses, line_dedup, suffix_dedup


def test_short_lines_repeat(spark):
    texts = ["home\nhome about\n\nthe text by itself ends", "a a a a a\nHOME\nabout home\n \nthe text by itself ends here", "日本語文\nx y z",
             "日本語文\nx y z w\nx  z\ty\nx y", "a\nread more now please"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.removed_lines for r in line_dedup.removed_lines(docs, min_words=1).collect()}
    earlier, want = [], {}
    for i, t in enumerate(texts):
        want[i] = []
        for n, line in enumerate(t.lower().split("\n")):
            x = set(line.split())
            if x and any(100 * len(x & y) >= 80 * len(x | y) for y in earlier):
                want[i].append(n)
            earlier += [x] if x else []
    assert got == want == {0: [], 1: [1, 2, 4], 2: [], 3: [0, 2], 4: [0]}


def test_op9_takes_lines_of_one_word(spark, tmp_path):
    from rollcall.llm.queries import op9_line_dedup
    spark.createDataFrame([(0, "menu\nx"), (1, "y\nmenu")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.removed_lines for r in op9_line_dedup(spark, str(tmp_path)).collect()} == {0: "", 1: "1"}


def test_edited_texts_score_above_the_next(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = fingerprints.with_edited(docs).where("n_chars > 200").select("near_edited", "near_next").collect()
    no_higher = sum(r.near_edited <= r.near_next for r in rows) / len(rows)
    assert len(rows) > 900 and no_higher <= 0.002
    assert all(r.near_edited > 0 for r in rows)


@pytest.mark.parametrize("line,labels,accepted", [
    ("<!-- SPDX-License-Identifier: MIT -->", "mit", True),
    ("<!-- SPDX-License-Identifier: MIT-->", "mit", True),
    ("// SPDX-License-Identifier: MIT Copyright 2020 X", "mit", True),
    ("SPDX-License-Identifier: Apache-2.0. See LICENSE", "apache-2.0", True),
    ("SPDX-License-Identifier: Apache-2.0. And see LICENSE", "apache-2.0", True),
    ("/* SPDX-License-Identifier: (MIT OR GPL-2.0+) AND ISC */", "gpl-2.0+,isc,mit", True),
    ("SPDX-License-Identifier: GPL-2.0-only WITH x (see COPYING)", "gpl-2.0-only", False),
    ("SPDX-License-Identifier: MIT AND GPL-3.0-only - all files", "gpl-3.0-only,mit", False),
    ("SPDX-License-Identifier: MIT) (c) X", "mit", True),
    ("SPDX-License-Identifier: MIT OR --", "mit", True),
])
def test_tags_within_a_line(line, labels, accepted):
    found = licenses.scan(f"first\n{line}\nlast".encode())
    assert (found["labels"], found["expressions"], found["accepted"]) == (labels, 1, accepted)
    assert found["base_labels"] == "" and found["n_base"] == 0 and found["score"] == 0.5


@pytest.mark.parametrize("line", ["SPDX-License-Identifier:", "SPDX-License-Identifier: -->", "SPDX-License-Identifier: (MIT OR ISC",
                                  "SPDX-License-Identifier: OR MIT", "SPDX-License-Identifier: ()"])
def test_tags_without_an_expression(line):
    found = licenses.scan(line.encode())
    assert (found["labels"], found["expressions"], found["accepted"]) == ("", 0, None)


def passages(texts):
    """Spans of the words that stand in a window of 50 words which another text has too."""
    seen = {}
    for d, w in enumerate(texts):
        for i in range(len(w) - 49):
            seen.setdefault(tuple(w[i:i + 50]), set()).add(d)
    spans = set()
    for d, w in enumerate(texts):
        own = []
        for i in range(len(w) - 49):
            if len(seen[tuple(w[i:i + 50])]) > 1:
                if own and i <= own[-1][1]:
                    own[-1][1] = i + 50
                else:
                    own.append([i, i + 50])
        spans |= {(d, *s) for s in own}
    return spans


def found_passages(spark, texts):
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(texts)], "doc_id long, text string")
    return {(r.doc_id, r.first_word, r.end_word) for r in suffix_dedup.repeated_passages(docs).collect()}


def test_many_quotes_and_near_copies(spark):
    r = random.Random(11)
    source = [f"s{i}" for i in range(300)]
    texts = []
    for d in range(200):
        n = r.randrange(50, 56)
        lo = r.randrange(len(source) - n)
        texts.append([f"a{d}x{i}" for i in range(20)] + source[lo:lo + n] + [f"b{d}x{i}" for i in range(20)])
    base = [f"n{i}" for i in range(150)]
    for _ in range(300):
        texts.append([f"{w}e{r.randrange(3)}" if r.random() < 1 / 15 else w for w in base])
    assert found_passages(spark, texts) == passages(texts)


def test_text_that_repeats_itself_over_many_partitions(spark):
    passage = [f"p{i}" for i in range(60)]
    texts = [[f"a{i}" for i in range(30)] + passage * 400, [f"b{i}" for i in range(30)] + passage * 3 + [f"c{i}" for i in range(30)]]
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for both in (texts, texts[::-1]):
            assert found_passages(spark, both) == passages(both)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_near_dedup_decides_by_row(spark):
    import corpus_pipeline

    def text(name, change=None):
        return " ".join("changed" if i == change else f"{name}{i}" for i in range(100))

    rows = [(None, text("a")), (None, text("a", 3)), (4, text("a", 50)),  # one stays, with an id
            (7, text("b")), (9, text("b", 5)), (9, text("c")), (9, text("c", 2)),  # 9 has two other texts
            (None, text("d")), (None, text("d", 7)), (None, ""), (None, None), (1, text("e"))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.drop_near_copies(spark, docs.coalesce(1), "").collect()
    assert docs.columns == list(left[0].asDict())
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted(
        [rows[2], rows[3], rows[5], rows[7], (None, ""), (None, None), rows[11]], key=str)


def test_one_copy_of_every_passage_stays(spark):
    def some(name, n=60):
        return [f"{name}{i}" for i in range(n)]

    p, q, z = some("p"), some("q"), some("z", 90)
    texts = {2: some("a", 9) + p, 5: some("b", 9) + p + q + some("c", 9), 9: some("d", 9) + q, 1: z[:60] + some("e", 9),
             3: some("f", 9) + z, 4: z[30:] + some("g", 9), 8: q + p + z, 7: p}
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in texts.items()], "doc_id long, text string")
    found = suffix_dedup.repeated_passages(docs)
    assert {r.doc_id: r.match_doc_id for r in found.where("doc_id in (5, 9)").collect()} == {5: 2, 9: 5}
    left = {r.doc_id: (r.text or "").split() for r in suffix_dedup.without_passages(docs, found).collect()}
    assert left[5] == some("b", 9) + q + some("c", 9) and left[9] == some("d", 9) and left[7] == [] and left[2] == texts[2]
    # every window of 50 words is still in the smallest document that has it
    windows = {d: {tuple(w[i:i + 50]) for i in range(len(w) - 49)} for d, w in texts.items()}
    for d, mine in windows.items():
        for w in mine:
            first = min(x for x in windows if w in windows[x])
            if any(w in windows[x] for x in windows if x != first):
                t = left[first]
                assert any(tuple(t[i:i + 50]) == w for i in range(len(t) - 49)), (d, w[0])
