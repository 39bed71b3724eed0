"""The models against a forward pass of their own, and their samples."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import language, quality


def test_a_rare_language_is_learned(spark):
    common = [(i, "the of and in that it was for on with as by " * 8 + str(i), "en") for i in range(3000)]
    rare = [(100_000 + i, "der die und nicht über größe für straße wäre mögen " * 8 + str(i), "de") for i in range(12)]
    docs = spark.createDataFrame(common + rare, "doc_id long, text string, lang string").repartition(4)
    network = language.fit(docs, F.lit(True), max_documents=400)
    assert sorted(network.languages) == ["de", "en"]
    tried = spark.createDataFrame([(1, "nicht über die größe der straße " * 9), (2, "that was for it and with the " * 9)], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in language.predict(tried, network).collect()} == {1: "de", 2: "en"}


def test_training_rows_don_t_depend_on_the_layout(spark):
    rows = [(i % 50, f"text {i} " * 40) for i in range(400)]  # ids repeat, more rows than are taken
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    nets = [quality.fit(d, labels, F.lit(True), max_documents=40) for d in (docs.repartition(3), docs.repartition(7, "text"))]
    tried = [r.text.encode() for r in docs.limit(20).collect()]
    assert np.array_equal(nets[0].scores(tried), nets[1].scores(tried))


def test_attention_scores_by_hand(spark):
    """Gated attention written out for one text at a time, without its code."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = quality.fit(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), F.lit(True), max_documents=60)
    texts = [(r.text or "").encode() for r in docs.orderBy("doc_id").limit(25).collect()]
    p = net.p
    for text, got in zip(texts, net.scores(texts), strict=True):
        x = (quality.passages(text) - net.shift) / net.scale
        h = [[math.tanh(sum(a * w for a, w in zip(row, column, strict=True)) + b) for column, b in zip(p["W"].T, p["b"], strict=True)] for row in x]
        attention = []
        for one in h:
            t = [math.tanh(sum(a * w for a, w in zip(one, column, strict=True))) for column in p["V"].T]
            g = [1 / (1 + math.exp(-sum(a * w for a, w in zip(one, column, strict=True)))) for column in p["U"].T]
            attention.append(sum(a * b * w for a, b, w in zip(t, g, np.ravel(p["w"]), strict=True)))
        e = [math.exp(a - max(attention)) for a in attention]
        z = [sum(w * one[k] for w, one in zip(e, h, strict=True)) / sum(e) for k in range(len(h[0]))]
        want = 1 / (1 + math.exp(-(sum(a * w for a, w in zip(z, np.ravel(p["c"]), strict=True)) + float(p["c0"]))))
        assert got == pytest.approx(want, abs=2e-4)
