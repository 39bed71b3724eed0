"""Licence scans against places found word by word, and the forms that tags take."""

import re

import pytest

from rollcall.llm import licenses
from rollcall.llm.queries import op1_license_scan

BASE = {("under", "the", "mit", "license"): "mit", ("apache", "license", "version", "2"): "apache-2", ("cc", "by", "nc"): "cc-by-nc"}


def base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    at = [(i, label) for phrase, label in BASE.items() for i in range(len(words)) if tuple(words[i:i + len(phrase)]) == phrase]
    places = [i for i, _ in at]
    return (len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at})))


def test_base_columns_of_all_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    rows = op1_license_scan(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(texts) and any(r.n_base for r in rows)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


@pytest.mark.parametrize("text", ["", "a", "cc by nc by nc cc by nc", "under the MIT license under the mit license", "Cc-By-Nc9 cc by nc",
                                  "apache license version 2 0 apache license, Version 2", "é cc\x00by~nc İ", "cc by nc" * 20000])
def test_base_columns_of_odd_texts(text):
    found = licenses.scan(text.encode())
    assert tuple(found[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == base(text)


@pytest.mark.parametrize("line,labels,expressions", [
    ("SPDX-License-Identifier: MIT and see COPYING", "mit", 1),
    ("SPDX-License-Identifier: MIT or later", "mit", 1),
    ("SPDX-License-Identifier: MIT AND LicenseRef-Own-1", "licenseref-own-1,mit", 1),
    ("SPDX-License-Identifier: GPL-3.0-or-later OR (Apache-2.0 AND BSL-1.0)", "apache-2.0,bsl-1.0,gpl-3.0-or-later", 1),
    ("License: MIT", "mit", 1), ("Licence: Apache-2.0 or MIT", "apache-2.0,mit", 1), ("# license = \"ISC\"", "isc", 1),
    ("{\"license\": \"BSD-3-Clause\", \"x\": 1}", "bsd-3-clause", 1), (" * @license GPL-2.0+", "gpl-2.0+", 1),
    ("License: see the file COPYING", "", 0), ("the license: it is long", "", 0), ("license MIT", "", 0), ("License:", "", 0),
    ("under the GNU General Public License, version 2", "gpl,gpl-2", 0), ("GNU Lesser General Public License v2.1", "lgpl,lgpl-2.1", 0),
])
def test_tags_and_versions(line, labels, expressions):
    found = licenses.scan(f"before\n{line}\nafter".encode())
    assert (found["labels"], found["expressions"]) == (labels, expressions)


def test_empty(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string, labels string")).collect() == []
