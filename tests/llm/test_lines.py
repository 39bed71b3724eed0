"""The line join against all pairs of lines."""

import random

import pytest

from rollcall.llm import line_dedup


def expected(rows, percent=80, min_words=1):
    """rows: (doc_id, text) in the order of their numbers."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    earlier, out = [], {}
    for i in order:
        text = (rows[i][1] or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
        out[i] = []
        for n, line in enumerate(text.split(b"\n")):
            x = frozenset(line.split())
            if len(x) >= min_words and x:
                if any(100 * len(x & y) >= percent * len(x | y) for y in earlier):
                    out[i].append(n)
                earlier.append(x)
    return sorted((repr(rows[i][0]), (rows[i][1] or "").count("\n") + 1, len(g), tuple(g)) for i, g in out.items())


def found(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, n_lines string, n long").coalesce(1)
    got = line_dedup.removed_lines(docs, **{"min_words": 1, **options}).collect()
    return sorted((repr(r.doc_id), r.n_lines, r.n_removed, tuple(r.removed_lines)) for r in got)


def random_rows(seed, n, words=60):
    r = random.Random(seed)
    lines = []
    for _ in range(n * 3):
        if lines and r.random() < 0.6:
            x = list(r.choice(lines))
            for _ in range(r.randrange(3)):
                if r.random() < 0.5 and len(x) > 1:
                    x.pop(r.randrange(len(x)))
                else:
                    x.insert(r.randrange(len(x) + 1), f"W{r.randrange(words)}")
            lines.append(x)
        else:
            lines.append([f"w{r.randrange(words)}" for _ in range(r.choice([1, 2, 3, 4, 5, 6, 9, 14, 30]))])
    seps = [" ", "  ", "\t", " \x0b", "\r "]
    text = [r.choice(seps).join(x) for x in lines]
    return [(r.choice([i, i, i, None, 7]), "\n".join(text[3 * i:3 * i + 3])) for i in range(n)]


@pytest.mark.parametrize("percent,min_words", [(80, 1), (80, 5), (60, 1), (95, 2)])
def test_random_lines(spark, percent, min_words):
    rows = random_rows(percent + min_words, 120)
    assert found(spark, rows, percent=percent, min_words=min_words) == expected(rows, percent, min_words)


def test_a_family_of_near_equal_lines(spark):
    """Many lines near one, which are not all near each other nor near the first."""
    r = random.Random(4)
    base = [f"b{i}" for i in range(40)]
    rows = [(i, " ".join(f"{w}x{r.randrange(2)}" if r.random() < 0.12 else w for w in base)) for i in range(200)]
    assert found(spark, rows) == expected(rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n\n \r"), (4, "one"), (5, "ONE one\nTwo"), (None, "one"), (None, "two\nthree\n"), (4, "été É\nétÉ é"),
            (6, "日本 語\n日本  語\x00"), (7, "日本 語"), (8, "\n".join(["menu", "home"] * 50)), (9, "w" * 100_000 + "\nmenu")]
    assert found(spark, rows) == expected(rows)
    assert found(spark, []) == []
