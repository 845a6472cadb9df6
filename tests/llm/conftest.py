import os

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def sf():
    if not os.path.isdir(SF):
        pytest.skip("needs the generated tables")
    return SF


@pytest.fixture
def docs(spark):
    """Documents from texts; ids count from 1, sources and languages alternate."""

    def make(texts, **columns):
        rows = [(i, t, ("en", "fr")[i % 2], f"src{i % 3}", len(t or "")) for i, t in enumerate(texts, 1)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return make


LONG = " ".join(f"word{i % 977}" for i in range(30_000))
ODD = [
    None, "", " \t\n", "a", "one two three four", "one two three four five", "one two three four five", "x" * 50_000, LONG, LONG + " and more",
    "ünïcödé — 日本語 😀 \x00   ok", "!!! ### $$$", "1234567890 " * 30, "A\nA\nA\n\nB", "token = 'abcdef0123456789abcdef'", "Licensed under the Apache License, Version 2.0.",
]


#: Names that operators give to columns of their own, results and others.
CLASHES = "id row score rejected lang_pred __text __pick __again __gone __k __size __src __copy __salt __host pick gone again src size x k n cid label c0 c1 findings decoded ids".split()


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns with names that operators use."""
    rows = [(i, t, None if i % 4 == 0 else "en" if i % 2 else "fr", None if i % 5 == 0 else f"s{i % 2}", len(t or ""), "x", i, 0.5) for i, t in enumerate(ODD, 1)]
    rows += [rows[5], rows[8], rows[0], (None, "a text without an id and some words", "en", "s1", 3, None, None, None), (None, None, None, None, None, None, None, None)]
    rows = [(*r, *[f"{name}-{r[0]}" for name in CLASHES[3:]]) for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, row long, score double, " + ", ".join(f"`{name}` string" for name in CLASHES[3:]))
