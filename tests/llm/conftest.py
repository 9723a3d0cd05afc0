"""Small tables with the awkward cases every operator must take."""

import os

import pytest

SF = "/root/testdata/sf0.001"
# further columns, under names that operators use themselves
EXTRA = ("score", "kept", "shard", "size", "_id", "_sha", "_n", "_gone", "_row", "_base", "_extra", "_m", "_", "_copy", "_mark",
         "_text", "_lang", "_source", "_size", "_own_kept", "id", "c0", "c1", "p", "tie", "label", "term", "n.dot")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)

need_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def awkward_rows():
    """Nulls, empty and blank texts, a very long text, equal rows, ties."""
    rows = [
        (1, "One two three four five six seven", "en", "a", 7),
        (2, "one TWO three four five six seven", "en", "a", 7),
        (3, "one two three four five six eight nine ten eleven", "en", "b", 9),
        (4, None, None, None, None),
        (5, "", "en", "b", 0),
        (6, " \t\n ", "en", "b", 4),
        (7, "word", "de", None, 4),
        (7, "word", "de", None, 4),
        (8, "ÄÖ Ü é日本 \u00a0 x", "xx", "a", 12),
        (9, "very long " * 30000, "en", "a", 300000),
        (10, "very long " * 30000, "en", "a", 300000),
        (11, "very long " * 29990 + "other end", "en", "c", 299909),
        (None, "no id here", "en", "c", 10),
        (None, None, "en", "c", None),
    ]
    return [(*r, *[c[:1] for c in EXTRA]) for r in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def corpus(docs):
    return docs.collect()
