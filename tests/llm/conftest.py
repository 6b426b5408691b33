from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, th long, _id long, fp long, rank int"
LONG = "lorem ipsum dolor sit amet " * 20_000


@pytest.fixture(scope="session")
def edge_rows():
    """Repeated rows, null ids, null, empty, blank and very long texts, letters beyond ASCII."""
    texts = [(1, "The quick brown fox, a dog.\nAnd more."), (1, "The quick brown fox, a dog.\nAnd more."), (None, "no id here"), (None, None), (2, None), (3, ""), (4, LONG), (5, " \n\n\t "),
             (6, "ÉÑ İstanbul ß ñandú ★ 漢字   end"), (7, "1234 !!! ???"), (8, "a"), (9, "nul \0 byte")]
    return [(i, t, "en" if i != 6 else None, None, None if t is None else len(t), None, None, None, None, None, None) for i, t in texts]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
