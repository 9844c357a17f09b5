from __future__ import annotations

import pytest
from made import words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Copies, near copies, nulls in every column, empty and very long texts, ties and repeated rows, and more columns with clashing names."""
    own = words(120, 1)
    near = own.replace(own.split()[60], "other")
    passage = words(60, 2)
    rows = [
        (1, own, "en", "a", 1), (2, own, "en", "a", 1), (3, near, "en", None, 1), (4, None, "en", "a", None), (5, "", None, "b", 0), (6, "  \n\t ", "fr", "b", 5), (7, "one", "fr", "b", 3),
        (8, "one two", "fr", None, 7), (9, words(100, 3) + "\n" + passage + "\n" + words(90, 4), "de", "c", 9), (10, words(70, 5) + ".\n" + passage + " " + words(80, 6), "de", "c", 9),
        (11, words(30_000, 7), "de", "c", 9), (12, "x" * 20_000, None, None, None), (13, words(200, 8), "fr", "a", 4), (13, words(200, 8), "fr", "a", 4), (None, words(60, 9), "en", "a", 2), (-5, own, None, "a", 2),
        (14, 'key: token = "0123456789abcdef0123456789abcdef01234567" ÀÉ ' + words(60, 10), "en", "z", 1), (15, "!!! ... 123", "en", "z", 1), (16, "spam spam " * 60, "en", "z", 1),
    ]
    more = {"n_words": 7, "size": 8, "host": "h", "shard": 9, "_id": 1, "_size": 2, "_src": "s", "_first": 3, "_shape": "t", "_rejected": "x", "_gone": 4, "gone": 5, "rejected": "y", "first": 6, "shape": 7, "own_id": 8, "place": 9, "best": 1, "node": 2, "a": 3, "b": 4, "lang_pred": "z"}
    kinds = ", ".join(f"{k} {'string' if isinstance(v, str) else 'long'}" for k, v in more.items())
    return spark.createDataFrame([(*r, *more.values()) for r in rows], f"{SCHEMA}, {kinds}").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def table():
    """The smallest table of documents: its folder, and its rows by doc_id."""
    import pyarrow.parquet as pq

    at = "/root/testdata/sf0.001"
    return at, sorted(((r["doc_id"], r["text"], r["lang"], r["source"]) for r in pq.read_table(f"{at}/documents.parquet").to_pylist()), key=lambda r: r[0])
