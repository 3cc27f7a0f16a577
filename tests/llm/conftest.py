"""Small tables with everything that may go wrong in them."""

from __future__ import annotations

import pytest

LONG = " ".join(f"word{i % 977} other{i % 31}" for i in range(60_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, size string, label int, row long, held_out boolean, extra map<string, int>"


def _row(doc_id, text, lang="en", source="src0", n_chars=0):
    return (doc_id, text, lang, source, n_chars, 7, "clash", 3, 9, None, {"k": 1})


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties, clashing extra columns."""
    rows = [
        _row(1, "The first plain sentence has quite a few ordinary words in it, and then some more of them to be safe."),
        _row(2, None),
        _row(3, ""),
        _row(4, " \n\t "),
        _row(5, LONG),
        _row(6, "same text again and again", "de", None),
        _row(6, "same text again and again", "de", None),
        _row(7, "same text again and again", None, "src1", None),
        _row(None, "no id at all here", None, None, None),
        _row(None, None, None, None, None),
        _row(8, "12 345 !!! ???", "fr", ""),
        _row(9, "\x00 odd \x85 white\xa0space   and ünïcode ÀÉ", "fr", "src2"),
        _row(10, "x" * 100_000, "es", "src2"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
