"""Small tables with the cases that every operator has to stand."""

import pytest

ODD_COLUMNS = "`row` string, seen int, tie string, `key` int, size string, fp string, matches int, kept int, n_words int"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {ODD_COLUMNS}"
ODD = ("r", 1, "t", 2, "s", "f", 3, 4, 5)


def document(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *ODD)


LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(20_000))
AWKWARD = [
    document(1, None),
    document(2, ""),
    document(3, " \t\n\x0b "),
    document(4, "one"),
    document(5, "The cat sat.\nThe dog ran.\n\nThe cat sat.", None, None),
    document(5, "The cat sat.\nThe dog ran.\n\nThe cat sat.", None, None),
    document(5, "another text under the same id", "en", "b"),
    document(None, "a text without an id", "fr", "b"),
    document(None, "a text without an id", "fr", "b"),
    document(None, None, None, None),
    document(6, LONG, "en", "c"),
    document(7, LONG, "en", "c"),
    document(8, "12 34 !?   \x00 \x1c $$", "de", "c"),
    document(9, "日本語 の テキスト ÀÉ \U0001f600", "ja", "d"),
]


@pytest.fixture
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""
    return lambda rows: spark.createDataFrame([document(*row) for row in rows], SCHEMA)
