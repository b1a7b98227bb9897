"""Helpers that several of the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.session import arrow_batches, ship_package  # noqa: F401 - the operators take arrow_batches from here

#: A word of the contracts: no space and no code point from tab to carriage return.  ``bytes.split()``
#: splits at exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SPACES_FOR_PUNCTUATION = bytes.maketrans(ASCII_PUNCTUATION, b" " * len(ASCII_PUNCTUATION))


def map_in_arrow(df: DataFrame, function: Callable, schema: str | T.StructType) -> DataFrame:
    """``df.mapInArrow`` with this package on the Python path of the workers.

    A worker process serves many tasks, so what Arrow holds in reserve is given back at the end of each.
    """
    ship_package(df.sparkSession)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(apply, schema)


def whole_row(df: DataFrame) -> Column:
    """All columns in one struct, so that no column an operator adds can clash with them."""
    return F.struct(*[F.col(f"`{name}`") for name in df.columns])


def without_text(docs: DataFrame, carry: Sequence[str]) -> tuple[DataFrame, Column]:
    """(rest, seen): the ``carry`` columns without the text, and the text; and the column that puts both together again.

    A text goes to a Python function once and comes back as the column ``seen``, if it is carried at all.
    """
    others = [name for name in carry if name != "text"]
    rest = whole_row(docs.select(*others)) if others else F.struct(F.lit(0).alias("nothing"))
    again = F.struct(*[(F.col("seen") if c == "text" else F.col(f"rest.`{c}`")).alias(c) for c in carry])
    return docs.select(rest.alias("rest"), F.col("text").alias("seen")), again.alias("row")


def binary_texts(column: pa.Array) -> Iterator[bytes | None]:
    """The texts of a string column as UTF-8 bytes, one at a time."""
    for value in column.cast(pa.binary()):
        yield value.as_py()


def grouped(texts: Iterable[bytes | None], max_bytes: int) -> Iterator[list[bytes]]:
    """The texts, null ones empty, in lists of about ``max_bytes``; a longer text comes alone."""
    group, size = [], 0
    for text in texts:
        text = text or b""
        if group and size + len(text) > max_bytes:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def word_count(text: Column | str) -> Column:
    """Words of a text; 0 for a null one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def plain_words(text: bytes) -> list[bytes]:
    """Lower-case words of a text without ASCII punctuation."""
    return text.decode("utf-8", "replace").lower().encode().translate(SPACES_FOR_PUNCTUATION).split()


def per_batch(function: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable:
    """A function of one record batch as the iterator function that ``mapInArrow`` takes."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return apply
