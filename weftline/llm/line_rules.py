"""Quality rules by the frequency of lines across documents.

Lines are normalised (lower-case letters A-Z, words joined by one space) and hashed.  A line that more than
``max_docs`` documents of a host and more than ``max_share`` of the host's documents have is boilerplate and
is removed there; a document that keeps less than ``min_left`` of its words is depleted and rejected.

Base rules come first: too few words, or too many words in repeated word triples.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import binary_texts, map_in_arrow, whole_row
from weftline.session import stored

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a triple of consecutive words found twice or more in the list."""
    triples = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(triples)) == len(triples):
        return 0
    counts = Counter(triples)
    often = np.fromiter((counts[t] > 1 for t in triples), bool, len(triples))
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(often)] |= often
    return int(covered.sum())


def line_hash(line: bytes) -> int:
    """Hash of a line's words, letters A-Z in lower case."""
    return xxhash.xxh64_intdigest(b" ".join(line.lower().split())) - (1 << 63)


def measures(text: bytes | None) -> tuple[list[int], dict[int, int]]:
    """The base counts of a text, and the words of each of its lines by the line's hash."""
    if not text:
        return [0] * len(COUNTS), {}
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    by_line: dict[int, int] = {}
    for line, n in Counter(lines).items():
        key = line_hash(line)
        by_line[key] = by_line.get(key, 0) + n * len(line.split())
    chars = len(text.translate(None, SPACES).decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return [len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)], by_line


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        found = [measures(text) for text in binary_texts(batch.column("text"))]
        numbers = range(number, number + len(found))
        number += len(found)
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"), batch.column("doc"), batch.column("host"), pa.array(numbers, pa.int64()),
                *[pa.array([f[0][i] for f in found], pa.int64()) for i in range(len(COUNTS))],
                pa.array([list(f[1]) for f in found], longs), pa.array([list(f[1].values()) for f in found], longs),
            ],
            ["row", "doc", "host", "number", *COUNTS, "line", "line_words"],
        )


def line_rules(
    docs: DataFrame,
    max_docs: int = 20,
    max_share: float = 0.02,
    min_left: float = 0.5,
    min_words: int = 50,
    max_repeat_share: float = 0.5,
    carry: Sequence[str] = ("doc_id",),
    host: str = "source",
) -> DataFrame:
    """The ``carry`` columns of every row of ``docs(doc_id, text, host)`` as the struct ``row``, with the counts,
    ``common_lines`` (hashes of the lines that are removed), ``n_common_words`` (words in them), ``base_failed``
    and ``kept``.

    Null and empty texts have no words and fail the base rules.  Rows with an equal id count as one document of
    their host, null ids as one as well; a null host is a host of its own.
    """
    texts = docs.select(
        whole_row(docs.select(*carry)).alias("row"),
        F.col("doc_id").cast("bigint").alias("doc"),
        F.col(host).cast("string").alias("host"),
        "text",
    )
    fields = ["doc", "host", "number", *COUNTS, "line", "line_words"]
    kinds = [T.LongType(), T.StringType(), T.LongType(), *[T.LongType()] * len(COUNTS), *[T.ArrayType(T.LongType())] * 2]
    schema = [T.StructField(name, kind) for name, kind in zip(fields, kinds, strict=True)]
    seen = stored(map_in_arrow(texts, _measure, T.StructType([texts.schema["row"], *schema])), "lines")

    some_doc = F.struct("doc")  # never null, so that null ids count
    lines = seen.select("number", "doc", "host", F.explode(F.arrays_zip("line", "line_words")).alias("l"))
    lines = lines.select("number", "doc", "host", "l.line", "l.line_words")
    n_docs = seen.groupBy("host").agg(F.count_distinct(some_doc).alias("host_docs"))
    common = lines.groupBy("host", "line").agg(F.count_distinct(some_doc).alias("n")).filter(F.col("n") > max_docs)
    common = common.withColumnRenamed("host", "h").join(n_docs, F.col("h").eqNullSafe(n_docs.host))
    common = common.filter(F.col("n") > F.col("host_docs") * max_share).select("h", F.col("line").alias("hash"))
    met = lines.join(common, lines.host.eqNullSafe(common.h) & (lines.line == common.hash))
    removed = met.groupBy("number").agg(
        F.sum("line_words").alias("n_common_words"), F.collect_set("line").alias("common_lines")
    )
    base_failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > F.col("n_words") * max_repeat_share)
    left = F.col("n_words") - F.col("n_common_words")
    judged = seen.drop("line", "line_words").join(removed, "number", "left")
    judged = judged.withColumn("n_common_words", F.coalesce("n_common_words", F.lit(0)))
    judged = judged.withColumn("base_failed", base_failed)
    judged = judged.withColumn("kept", ~F.col("base_failed") & (left >= F.col("n_words") * min_left))
    return judged.select("row", *COUNTS, "common_lines", "n_common_words", "base_failed", "kept")


def _without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, lines in zip(binary_texts(batch.column("text")), batch.column("common_lines").to_pylist(), strict=True):
            gone = set(lines or ())
            if text and gone:
                text = b"\n".join(line for line in text.split(b"\n") if not line.strip() or line_hash(line) not in gone)
            texts.append(None if text is None else text.decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])


def clean_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, their texts without the removed lines."""
    judged = line_rules(docs, carry=docs.columns, **settings).filter("kept")
    rows = judged.select("row", F.col("row.text").alias("text"), "common_lines")
    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType())])
    cut = map_in_arrow(rows, _without_lines, schema)
    return cut.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
