"""Toxicity by a classifier chain.

The categories are predicted one after the other.  Each has a linear model over the words of a document, their stems and
the probabilities of the categories before it.  In training these probabilities are out of fold: each
document's come from models that have not seen it, so that the later models learn how far to trust them.

The models are fitted on the driver on at most ``sample`` labelled documents, drawn by a hash of the id.  Their
vocabulary, at most ``vocabulary`` words per category, is chosen by chi-square on word counts that Spark makes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import binary_texts, map_in_arrow, plain_words, whole_row
from weftline.llm.logistic import Sparse, fit_logistic, sigmoid
from weftline.session import stored

FOLDS = 5
STEM = 4


def terms(text: bytes | None) -> set[str]:
    """The distinct words of a text, and the first ``STEM`` letters of the longer ones."""
    words = set(b" ".join(plain_words(text or b"")).decode().split())
    return words | {word[:STEM] + "-" for word in words if len(word) > STEM}


@dataclass
class Chain:
    """Categories in order, vocabulary, and for each category its weights: words, earlier categories, bias."""

    categories: list[str]
    vocabulary: dict[str, int]
    weights: list[np.ndarray]

    def probabilities(self, text: bytes | None) -> list[float]:
        """The probability of each category; a chain that was fitted on nothing gives 0."""
        if not self.weights:
            return [0.0] * len(self.categories)
        number = self.vocabulary
        words = [number[term] for term in terms(text) if term in number]
        found: list[float] = []
        for weights in self.weights:
            score = weights[words].sum() + weights[len(number) : -1] @ np.array(found) + weights[-1]
            found.append(float(sigmoid(score)))
        return found


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [sorted(terms(text)) for text in binary_texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("draw"), batch.column("marks"), pa.array(words, pa.list_(pa.string()))],
            ["draw", "marks", "words"],
        )


def fit_chain(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str], sample: int = 20_000, vocabulary: int = 120,
    min_docs: int = 5, min_gain: float = 25.0, seed: int = 42,
) -> Chain:
    """A chain for the 0/1 columns ``categories`` of ``labels(doc_id, ...)``, which is fitted in that order.

    A term joins the vocabulary of a category when at least ``min_docs`` documents have it and its chi-square is
    above ``min_gain``, so that rare terms do not enter by chance.  Labels that are null in a category are not used; a document that is labelled twice counts
    twice, one of several rows with an id is taken: the driver gets at most ``sample`` rows.
    """
    marks = F.array(*[F.col(c).cast("int") for c in categories])
    drawn = labels.select("doc_id", marks.alias("marks"), F.xxhash64(F.lit(seed), "doc_id", marks).alias("draw"))
    drawn = drawn.filter(~F.exists("marks", lambda m: m.isNull())).filter(F.col("doc_id").isNotNull())
    number = F.row_number().over(Window.orderBy("draw"))  # of at most ``sample`` rows
    drawn = stored(drawn.orderBy("draw").limit(sample).withColumn("number", number), "drawn-labels")
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").groupBy("number", "draw", "marks")
    texts = texts.agg(F.min_by("text", F.xxhash64("text")).alias("text")).drop("number")
    seen = stored(map_in_arrow(texts, _words, "draw bigint, marks array<int>, words array<string>"), "label-words")

    n = seen.count()
    if not n:
        return Chain(list(categories), {}, [])
    each = seen.select("marks", F.explode("words").alias("word"))
    sums = [F.sum(F.col("marks")[i]).alias(f"n{i}") for i in range(len(categories))]
    totals = seen.agg(*sums).first()
    counts = each.groupBy("word").agg(F.count("*").alias("n"), *sums).filter(F.col("n") >= min_docs)
    counts = stored(counts, "word-counts")
    chosen: set[str] = set()
    for i in range(len(categories)):
        base = (totals[i] or 0) / n
        gain = (F.col(f"n{i}") - F.col("n") * base) ** 2 / (F.col("n") * max(base * (1 - base), 1e-9))
        best = counts.filter(gain > min_gain).orderBy(F.desc(gain), "word").limit(vocabulary)
        chosen.update(row["word"] for row in best.select("word").collect())
    number = {word: i for i, word in enumerate(sorted(chosen))}
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def numbers(batches):
        for batch in batches:
            known = [[shared.value[w] for w in words if w in shared.value] for words in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("draw"), batch.column("marks"), pa.array(known, pa.list_(pa.int32()))],
                ["draw", "marks", "words"],
            )

    rows = map_in_arrow(seen, numbers, "draw bigint, marks array<int>, words array<int>").collect()
    return _fit(list(categories), number, sorted(rows, key=lambda r: (r["draw"], r["words"])))


def _fit(categories: list[str], number: dict[str, int], rows: list) -> Chain:
    x_words = [row["words"] for row in rows]
    y = np.array([row["marks"] for row in rows], float)
    fold = np.arange(len(rows)) % FOLDS
    earlier, weights = np.zeros((len(rows), 0)), []
    for k in range(len(categories)):
        x = Sparse(x_words, len(number), earlier)
        weights.append(fit_logistic(x, y[:, k]))
        out_of_fold = np.zeros(len(rows))
        for f in range(FOLDS if k < len(categories) - 1 else 0):
            own = fit_logistic(x.take(fold != f), y[fold != f, k])
            out_of_fold[fold == f] = sigmoid(x.take(fold == f).times(own[:-1]) + own[-1])
        earlier = np.column_stack([earlier, out_of_fold])
    return Chain(categories, number, weights)


def predict(docs: DataFrame, chain: Chain, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns of every row of ``docs(text, ...)`` as the struct ``row``, with ``probabilities``, one
    per category.  Null and empty texts are judged by the models' bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def judge(batches):
        for batch in batches:
            found = [shared.value.probabilities(text) for text in binary_texts(batch.column("seen"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(found, pa.list_(pa.float64()))], ["row", "probabilities"]
            )

    rows = docs.select(whole_row(docs.select(*carry)).alias("row"), F.col("text").alias("seen"))
    kind = T.StructField("probabilities", T.ArrayType(T.DoubleType()))
    return map_in_arrow(rows, judge, T.StructType([rows.schema["row"], kind]))
