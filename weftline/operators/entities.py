"""Entity counts with a pluggable extractor.

An extractor turns a text column into an array of ``struct<text, label>``.  ``capitalised_words`` is a
native rule; ``model_extractor`` wraps a user's own model.  The rule is no substitute for a trained model:
it finds single capitalised words, and their labels come from a gazetteer table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.text import NOT_WORD, as_column, trimmed
from weftline.functions.wordlists import BATCH_ENTITY_LABELS
from weftline.operators.ranking import top_k
from weftline.session import ship_package

Extractor = Callable[[Column], Column]
Model = Callable[[list[str]], Iterable[Iterable[tuple[str, str]]]]
_MODELS: dict[str, Model] = {}
MENTIONS = "array<struct<text:string,label:string>>"


def capitalised_words(text: Column | str) -> Column:
    """Whole words of one ASCII capital and ASCII small letters, without a label."""
    found = F.filter(F.split(as_column(text), NOT_WORD), lambda word: word.rlike("^[A-Z][a-z]+$"))
    return F.transform(
        found, lambda word: F.struct(word.alias("text"), F.lit(None).cast("string").alias("label"))
    )


def worker_model(key: str, load_model: Callable[[], Model]) -> Model:
    """The model of ``key`` in this worker process, loaded when it is asked for the first time."""
    if key not in _MODELS:
        _MODELS[key] = load_model()
    return _MODELS[key]


def model_extractor(load_model: Callable[[], Model]) -> Extractor:
    """Extractor around a model: ``load_model`` runs once per worker process, not per task, and its result is
    called with a list of texts, one per Arrow batch.

    A NULL text has no entities and is not shown to the model.
    """
    key = uuid.uuid4().hex
    ship_package(SparkSession.active())

    @F.pandas_udf(MENTIONS)
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = worker_model(key, load_model)
        for texts in batches:
            found = iter(model([text for text in texts if text is not None]))
            yield pd.Series(
                [
                    [] if text is None else [{"text": entity, "label": label} for entity, label in next(found)]
                    for text in texts
                ],
                dtype=object,
            )

    return lambda text: extract(as_column(text))


def entity_mentions(
    df: DataFrame,
    extractor: Extractor = capitalised_words,
    labels: Sequence[str] | None = None,
    text: str = "text",
    keep_blank: bool = False,
) -> DataFrame:
    """(entity, label), one row per mention, trimmed; works on batches and on streams.

    ``labels`` keeps the mentions with one of these labels; None keeps all.
    """
    found = df.select(F.explode_outer(extractor(F.col(text))).alias("mention")).filter(F.col("mention").isNotNull())
    mentions = found.select(trimmed("mention.text").alias("entity"), F.col("mention.label").alias("label"))
    if labels is not None:
        mentions = mentions.filter(F.col("label").isin(list(labels)))
    return mentions if keep_blank else mentions.filter(F.col("entity") != "")


def count_entities(mentions: DataFrame) -> DataFrame:
    """(entity, count)."""
    return mentions.groupBy("entity").agg(F.count("*").alias("count"))


def keep_known_entities(counts: DataFrame, gazetteer: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(entity, label, count) of the counted entities that ``gazetteer(entity, label)`` labels.

    The label of a rule entity depends on its text alone, so the join comes after the count and sees each
    entity once, however often it is mentioned.
    """
    return counts.join(gazetteer.filter(F.col("label").isin(list(labels))), "entity").select(
        "entity", "label", "count"
    )


def entity_counts(
    df: DataFrame,
    extractor: Extractor = capitalised_words,
    labels: Sequence[str] | None = BATCH_ENTITY_LABELS,
    k: int = 20,
    text: str = "text",
    keep_blank: bool = True,
) -> DataFrame:
    """The ``k`` most frequent entities of a text column as (entity, count)."""
    counts = count_entities(entity_mentions(df, extractor, labels, text, keep_blank))
    return top_k(counts, k, [F.desc("count"), F.asc("entity")])
