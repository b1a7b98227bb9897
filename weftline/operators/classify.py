"""Multinomial Naive Bayes on token counts.

Prior: share of the class among the training documents, not smoothed.  Likelihood of a word:
(count in class + 1) / (tokens in class + V).  Words the training part does not know are scored too.

    score = ln(prior) - length * ln(tokens + V) + sum over words of n * ln(count + 1)

ln(0 + 1) is 0, so the sum needs only the (word, class) pairs that exist in the model.  The rest of the
score is a base that depends on the class and on the document's length.  A class that shares a word with a
document scores above its own base, hence the winner is either one of these classes or the class with the
best base: classes without a common word need not be listed per document.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from weftline.functions.scalars import rank_value
from weftline.functions.text import drop_mail_addresses, drop_urls, letter_runs, strip_message_header
from weftline.functions.wordlists import NEWS_STOP_WORDS
from weftline.operators.ranking import top_k, top_k_per_group
from weftline.operators.rows import computed_once
from weftline.operators.skew import MIN_HOT_ROWS, broadcast_if_small, key_counts, salted_join
from weftline.session import materialise

SCORE_DIGITS = 9
BODY = "__body"


def clean_news_text(df: DataFrame, min_tokens: int = 6, stop_words: Sequence[str] = NEWS_STOP_WORDS) -> DataFrame:
    """Add ``tokens`` to a table with ``text``; documents of fewer than ``min_tokens`` tokens are dropped.

    Header, mail addresses and URLs are removed before the letters are taken.  Several operators read the
    result; ``materialise`` it if the texts are many.
    """
    body = computed_once(df, BODY, strip_message_header("text"))
    body = computed_once(body, BODY, drop_mail_addresses(BODY))
    body = computed_once(body, BODY, drop_urls(BODY))
    tokens = computed_once(body, "tokens", letter_runs(BODY, stop_words))
    return tokens.drop(BODY).filter(F.size("tokens") >= min_tokens)


def class_priors(train: DataFrame) -> DataFrame:
    """(label, n_docs, prior)."""
    counts = train.groupBy("label").agg(F.count("*").alias("n_docs"))
    total = counts.agg(F.sum("n_docs")).scalar()
    return counts.select("label", "n_docs", (F.col("n_docs") / total).alias("prior"))


def word_class_counts(train: DataFrame) -> DataFrame:
    """(label, word, n)."""
    words = train.select("label", F.explode_outer("tokens").alias("word")).filter(F.col("word").isNotNull())
    return words.groupBy("label", "word").agg(F.count("*").alias("n"))


def class_word_totals(train: DataFrame) -> DataFrame:
    """(label, n_words)."""
    return train.groupBy("label").agg(F.sum(F.size("tokens")).cast("bigint").alias("n_words"))


def vocabulary(train: DataFrame) -> DataFrame:
    """(word), each word of the training part once."""
    return train.select(F.explode_outer("tokens").alias("word")).filter(F.col("word").isNotNull()).distinct()


@dataclass(frozen=True)
class NaiveBayesModel:
    """``classes(label, n_docs, n_words, log_prior, log_total)`` and ``words(label, word, n)``.

    ``log_total`` is ln(tokens of the class + V).
    """

    classes: DataFrame
    words: DataFrame


def nb_fit(train: DataFrame) -> NaiveBayesModel:
    """Model of ``train(label, tokens)``, computed here and checkpointed, as every prediction reads it."""
    words = materialise(word_class_counts(train))
    totals = words.groupBy("label").agg(F.sum("n").alias("n_words"))
    v = words.select("word").distinct().agg(F.count("*").alias("v")).scalar()
    classes = class_priors(train).join(totals, "label", "left")
    n_words = F.coalesce("n_words", F.lit(0))
    classes = classes.select(
        "label",
        "n_docs",
        n_words.alias("n_words"),
        F.log("prior").alias("log_prior"),
        F.log(n_words + v).alias("log_total"),
    )
    return NaiveBayesModel(materialise(classes), words)


def _better(a: Column, b: Column) -> Column:
    """The ``struct<score, label>`` with the higher score, on a tie the smaller label; NULL labels lose."""
    ahead = (b["score"] > a["score"]) | ((b["score"] == a["score"]) & (b["label"] < a["label"]))
    return F.when(b["label"].isNotNull() & (a["label"].isNull() | ahead), b).otherwise(a)


def _base_winners(model: NaiveBayesModel) -> list[Row]:
    """The classes whose base score is the best for some document length, ties within the rounding included.

    Base scores are straight lines, ``log_prior - length * log_total``.  Of the classes with equally many
    documents only the one with the fewest tokens or, where all tie at length 0, the smallest label can win.
    Different numbers of documents add up to the training size N, so at most 2 sqrt(2 N) lines reach the
    driver; there only those on the upper envelope, mostly a handful, are kept.
    """
    stats = F.struct("log_prior", "log_total", "label")
    fewest = F.min_by(stats, F.struct("n_words", "label"))
    lines = model.classes.groupBy("n_docs").agg(F.array_distinct(F.array(fewest, F.min_by(stats, "label"))).alias("l"))
    rows = lines.select(F.inline("l")).collect()
    return winning_lines(rows)


def winning_lines(rows: Sequence[Row], slack: float = 4 * 10**-SCORE_DIGITS) -> list[Row]:
    """Rows (log_prior, log_total, label) that come within ``slack`` of the best ``log_prior - x * log_total`` at
    some x >= 0."""
    rows = sorted(rows, key=lambda r: (r["log_total"], -r["log_prior"], r["label"]))
    envelope: list[tuple[float, Row]] = []  # from which x on a line is the best; x falls from infinity to 0
    for row in rows:
        while envelope:
            best = envelope[-1][1]
            if row["log_prior"] <= best["log_prior"]:
                break
            cross = (row["log_prior"] - best["log_prior"]) / (row["log_total"] - best["log_total"])
            if len(envelope) > 1 and cross >= envelope[-1][0]:
                envelope.pop()
                continue
            envelope.append((cross, row))
            break
        if not envelope:
            envelope.append((float("inf"), row))
    # ``cross`` of an entry is where it meets the one before it: below it the entry is better
    ends = sorted({0.0, *(x for x, _ in envelope if x != float("inf"))})

    def best_at(x: float) -> float:
        return max(row["log_prior"] - x * row["log_total"] for _, row in envelope)

    top = [(x, best_at(x)) for x in ends]
    least = envelope[0][1]["log_total"] if envelope else 0.0
    return [
        row for row in rows
        if row["log_total"] == least or any(row["log_prior"] - x * row["log_total"] >= y - slack for x, y in top)
    ]


def nb_scores(model: NaiveBayesModel, test: DataFrame, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """(doc_id, length, label, score) of the classes that share a word with a document of
    ``test(doc_id, tokens)``, and one row without a label for the words that no class knows."""
    terms = (
        test.select("doc_id", F.size("tokens").alias("length"), F.explode_outer("tokens").alias("word"))
        .groupBy("doc_id", "length", "word")
        .agg(F.count("*").alias("times"))
    )
    weights = model.words.join(broadcast_if_small(model.classes), "label").select(
        "word", "label", F.log(F.col("n") + 1).alias("weight"), "log_prior", "log_total"
    )
    counts = key_counts(terms, "word", positive="times")
    return (
        salted_join(terms, weights, "word", spread=["doc_id"], counts=counts, how="left", min_hot_rows=min_hot_rows)
        .groupBy("doc_id", "length", "label", "log_prior", "log_total")
        .agg(F.sum(F.col("times") * F.col("weight")).alias("evidence"))
        .select(
            "doc_id",
            "length",
            "label",
            rank_value(
                F.col("log_prior") - F.col("length") * F.col("log_total") + F.col("evidence"), SCORE_DIGITS
            ).alias("score"),
        )
    )


def nb_predict(model: NaiveBayesModel, test: DataFrame, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """(doc_id, predicted, score) for each document of ``test(doc_id, tokens)`` with unique ids.

    Scores are compared at nine decimals; equal ones go to the smaller label.  A model without classes
    predicts NULL.
    """
    scores = nb_scores(model, test, min_hot_rows)
    own = top_k_per_group(scores, "doc_id", 1, [F.desc_nulls_last("score"), F.asc("label")])

    def base(rival: dict[str, Column]) -> Column:
        score = rank_value(rival["log_prior"] - F.col("length") * rival["log_total"], SCORE_DIGITS)
        return F.struct(score.alias("score"), rival["label"].alias("label"))

    winner = F.struct("score", "label")
    for row in _base_winners(model):
        rival = {name: F.lit(row[name]) for name in ("log_prior", "log_total", "label")}
        own = own.withColumn("best", _better(winner, base(rival)))
        winner = F.col("best")
    return own.select("doc_id", winner.alias("winner")).select(
        "doc_id", F.col("winner.label").alias("predicted"), "winner.score"
    )


def with_truth(predictions: DataFrame, test: DataFrame) -> DataFrame:
    """(doc_id, label, predicted, score)."""
    return test.select("doc_id", "label").join(predictions, "doc_id").select("doc_id", "label", "predicted", "score")


def accuracy(predictions: DataFrame) -> DataFrame:
    """One row (n_test, n_correct, accuracy); the accuracy of no documents is NULL."""
    correct = F.count_if(F.col("label") == F.col("predicted"))
    return predictions.agg(F.count("*").alias("n_test"), correct.alias("n_correct")).withColumn(
        "accuracy", F.try_divide("n_correct", "n_test")
    )


def class_accuracy(predictions: DataFrame) -> DataFrame:
    """(label, n_correct, n_test, accuracy) by true class."""
    return predictions.groupBy("label").agg(
        F.count_if(F.col("label") == F.col("predicted")).alias("n_correct"), F.count("*").alias("n_test")
    ).withColumn("accuracy", F.col("n_correct") / F.col("n_test"))


def best_classes(per_class: DataFrame, k: int = 10) -> DataFrame:
    return top_k(per_class, k, [F.desc("accuracy"), F.asc("label")])


def largest_priors(priors: DataFrame, k: int = 10) -> DataFrame:
    return top_k(priors, k, [F.desc("prior"), F.asc("label")])
