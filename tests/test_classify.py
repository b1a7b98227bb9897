import math
import random
from collections import Counter

import pytest

from weftline.operators import classify

SCHEMA = "doc_id bigint, label string, tokens array<string>"


def brute_force(train, test):
    """{doc_id: (label, score)}: every class, every token."""
    docs = Counter(label for _, label, _ in train)
    counts = Counter((label, word) for _, label, tokens in train for word in tokens)
    totals = Counter()
    for _, label, tokens in train:
        totals[label] += len(tokens)
    v = len({word for _, _, tokens in train for word in tokens})
    best = {}
    for doc_id, _, tokens in test:
        scores = []
        for label, n in docs.items():
            score = math.log(n / len(train))
            score += sum(math.log((counts[label, word] + 1) / (totals[label] + v)) for word in tokens)
            scores.append((-round(score, 9), label))
        score, label = min(scores)
        best[doc_id] = (label, -score)
    return best


def predict(spark, train, test, **options):
    model = classify.nb_fit(spark.createDataFrame(train, SCHEMA))
    rows = classify.nb_predict(model, spark.createDataFrame(test, SCHEMA), **options).collect()
    assert len(rows) == len(test)
    return {row.doc_id: (row.predicted, row.score) for row in rows}


def same(got, want):
    assert {doc: label for doc, (label, _) in got.items()} == {doc: label for doc, (label, _) in want.items()}
    for doc, (_, score) in want.items():
        assert got[doc][1] == pytest.approx(score, abs=1e-8)


def test_predictions_by_hand(spark):
    train = [
        (1, "a", ["ball", "goal", "ball"]), (2, "a", ["goal"]), (3, "b", ["star", "moon"]),
        (4, "c", ["star", "star", "star", "moon", "ball", "sun", "sun", "sky"]),
    ]
    test = [
        (10, "a", ["ball", "ball"]), (11, "b", ["star"]), (12, "new", ["unseen", "other"]), (13, "c", []),
        (14, "b", ["moon", "unseen", "star", "star"]),
    ]
    same(predict(spark, train, test), brute_force(train, test))


@pytest.mark.parametrize("seed", range(3))
def test_random_models_with_hot_words(spark, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)]

    def docs(start, n):
        return [
            (start + i, f"c{rng.randint(0, 5)}", rng.choices(words, range(30, 0, -1), k=rng.randint(0, 9)))
            for i in range(n)
        ]

    train, test = docs(0, 40), docs(100, 40)
    test.append((999, "c0", ["unknown"] * 4))
    same(predict(spark, train, test, min_hot_rows=2), brute_force(train, test))


def test_tied_classes_go_to_the_smaller_label(spark):
    train = [(1, "b", ["x", "y"]), (2, "a", ["x", "y"])]
    got = predict(spark, train, [(3, "a", ["x"]), (4, "a", ["z"])])
    assert {label for label, _ in got.values()} == {"a"}


def test_priors_are_not_smoothed(spark):
    train = spark.createDataFrame([(1, "a", ["x"]), (2, "a", ["x"]), (3, "b", ["y"])], SCHEMA)
    rows = {row.label: (row.n_docs, row.prior) for row in classify.class_priors(train).collect()}
    assert rows == {"a": (2, pytest.approx(2 / 3)), "b": (1, pytest.approx(1 / 3))}
    assert [row.label for row in classify.largest_priors(classify.class_priors(train), 1).collect()] == ["a"]


def test_evaluation(spark):
    predictions = spark.createDataFrame(
        [(1, "a", "a"), (2, "a", "b"), (3, "b", "b"), (4, "c", "c")], "doc_id bigint, label string, predicted string"
    )
    assert classify.accuracy(predictions).first() == (4, 3, 0.75)
    per_class = classify.class_accuracy(predictions)
    assert [tuple(r) for r in classify.best_classes(per_class, 2).collect()] == [("b", 1, 1, 1.0), ("c", 1, 1, 1.0)]


def test_empty_test_set(spark):
    model = classify.nb_fit(spark.createDataFrame([(1, "a", ["x"])], SCHEMA))
    empty = spark.createDataFrame([], SCHEMA)
    predictions = classify.with_truth(classify.nb_predict(model, empty), empty)
    assert classify.accuracy(predictions).first() == (0, 0, None)


def test_vocabulary_and_totals(spark):
    train = spark.createDataFrame([(1, "a", ["x", "x", "y"]), (2, "b", ["y"]), (3, "c", [])], SCHEMA)
    assert sorted(row.word for row in classify.vocabulary(train).collect()) == ["x", "y"]
    assert sorted(map(tuple, classify.word_class_counts(train).collect())) == [("a", "x", 2), ("a", "y", 1), ("b", "y", 1)]
    assert sorted(map(tuple, classify.class_word_totals(train).collect())) == [("a", 3), ("b", 1), ("c", 0)]


@pytest.mark.parametrize("seed", range(6))
def test_only_lines_that_win_somewhere_are_kept(seed):
    rng = random.Random(seed)
    rows = [
        {"log_prior": -rng.random() * 5, "log_total": rng.choice([rng.random() * 3, 1.0]), "label": f"l{i}"} for i in range(40)
    ]
    kept = classify.winning_lines(rows)
    assert len(kept) < 25
    for x in [*range(200), 10**6]:
        best = max(rows, key=lambda r: (round(r["log_prior"] - x * r["log_total"], 9), [-ord(c) for c in r["label"]]))
        assert best in kept
