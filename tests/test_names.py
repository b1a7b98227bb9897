"""Names of several words, next to a walk through each text."""

import random

import pytest

from weftline.operators.names import find_names, name_counts, name_trie

NAMES = [
    ("Jane Austen", "PERSON"), ("Jane", "PERSON"), ("New York", "GPE"), ("New York Times", "ORG"), ("York", "GPE"),
    ("Times Square in New York", "LOC"), ("Jane  Austen!", "ORG"), ("...", "ORG"), ("Zürich", "GPE"), ("not found here", "LOC"),
]
TEXTS = [
    (1, "Jane Austen met Jane in New York."), (2, "The New York Times, Times Square in New York Times"), (3, ""), (4, None),
    (5, "New New York York; Zürich, zürich jane"), (6, "Jane\nAusten"), (7, "Austen Jane"),
]


def plain(texts, names):
    import re

    known = {}
    for entity, label in names:
        words = tuple(re.findall(r"\w+", entity))
        if words:
            known[words] = min(label, known.get(words, label))
    out = set()
    for doc_id, text in texts:
        words, i = re.findall(r"\w+", text or ""), 0
        while i < len(words):
            n = max((n for n in range(1, len(words) - i + 1) if tuple(words[i : i + n]) in known), default=0)
            if n:
                out.add((doc_id, i, n, " ".join(words[i : i + n]), known[tuple(words[i : i + n])]))
            i += max(n, 1)
    return out


@pytest.fixture
def found(spark):
    def run(texts, names, **options):
        docs = spark.createDataFrame(texts, "doc_id bigint, text string")
        gazetteer = spark.createDataFrame(names, "entity string, label string")
        return find_names(docs, gazetteer, **options)

    return run


def test_leftmost_longest(found):
    assert {tuple(r) for r in found(TEXTS, NAMES).collect()} == plain(TEXTS, NAMES)


def test_random_texts_and_long_islands(found):
    rng = random.Random(5)
    names = [(" ".join(rng.choices("abcd", k=rng.randint(1, 4))), rng.choice("XY")) for _ in range(25)]
    texts = [(i, " ".join(rng.choices("abcde", k=rng.randint(0, 60)))) for i in range(60)]
    texts.append((99, "a " * 400))
    assert {tuple(r) for r in found(texts, [*names, ("a a a", "X")]).collect()} == plain(texts, [*names, ("a a a", "X")])


def test_labels_are_kept_after_the_match(found):
    rows = found([(1, "New York Times and York")], NAMES, labels=["GPE"]).collect()
    assert [(r.place, r.entity) for r in rows] == [(4, "York")]  # the paper hides the town


def test_no_names_and_no_texts(found):
    assert found(TEXTS, []).collect() == []
    assert found([], NAMES).collect() == []


def test_counts_and_trie(spark, found):
    counts = {(r.entity, r.label): r["count"] for r in name_counts(found(TEXTS, NAMES)).collect()}
    assert counts["New York", "GPE"] == 2 and counts["Jane Austen", "ORG"] == 2
    trie = {r.prefix: r for r in name_trie(spark.createDataFrame(NAMES, "entity string, label string")).collect()}
    assert (trie["New"].is_name, trie["New"].deepest, trie["New"].label) == (False, 3, None)
    assert (trie["New York"].is_name, trie["New York"].label) == (True, "GPE")


def test_no_broadcast_of_a_large_gazetteer(spark):
    """The gazetteer is broadcast only where Spark's own size check allows it."""
    from weftline.operators.names import name_candidates

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        trie = name_trie(spark.createDataFrame(NAMES, "entity string, label string"))
        docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
        plan = name_candidates(docs, trie)._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
