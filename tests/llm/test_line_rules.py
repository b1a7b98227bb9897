"""Line rules next to a plain Python version."""

import random
from collections import Counter

import pytest

from weftline.llm.line_rules import COUNTS, clean_documents, line_rules, measures, repeated_words

SPACES = " \t\n\x0b\x0c\r"


def plain_words(text):
    words, word = [], ""
    for char in text + " ":
        if char in SPACES:
            words += [word] if word else []
            word = ""
        else:
            word += char
    return words


def plain_counts(text):
    words = plain_words(text or "")
    lines = [line for line in (text or "").split("\n") if plain_words(line)]
    triples = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) for k in range(3) if triples[tuple(words[i : i + 3])] > 1}
    return [
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
    ]


def plain_rules(rows, max_docs, max_share, min_left, min_words):
    """(doc_id, text, source) rows -> sorted results."""
    def lines_of(text):
        return [" ".join(plain_words(line)).lower() for line in (text or "").split("\n") if plain_words(line)]

    hosts, having = {}, {}
    for doc_id, text, source in rows:
        hosts.setdefault(source, set()).add(doc_id)
        for line in lines_of(text):
            having.setdefault((source, line), set()).add(doc_id)
    out = []
    for doc_id, text, source in rows:
        counts = plain_counts(text)
        common = sum(
            len(line.split(" ")) for line in lines_of(text)
            if len(having[source, line]) > max_docs and len(having[source, line]) > max_share * len(hosts[source])
        )
        failed = counts[0] < min_words or counts[4] > counts[0] * 0.5
        out.append((doc_id, *counts, common, failed, not failed and counts[0] - common >= counts[0] * min_left))
    return sorted(out, key=repr)


def results(found):
    columns = ["row.doc_id", *COUNTS, "n_common_words", "base_failed", "kept"]
    return sorted((tuple(r) for r in found.select(*columns).collect()), key=repr)


def test_rules_equal_plain_python(documents):
    rng = random.Random(1)
    boilerplate = ["All rights reserved", "ALL rights  reserved", "Read more | here", "next"]
    rows = []
    for i in range(120):
        body = [" ".join(rng.choice("abcdefgh") * 2 for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 6))]
        body += rng.sample(boilerplate, rng.randint(0, 3))
        rng.shuffle(body)
        rows.append((i // 2 if i > 100 else i, "\n".join(body), "en", rng.choice(["a", "a", "b", None])))
    found = line_rules(documents(rows), max_docs=5, max_share=0.1, min_words=4)
    expected = plain_rules([(r[0], r[1], r[3]) for r in rows], 5, 0.1, 0.5, 4)
    assert results(found) == expected
    assert any(r[6] for r in expected) and {r[8] for r in expected} == {True, False}


def test_limits_are_per_host(documents):
    rows = [(i, f"same line here\nown words number {i}", "en", "a") for i in range(10)]
    rows += [(i, f"same line here\nown words number {i}", "en", "b") for i in range(10, 12)]
    found = line_rules(documents(rows), max_docs=3, min_words=2)
    common = {r["doc_id"]: r["n_common_words"] for r in found.select("row.doc_id", "n_common_words").collect()}
    assert all(common[i] == 3 for i in range(10)) and common[10] == common[11] == 0


def test_clean_documents_lose_the_common_lines(documents):
    rows = [(i, f"Same  LINE here\n\nown words number {i}\nsame line here", "en", "a") for i in range(10)]
    rows += [(20, "same line here\nx", "en", "a"), (21, None, "en", "a")]
    docs = documents(rows)
    found = clean_documents(docs, max_docs=3, min_words=2, min_left=0.4)
    assert found.columns == docs.columns
    assert {r.doc_id: r.text for r in found.collect()} == {i: f"\nown words number {i}" for i in range(10)}


def test_awkward_rows(awkward, no_documents):
    found = line_rules(awkward, max_docs=0, max_share=0.0, min_words=1)
    assert results(found) == plain_rules([(r.doc_id, r.text, r.source) for r in awkward.collect()], 0, 0.0, 0.5, 1)
    assert line_rules(no_documents).count() == clean_documents(no_documents).count() == 0
    assert clean_documents(awkward, min_words=1).columns == awkward.columns


def test_repeated_words_count_the_first():
    assert repeated_words(b"a b c x a b c".split()) == 6
    assert repeated_words(b"a a a a".split()) == 4
    assert repeated_words(b"a b c".split()) == 0


@pytest.mark.parametrize("text", [None, "", " \n ", "é é\né é\n", "a|b <c>\r\na|b <c>\r\n"])
def test_measures(text):
    assert measures(None if text is None else text.encode())[0] == plain_counts(text)
