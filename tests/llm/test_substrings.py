"""Repeated passages next to a dictionary of all windows."""

import random
import re

import numpy as np
import pytest

from weftline.llm.substrings import PIECE, WINDOW, pieces_of, remove_repeats, runs_of, windows_of
from weftline.session import checkpoint_dir, folder_names, freed_afterwards


def plain_removal(rows):
    """{row place: kept words} for (doc_id, text) rows."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    ids = [float("inf") if doc_id is None else doc_id for doc_id, _ in rows]
    first = {}
    for own, doc_id in zip(words, ids, strict=True):
        for i in range(len(own) - WINDOW + 1):
            window = tuple(own[i : i + WINDOW])
            first[window] = min(first.get(window, doc_id), doc_id)
    out = []
    for (doc_id, _), own, rank in zip(rows, words, ids, strict=True):
        gone = set()
        for i in range(len(own) - WINDOW + 1):
            if first[tuple(own[i : i + WINDOW])] < rank:
                gone.update(range(i, i + WINDOW))
        out.append((doc_id, len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone)))
    return sorted(out, key=repr)


def results(found):
    return sorted((tuple(r) for r in found.select("row.doc_id", "n_words", "n_removed", "kept").collect()), key=repr)


def passages(seed, n, small=False):
    rng = random.Random(seed)
    letters = "ab" if small else "abcdefghijklmnopqrstuvwxyz"

    def some(k):
        return [rng.choice(letters) * rng.randint(1, 2) for _ in range(k)]

    shared = [some(rng.choice([49, 50, 51, 60, 140])) for _ in range(6)]
    rows = []
    for i in range(n):
        own = some(rng.randint(0, 60))
        for passage in rng.sample(shared, rng.randint(0, 3)):
            a = rng.randint(0, 5)
            own += passage[a:] + some(rng.randint(0, 30))
        rows.append((rng.randint(0, n), " ".join(own) if i % 3 else "\n".join(own)))
    return rows


@pytest.mark.parametrize("bucket_windows", [1, 40_000])
def test_removal_equals_the_dictionary(documents, bucket_windows):
    rows = passages(1, 60)
    assert results(remove_repeats(documents(rows), bucket_windows)) == plain_removal(rows)


@pytest.mark.parametrize("bucket_windows", [3, 40_000])
def test_few_different_words(documents, bucket_windows):
    rows = [*passages(2, 25, small=True), (3, "a " * 300), (9, "a " * 120), (1, "a " * 49), (2, "a b " * 60)]
    assert results(remove_repeats(documents(rows), bucket_windows)) == plain_removal(rows)


def test_awkward_rows(awkward, no_documents):
    assert results(remove_repeats(awkward)) == plain_removal([(r.doc_id, r.text) for r in awkward.collect()])
    assert remove_repeats(no_documents).count() == 0


def test_runs_hold_every_window_once():
    words = [str(i * i % 97).encode() for i in range(400)]
    mins, firsts, counts = runs_of(words)
    assert firsts[0] == 0 and (firsts[1:] == firsts[:-1] + counts[:-1]).all()
    assert firsts[-1] + counts[-1] == len(words) - WINDOW + 1
    assert (mins[1:] != mins[:-1]).all()
    joined = b" ".join(words[:60])
    assert windows_of(joined) == [b" ".join(words[i : i + WINDOW]) for i in range(11)]


def test_one_word_again_and_again(documents):
    """Long runs are cut into equal pieces: the memory of a bucket follows its windows, which are few different ones."""
    word = "word" + "x" * 20
    long = " ".join([word] * 200_000)
    found = remove_repeats(documents([(1, long), (2, long + " end"), (3, "start " + long)])).collect()
    counts = {r["row"]["doc_id"]: (r.n_words, r.n_removed) for r in found}
    assert counts == {1: (200_000, 0), 2: (200_001, 200_000), 3: (200_001, 200_000)}


def test_pieces_cover_a_run_once():
    mins, firsts, counts = pieces_of(np.array([7, 8, 9]), np.array([0, 5000, 5001]), np.array([5000, 1, PIECE]))
    assert mins.tolist() == [7, 7, 7, 8, 9] and firsts.tolist() == [0, 2000, 4000, 5000, 5001]
    assert counts.tolist() == [2000, 2000, 1000, 1, 2000]


def test_no_tables_are_left_over(spark, documents, tmp_path):
    text = " ".join(f"w{i}" for i in range(80))
    tables = lambda: {n for n in folder_names(spark, checkpoint_dir(spark)) if "-" in n}
    before = tables()
    with freed_afterwards(spark):
        cut = remove_repeats(documents([(1, text), (2, text + " end")]), carry=["doc_id"])
        assert tables() > before
        cut.select("row.doc_id", "n_removed").write.parquet(str(tmp_path / "cut"))
    assert tables() == before
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "cut")).collect())) == [(1, 0), (2, 80)]
