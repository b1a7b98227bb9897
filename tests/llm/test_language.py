"""The conditional random field next to sums over all label paths, and its accuracy on held-out documents."""

import itertools
import os

import numpy as np
import pytest

from weftline.llm import language
from weftline.llm.language import UNKNOWN, fit, fit_documents, held_out, identify, in_a_language, marginals

SF_DIR = "/root/testdata/sf0.01"


def all_paths(potential, transition):
    n, k = potential.shape
    out = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        weight = sum(transition[s, path[0]] for s in range(k)) / k
        for t, label in enumerate(path):
            weight *= potential[t, label] * (transition[path[t - 1], label] if t else 1.0)
        for t, label in enumerate(path):
            out[t, label] += weight
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("step", [2, 3, 256])
def test_marginals_equal_all_paths(monkeypatch, step):
    monkeypatch.setattr(language, "STEP", step)
    rng = np.random.default_rng(step)
    lengths = np.array([5, 0, 1, 7, 2])
    potential, transition = rng.random((15, 3)) + 0.01, rng.random((3, 3)) + 0.01
    found = marginals(potential, lengths, transition)
    start = 0
    for n in lengths:
        if n:
            assert np.allclose(found[start : start + n], all_paths(potential[start : start + n], transition))
        start += n


SAMPLE = {
    "x": ["aka baka taka naka saka laka"] * 8,
    "y": ["ilo milo pilo tilo silo vilo"] * 8,
}


def test_code_switched_text_has_spans(documents):
    model = fit(SAMPLE)
    text = "taka naka baka aka saka taka ilo pilo milo silo tilo vilo 77"
    found = identify(documents([(1, text), (2, "naka"), (3, None), (4, "1 2 !")]), model, spans=True)
    rows = {r["row"]["doc_id"]: r for r in found.collect()}
    assert [(s.first, s.lang) for s in rows[1].spans] == [(0, "x"), (6, "y")]
    assert rows[1].spans[-1].end == 13
    assert rows[2].lang_pred == "x" and 0.5 < rows[2].score <= 1
    assert (rows[3].lang_pred, rows[3].score) == (rows[4].lang_pred, rows[4].score) == (UNKNOWN, 0.0)


def test_long_text_is_not_cut_short(documents):
    model = fit(SAMPLE)
    text = " ".join(["naka baka"] * 400 + ["milo pilo"] * 700)
    found = identify(documents([(1, text)]), model, spans=True).first()
    assert found.lang_pred == "y" and found.score == pytest.approx(1400 / 2200, abs=0.01)
    assert [(s.first, s.end) for s in found.spans] == [(0, 800), (800, 2200)]


def test_awkward_rows(awkward, no_documents):
    model = fit_documents(awkward)
    found = identify(awkward, model).collect()
    assert len(found) == awkward.count()
    assert {r["row"]["doc_id"] for r in found if r.lang_pred == UNKNOWN} == {1, 2, 3, 8, None}
    assert in_a_language(awkward, model, 0.0).columns == awkward.columns
    assert in_a_language(awkward, model, 0.0).count() == sum(r.lang_pred != UNKNOWN for r in found)
    assert identify(no_documents, fit_documents(no_documents)).count() == 0
    unlabelled = identify(awkward, fit_documents(no_documents)).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in unlabelled] == [(UNKNOWN, 0.0)]


def test_held_out_documents_do_not_train(spark, documents):
    rows = documents([(i, "word " * i) for i in range(1, 200)])
    own = {r.doc_id for r in rows.filter(~held_out("doc_id")).collect()}
    import zlib

    assert own == {i for i in range(1, 200) if zlib.crc32(str(i).encode()) % 5}
    sample = language.training_sample(rows.filter(~held_out("doc_id")), per_language=20)
    assert len(sample["en"]) == 20 and {len(t) // 5 for t in sample["en"]} <= own


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the benchmark tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = identify(docs, fit_documents(docs)).select("row.doc_id", "row.lang", "lang_pred")
    rows = found.filter(held_out("doc_id")).collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_repeated_rows_stay_out_of_the_driver(documents):
    """A document that is there thousands of times is one text of the sample, and a long one gives a piece."""
    rows = [(1, "the same words again", "en", "a")] * 3_000 + [(i, f"other words {i}", "en", "a") for i in range(2, 40)]
    rows += [(50, "lang " * 30_000, "xx", "a")]
    sample = language.training_sample(documents(rows), per_language=20, max_chars=1_000)
    assert len(sample["en"]) == 20 and sample["en"].count("the same words again") <= 1
    assert len(sample["xx"]) == 1 and len(sample["xx"][0]) == 1_000
