"""The registered queries next to their SQL, and the pipeline next to plain versions of its stages."""

import inspect
import os

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from check_oracle import compare, connect
from test_decontamination import plain_tiles
from test_simhash import plain_fingerprint, plain_groups
from test_tokens import digests

from weftline.llm.decontamination import plain_words
from weftline.llm.language import UNKNOWN, fit_documents, identify
from weftline.llm.oracle import ORACLE
from weftline.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the benchmark tables")


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    good, note = compare(spark, connect(SF_DIR), SF_DIR, name)
    assert good, note


def test_the_five_stages():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "decontamination", "mixing", "token_files"]
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for _, f in corpus_pipeline.STAGES)
    assert set(ORACLE) <= set(QUERIES)


@needs_tables
def test_stages_equal_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = fit_documents(docs)
    kept, after = [docs.toPandas()], docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, after, SF_DIR).write.parquet(path)
        after = spark.read.parquet(path)
        kept.append(after.toPandas())
    raw, spoken, single, clean, mixed, tokens = kept

    label = {r["row"]["doc_id"]: (r.lang_pred, r.score) for r in identify(docs, model, carry=["doc_id"]).collect()}
    assert set(spoken.doc_id) == {i for i in raw.doc_id if label[i][0] != UNKNOWN and label[i][1] >= 0.3}

    rows = sorted(zip(spoken.doc_id, spoken.text, strict=True))
    groups = plain_groups([plain_fingerprint(t) for _, t in rows])
    assert sorted(single.doc_id) == sorted({int(rows[g][0]) for g in groups})

    items = [plain_words(t.encode()) for t in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").toPandas().text]
    grams = [{tuple(item[i : i + 5]) for i in range(len(item) - 4)} for item in items]
    leaks = set()
    for doc_id, text in zip(single.doc_id, single.text, strict=True):
        words = plain_words(text.encode())
        own = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        for item, seeds in zip(items, grams, strict=True):
            if own & seeds and sum(n for _, _, n in plain_tiles(words, item, 5)) >= 0.6 * len(item):
                leaks.add(doc_id)
    assert set(clean.doc_id) == set(single.doc_id) - leaks

    con = duckdb.connect()
    con.register("documents", clean)
    taken = con.sql(ORACLE["op9_mixing"]).df().set_index("doc_id").taken
    words = mixed.text.map(lambda t: len(t.encode().split())).groupby(mixed.doc_id).sum()
    assert words.to_dict() == taken[taken > 0].to_dict()
    assert list(mixed.columns) == list(raw.columns)

    ends = tokens.sort_values("start")
    assert (ends.doc_id.diff().dropna() >= 0).all()
    assert (ends.start.to_numpy() == np.concatenate([[0], ends.n_tokens.cumsum()[:-1]])).all()
    expected = digests(sorted(zip(mixed.doc_id.tolist(), mixed.text, strict=True)))
    got = zip(tokens.doc_id, tokens.n_tokens, tokens.ids_crc32, strict=True)
    assert sorted(got) == sorted((i, n, crc) for i, _, n, crc in expected)


def test_awkward_rows_pass_through_every_stage(spark, awkward, no_documents, tmp_path):
    spark.createDataFrame([(1, "never seen in any of these documents at all")], "item_id bigint, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    for docs in (awkward, no_documents):
        after = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, after, str(tmp_path))
            assert after.columns == docs.columns
            after.count()
        assert corpus_pipeline.STAGES[-1][1](spark, after, str(tmp_path)).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
