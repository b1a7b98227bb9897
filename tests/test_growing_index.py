"""Blocks and segments give the rows of the plain index."""

import os
import random

import pytest
from pyspark.sql import functions as F
from test_search import brute_force, same

from weftline.operators import blocks, search
from weftline.operators.segments import SegmentedIndex
from weftline.plans import tables
from weftline.session import folder_names, materialise

SF_DIR = "/root/testdata/sf0.01"

SCHEMA, ASKED = "doc_id string, text string", "query_id string, text string"


def corpus(n, seed=3, n_words=40):
    rng = random.Random(seed)
    words = ["w" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(n_words)]
    weights = [1 / (i + 1) for i in range(n_words)]
    docs = [(f"{i:04}", " ".join(rng.choices(words, weights, k=rng.choice((0, 3, 8, 30, 120))))) for i in range(n)]
    return docs, [(f"q{i}", " ".join(rng.sample(words, rng.randint(2, 5)))) for i in range(12)]


def found(df):
    out = {}
    for row in df.orderBy("query_id", "rank").collect():
        out.setdefault(row.query_id, []).append((row.doc_id, row.score))
    return out


@pytest.mark.parametrize("block_docs", [1, 7, 128])
def test_blocks_equal_brute_force(spark, tmp_path, block_docs):
    docs, queries = corpus(150)
    index = search.build_index(spark.createDataFrame(docs, SCHEMA), stop_words=())
    blocks.BlockIndex.save(index, str(tmp_path), block_docs, buckets=4)
    loaded = blocks.BlockIndex.load(spark, str(tmp_path))
    assert loaded.blocks.agg(F.max("n")).first()[0] <= block_docs
    asked = spark.createDataFrame([*queries, ("none", "never seen"), ("one", "waa"), ("empty", "")], ASKED)
    same(found(blocks.search_blocks(asked, loaded, 5, stop_words=(), first_blocks=2)), brute_force(docs, queries, 5))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the benchmark tables")
def test_less_than_half_of_the_postings_is_read(spark, tmp_path):
    index = search.build_index(tables.documents(spark, SF_DIR)).checkpointed()
    blocks.BlockIndex.save(index, str(tmp_path))
    loaded = blocks.BlockIndex.load(spark, str(tmp_path))
    weighed = materialise(search.query_weights(tables.phrase_queries(spark, SF_DIR), loaded.terms))
    bounds = materialise(blocks.block_bounds(weighed, loaded.blocks))
    alive = blocks.blocks_that_can_win(bounds, weighed, loaded.blocks, 10, 20)
    read = blocks.blocks_read(alive, weighed, loaded.blocks).agg(F.sum("n")).first()[0]
    every = index.postings.join(weighed, "term").count()
    assert 0 < read < every / 2


def plain_index(docs, queries, k=5):
    return brute_force(docs, queries, k)


def test_segments_grow_shrink_and_merge(spark, tmp_path):
    docs, queries = corpus(120, seed=9)
    asked = spark.createDataFrame(queries, ASKED)
    index = SegmentedIndex(spark, str(tmp_path / "i"), "string", stop_words=(), fanout=3)
    assert index.snapshot().postings.count() == 0
    as_table = lambda rows: spark.createDataFrame(rows, SCHEMA)
    for first in range(0, 60, 20):
        index.append(as_table(docs[first : first + 20]))
    assert [tier for _, tier in index.segments()] == [1]  # three were merged
    index.append(as_table(docs[60:100]))
    index.delete(as_table(docs[5:70:7]).select("doc_id"))
    now = [d for i, d in enumerate(docs[:100]) if not (5 <= i < 70 and (i - 5) % 7 == 0)]
    same(found(search.search_cosine(asked, index.snapshot(), 5, stop_words=())), plain_index(now, queries))
    again = [(docs[5][0], "waa wab wac"), (docs[12][0], "")]
    index.append(as_table(again))
    now += again
    same(found(search.search_cosine(asked, index.snapshot(), 5, stop_words=())), plain_index(now, queries))
    index.append(as_table(docs[100:]))
    now += docs[100:]
    assert [tier for _, tier in index.segments()] == [1, 1]
    same(found(search.search_cosine(asked, index.snapshot(), 5, stop_words=())), plain_index(now, queries))
    index.vacuum()
    assert len(folder_names(spark, str(tmp_path / "i" / "postings"))) == 2
    assert len(folder_names(spark, str(tmp_path / "i" / "versions"))) == 1
    same(found(search.search_cosine(asked, index.snapshot(), 5, stop_words=())), plain_index(now, queries))


def test_a_change_that_fails_leaves_the_version_before(spark, tmp_path, monkeypatch):
    docs, _ = corpus(20)
    index = SegmentedIndex(spark, str(tmp_path), "string", stop_words=())
    index.append(spark.createDataFrame(docs[:10], SCHEMA))
    before = sorted(index.counts()[0].collect())
    with monkeypatch.context() as m:
        m.setattr(index, "_publish", lambda version: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            index.append(spark.createDataFrame(docs[10:], SCHEMA))
    assert sorted(index.counts()[0].collect()) == before
    index.append(spark.createDataFrame(docs[10:], SCHEMA))
    assert index.counts()[1].count() == 20


def test_old_texts_are_not_read_again(spark, tmp_path):
    docs, _ = corpus(20)
    first = str(tmp_path / "texts")
    spark.createDataFrame(docs[:10], SCHEMA).write.parquet(first)
    index = SegmentedIndex(spark, str(tmp_path / "i"), "string", stop_words=(), fanout=2)
    index.append(spark.read.schema(SCHEMA).parquet(first))
    from weftline.session import drop_stored

    drop_stored(spark, first)
    index.append(spark.createDataFrame(docs[10:], SCHEMA))  # merges the first segment
    index.delete(spark.createDataFrame(docs[:1], SCHEMA).select("doc_id"))
    assert index.counts()[1].count() == 19


def test_a_segment_is_written_without_another_shuffle(spark, tmp_path, monkeypatch):
    """Limits of ranges would have the counts computed a second time, and moved."""
    docs, queries = corpus(40)
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.repartitionByRange", lambda *_: 1 / 0)
    index = SegmentedIndex(spark, str(tmp_path), "string", stop_words=(), fanout=2)
    index.append(spark.createDataFrame(docs[:20], SCHEMA))
    index.append(spark.createDataFrame(docs[20:], SCHEMA))  # merges both
    assert [tier for _, tier in index.segments()] == [1]
    same(found(search.search_cosine(spark.createDataFrame(queries, ASKED), index.snapshot(), 5, stop_words=())), brute_force(docs, queries, 5))


def test_the_ranges_of_blocks_are_found_in_stored_rows(spark, tmp_path, monkeypatch):
    plans = []
    write = blocks.write_by_term

    def seen(rows, *args, **options):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        write(rows, *args, **options)

    monkeypatch.setattr(blocks, "write_by_term", seen)
    blocks.BlockIndex.save(search.build_index(spark.createDataFrame(corpus(30)[0], SCHEMA), stop_words=()), str(tmp_path), 7, buckets=2)
    assert len(plans) == 1 and "Join" not in plans[0]
