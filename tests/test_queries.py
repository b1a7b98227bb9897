"""Every named query next to its SQL, and the plans behind the queries."""

import os
import re

import pytest
from check_oracle import compare, connect

from __spark_entry__ import entry
from weftline.plans.catalog import QUERIES
from weftline.plans.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the benchmark tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    good, note = compare(spark, con, SF_DIR, name)
    assert good, note


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["query_id", "doc_id", "score", "rank", "title"]


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


LAZY = [
    "tfidf", "doc_norms", "search_cosine_topk", "search_with_titles", "mutual_friend_counts", "recommend_topk",
    "nb_predict", "triangle_counts", "graph_vertices", "word_class_counts",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python_rows(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert operator not in text


@pytest.mark.parametrize("name", ["search_cosine_topk", "recommend_topk", "nb_predict"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    cut = re.search(r"WindowGroupLimit.*Partial", text)
    assert cut and "Exchange" in text[:cut.start()]


def test_only_needed_columns_are_read(spark):
    text = plan(spark, "in_degrees")
    assert "ReadSchema: struct<l_suppkey:bigint>" in text


def test_texts_are_split_once_for_the_index(spark):
    df = QUERIES["tfidf"](spark, SF_DIR)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
