"""Counts, components, sketches and messages that come in parts, next to the whole."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.operators import sketches, top_counts
from weftline.operators.graph import connected_components, graph_vertices
from weftline.operators.growing_graph import GrowingComponents
from weftline.session import folder_names
from weftline.streaming import messages as M


def partials_of(spark, rows):
    return spark.createDataFrame(
        [(p, k, n) for (p, k), n in Counter(rows).items()], "part string, key string, count bigint"
    )


@pytest.mark.parametrize("seed", range(4))
def test_top_counts_equal_full_counts(spark, seed):
    rng = random.Random(seed)
    keys = [f"k{i:03}" for i in range(200)] + [None]
    rows = [(f"p{rng.randint(0, 5)}", rng.choices(keys, [1 / (i + 1) for i in range(201)])[0]) for _ in range(2000)]
    for k in (1, 7, 500):
        got = [tuple(r) for r in top_counts.top_counts(partials_of(spark, rows), k).collect()]
        full = sorted(Counter(key for _, key in rows).items(), key=lambda kv: (-kv[1], kv[0] is not None, kv[0] or ""))
        assert got == full[:k]


def test_few_rows_of_the_partial_counts_are_moved(spark, tmp_path):
    rng = random.Random(9)
    keys = [f"k{i}" for i in range(5000)]
    rows = [(f"p{i % 4}", rng.choices(keys, [1 / (j + 1) ** 1.3 for j in range(5000)])[0]) for i in range(20_000)]
    whole = spark.createDataFrame(rows, "part string, key string")
    for part in ("p0", "p1", "p2", "p3"):  # a part at a time
        top_counts.write_partial_counts(whole.filter(F.col("part") == part), str(tmp_path), "part", "key")
    partials = spark.read.schema("key string, count bigint, part string").parquet(str(tmp_path))
    able, least = top_counts.candidates(partials, 10)
    asked = partials.filter(F.col("count") >= least).count()
    looked_up = partials.join(able, "key", "left_semi").count()
    assert 4 * 10 + asked + looked_up < partials.count() / 5
    assert [r.key for r in top_counts.top_counts(partials, 10).collect()] == [
        k for k, _ in sorted(Counter(k for _, k in rows).items(), key=lambda kv: (-kv[1], kv[0]))[:10]
    ]


def test_top_counts_of_nothing(spark):
    assert top_counts.top_counts(partials_of(spark, []), 5).collect() == []


def test_components_grow_as_a_full_run_has_them(spark, tmp_path):
    rng = random.Random(4)
    growing = GrowingComponents(spark, str(tmp_path / "g"))
    assert growing.labels().collect() == []
    seen = []
    for n in (60, 40, 30, 1):
        new = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(n)] + [(500 + n, 500 + n)]
        seen += new
        growing.append(spark.createDataFrame(new, "src bigint, dst bigint"))
        edges = spark.createDataFrame(seen, "src bigint, dst bigint")
        full = connected_components(graph_vertices(edges), edges)
        assert sorted(growing.labels().collect()) == sorted(full.collect())


def test_the_search_sees_only_contracted_edges(spark, tmp_path):
    growing = GrowingComponents(spark, str(tmp_path / "g"), "string")
    ring = [(f"a{i:03}", f"a{(i + 1) % 300:03}") for i in range(300)]
    growing.append(spark.createDataFrame(ring, "src string, dst string"))
    new = spark.createDataFrame([("a005", "a200"), ("a299", "b"), ("b", "c")], "src string, dst string")
    ends = growing._labelled(graph_vertices(new))
    assert sorted(map(tuple, growing.contract(new, ends).collect())) == [("a000", "b"), ("b", "c")]
    growing.append(new)
    labels = {r.id: r.component for r in growing.labels().collect()}
    assert len(labels) == 302 and set(labels.values()) == {"a000"}


def test_an_append_that_fails_is_not_seen(spark, tmp_path, monkeypatch):
    growing = GrowingComponents(spark, str(tmp_path / "g"))
    growing.append(spark.createDataFrame([(1, 2)], "src bigint, dst bigint"))
    with monkeypatch.context() as m:
        m.setattr("weftline.operators.growing_graph.make_folder", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            growing.append(spark.createDataFrame([(2, 3)], "src bigint, dst bigint"))
    assert sorted(growing.labels().collect()) == [(1, 1), (2, 1)]
    assert folder_names(spark, str(tmp_path / "g" / "records")) == ["1"]
    growing.append(spark.createDataFrame([(2, 3)], "src bigint, dst bigint"))
    assert sorted(growing.labels().collect()) == [(1, 1), (2, 1), (3, 1)]


def test_united_sketches(spark):
    rows = spark.range(60_000).select((F.col("id") % 3).alias("day"), ((F.col("id") * 7) % 40_000).cast("string").alias("word"))
    stored = sketches.distinct_sketches(rows, "day", "word")
    assert stored.count() == 3
    estimate = sketches.distinct_estimate(stored).first().estimate
    assert abs(estimate - 40_000) <= 3 * sketches.standard_error() * 40_000
    assert sketches.distinct_estimate(stored.limit(0)).first().estimate == 0


def test_rejected_messages_are_kept_with_a_reason(spark):
    good = {"id": "1", "author": "a", "created_utc": 1.5, "text": "x", "subreddit": None}
    values = {
        "good": json.dumps(good), "more": json.dumps({**good, "likes": 3, "deep": {"a": [1]}}), "few": "{}", "cut": '{"id": "1", "te',
        "list": "[1, 2]", "word": '"text"', "null": "null", "mistyped": json.dumps({**good, "created_utc": "soon"}), "none": None, "empty": "",
        "number": json.dumps({**good, "created_utc": 7}),
    }
    raw = spark.createDataFrame(list(values.items()), "key string, value string")
    reasons = {r.key: r.reason for r in M.judged_messages(raw).collect()}
    assert {k for k, r in reasons.items() if r is None} == {"good", "more", "few", "number"}
    assert reasons["none"] == "missing" and reasons["cut"] == reasons["empty"] == "no JSON"
    assert reasons["list"] == reasons["word"] == reasons["null"] == "no object"
    assert reasons["mistyped"] == "type of created_utc"
    judged = M.judged_messages(raw)
    accepted = M.accepted_messages(judged)
    assert accepted.schema.names == M.MESSAGE_SCHEMA.names
    assert accepted.count() + M.rejected_messages(judged).count() == len(values)
    assert accepted.filter("text = 'x'").select("created_utc").distinct().count() == 2
