"""The mix next to its SQL and to its own rules."""

import random
import re

import duckdb
import pandas as pd
import pytest

from weftline.llm.mixing import mix, mixed_documents, source_targets
from weftline.llm.oracle import ORACLE


def corpus(seed, n, sources):
    rng = random.Random(seed)
    return [(i, "w " * rng.choice([0, 1, 5, 40, 200]), "en", rng.choice(sources)) for i in range(n)]


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by sharing again and again, for [(source, size)] in order."""
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(sizes)}
    left, full = share * sum(n for _, n in sizes), {}
    while True:
        open_ = [(s, n) for s, n in sizes if s not in full]
        level = left / sum(weight[s] for s, _ in open_) if open_ else 0
        over = [(s, n) for s, n in open_ if weight[s] * level > most * n]
        if not over:
            return {s: full.get(s, weight[s] * level) for s, _ in sizes}
        for s, n in over:
            full[s] = most * n
            left -= most * n


@pytest.mark.parametrize("sizes", [[("a", 10), ("b", 1000), ("c", 5), ("d", 300), (None, 70)], [("a", 3)], [("a", 0), ("b", 0)]])
def test_targets(spark, sizes):
    table = spark.createDataFrame([(s, n, 1) for s, n in sizes], "source string, source_size bigint, n_docs bigint")
    found = {r.source: r.target for r in source_targets(table).collect()}
    assert found == pytest.approx(plain_targets(sizes))


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_equals_sql(documents, seed):
    rows = corpus(seed, 300, ["a", "a", "a", "a", "b", "c", "é", "Z", None])
    found = mix(documents(rows)).select("row.doc_id", "size", "source_size", "target", "taken").toPandas()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"]))
    expected = con.sql(ORACLE["op9_mixing"]).df()
    found["target"] = found["target"].round(6)
    key = ["doc_id"]
    found, expected = (t.sort_values(key).reset_index(drop=True)[found.columns] for t in (found, expected))
    pd.testing.assert_frame_equal(found, expected, check_dtype=False)


@pytest.mark.parametrize("settings", [{}, {"seats": 50}, {"shard_docs": 7}, {"shard_docs": 7, "max_block": 3}])
def test_sources_come_near_their_targets(documents, settings):
    rows = corpus(3, 400, ["a", "a", "a", "b", "c", "d", None])
    found = mix(documents(rows), **settings).select("row.doc_id", "size", "target", "taken", "copies").collect()
    source = {r[0]: r[3] for r in rows}
    taken, target = {}, {}
    for r in found:
        assert 0 <= r.taken <= 2 * r["size"] and all(0 <= c.first < c.end <= r["size"] for c in r.copies)
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        target[source[r.doc_id]] = r.target
    blocks = -(-sum(target.values()) // settings.get("seats", 100_000))
    n_shards = 1 if "shard_docs" not in settings else 40
    assert all(abs(taken[s] - target[s]) <= (min(blocks, settings.get("max_block", blocks)) + 1) * n_shards for s in target)


def taken_by_source(rows, docs, **settings):
    found = mix(docs, **settings).select("row.doc_id", "size", "target", "taken").collect()
    source, taken, target = {r[0]: r[3] for r in rows}, {}, {}
    for r in found:
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        target[source[r.doc_id]] = r.target
    return taken, target


def test_tiny_sources_beside_a_huge_one_meet_their_targets(documents):
    rows = [(i, "w " * 20_000, "en", "a") for i in range(100)]
    rows += [(1000 + i, "w " * (1 + i * 7), "en", f"tiny{i // 2:02}") for i in range(80)]
    taken, target = taken_by_source(rows, documents(rows), seats=100)
    assert all(abs(taken[s] - target[s]) <= max(1, target[s] / 64 + 1) for s in target if s != "a")
    assert abs(taken["a"] - target["a"]) <= sum(target.values()) / 100


@pytest.mark.parametrize("tiny", [5, 60, 3_000, 300_000])
def test_small_sources_equal_sql(documents, tiny):
    """On both sides of the limit below which a source is dealt in blocks of its own."""
    rows = [(i, "w " * 700, "en", "big") for i in range(1_500)]
    rows += [(10_000 + i, "v " * max(1, tiny // 4), "en", "small") for i in range(4)] + [(20_000, "", "en", "none")]
    docs = documents(rows)
    got = {(r.row.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mix(docs).collect()}
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas())
    assert got == set(con.sql(ORACLE["op9_mixing"]).fetchall())


def test_rows_without_an_id_spread_over_shards(documents):
    rows = [(None, f"w{i} x y z", "en", "a") for i in range(400)]
    got = mix(documents(rows), shard_docs=20, carry=["doc_id", "text"]).collect()
    assert len(got) == 400 and 0 < sum(r.taken for r in got) <= 2 * 4 * 400
    assert abs(sum(r.taken for r in got) - got[0].target) <= 32


def test_a_source_of_many_short_documents_meets_its_target(documents):
    rows = [(i, "w " * 20_000, "en", "a") for i in range(100)] + [(1000 + i, "w", "en", "b") for i in range(400)]
    taken, target = taken_by_source(rows, documents(rows), seats=10_000, shard_docs=4)
    assert target["b"] == 800 and abs(taken["b"] - 800) <= 800 / 64


def test_reruns_agree(documents):
    rows = corpus(4, 200, ["a", "b"])
    one = mix(documents(rows).repartition(7)).select("row.doc_id", "taken").collect()
    two = mix(documents(rows).repartition(2, "text")).select("row.doc_id", "taken").collect()
    assert sorted(one) == sorted(two)


def test_documents_of_the_mix(documents):
    rows = [(i, f"{i}-a  {i}-b\n{i}-c {i}-d ", "en", "ab"[i % 2]) for i in range(40)]
    docs = documents(rows)
    taken = {r.doc_id: r.taken for r in mix(docs).select("row.doc_id", "taken").collect()}
    found = mixed_documents(docs)
    assert found.columns == docs.columns
    words = {i: 0 for i in taken}
    for r in found.collect():
        assert r.text in rows[r.doc_id][1] and r.n_chars == len(r.text)
        words[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert words == taken


def test_awkward_rows(awkward, no_documents):
    found = mix(awkward).select("row.doc_id", "size", "taken").collect()
    assert len(found) == awkward.count() and all(r.taken <= 2 * r["size"] for r in found)
    assert {r["size"] for r in found if r.doc_id in (1, 2, 3)} == {0}
    assert mixed_documents(awkward).columns == awkward.columns and mixed_documents(awkward).count() > 0
    assert mix(no_documents).count() == 0
    empty = no_documents.sparkSession.createDataFrame([(1, "", "s"), (2, None, None)], "doc_id bigint, text string, source string")
    assert [r.taken for r in mix(empty).collect()] == [0, 0]
