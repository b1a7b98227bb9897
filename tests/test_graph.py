import os
import random
from itertools import combinations

import pytest

from weftline.operators import graph
from weftline.operators.skew import salted_join
from weftline.session import bucketed, checkpoint_dir

SMALL = [(1, 2), (1, 2), (2, 3), (3, 1), (1, 4), (5, 5), (6, 7)]


def frames(spark, edges, kind="bigint"):
    df = spark.createDataFrame(edges, f"src {kind}, dst {kind}")
    return graph.graph_vertices(df), df


def plain_pagerank(edges, rounds):
    ids = {end for edge in edges for end in edge}
    out = {v: sum(a == v for a, _ in edges) for v in ids}
    rank = dict.fromkeys(ids, 1.0)
    for _ in range(rounds):
        rank = {v: 0.15 + 0.85 * sum(rank[a] / out[a] for a, b in edges if b == v) for v in ids}
    total = sum(rank.values())
    return {v: r * len(ids) / total for v, r in rank.items()}


def plain_components(edges):
    label = {end: end for edge in edges for end in edge}
    while True:
        before = dict(label)
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            return label


def plain_triangles(edges):
    pairs = {frozenset(edge) for edge in edges if edge[0] != edge[1]}
    count = {end: 0 for edge in edges for end in edge}
    for corners in combinations(count, 3):
        if all(frozenset(pair) in pairs for pair in combinations(corners, 2)):
            for corner in corners:
                count[corner] += 1
    return count


def as_dict(df):
    rows = df.collect()
    assert len({row[0] for row in rows}) == len(rows)
    return {row[0]: row[1] for row in rows}


def random_edges(seed, n, m):
    rng = random.Random(seed)
    return [(rng.randint(0, n), min(rng.randint(0, n), rng.randint(0, n))) for _ in range(m)]


def test_degrees(spark):
    vertices, edges = frames(spark, SMALL)
    assert as_dict(graph.out_degrees(edges)) == {1: 3, 2: 1, 3: 1, 5: 1, 6: 1}
    assert as_dict(graph.in_degrees(edges)) == {1: 1, 2: 2, 3: 1, 4: 1, 5: 1, 7: 1}
    assert graph.graph_size(edges).first() == (7, 7)
    assert [row.id for row in graph.top_by(graph.out_degrees(edges), "out_degree", 2).collect()] == [1, 2]


@pytest.mark.parametrize("edges", [SMALL, random_edges(1, 15, 50)])
def test_pagerank(spark, edges):
    got = as_dict(graph.pagerank(*frames(spark, edges), iterations=6, checkpoint_every=4, min_hot_rows=2))
    assert got == pytest.approx(plain_pagerank(edges, 6))
    assert sum(got.values()) == pytest.approx(len(got))


def test_pagerank_without_rounds(spark):
    assert set(as_dict(graph.pagerank(*frames(spark, SMALL), iterations=0)).values()) == {1.0}


PATH = [(i, i + 1) for i in range(60)]
SHUFFLED_PATH = [(i * 37 % 61, (i + 1) * 37 % 61) for i in range(60)]
STAR = [(50, i) for i in range(100, 130)] + [(i, 3) for i in range(100, 103)]


@pytest.mark.parametrize(
    "edges", [SMALL, SHUFFLED_PATH + [(70, 71)], STAR, random_edges(2, 80, 50)], ids=["small", "path", "star", "random"]
)
def test_components(spark, edges):
    assert as_dict(graph.connected_components(*frames(spark, edges))) == plain_components(edges)


def test_components_of_text_ids_and_loops(spark):
    edges = [("b", "a"), ("c", "b"), ("z", "z")]
    components = graph.connected_components(*frames(spark, edges, "string"))
    assert as_dict(components) == {"a": "a", "b": "a", "c": "a", "z": "z"}
    assert as_dict(graph.component_sizes(components)) == {"a": 3, "z": 1}


def test_components_without_links(spark):
    assert as_dict(graph.connected_components(*frames(spark, [(5, 5)]))) == {5: 5}


@pytest.mark.parametrize("block", [1, 2, 1_000])
@pytest.mark.parametrize("edges", [SMALL, random_edges(3, 18, 90)])
def test_triangles(spark, edges, block):
    got = as_dict(graph.triangle_count(*frames(spark, edges), block=block))
    assert got == plain_triangles(edges)
    assert sum(got.values()) % 3 == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_join(spark, how):
    rng = random.Random(5)
    big = spark.createDataFrame([(rng.choice("aaaaabbc"), i) for i in range(80)], "k string, x bigint")
    small = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("d", 4)], "k string, y bigint")
    got = salted_join(big, small, "k", spread=["x"], how=how, min_hot_rows=5)
    assert sorted(got.collect(), key=repr) == sorted(big.join(small, "k", how).collect(), key=repr)


def test_salted_join_refuses_other_joins(spark):
    with pytest.raises(ValueError):
        salted_join(spark.range(1), spark.range(1), "id", spread=["id"], how="outer")


def test_a_star_with_edges_between_its_leaves_stays_in_blocks(spark):
    edges = [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(1, 59)] + [(i, i + 7) for i in range(1, 52)]
    vertices, table = frames(spark, edges)
    found = graph.triangle_count(vertices, table, block=4)
    assert as_dict(found) == plain_triangles(edges)


def test_rounds_leave_one_table(spark):
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    graph.connected_components(*frames(spark, SHUFFLED_PATH)).collect()
    assert len([name for name in set(os.listdir(folder)) - before if name.startswith("links-")]) == 1


def test_edges_in_buckets_are_not_shuffled_again(spark):
    """The join of a PageRank round: an exchange on the side of the ranks, none above the scan of the edges."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges, drop = bucketed(spark.createDataFrame([(1, 2, 0), (2, 1, 0)], "src bigint, dst bigint, salt int"), "edges", ["src", "salt"], width)
    shares = spark.createDataFrame([(1, 0, 1.0)], "src bigint, salt int, share double")
    joined = edges.join(shares.hint("shuffle_hash"), ["src", "salt"])
    assert joined.count() == 1
    plan = joined._jdf.queryExecution().executedPlan().toString()
    edge_side = plan[plan.index("weftline_edges") - 400 : plan.index("weftline_edges")].rsplit("ShuffledHashJoin", 1)[-1]
    assert "Exchange" not in edge_side and "Bucketed: true" in plan and "Cached" not in plan
    drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("weftline_edges")]


def test_rounds_of_the_component_search_shrink(spark, monkeypatch):
    """Leaves are put aside: no round writes as many rows as the one before."""
    written = []
    store = graph.store_counted

    def counted(df, name, **sums):
        table, path, seen = store(df, name, **sums)
        written.extend([seen["n"]] if name == "links" else [])
        return table, path, seen

    monkeypatch.setattr(graph, "store_counted", counted)
    edges = [(1_000 + i, i % 40) for i in range(400)] + [(i, (i * 7 + 3) % 40) for i in range(40)] + [(900, i) for i in range(0, 40, 9)]
    assert as_dict(graph.connected_components(*frames(spark, edges))) == plain_components(edges)
    assert len(written) > 1 and all(after < before for before, after in zip(written, written[1:]))


@pytest.mark.parametrize("hot", [0, 5])
def test_components_with_salted_joins(spark, monkeypatch, hot):
    monkeypatch.setattr(graph, "MIN_HOT_ROWS", hot)
    edges = STAR + [(200 + i, 100 + i % 7) for i in range(40)] + [(i, 300) for i in range(200, 210)]
    assert as_dict(graph.connected_components(*frames(spark, edges))) == plain_components(edges)
