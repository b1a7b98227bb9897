"""Greedy string tiling next to the quadratic algorithm, and passages in another order."""

import random
import time

import corpus_pipeline
import pytest

from weftline.llm.decontamination import build_index, clean_documents, match_documents, tile
from weftline.llm.queries import QUERIES

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def plain_tiles(doc, item, least):
    """Greedy tiling as it is defined: all unmarked common runs, the longest first, ties by item and document place."""
    marked_doc, marked_item, tiles = set(), set(), []
    while True:
        best = None
        for q in range(len(item)):
            for p in range(len(doc)):
                n = 0
                while (
                    p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n]
                    and p + n not in marked_doc and q + n not in marked_item
                ):
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (p, q, n)
        if best is None:
            return tiles
        p, q, n = best
        tiles.append(best)
        marked_doc.update(range(p, p + n))
        marked_item.update(range(q, q + n))


@pytest.mark.parametrize("seed", range(12))
def test_tiling_equals_the_definition(seed):
    rng = random.Random(seed)
    letters = "abc" if seed % 2 else "abcdefghijkl"
    item = [rng.choice(letters) for _ in range(30)]
    doc = [rng.choice(letters) for _ in range(20)]
    for _ in range(3):
        a, n, at = rng.randint(0, 25), rng.randint(3, 12), rng.randint(0, len(doc))
        doc[at:at] = item[a : a + n]
    index = build_index([(1, " ".join(item))], seed_words=3)
    found = index.matches(" ".join(doc).encode(), 0.0)
    expected = plain_tiles(doc, item, 3)
    tiles = [(t["doc_first"], t["item_first"], t["length"]) for t in found[0]["tiles"]] if found else []
    assert sorted(tiles) == sorted(expected)
    if found:
        assert found[0]["coverage"] == pytest.approx(sum(n for _, _, n in expected) / 30)


def test_unmarked_pieces_compete_on():
    assert sorted(tile([(0, 0, 10), (100, 5, 12)], 3)) == [(0, 0, 5), (100, 5, 12)]
    assert tile([(0, 0, 2)], 3) == []


def benchmark(spark):
    return spark.createDataFrame([(1, ITEM), (2, "one two"), (3, None), (None, "no id but five or more words here")], "item_id bigint, text string")


def test_reordered_passages_are_caught(spark, documents):
    words = ITEM.split()
    moved = " ".join([*words[12:], "and", "then", *words[:12]])
    rows = [
        (1, f"before {ITEM.upper()}. after"), (2, f"x {moved} y"), (3, " ".join(words[:8]) + " something else"),
        (4, "one two"), (5, " ".join(reversed(words))), (6, "No id, but five or more words here!"),
    ]
    found = match_documents(documents(rows), benchmark(spark)).collect()
    matches = {r["row"]["doc_id"]: [(m.item_id, m.coverage, len(m.tiles)) for m in r.matches] for r in found}
    assert matches == {1: [(1, 1.0, 1)], 2: [(1, 1.0, 2)], 3: [], 4: [], 5: [], 6: [(None, 1.0, 1)]}
    clean = clean_documents(documents(rows), benchmark(spark))
    assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 5]


def test_blocks_of_the_benchmark_add_up(spark, documents):
    rng = random.Random(1)
    items = [(i, " ".join(rng.choice("abcdefghijklmnop") * 2 for _ in range(12))) for i in range(30)]
    docs = documents([(i, f"start {items[i % 30][1]} middle {items[(i * 7 + 1) % 30][1]} end") for i in range(40)])
    table = spark.createDataFrame(items, "item_id bigint, text string")

    def results(**settings):
        rows = match_documents(docs, table, **settings).collect()
        return sorted((r["row"]["doc_id"], sorted((m.item_id, m.coverage) for m in r.matches)) for r in rows)

    assert results(block_words=60) == results()
    assert all(len(found) == 2 for i, found in results() if i % 30 != (i * 7 + 1) % 30)


def test_awkward_rows(spark, awkward, no_documents):
    found = match_documents(awkward, benchmark(spark))
    assert found.count() == awkward.count() and found.filter("size(matches) > 0").count() == 0
    assert clean_documents(awkward, benchmark(spark)).columns == awkward.columns
    assert clean_documents(no_documents, benchmark(spark)).count() == 0
    nothing = benchmark(spark).filter("false")
    assert clean_documents(awkward, nothing).count() == awkward.count()


def test_short_items_are_found_as_a_whole(spark, documents, tmp_path):
    items = [(1, ITEM), (2, "one two"), (3, "日本語のテキスト"), (4, "three"), (5, None), (6, "?!")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, "zero One, two"), (2, "two one"), (3, "a 日本語のテキスト。 日本語のテキスト"), (4, "one three two"), (5, ITEM), (6, ""), (7, "? !")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op10_benchmark_matches"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.item_id, r.coverage, r.n_words, r.n_tiles) for r in found) == [
        (1, 2, 1.0, 2, 1), (3, 3, 1.0, 1, 1), (4, 4, 1.0, 1, 1), (5, 1, 1.0, 20, 1)
    ]
    clean = dict(corpus_pipeline.STAGES)["decontamination"](spark, documents(rows), str(tmp_path))
    assert sorted(r.doc_id for r in clean.collect()) == [1, 2, 4, 6, 7]  # two short words are reported, not dropped


def test_common_seeds_cost_little():
    prompt = "please answer the following question in one word only"
    index = build_index((i, f"{prompt} " + " ".join(f"q{i}w{j}" for j in range(22))) for i in range(20_000))
    text = f"{prompt} {' '.join(f'x{j}' for j in range(50))}".encode()
    start = time.process_time()
    assert index.matches(text, 0.6) == []
    assert time.process_time() - start < 0.2  # a loop over the places takes above 0.4
    index = build_index([(1, "a " * 100)])
    start = time.process_time()
    assert [m["coverage"] for m in index.matches(b"a " * 20_000, 0.6)] == [1.0]
    assert time.process_time() - start < 2  # a loop over the places takes above 4
