"""Near-duplicates next to a comparison of all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from weftline.llm.simhash import fingerprint, links, near_duplicates, one_of_each_group


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(points):
    """Smallest index of each point's group; points within two bits are linked."""
    points = np.array(points, np.uint64)
    root = list(range(len(points)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 2):
            a, b = sorted((find(i), find(int(j))))
            root[b] = a
    return [find(i) for i in range(len(points))]


@pytest.mark.parametrize("text", [None, "", "One", "a b", "A b C", "a b c d " * 40, "É ÀB c", LONG := "x y z w " * 30_000])
def test_fingerprints(text):
    assert fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


def near_points(n, seed):
    """Random points with chains and crowds around them."""
    rng = random.Random(seed)
    points = [rng.getrandbits(64) for _ in range(n)]
    for i in range(n):
        point = points[i]
        for _ in range(rng.choice([0, 0, 1, 3, 25])):
            for bit in rng.sample(range(64), rng.choice([1, 2, 2, 3])):
                point ^= 1 << bit
            points.append(point)
    return list(dict.fromkeys(points))


@pytest.mark.parametrize("shard_size", [1, 4, 512])
def test_links_join_what_all_pairs_join(spark, shard_size):
    points = near_points(60, 5)
    signed = np.array(points, np.uint64).view(np.int64).tolist()
    found = links(spark.createDataFrame([(p,) for p in signed], "fp bigint"), shard_size).collect()
    place = {p: i for i, p in enumerate(signed)}
    root = list(range(len(points)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for r in found:
        assert bin((r.src ^ r.dst) & (1 << 64) - 1).count("1") <= 2
        a, b = sorted((find(place[r.src]), find(place[r.dst])))
        root[b] = a
    assert [find(i) for i in range(len(points))] == plain_groups(points)


def test_components_of_documents(documents):
    rng = random.Random(2)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(200)) for _ in range(12)]
    rows = []
    for i in range(80):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(200)] = "changed"
        rows.append((100 - i, " ".join(words)))
    found = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in near_duplicates(documents(rows)).collect()}
    rows.sort()
    points = [plain_fingerprint(t) for _, t in rows]
    groups = plain_groups(points)
    assert found == {i: (p, rows[g][0]) for (i, _), p, g in zip(rows, points, groups, strict=True)}
    kept = [r.doc_id for r in one_of_each_group(documents(rows)).collect()]
    assert sorted(kept) == sorted({rows[g][0] for g in groups})


def test_awkward_rows(awkward, no_documents):
    found = near_duplicates(awkward).collect()
    assert len(found) == awkward.count()
    empty = {r.component_id for r in found if r.fp == 0}
    assert empty == {1}
    kept = one_of_each_group(awkward)
    assert kept.columns == awkward.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == [1, 4, 5, 5, 6, 8, 9, None]
    assert near_duplicates(no_documents).count() == 0
    assert one_of_each_group(no_documents).columns == no_documents.columns
