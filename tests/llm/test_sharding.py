"""Uniform shards: exact sizes, whole rows, even frequencies."""

import zlib
from collections import Counter
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm.sharding import (
    communication_matrix, hypergeometric, shard_sizes, shuffle_into_shards, sizes_and_hashes, write_shards,
)


def test_matrix_has_exact_sums():
    parts = [0, 7, 1000, 3, 99_999, 1]
    sizes = shard_sizes(sum(parts), 24)
    matrix = communication_matrix(parts, sizes, 42)
    assert matrix.sum(axis=1).tolist() == parts and matrix.sum(axis=0).tolist() == sizes and (matrix >= 0).all()
    assert communication_matrix([], shard_sizes(0, 24), 1).shape == (0, 24)
    assert (communication_matrix(parts, sizes, 42) == matrix).all()


def test_matrix_follows_the_law():
    draws = Counter(int(communication_matrix([3, 5], [4, 4], seed)[0, 0]) for seed in range(4000))
    for k in range(4):
        p = comb(4, k) * comb(4, 3 - k) / comb(8, 3)
        assert abs(draws[k] / 4000 - p) < 4 * (p * (1 - p) / 4000) ** 0.5


def test_large_urns(monkeypatch):
    rng = np.random.default_rng(1)
    good, bad, n = 3 * 10**10, 10**10, 10_000
    found = np.array([hypergeometric(rng, good, bad, n) for _ in range(2000)])
    assert abs(found.mean() - 7500) < 4 * (1875 / 2000) ** 0.5 and abs(found.var() / 1875 - 1) < 0.15
    assert hypergeometric(rng, 0, good, 5) == 0 and hypergeometric(rng, good, 0, 5) == 5 and hypergeometric(rng, good, bad, 0) == 0
    monkeypatch.setattr("weftline.llm.sharding.URN", 0)
    small = Counter(hypergeometric(rng, 4, 4, 3) for _ in range(4000))
    assert all(abs(small[k] / 4000 - comb(4, k) * comb(4, 3 - k) / 56) < 0.035 for k in range(4))


def shards_of(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.shard, r.slot)):
        out.setdefault(r.shard, []).append(r)
    for own in out.values():
        assert [r.slot for r in own] == list(range(len(own)))
    return out


def test_every_row_once(spark, awkward, no_documents):
    out = shards_of(shuffle_into_shards(awkward, shards=5))
    sizes = [len(own) for own in out.values()]
    assert sum(sizes) == awkward.count() and max(sizes) - min(sizes) <= 1
    key = lambda r: str((r["doc_id"], (r["text"] or "")[:80], r["row"], r["n_chars"]))
    assert sorted(key(r.row) for own in out.values() for r in own) == sorted(key(r) for r in awkward.collect())
    assert shuffle_into_shards(no_documents).collect() == []


def test_places_are_even(spark):
    n, shards = 40, 4
    rows = spark.range(n).repartition(3)
    hits = np.zeros((n, shards))
    for seed in range(12):
        for shard, own in shards_of(shuffle_into_shards(rows, shards, seed, max_parts=2)).items():
            assert len(own) == n // shards
            for r in own:
                hits[r.row.id, shard] += 1
    assert hits.sum(axis=0).tolist() == [12 * n / shards] * shards
    assert ((hits - 3) ** 2 / 3).sum() < 220  # 120 degrees of freedom


def test_repeats_itself_and_writes(spark, tmp_path):
    rows = spark.range(0, 500, 1, 7)
    once = [[r.row.id for r in own] for own in shards_of(shuffle_into_shards(rows, 3)).values()]
    found = shuffle_into_shards(rows, 3)
    assert once == [[r.row.id for r in own] for own in shards_of(found).values()]
    write_shards(found, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert [[r.id for r in sorted(back.filter(F.col("shard") == s).collect(), key=lambda r: r.slot)] for s in range(3)] == once


@pytest.mark.parametrize("text", [None, "", "café \U0001f600", "x" * 100_000])
def test_sizes_and_hashes(spark, text):
    row = spark.createDataFrame([(text,)], "text string").select(*sizes_and_hashes("text")).first()
    assert tuple(row) == (len((text or "").encode()) + 8, zlib.crc32((text or "").encode()))
