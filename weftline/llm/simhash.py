"""SimHash near-duplicates, found by a vantage-point tree over Hamming distance.

A node of the tree compares fingerprints with a vantage point.  By the triangle bound, fingerprints that
differ in ``r`` bits have distances to the point that differ by ``r`` at most.  Here each of the eight levels
measures the distance on its own eight bits.  Distances on separate bits add up to the Hamming distance, so
the *sum over all levels* of the differences is bounded by ``r``: the branches left by this bound are few.

With ``r = 2`` two linked fingerprints either lie in the same leaf shard, or a shard at most one step away
from each of them holds both.  So every fingerprint goes to its own shard and, across one boundary, to the
shards next to it: 17 copies at most.  Shards are compared pair by pair.  A shard of more than ``shard_size``
fingerprints is not compared: its members go down to levels of one bit each, where a shard is a point with
all that is at most one bit away.  It cannot hold more than 65, and all of them are linked, so that the way
for crowded shards is exact, linear and needs no pairs at all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import binary_texts, map_in_arrow, per_batch
from weftline.operators.graph import connected_components
from weftline.session import stored

SEED = 42
SHINGLE = 3
BITS = 64
LEVEL_BITS = 8
VANTAGE = 0x1E3779B97F4A7C15
PART = 1 << 16


def fingerprint(text: bytes | None) -> int:
    """SimHash of the word shingles of a text as an unsigned number; 0 for a text without words."""
    words = [] if text is None else text.lower().split()
    if not words:
        return 0
    ones, total = np.zeros(BITS, np.int64), 0
    digest = xxhash.xxh64_intdigest
    last = max(1, len(words) - SHINGLE + 1)
    for low in range(0, last, PART):
        part = words[low : min(low + PART, last) + SHINGLE - 1]
        if len(part) <= SHINGLE:
            hashes = [digest(b" ".join(part), SEED)]
        else:
            hashes = [digest(b" ".join(three), SEED) for three in zip(part, part[1:], part[2:], strict=False)]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            counts = np.bincount(octets[:, k], minlength=256)
            ones[8 * k : 8 * k + 8] += counts @ _BITS_OF_OCTET
        total += len(hashes)
    return int(((2 * ones > total).astype(np.uint64) << np.arange(BITS, dtype=np.uint64)).sum())


_BITS_OF_OCTET = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


@per_batch
def _fingerprints(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = _signed([fingerprint(text) for text in binary_texts(batch.column("text"))])
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("tie"), pa.array(found, pa.int64())], ["doc_id", "tie", "fp"]
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, fp) for each row of ``docs(doc_id, text)``; ``tie`` is a hash of the text."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    return map_in_arrow(texts, _fingerprints, "doc_id bigint, tie bigint, fp bigint")


def shard_keys(fp: Column) -> Column:
    """Shards of a fingerprint: its distance to the vantage point on each level, and one step beside it.

    Distances are 0 to 8 and take four bits of the key each.
    """
    apart = fp.bitwiseXOR(F.lit(VANTAGE))
    distances = [
        F.bit_count(F.shiftrightunsigned(apart, j * LEVEL_BITS).bitwiseAND(F.lit(255)))
        for j in range(BITS // LEVEL_BITS)
    ]
    own = sum((d.cast("bigint") * F.lit(16**j) for j, d in enumerate(distances)), F.lit(0).cast("bigint"))
    beside = [F.when(d > 0, own - F.lit(16**j)) for j, d in enumerate(distances)]
    beside += [F.when(d < LEVEL_BITS, own + F.lit(16**j)) for j, d in enumerate(distances)]
    return F.array_compact(F.array(own, *beside))


def point_keys(fp: Column) -> Column:
    """The fingerprint and all that differ from it in one bit."""
    bits = [F.lit(1 << j if j < 63 else -(1 << 63)).cast("bigint") for j in range(BITS)]
    return F.array(fp, *[fp.bitwiseXOR(bit) for bit in bits])


@per_batch
def _links_in_shards(batch: pa.RecordBatch) -> pa.RecordBatch:
    src, dst = [], []
    for value in batch.column("members"):
        members = value.values.to_numpy(zero_copy_only=False).view(np.uint64)
        near = np.bitwise_count(members[:, None] ^ members) <= 2
        root = np.arange(len(members))
        for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True):
            if root[i] != root[j]:
                root[root == root[j]] = root[i]
                src.append(members[i])
                dst.append(members[j])
    return pa.RecordBatch.from_arrays(
        [pa.array(_signed(src), pa.int64()), pa.array(_signed(dst), pa.int64())], ["src", "dst"]
    )


def links(points: DataFrame, shard_size: int = 512) -> DataFrame:
    """(src, dst): links that join all of ``points(fp)``, distinct, that chains of at most two bits a step join.

    Links that close a circle within a shard are left out.
    """
    keyed = points.select("fp", F.explode(shard_keys(F.col("fp"))).alias("key"))
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    met = stored(keyed.join(counts, "key"), "shards")
    shards = met.filter(F.col("n") <= shard_size).groupBy("key").agg(F.collect_list("fp").alias("members"))
    compared = map_in_arrow(shards.select("members"), _links_in_shards, "src bigint, dst bigint")
    crowded = met.filter(F.col("n") > shard_size).select("fp").distinct()
    points_near = crowded.select("fp", F.explode(point_keys(F.col("fp"))).alias("key"))
    low = points_near.groupBy("key").agg(F.min("fp").alias("src"), F.collect_list("fp").alias("members"))
    joined = low.select("src", F.explode("members").alias("dst")).filter("src <> dst")
    return compared.unionAll(joined).distinct()


def near_duplicates(docs: DataFrame, shard_size: int = 512) -> DataFrame:
    """(doc_id, tie, fp, component, component_id) for each row of ``docs(doc_id, text)``.

    ``component`` names the group of linked fingerprints, ``component_id`` is the smallest doc_id in it.
    Exact copies meet as one fingerprint before anything is compared.  Null and empty texts have fingerprint 0.
    Rows with an equal or a null id each count for themselves; a null id is never the smallest, and a group of
    null ids has a null component_id.
    """
    marked = stored(fingerprints(docs), "fingerprints")
    points = marked.groupBy("fp").agg(F.min("doc_id").alias("lowest"))
    edges = stored(links(points.select("fp"), shard_size), "links")
    ends = edges.select(F.col("src").alias("id")).unionAll(edges.select(F.col("dst").alias("id")))
    linked = connected_components(ends, edges).withColumnRenamed("id", "fp")
    groups = stored(
        points.join(linked, "fp", "left").select("fp", "lowest", F.coalesce("component", "fp").alias("component")),
        "groups",
    )
    lowest = groups.groupBy("component").agg(F.min("lowest").alias("component_id"))
    named = groups.select("fp", "component").join(lowest, "component")
    return marked.join(named, "fp").select("doc_id", "tie", "fp", "component", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def one_of_each_group(docs: DataFrame, shard_size: int = 512) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest id, then text hash.

    Equal rows are one document.  All columns of ``docs`` are returned.
    """
    return first_of_each_group(docs, near_duplicates(docs, shard_size))


def first_of_each_group(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are the first of their component in ``marked(doc_id, tie, component)``."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("tie"))
    first = marked.groupBy("component").agg(F.min(order).alias("first"))
    first = first.select(F.col("first.doc_id").alias("keep_id"), F.col("first.tie").alias("keep_tie"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("bigint").alias("row_id"),
        F.xxhash64("text").alias("row_tie"),
    )
    same = F.col("row_id").eqNullSafe(F.col("keep_id")) & (F.col("row_tie") == F.col("keep_tie"))
    return rows.join(first, same, "left_semi").dropDuplicates(["row_id", "row_tie"]).select("row.*")
