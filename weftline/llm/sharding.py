"""A uniform shuffle into shards of exact size by a hypergeometric communication matrix.

In a uniform random order of all rows, cut into shards, the number of rows that a part of the input sends to each shard
follows a multivariate hypergeometric law.  These numbers are drawn first, as one small matrix with exact row and
column sums: one row for each part, one column for each shard.  Then every part permutes its own rows and deals them by
its row of the matrix, the rows are exchanged, and every shard permutes what it has got.  No count has to be corrected
afterwards and no row is moved twice.

The first permutation ranks a part by random numbers, which are stored with the rows so that a repeated task deals
the same.  A shard is too large for one task: its permutation is a range partitioning by further random numbers, ranked
range by range.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import whole_row
from weftline.operators.ranking import numbered
from weftline.session import drop_stored, write_stored

#: numpy draws from urns of less than this many balls of a kind.
URN = 10**9
MAX_PARTS = 65_536


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` balls drawn from an urn are good.

    Beyond numpy's limit the law is summed up from its mode by the ratio of neighbours, as far as it is not zero.
    """
    if n == 0 or good == 0:
        return 0
    if bad == 0:
        return n
    if good < URN and bad < URN:
        return int(rng.hypergeometric(good, bad, n))
    least, most = max(0, n - bad), min(n, good)
    mode = min(most, max(least, (n + 1) * (good + 1) // (good + bad + 2)))
    share = good / (good + bad)
    reach = int(40 * (n * share * (1 - share) + 1) ** 0.5) + 40
    up = np.arange(mode, min(most, mode + reach), dtype=float)
    down = np.arange(mode, max(least, mode - reach), -1, dtype=float)
    higher = np.cumprod((good - up) * (n - up) / ((up + 1) * (bad - n + up + 1)))
    lower = np.cumprod(down * (bad - n + down) / ((good - down + 1) * (n - down + 1)))
    weights = np.concatenate([lower[::-1], [1.0], higher])
    place = int(np.searchsorted(np.cumsum(weights), rng.random() * weights.sum()))
    return mode - len(lower) + min(place, len(weights) - 1)


def shard_sizes(n: int, shards: int) -> list[int]:
    """Sizes that differ by one at most and add up to ``n``."""
    return [n // shards + (s < n % shards) for s in range(shards)]


def communication_matrix(parts: Sequence[int], sizes: Sequence[int], seed: int) -> np.ndarray:
    """Rows that each of ``parts`` sends to each shard; the row and column sums are the sizes of parts and shards."""
    rng = np.random.default_rng(seed)
    left = [int(s) for s in sizes]
    matrix = np.zeros((len(parts), len(left)), np.int64)
    for i, n in enumerate(parts):
        rest, open_ = int(n), sum(left)
        for s, room in enumerate(left):
            matrix[i, s] = sent = hypergeometric(rng, room, open_ - room, rest)
            open_ -= room
            rest -= sent
        left = [room - int(sent) for room, sent in zip(left, matrix[i], strict=True)]
    return matrix


def sizes_and_hashes(text: Column | str) -> tuple[Column, Column]:
    """UTF-8 bytes of a text plus 8, and its crc32; a null text is empty."""
    bytes_ = F.coalesce(text, F.lit("")).cast("binary")
    return (F.octet_length(bytes_) + 8).cast("bigint").alias("size"), F.crc32(bytes_).alias("text_crc32")


def shuffle_into_shards(
    rows: DataFrame, shards: int = 24, seed: int = 42, carry: Sequence[str] | None = None, max_parts: int = MAX_PARTS
) -> DataFrame:
    """The ``carry`` columns of ``rows``, all by default, as the struct ``row``, with ``shard`` and ``slot``.

    Each of the orders of all rows is equally likely; shards differ by one row at most and slots go from 0 without a
    gap.  Rows are dealt by place: ids, nulls, repeated rows and texts do not matter.  The parts are the tasks
    that read the rows, at most ``max_parts`` of them (more share one), so that the matrix is bounded.  With the same
    input splits and seed a repeated run gives the same shuffle.
    """
    spark = rows.sparkSession
    carried = whole_row(rows.select(*(carry or rows.columns)))
    part = F.pmod(F.spark_partition_id(), F.lit(max_parts))
    drawn, path = write_stored(
        rows.select(
            carried.alias("row"), part.alias("part"),
            *[F.rand(seed + i).alias(name) for i, name in enumerate(("first", "second", "third"))],
        ),
        "drawn-rows",
    )
    counts = sorted((r["part"], r["n"]) for r in drawn.groupBy("part").agg(F.count("*").alias("n")).collect())
    sizes = shard_sizes(sum(n for _, n in counts), shards)
    matrix = communication_matrix([n for _, n in counts], sizes, seed)
    ends = [(part, row.tolist()) for (part, _), row in zip(counts, matrix.cumsum(axis=1), strict=True)]
    bounds = F.broadcast(spark.createDataFrame(ends, "part int, ends array<bigint>"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("first", "second", "third"))
    dealt = drawn.withColumn("place", place).join(bounds, "part")
    shard = F.size(F.filter("ends", lambda end: end < F.col("place")))
    dealt = dealt.select("row", shard.cast("int").alias("shard"), "second", "third", "first")
    placed = numbered(dealt, [F.col("shard"), F.col("second"), F.col("third"), F.col("first")], "place")
    drop_stored(spark, path)  # the rows are stored again in the new order
    before = F.get(F.array(*[F.lit(int(b)) for b in np.cumsum([0, *sizes[:-1]])]), F.col("shard"))
    return placed.select("row", "shard", (F.col("place") - 1 - before).cast("bigint").alias("slot"))


def write_shards(shuffled: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """Write the rows of ``shuffle_into_shards`` as one folder for each shard, in the order of their slots."""
    shards = (shuffled.agg(F.max("shard")).first()[0] or 0) + 1
    order = ["shard", "slot"]
    laid = shuffled.repartitionByRange(shards * files_per_shard, *order).sortWithinPartitions(*order)
    laid.select("row.*", *order).write.partitionBy("shard").parquet(path)
