"""The most frequent keys of stored partial counts, without adding up all keys.

Counts are kept per part, a day or a source, and the k largest sums are asked for.  Three phases (Cao and Wang, "Efficient
top-k query calculation in distributed networks", 2004) move few rows:

1. each part gives its own k largest counts; the k-th largest of their sums is a threshold the k-th result reaches,
2. each part gives what is at least the threshold over the number of parts; a key that no part gives cannot reach it.  With
   what a part may still hide, each key has an upper bound, and those below the new k-th sum are out,
3. the keys that are left are looked up in all parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.ranking import top_k, top_k_per_group


def write_partial_counts(rows: DataFrame, path: str, part: str, key: str) -> None:
    """Write ``path`` with the counts of ``key`` in one folder per ``part``, largest first; other parts stay."""
    counts = rows.groupBy(F.col(part).alias("part"), F.col(key).alias("key")).agg(F.count("*").alias("count"))
    laid = counts.repartitionByRange("part", F.desc("count")).sortWithinPartitions("part", F.desc("count"), "key")
    laid.write.mode("append").partitionBy("part").parquet(path)


def candidates(partials: DataFrame, k: int) -> tuple[DataFrame, float]:
    """(key) of the keys that can be among the ``k`` largest sums, and the count below which parts were not asked."""
    n_parts = partials.select("part").distinct().count()
    if not n_parts:
        return partials.select("key"), 0.0
    first = top_k_per_group(partials, "part", k, [F.desc("count"), F.asc_nulls_first("key")]).drop("rank")
    least = _kth_sum(first, k) / n_parts
    seen = partials.filter(F.col("count") >= least)
    bounds = seen.groupBy("key").agg(F.sum("count").alias("lower"), F.count("*").alias("n"))
    hidden = max(0, -(-least // 1) - 1)  # the largest whole number below ``least``
    threshold = _kth_sum(seen, k)
    able = bounds.filter(F.col("lower") + (F.lit(n_parts) - F.col("n")) * hidden >= threshold)
    return able.select("key"), least


def _kth_sum(partials: DataFrame, k: int) -> int:
    """The k-th largest sum by key, 0 where there are fewer keys."""
    sums = partials.groupBy("key").agg(F.sum("count").alias("sum")).orderBy(F.desc("sum")).limit(k)
    n, least = sums.agg(F.count("*"), F.min("sum")).first()
    return least if n == k else 0


def top_counts(partials: DataFrame, k: int) -> DataFrame:
    """(key, count): the ``k`` largest sums of ``partials(part, key, count)``, ties by key.

    A key has one row per part at most and counts are whole and positive.
    """
    able, _ = candidates(partials, k)
    exact = partials.join(able, partials["key"].eqNullSafe(able["key"]), "left_semi")
    sums = exact.groupBy("key").agg(F.sum("count").alias("count"))
    return top_k(sums, k, [F.desc("count"), F.asc("key")])
