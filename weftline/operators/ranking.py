"""Top-k, overall and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.session import stored


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """The first ``k`` rows: each task keeps ``k`` rows, there is no full sort."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: str, k: int, order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group with their rank.

    Filtering a ``row_number`` lets Spark cut each group to ``k`` rows per task *before* the shuffle, so a
    group that holds most of the rows does not end up in one task.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add ``name``: the place of each row in the whole order, from 1.

    The rows are dealt by range and numbered within each part; only one row per part, its size, meets in
    one task.  The dealt rows are stored so that parts keep their numbers.
    """
    parts = stored(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "numbered")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy("__part").agg(F.count("*").alias("__n"))
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order)).cast("bigint") + F.col("__before")
    return parts.join(offsets, "__part").withColumn(name, place).drop("__part", "__before")
