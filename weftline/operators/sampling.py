"""Repeatable sampling and splitting by hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.scalars import id_order
from weftline.operators.ranking import top_k


def seeded_hash(seed: int, key: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def first_rows(df: DataFrame, n: int, order: Sequence[Column], position: str = "position") -> DataFrame:
    """The first ``n`` rows in the given order with their position, counted from 0.

    The rows are cut to ``n`` before they are numbered, so the numbering sees ``n`` rows at most.
    """
    window = Window.partitionBy(F.lit(0)).orderBy(*order)
    return top_k(df, n, order).withColumn(position, F.row_number().over(window) - 1)


def sample_users(users: DataFrame, n: int, seed: int, key: str = "user", first: int | None = None) -> DataFrame:
    """``n`` users drawn by seeded hash from all users, or from the ``first`` ones in id order."""
    batch = users.select(key).distinct()
    if first is not None:
        batch = top_k(batch, first, id_order(key))
    return top_k(batch, n, [seeded_hash(seed, key), F.col(key)])


def split_flag(seed: int, key: str, test_share: float) -> Column:
    """True for the rows that belong to the test part."""
    limit = round(test_share * 0x100000000)
    return F.conv(F.substring(seeded_hash(seed, key), 1, 8), 16, 10).cast("bigint") < limit


def hash_split(df: DataFrame, seed: int, key: str, test_share: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """(train, test).  A row's side depends on the seed and its key only, not on the partitioning."""
    test = split_flag(seed, key, test_share)
    return df.filter(~test), df.filter(test)


def random_split(df: DataFrame, seed: int, test_share: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """(train, test) by Spark's seeded Bernoulli sampling; it depends on the partitioning of ``df``."""
    train, test = df.randomSplit([1.0 - test_share, test_share], seed=seed)
    return train, test
