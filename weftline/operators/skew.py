"""Joins that stay balanced when one key holds a large part of the rows.

A key is *hot* when it holds more than ``MIN_HOT_ROWS`` rows of the big side and more than one row in
``MAX_HOT_KEYS``.  There are fewer than ``MAX_HOT_KEYS`` such keys at any scale, by arithmetic and not by a
cut, so their table can be broadcast; it is the one thing that is broadcast here.  Every hot key is split: its
rows are spread over salts of ``MIN_HOT_ROWS`` rows, the matching rows of the other side are repeated once
per salt.  A key that is not hot has at most one row in ``MAX_HOT_KEYS``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HOT_KEYS = 100_000
MIN_HOT_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 16 << 20
SALT = "__salt"
SALTS = "__salts"


def key_counts(df: DataFrame, key: str, positive: str | None = None) -> DataFrame:
    """(key, n_rows): combined before the shuffle, so a hot key costs one row per task.

    ``positive`` names a count column of ``df``, which is above 0 in every row.  Counting by it keeps the
    column in the plan, and with it the shuffle that ``df`` comes from is the same and is used again.
    """
    rows = F.count("*") if positive is None else F.count_if(F.col(positive) > 0)
    return df.groupBy(key).agg(rows.alias("n_rows"))


def hot_keys(counts: DataFrame, key: str, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """(key, __salts) of the hot keys of ``counts(key, n_rows)``; fewer than ``MAX_HOT_KEYS``."""
    total = counts.agg(F.sum("n_rows")).scalar()
    hot = counts.filter((F.col("n_rows") > min_hot_rows) & (F.col("n_rows") > total / F.lit(MAX_HOT_KEYS)))
    return hot.select(key, F.ceil(F.col("n_rows") / min_hot_rows).cast("int").alias(SALTS))


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` if its rows add up to few bytes; a larger table is left to an ordinary join."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether the rows of ``df`` add up to few bytes.

    Strings count by their length, however long they are.  Meant for materialised tables, where adding up costs little.
    """
    size = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns]
    total = df.agg(F.sum(sum(size, F.lit(16)).cast("bigint"))).first()[0] or 0
    return total <= max_bytes


def salt_rows(df: DataFrame, hot: DataFrame, key: str, spread: Sequence[str]) -> DataFrame:
    """Give each row one salt.  It is a hash of the ``spread`` columns, so a repeated task repeats it."""
    return (
        df.join(F.broadcast(hot), key, "left")
        .withColumn(SALT, F.pmod(F.xxhash64(*spread), F.coalesce(SALTS, F.lit(1))).cast("int"))
        .drop(SALTS)
    )


def repeat_rows(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Repeat each row once per salt of its key."""
    return (
        df.join(F.broadcast(hot), key, "left")
        .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(SALTS, F.lit(1)) - 1)))
        .drop(SALTS)
    )


def salted_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    spread: Sequence[str],
    counts: DataFrame | None = None,
    how: str = "inner",
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Join on ``key`` where the rows of ``big`` may be concentrated on few keys.

    ``counts(key, n_rows)`` tells how many rows of ``big`` each key has; it is computed when absent.
    ``how`` is a join type that keeps or drops rows of ``big`` one by one: inner, left, left_semi or
    left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot do a {how} join")
    hot = hot_keys(key_counts(big, key) if counts is None else counts, key, min_hot_rows)
    salted = salt_rows(big, hot, key, spread)
    return salted.join(repeat_rows(small, hot, key), [key, SALT], how).drop(SALT)
