"""Small scalar expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.text import as_column


def numeric_id(col: Column | str) -> Column:
    """The number a digits-only id stands for, else NULL (``-5`` and ``x1`` are not digits-only)."""
    text = as_column(col).cast("string")
    return F.when(text.rlike(r"^[0-9]+\z"), text.try_cast("decimal(38,0)"))


def id_order(col: Column | str) -> list[Column]:
    """Sort columns: digits-only ids first by their number, the others after them by text."""
    return [numeric_id(col).asc_nulls_last(), as_column(col).asc()]


def pair_low(a: Column | str, b: Column | str) -> Column:
    return F.least(as_column(a), as_column(b))


def pair_high(a: Column | str, b: Column | str) -> Column:
    return F.greatest(as_column(a), as_column(b))


def cosine(dot: Column, norm_a: Column, norm_b: Column) -> Column:
    """Cosine from a dot product and two norms; 0.0 where a norm is 0."""
    norms = norm_a * norm_b
    return F.when(norms == 0, F.lit(0.0)).otherwise(dot / norms)


def rank_value(score: Column | str, digits: int = 9) -> Column:
    """Score as used for ranking.

    Sums of doubles depend on the order of addition in their last bits; equal scores must tie whatever
    the partitioning, so ranking looks at ``digits`` decimals and leaves the rest to the id.
    """
    return F.round(as_column(score), digits)
