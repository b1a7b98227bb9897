"""Distinct counts that can be stored per part and united: HyperLogLog sketches beside the exact count.

A sketch of ``2 ** precision`` registers estimates with a relative standard error of about ``1.04 / 2 ** (precision / 2)``,
1.6 % for the default of 12, whatever it counts, in some kilobytes; the union of the sketches of parts is the sketch of the
whole.  So a new day costs its own rows and not a shuffle of every key ever seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRECISION = 12


def standard_error(precision: int = PRECISION) -> float:
    return 1.04 / 2 ** (precision / 2)


def distinct_sketches(rows: DataFrame, part: str, column: str, precision: int = PRECISION) -> DataFrame:
    """(part, sketch): the different values of ``column`` in each part, NULLs left out."""
    return rows.groupBy(F.col(part).alias("part")).agg(F.hll_sketch_agg(column, F.lit(precision)).alias("sketch"))


def distinct_estimate(sketches: DataFrame) -> DataFrame:
    """One row (estimate): the different values in all parts together, 0 without sketches."""
    united = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.agg(F.coalesce(united, F.lit(0)).cast("bigint").alias("estimate"))
