"""Row-level helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """``df.withColumn(name, column)`` for an expensive column that later steps use more than once.

    Spark copies the expression of a plain column into each filter that is pushed below it.  The output of
    a generator is not copied, and a one-element ``explode`` is one.
    """
    return df.withColumn(name, F.explode(F.array(column)))


def spread_rows(df: DataFrame) -> DataFrame:
    """Use all cores for per-row work on an input that has fewer splits than there are cores.

    Large inputs have more splits than that and stay as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
