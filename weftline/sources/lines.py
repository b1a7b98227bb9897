"""Text lines in, typed rows out.  Every parser takes a DataFrame with one string column ``value``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.text import trimmed
from weftline.operators.rows import computed_once
from weftline.session import materialise

FIELDS = "__fields"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)


def fields(lines: DataFrame, value: Column, pattern: str, limit: int = -1) -> DataFrame:
    """Add ``__fields``, the parts of ``value``, split once per line."""
    return computed_once(lines, FIELDS, F.split(value, pattern, limit))


def field(i: int) -> Column:
    """Field ``i`` or NULL."""
    return F.get(F.col(FIELDS), F.lit(i))


def parse_id_text(lines: DataFrame) -> DataFrame:
    """``id<TAB>text`` -> (doc_id, text); only the first tab splits, lines without a tab are dropped."""
    parts = fields(lines, F.col("value"), "\t", 2).filter(F.size(FIELDS) == 2)
    return parts.select(field(0).alias("doc_id"), field(1).alias("text"))


def parse_titles(lines: DataFrame, line: str | None = None) -> DataFrame:
    """Tab-separated metadata -> (doc_id, title) from fields 0 and 2; shorter lines are dropped.

    ``line`` names a column that numbers the lines; it is kept, for ``with_titles`` to take the last title.
    """
    parts = fields(lines, F.col("value"), "\t").filter(F.size(FIELDS) > 2)
    return parts.select(field(0).alias("doc_id"), field(2).alias("title"), *([line] if line else []))


def parse_adjacency(lines: DataFrame) -> DataFrame:
    """``user<TAB>id,id,...`` -> (user, friends); blank users and users without friends are dropped."""
    parts = fields(lines, trimmed("value"), "\t").filter(F.size(FIELDS) > 1)
    users = computed_once(parts, "user", trimmed(field(0))).filter(F.col("user") != "")
    friends = F.transform(F.split(field(1), ","), lambda friend: trimmed(friend))
    return (
        computed_once(users, "friends", F.filter(friends, lambda friend: friend != ""))
        .select("user", "friends")
        .filter(F.size("friends") > 0)
    )


def parse_edges(lines: DataFrame) -> DataFrame:
    """White-space separated edge list -> (src, dst); ``#`` comments, empty and one-field lines are dropped."""
    content = lines.filter(~F.startswith("value", F.lit("#")) & (F.length("value") > 0))
    parts = fields(content, F.col("value"), r"\s+").filter(F.size(FIELDS) > 1)
    return parts.select(field(0).alias("src"), field(1).alias("dst"))


def parse_queries(lines: DataFrame, line: str | None = None) -> DataFrame:
    """One search per non-blank line -> (query_id, text); repeated lines are repeated searches.

    ``line`` names a column that numbers the lines and becomes the id.  Without one the id grows in file order;
    such ids are stored at once, since a repeated task could number its rows in another order.
    """
    number = F.monotonically_increasing_id() if line is None else F.col(line)
    asked = lines.select(number.alias("query_id"), trimmed("value").alias("text"))
    return (materialise(asked) if line is None else asked).filter(F.col("text") != "")
