"""Friend recommendation by mutual friends.

Friend lists are kept in long form, ``memberships(list_id, owner, friend)``, one row per entry of a list,
so that a list of any length spreads over tasks.  Two people on the same list share its owner as a mutual
friend.  ``users`` are the people asked about, usually a small sample: Spark broadcasts them when their
measured size allows it and otherwise splits skewed partitions of the semi joins by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.scalars import id_order, pair_high, pair_low
from weftline.operators.ranking import top_k_per_group
from weftline.operators.skew import MIN_HOT_ROWS, broadcast_if_small, key_counts, salted_join
from weftline.session import materialise


def explode_adjacency(adjacency: DataFrame) -> DataFrame:
    """``adjacency(user, friends)`` -> memberships.

    Every input row is a list of its own, also where a user has several.  The list ids are checkpointed
    with the lists, since a repeated task could number its rows in another order.
    """
    lists = materialise(adjacency.select(F.monotonically_increasing_id().alias("list_id"), "user", "friends"))
    return lists.select("list_id", F.col("user").alias("owner"), F.explode("friends").alias("friend"))


def memberships_from_edges(edges: DataFrame) -> DataFrame:
    """Undirected ``edges(src, dst)`` -> memberships with one list per vertex and no repeated friends."""
    both = edges.select(F.col("src").alias("owner"), F.col("dst").alias("friend")).unionAll(
        edges.select(F.col("dst").alias("owner"), F.col("src").alias("friend"))
    )
    return both.distinct().select(F.col("owner").alias("list_id"), "owner", "friend")


def existing_friendships(memberships: DataFrame, users: DataFrame) -> DataFrame:
    """(a, b) with a < b: the pairs that the own list of one of ``users(user)`` names."""
    own = memberships.select(F.col("owner").alias("user"), "friend").join(users.select("user"), "user", "left_semi")
    return own.select(pair_low("user", "friend").alias("a"), pair_high("user", "friend").alias("b")).distinct()


def mutual_friend_counts(memberships: DataFrame, users: DataFrame, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """(user, candidate, mutual) for each of ``users(user)`` and everyone who shares a list with them.

    Only pairs with a requested user at one end are made.  The entries that name such a user are found first;
    only the lists they are on are read on.  An entry that a list repeats counts each time.
    """
    hits = materialise(
        memberships.withColumnRenamed("friend", "user")
        .join(users.select("user"), "user", "left_semi")
        .groupBy("list_id", "user")
        .agg(F.count("*").alias("user_times"))
    )
    touched = broadcast_if_small(hits.select("list_id").distinct())
    entries = memberships.select("list_id", "friend").join(touched, "list_id", "left_semi")
    entries = entries.groupBy("list_id", "friend").agg(F.count("*").alias("times"))
    counts = key_counts(entries, "list_id", positive="times")
    pairs = salted_join(entries, hits, "list_id", spread=["friend"], counts=counts, min_hot_rows=min_hot_rows)
    return (
        pairs.filter(F.col("user") != F.col("friend"))
        .groupBy("user", F.col("friend").alias("candidate"))
        .agg(F.sum(F.col("times") * F.col("user_times")).alias("mutual"))
    )


def candidate_counts(memberships: DataFrame, users: DataFrame, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """``mutual_friend_counts`` without the pairs that are friends already."""
    counts = mutual_friend_counts(memberships, users, min_hot_rows)
    existing = existing_friendships(memberships, users)
    return (
        counts.withColumn("a", pair_low("user", "candidate"))
        .withColumn("b", pair_high("user", "candidate"))
        .join(existing, ["a", "b"], "left_anti")
        .select("user", "candidate", "mutual")
    )


def recommend(
    memberships: DataFrame, users: DataFrame, k: int = 10, min_hot_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """(user, candidate, mutual, rank): the ``k`` best candidates by mutual friends, then by id.

    Users without candidates do not appear.
    """
    order = [F.desc("mutual"), *id_order("candidate")]
    return top_k_per_group(candidate_counts(memberships, users, min_hot_rows), "user", k, order)


def recommendation_lists(ranked: DataFrame) -> DataFrame:
    """(user, candidates) with the at most k candidates of each user as an array, best first."""
    entries = F.array_sort(F.collect_list(F.struct("rank", F.col("candidate").cast("string").alias("candidate"))))
    return ranked.groupBy("user").agg(F.transform(entries, lambda entry: entry["candidate"]).alias("candidates"))
