import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.operators import sampling, social
from weftline.sources.lines import parse_adjacency
from weftline.sources.sinks import recommendation_lines


def brute_force(lists, users, k=10):
    """Recommendations straight from the definitions: count each pair of entries of each list."""
    mutual = Counter()
    for _, friends in lists:
        for i, a in enumerate(friends):
            for b in friends[i + 1:]:
                if a != b:
                    mutual[a, b] += 1
                    mutual[b, a] += 1
    known = {frozenset((owner, friend)) for owner, friends in lists if owner in users for friend in friends}
    best = {}
    for (user, candidate), n in mutual.items():
        if user in users and frozenset((user, candidate)) not in known:
            best.setdefault(user, []).append((-n, not candidate.isdigit(), int(candidate) if candidate.isdigit() else 0, candidate))
    return {user: [entry[3] for entry in sorted(entries)[:k]] for user, entries in best.items()}


def recommend(spark, lists, users, **options):
    lines = spark.createDataFrame([(f"{owner}\t{','.join(friends)}",) for owner, friends in lists], "value string")
    members = social.explode_adjacency(parse_adjacency(lines))
    asked = spark.createDataFrame([(user,) for user in users], "user string")
    ranked = social.recommend(members, asked, **options)
    return {row.user: row.candidates for row in social.recommendation_lists(ranked).collect()}


CASES = {
    "plain": ([("1", ["2", "3"]), ("2", ["1", "4"]), ("3", ["1", "4"]), ("4", ["2", "3"])], ["1", "2"]),
    "named only by the other side": ([("5", ["6", "7"]), ("7", ["6"])], ["6"]),
    "both asked, one names the other": ([("5", ["6", "7"]), ("7", ["6"])], ["6", "7"]),
    "repeated friend": ([("1", ["2", "2", "3"]), ("9", ["2", "4"]), ("8", ["2", "4"])], ["2"]),
    "own entry": ([("1", ["1", "2", "3"])], ["1", "2"]),
    "two lists of one user": ([("1", ["2", "3"]), ("1", ["4", "5"])], ["2"]),
    "tied 9 and 10 and a name": ([("1", ["2", "10", "9", "x", "a"])], ["2"]),
    "no candidates": ([("1", ["2"])], ["2", "77"]),
}


@pytest.mark.parametrize("name", CASES)
def test_recommend(spark, name):
    lists, users = CASES[name]
    assert recommend(spark, lists, users) == brute_force(lists, users)


@pytest.mark.parametrize("seed", range(3))
def test_random_lists_with_hot_lists(spark, seed):
    rng = random.Random(seed)
    people = [str(i) for i in range(20)] + ["x", "y"]
    lists = [(rng.choice(people), rng.choices(people, k=rng.randint(1, 14))) for _ in range(25)]
    users = rng.sample(people, 6)
    assert recommend(spark, lists, users, k=4, min_hot_rows=2) == brute_force(lists, users, 4)


def test_lines_of_recommendations(spark):
    ranked = spark.createDataFrame(
        [("7", "3", 2, 2), ("7", "10", 5, 1), ("8", "1", 1, 1)], "user string, candidate string, mutual bigint, rank int"
    )
    rows = recommendation_lines(social.recommendation_lists(ranked)).collect()
    assert sorted(row.value for row in rows) == ["7\t10,3", "8\t1"]


def test_sample_is_repeatable_and_from_the_first_users(spark):
    users = spark.createDataFrame([(str(i),) for i in range(300)] * 2, "user string")
    once = {row.user for row in sampling.sample_users(users, 5, 42, first=50).collect()}
    again = {row.user for row in sampling.sample_users(users.repartition(7), 5, 42, first=50).collect()}
    other = {row.user for row in sampling.sample_users(users, 5, 43, first=50).collect()}
    assert once == again != other
    assert len(once) == 5 and all(int(user) < 50 for user in once)
    assert sampling.sample_users(users, 500, 42, first=50).count() == 50


def test_first_rows(spark):
    rows = sampling.first_rows(spark.range(100).repartition(5), 3, [F.desc("id")]).collect()
    assert sorted((row.position, row.id) for row in rows) == [(0, 99), (1, 98), (2, 97)]


def test_splits(spark):
    docs = spark.range(2000).withColumnRenamed("id", "doc_id")
    train, test = sampling.hash_split(docs, 42, "doc_id")
    train_again, test_again = sampling.hash_split(docs.repartition(3), 42, "doc_id")
    assert train.unionAll(test).distinct().count() == 2000
    assert {r[0] for r in test.collect()} == {r[0] for r in test_again.collect()}
    assert 300 < test.count() < 500
    a, b = sampling.random_split(docs, 42)
    assert a.count() + b.count() == 2000 and 300 < b.count() < 500


def test_only_the_lists_of_requested_users_are_shuffled(spark):
    """Entries are cut to the touched lists by a broadcast before the first exchange."""
    members = spark.createDataFrame([(i % 9, str(i % 9), str(i)) for i in range(90)], "list_id bigint, owner string, friend string")
    users = spark.createDataFrame([("1",), ("2",)], "user string")
    counts = social.mutual_friend_counts(members, users)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    below = re.split(r"Exchange hashpartitioning\(list_id#\w+, friend", plan)[1:]
    assert below and all("LeftSemi" in part.split("Exchange")[0] for part in below)
    assert {r.user for r in counts.collect()} == {"1", "2"}
