"""Recommendations for all users next to those made user by user, and the pairs that are made for them."""

import random

import pytest
from pyspark.sql import functions as F
from test_social import CASES, brute_force

from weftline.operators import everyone, social
from weftline.operators.ranking import top_k_per_group
from weftline.functions.scalars import id_order
from weftline.sources.lines import parse_adjacency


def members_of(spark, lists):
    lines = spark.createDataFrame([(f"{owner}\t{','.join(friends)}",) for owner, friends in lists], "value string")
    return social.explode_adjacency(parse_adjacency(lines))


def run(spark, lists, **options):
    ranked = everyone.recommend_everyone(members_of(spark, lists), **options)
    return {row.user: row.candidates for row in social.recommendation_lists(ranked).collect()}


def people(lists):
    return {p for owner, friends in lists for p in [owner, *friends]}


@pytest.mark.parametrize("name", CASES)
def test_small_cases(spark, name):
    lists = CASES[name][0]
    assert run(spark, lists) == brute_force(lists, people(lists))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("options", [{"k": 2, "head": 3}, {"k": 3, "head": 5}])
def test_random_lists(spark, seed, options):
    rng = random.Random(seed)
    names = [str(i) for i in range(60)] + ["x", "y"]
    lists = [(rng.choice(names), rng.choices(names, k=rng.choice((1, 3, 6, 25)))) for _ in range(50)]
    assert run(spark, lists, **options) == brute_force(lists, people(lists), options["k"])


def test_a_list_of_everybody_makes_no_square(spark):
    everybody = [str(i) for i in range(1500)]
    lists = [("boss", everybody)] + [(f"o{i}", [str((i * j * 7 + j) % 1500) for j in range(12)]) for i in range(200)]
    members = members_of(spark, lists)
    entries = members.groupBy("list_id", "friend").agg(F.count("*").alias("times"))
    others = entries.select("list_id", F.col("friend").alias("candidate"), F.col("times").alias("their_times"))
    heads = top_k_per_group(others, "list_id", 64, id_order("candidate")).drop("rank")
    needed = everyone.needed_lists(entries, heads, everyone._both_ways(members), 10)
    made = everyone.planned_pairs(needed, 64).first()
    assert made.all_pairs > 1500 * 1500 and made.pairs < made.all_pairs / 10
    assert run(spark, lists) == brute_force(lists, people(lists))


def test_lists_of_one_length_are_joined_whole_and_counted_in_blocks(spark, monkeypatch):
    """Where every list is needed but for the last ones, leaving these out kept every pair for a second look."""
    monkeypatch.setattr(everyone, "BLOCK", 7)
    rng = random.Random(1)
    names = [str(i) for i in range(80)]
    lists = [(rng.choice(names), rng.sample(names, 20)) for _ in range(40)]
    members = members_of(spark, lists)
    entries = members.groupBy("list_id", "friend").agg(F.count("*").alias("times"))
    others = entries.select("list_id", F.col("friend").alias("candidate"), F.col("times").alias("their_times"))
    heads = top_k_per_group(others, "list_id", 4, id_order("candidate")).drop("rank")
    needed = everyone.needed_lists(entries, heads, everyone._both_ways(members), 3)
    assert [row["use"] for row in needed.select("use").distinct().collect()] == ["whole"]
    assert run(spark, lists, k=3, head=4) == brute_force(lists, people(lists), 3)


@pytest.mark.parametrize("block", [5, 65536])
@pytest.mark.parametrize("seed", range(2))
def test_users_of_long_lists_and_a_spool(spark, seed, block, monkeypatch):
    """Long lists are joined by need, in blocks of any size, with repeated friends and several lists of an owner."""
    monkeypatch.setattr(everyone, "BLOCK", block)
    monkeypatch.setattr(everyone, "SPOOL_BYTES", 16)
    rng = random.Random(seed)
    names = [str(i) for i in range(60)] + ["x", "y"]
    lists = [(rng.choice(names), rng.choices(names, k=rng.choice((1, 3, 6, 25)))) for _ in range(50)]
    for long_list in (0, 1024):
        assert run(spark, lists, k=3, head=3, long_list=long_list) == brute_force(lists, people(lists), 3)


def test_lists_take_two_bytes_a_person_and_no_row_a_pair(spark, monkeypatch):
    """What is shuffled for lists of one length are their pieces, not users by candidates of every small block."""
    rng = random.Random(2)
    owners = [(str(i), [str(j) for j in rng.sample(range(4000), 150)]) for i in range(400)]
    seen, made = {}, everyone._counted_blocks

    def counted(rows, k, blocks):
        size = F.size("users") + F.size("candidates")
        seen["people"] = rows.agg(F.sum(size)).first()[0]
        seen["types"] = dict(rows.dtypes)
        return made(rows, k, blocks)

    monkeypatch.setattr(everyone, "_counted_blocks", counted)
    assert run(spark, owners) == brute_force(owners, people(owners))
    assert seen["types"]["users"] == seen["types"]["candidates"] == "array<smallint>"
    assert seen["people"] < 400 * 150 * 64
    assert not spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "true"
