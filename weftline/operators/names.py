"""Entities of several words: all names of a gazetteer in all texts, leftmost and longest first.

The gazetteer becomes a trie that is kept as a table, one row per prefix of a name: where a name ends, and how many
words the longest name below it has.  Texts are matched against it by joins only.  A place whose word starts no name
ends there; at the others the runs of words up to the longest possible name are looked up.  No join has a side that is
broadcast by hand, so the gazetteer may be as large as the texts.

Matches that overlap are resolved inside each document: matches that do not touch each other are islands, and only
within an island of several matches the text is walked from left to right.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import NOT_WORD, as_column
from weftline.session import drop_stored, write_stored


def name_words(text: Column | str) -> Column:
    """Runs of letters, digits and ``_`` as they are written, in order."""
    return F.filter(F.split(as_column(text), NOT_WORD), lambda word: word != "")


def name_trie(gazetteer: DataFrame) -> DataFrame:
    """(prefix, n_words, deepest, is_name, label) of ``gazetteer(entity, label)``: each prefix of a name once.

    Names are compared word by word, signs and spaces between the words do not matter.  ``deepest`` is the number of words
    of the longest name with the prefix.  A name with several labels has the first of them, one without words is left out.
    """
    names = gazetteer.select(name_words("entity").alias("words"), "label").filter(F.size("words") > 0)
    lengths = F.sequence(F.lit(1), F.size("words"))
    rows = names.select("words", "label", F.explode(lengths).alias("n_words"))
    ends = F.col("n_words") == F.size("words")
    return (
        rows.groupBy(F.array_join(F.slice("words", F.lit(1), F.col("n_words")), " ").alias("prefix"), "n_words")
        .agg(F.max(F.size("words")).alias("deepest"), F.max(ends).alias("is_name"), F.min(F.when(ends, F.col("label"))).alias("label"))
    )


def name_candidates(docs: DataFrame, trie: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, place, n_words, entity, label): the longest name that starts at each place of ``docs(doc_id, text)``."""
    longest = trie.agg(F.max("deepest")).first()[0] or 0
    places = F.transform(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: F.struct(i.alias("place"), F.slice("words", i + 1, F.lit(max(1, longest))).alias("ahead")),
    )
    split = docs.select("doc_id", name_words(text).alias("words")).filter(F.size("words") > 0)
    starts = split.select("doc_id", F.inline(places)).withColumn("first", F.get("ahead", F.lit(0)))
    roots = trie.filter("n_words = 1").select(F.col("prefix").alias("first"), "deepest")
    lengths = F.sequence(F.lit(1), F.least("deepest", F.size("ahead")))
    runs = starts.join(roots, "first").select("doc_id", "place", "ahead", F.explode(lengths).alias("n_words"))
    run = F.array_join(F.slice("ahead", F.lit(1), F.col("n_words")), " ").alias("entity")
    names = trie.filter("is_name").select(F.col("prefix").alias("entity"), "label")
    found = runs.select("doc_id", "place", "n_words", run).join(names, "entity")
    best = F.max_by(F.struct("n_words", "entity", "label"), "n_words").alias("best")
    return found.groupBy("doc_id", "place").agg(best).select("doc_id", "place", "best.*")


def leftmost_longest(candidates: DataFrame) -> DataFrame:
    """The rows of ``candidates(doc_id, place, n_words, ...)``, one for each place at most, that remain when each document
    is read from left to right and what overlaps an accepted name is passed over."""
    columns = candidates.columns
    ordered = Window.partitionBy("doc_id").orderBy("place")
    reach = F.max(F.col("place") + F.col("n_words")).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    apart = candidates.withColumn("apart", F.coalesce(F.col("place") >= reach, F.lit(True)).cast("int"))
    island = F.sum("apart").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    fields = F.struct("place", "n_words", *[c for c in columns if c not in ("doc_id", "place", "n_words")])
    islands = apart.withColumn("island", island).groupBy("doc_id", "island").agg(F.array_sort(F.collect_list(fields)).alias("m"))
    walked = F.aggregate(
        F.slice("m", 2, F.size("m")),
        F.slice("m", 1, 1),
        lambda kept, m: F.when(
            m["place"] >= F.element_at(kept, -1)["place"] + F.element_at(kept, -1)["n_words"], F.array_append(kept, m)
        ).otherwise(kept),
    )
    kept = F.when(F.size("m") == 1, F.col("m")).otherwise(walked)
    return islands.select("doc_id", F.inline(kept)).select(*columns)


def find_names(docs: DataFrame, gazetteer: DataFrame, labels: Sequence[str] | None = None, text: str = "text") -> DataFrame:
    """(doc_id, place, n_words, entity, label): the names of ``gazetteer(entity, label)`` in ``docs(doc_id, text)``.

    ``place`` counts words from 0.  Of names that overlap the leftmost, then the longest one is a mention.  ``labels`` keeps
    the mentions with one of them, after that; other names still hide what they overlap.  ``doc_id`` has to be unique.
    """
    trie, path = write_stored(name_trie(gazetteer), "name-trie")
    found, _ = write_stored(leftmost_longest(name_candidates(docs, trie, text)), "names")
    drop_stored(docs.sparkSession, path)
    return found if labels is None else found.filter(F.col("label").isin(list(labels)))


def name_counts(mentions: DataFrame) -> DataFrame:
    """(entity, label, count) of found names."""
    return mentions.groupBy("entity", "label").agg(F.count("*").alias("count"))
