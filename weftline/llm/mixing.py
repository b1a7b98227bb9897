"""Mixing sources to target weights by Sainte-Lague apportionment, on DataFrame functions only.

Every source has a target in words.  A source is cut into shards of about ``shard_docs`` documents, by a
seeded hash, and the documents of a shard are laid out one after the other in a seeded order.  The mix is
dealt in blocks of equally many words: a shard with ``v`` words to give bids the quotients ``v / 1``,
``v / 3``, ``v / 5`` ... and the highest quotients of all win one block each.  A shard then takes its quota of
blocks from a seeded place in its layout on, going round: whole rounds repeat every document, the rest is
one run of blocks, so that at most two documents of a shard are cut.

A block has ``1 / seats`` of the mix, ``max_block`` words at most.  Where that is more than ``1 / least_blocks``
of what a source has for each of its shards, the source leaves the common deal: its target is dealt among its own
shards, in blocks of that size, so that it is met to ``1 / (2 * least_blocks)`` or half a word.  No group has to fit into one task: shards
hold about ``shard_docs`` documents, by id or, without one, by text, and quotients are ranked by range.  Only rows that
are equal in every way, or repeat an id, share a shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import WORD, whole_row, word_count
from weftline.operators.ranking import numbered
from weftline.session import stored


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, max_repeats: int = 2
) -> DataFrame:
    """(source, source_size, n_docs, source_no, target) from (source, source_size, n_docs).

    The sources, by code point and null last, have the weights in turn.  They share ``share`` times all words
    by weight; a target stops at ``max_repeats`` times the source's size and what it leaves is shared again.
    With a level of ``x`` words per weight each source gets the smaller of ``x * weight`` and its limit, so
    that only the level has to be found: a few sums over the table of sources.
    """
    place = F.pmod(F.col("source_no") - 1, F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    ranked = numbered(sizes, [F.col("source").asc_nulls_last()], "source_no")
    ranked = stored(ranked.withColumn("weight", weight), "sources")
    limit = F.col("source_size") * F.lit(float(max_repeats))
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, n_full = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) > limit
        n, words, open_weight = ranked.agg(
            F.count_if(full), F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if n == n_full or not open_weight:
            break
        level, n_full = (total - (words or 0.0)) / open_weight, n
    return ranked.withColumn("target", F.least(F.col("weight") * F.lit(level), limit)).drop("weight")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    max_repeats: int = 2,
    seed: int = 42,
    seats: int = 100_000,
    max_block: int = 65_536,
    shard_docs: int = 8_000,
    least_blocks: int = 32,
    carry: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The ``carry`` columns of every row of ``docs(doc_id, text, source)`` as the struct ``row``, with

    * ``size`` words of the text (a null text has 0), ``source_size`` and ``target`` of its source (null is a
      source of its own),
    * ``copies``: array of (first, end), the runs of words that the mix takes, in words from 0,
    * ``taken``: the words in them; at most ``max_repeats`` times ``size``.

    Rows with an equal id are kept apart by size and text; equal rows take places next to each other.  An
    empty table gives an empty one, empty texts take nothing.
    """
    none = F.concat(F.lit("null|"), F.coalesce("text", F.lit("")))  # rows without an id are dealt by their text
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), none)))
    sized = stored(
        docs.select(
            whole_row(docs.select(*carry)).alias("row"),
            F.col("source"),
            word_count("text").alias("size"),
            key.alias("key"),
            F.xxhash64("text").alias("tie"),
        ),
        "sized",
    )
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    sources = stored(source_targets(per_source, weights, share, max_repeats), "targets")
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    block = int(min(max_block, max(1, -(-total // seats))))

    n_shards = F.ceil(F.col("n_docs") / F.lit(shard_docs))
    own = F.greatest(F.lit(1), F.floor(F.col("target") / (n_shards * F.lit(least_blocks)))).cast("bigint")
    sources = sources.withColumn("block", F.least(own, F.lit(block)))
    shared = F.col("block") == F.lit(block)
    n_own, shared_total = sources.agg(F.count_if(~shared), F.sum(F.when(shared, F.col("target")))).first()
    seats_shared = int((shared_total or 0.0) / block + 0.5)
    number = F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint")
    named = sources.withColumnRenamed("source", "name")
    dealt = sized.join(named, sized.source.eqNullSafe(named.name)).withColumn("shard", F.pmod(number, n_shards))
    shards = dealt.groupBy("source_no", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_size").alias("whole"), F.first("target").alias("goal"),
        F.first("block").alias("block"),
    )
    quotas = _quotas(shards, seats_shared, block, n_own > 0, max_repeats)

    ordered = Window.partitionBy("source_no", "shard").orderBy("key", "size", "tie")
    end = F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    laid = dealt.join(quotas, ["source_no", "shard"], "left").withColumn("end", end)
    words = F.least(F.coalesce("quota", F.lit(0)) * F.col("block"), F.col("shard_size") * max_repeats)
    place = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce("source", F.lit("null")), F.col("shard")))
    place = F.pmod(F.conv(F.substring(place, 1, 8), 16, 10).cast("bigint"), F.col("shard_size"))
    known = F.col("shard_size") > 0
    laid = laid.select(
        "row", "size", "source_size", "target",
        (F.col("end") - F.col("size")).alias("start"), "end", "shard_size",
        F.when(known, F.floor(words / F.col("shard_size"))).otherwise(0).cast("int").alias("rounds"),
        F.when(known, words % F.col("shard_size")).otherwise(0).alias("rest"),
        F.when(known, place - place % F.col("block")).otherwise(0).alias("place"),
    )
    whole = F.when(
        (F.col("rounds") > 0) & (F.col("size") > 0),
        F.array_repeat(F.struct(F.lit(0).cast("bigint").alias("first"), F.col("size").alias("end")), F.col("rounds")),
    ).otherwise(F.array().cast("array<struct<first:bigint,end:bigint>>"))

    def run(first: Column, last: Column) -> Column:
        a = F.greatest(first, F.col("start")) - F.col("start")
        b = F.least(last, F.col("end")) - F.col("start")
        return F.struct(a.cast("bigint").alias("first"), b.cast("bigint").alias("end"))

    stop = F.col("place") + F.col("rest")
    runs = F.array(run(F.lit(0), stop - F.col("shard_size")), run(F.col("place"), stop))
    copies = F.concat(whole, F.filter(runs, lambda r: r["end"] > r["first"]))
    taken = F.aggregate("copies", F.lit(0).cast("bigint"), lambda sum_, r: sum_ + r["end"] - r["first"])
    return laid.select("row", "size", "source_size", "target", copies.alias("copies")).withColumn("taken", taken)


def _quotas(shards: DataFrame, seats: int, block: int, some_own: bool, max_repeats: int) -> DataFrame:
    """(source_no, shard, shard_size, quota): the blocks that each shard wins.

    Sources with the common ``block`` are pool 0 and share ``seats``; one with smaller blocks, if there is
    ``some_own``, is a pool of its own.
    """
    votes = F.when(F.col("whole") > 0, F.col("goal") * F.col("shard_size") / F.col("whole")).otherwise(0.0)
    most = F.ceil(F.col("shard_size") * max_repeats / F.col("block")).cast("int")
    pool = F.when(F.col("block") == F.lit(block), F.lit(0)).otherwise(F.col("source_no")).cast("bigint")
    own_seats = F.floor(F.col("goal") / F.col("block") + 0.5).cast("bigint")
    bids = shards.select(
        pool.alias("pool"), own_seats.alias("seats"), "source_no", "shard", votes.alias("votes"), most.alias("most")
    ).filter("most > 0")
    bids = bids.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("most") - 1)))
    quotient = F.col("votes") / (2 * F.col("k") + 1)
    bids = bids.select("pool", "seats", "source_no", "shard", "k", quotient.alias("quotient"))
    order = [F.asc("pool"), F.desc("quotient"), F.asc("source_no"), F.asc("shard"), F.asc("k")]
    placed = numbered(bids, order, "place")
    won = placed.filter((F.col("pool") == 0) & (F.col("place") <= F.lit(seats))).select("source_no", "shard")
    if some_own:
        placed = placed.filter("pool > 0")
        first = placed.groupBy("pool").agg(F.min("place").alias("first"))
        own = placed.join(first, "pool").filter(F.col("place") - F.col("first") < F.col("seats"))
        won = won.unionAll(own.select("source_no", "shard"))
    won = won.groupBy("source_no", "shard").agg(F.count("*").alias("quota"))
    return shards.select("source_no", "shard", "shard_size").join(won, ["source_no", "shard"], "left")


def cut_words(text: Column | str, first: Column, end: Column) -> Column:
    """Words ``first`` to ``end`` of a text with the white space after them."""
    pieces = F.regexp_extract_all(text, F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    return F.array_join(F.slice(pieces, (first + 1).cast("int"), (end - first).cast("int")), "")


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of the mix with all columns of ``docs``: one for each copy of a document, cut texts only where
    the mix takes a part of it.  ``n_chars``, where there is such a column, follows the text."""
    rows = mix(docs, carry=docs.columns, **settings)
    rows = rows.select("row", "size", F.explode("copies").alias("copy"))
    whole = (F.col("copy.first") == 0) & (F.col("copy.end") == F.col("size"))
    text = F.when(whole, F.col("row.text")).otherwise(cut_words("row.text", F.col("copy.first"), F.col("copy.end")))
    rows = rows.withColumn("new_text", text)
    columns = {name: F.col(f"row.`{name}`") for name in docs.columns}
    columns["text"] = F.col("new_text")
    if "n_chars" in columns:
        columns["n_chars"] = F.length("new_text").cast("bigint")
    return rows.select(*[column.alias(name) for name, column in columns.items()])
