"""Benchmark decontamination by greedy string tiling.

A benchmark item and a document share *seeds*, runs of ``seed_words`` words with the same Karp-Rabin hash.
Seeds that follow each other grow to matches; the longest match is marked first, then the longest of what
is left unmarked on both sides, until nothing of ``seed_words`` words is left.  The share of the item's words
that are marked is its coverage.  Order does not matter, so a passage whose sentences were moved is found.

The benchmark is the query set: it is dealt into blocks of about ``block_words`` words, each block is
broadcast and meets all documents in one pass.  Texts are compared as lower-case words without ASCII
punctuation.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from weftline.llm.common import binary_texts, map_in_arrow, plain_words, without_text, word_count

BASE = np.uint64(0x9E3779B97F4A7C15)
TILE = T.StructType([T.StructField(name, T.LongType()) for name in ("doc_first", "item_first", "length")])
MATCH = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("coverage", T.DoubleType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("tiles", T.ArrayType(TILE)),
    ]
)
MATCHES = T.StructField("matches", T.ArrayType(MATCH))


def rolling_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of each run of ``length`` words, modulo 2**64."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = out * BASE + words[k : k + n]
    return out


def tile(
    runs: Iterable[tuple[int, int, int]], least: int, item_words: int | None = None
) -> list[tuple[int, int, int]]:
    """Greedy tiling of matches (document place, item place, length): the longest first, ties by place; what
    is left of a match that meets a marked word competes on with its unmarked pieces.  Of an item of ``item_words``
    words nothing more can be marked when fewer than ``least`` of them are left."""
    waiting = [(-length, q, p) for p, q, length in runs if length >= least]
    heapq.heapify(waiting)
    marked_doc, marked_item, tiles = set(), set(), []
    while waiting and (item_words is None or item_words - len(marked_item) >= least):
        length, q, p = heapq.heappop(waiting)
        free, pieces = 0, []
        for i in range(-length):
            if p + i in marked_doc or q + i in marked_item:
                if free >= least:
                    pieces.append((-free, q + i - free, p + i - free))
                free = 0
            else:
                free += 1
        if free == -length:
            tiles.append((p, q, free))
            marked_doc.update(range(p, p + free))
            marked_item.update(range(q, q + free))
            continue
        if free >= least:
            pieces.append((-free, q - length - free, p - length - free))
        for piece in pieces:
            heapq.heappush(waiting, piece)
    return tiles


@dataclass
class Index:
    """Words and seeds of a block of benchmark items."""

    items: list[tuple[int | None, np.ndarray]]
    chars: list[int]
    numbers: dict[bytes, int]
    seeds: list[Seeds]
    seed_words: int

    def matches(self, text: bytes | None, least: float) -> list[dict]:
        """The items that the text covers to ``least`` or more."""
        number = self.numbers.get
        words = np.array([number(word, 0) for word in plain_words(text or b"")], np.uint64)
        out = []
        for seeds in self.seeds:
            for item, runs in seeds.runs(words, self.items, least):
                item_id, own = self.items[item]
                tiles = tile(runs, seeds.length, len(own))
                coverage = sum(length for _, _, length in tiles) / len(own)
                if coverage >= least:
                    named = [{"doc_first": p, "item_first": q, "length": n} for p, q, n in sorted(tiles)]
                    sizes = {"n_words": len(own), "n_chars": self.chars[item]}
                    out.append((item, {"item_id": item_id, "coverage": coverage, **sizes, "tiles": named}))
        return [match for _, match in sorted(out, key=lambda m: m[0])]


@dataclass
class Seeds:
    """The seeds of ``length`` words: their hashes in order, and the items and places of each, one after the other."""

    length: int
    hashes: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    item_words: np.ndarray

    def runs(self, words: np.ndarray, items: list, least: float) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """(item, maximal matches) of the items that all matches together could cover.

        Places of different seeds are counted first, without the places in the text: an item whose seeds in the text reach
        less than ``least`` of its words is out, however often its seeds occur.
        """
        hashes = rolling_hashes(words, self.length)
        if not len(hashes):
            return
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hits = np.flatnonzero(self.hashes[at] == hashes)
        if not len(hits):
            return
        found = _spans(self.first, np.unique(at[hits]))
        item, place = self.item[found], self.place[found]
        order = np.lexsort((place, item))
        item, place = item[order], place[order]
        same = np.append(item[1:] == item[:-1], False)
        step = np.where(same, np.minimum(np.append(place[1:] - place[:-1], 0), self.length), self.length)
        reach = np.bincount(item, weights=step, minlength=len(self.item_words))
        able = reach >= least * self.item_words - 1e-9
        if not able[item].any():
            return
        sizes = self.first[at[hits] + 1] - self.first[at[hits]]
        pairs = _spans(self.first, at[hits])
        text_place = np.repeat(hits, sizes)
        wanted = able[self.item[pairs]]
        pairs, text_place = pairs[wanted], text_place[wanted]
        item, place = self.item[pairs], self.place[pairs]
        for one in np.unique(item):
            own = items[one][1]
            p, q = text_place[item == one], place[item == one]
            good = np.ones(len(p), bool)
            for k in range(self.length):  # equal hashes, equal words
                good &= words[p + k] == own[q + k]
            p, q = p[good], q[good]
            if not len(p):
                continue
            order = np.lexsort((p, p - q))
            p, q = p[order], q[order]
            new = np.flatnonzero(np.append(True, (np.diff(p) != 1) | (np.diff(q) != 1)))
            lengths = np.diff(np.append(new, len(p))) + self.length - 1
            yield int(one), list(zip(p[new].tolist(), q[new].tolist(), lengths.tolist(), strict=True))


def _spans(first: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """All numbers from ``first[c]`` to ``first[c + 1]`` for each of ``chosen``, one span after the other."""
    sizes = first[chosen + 1] - first[chosen]
    ends = np.cumsum(sizes)
    return np.arange(ends[-1]) + np.repeat(first[chosen] - (ends - sizes), sizes)


def build_index(
    items: Iterable[tuple[int | None, str | None]], seed_words: int = 5, short_items: bool = False
) -> Index:
    """An index of (item_id, text).  An item of fewer than ``seed_words`` words is its own seed with
    ``short_items``, else it cannot be matched."""
    numbers: dict[bytes, int] = {}
    kept, chars, places = [], [], defaultdict(list)
    for item_id, text in items:
        words = plain_words((text or "").encode())
        own = np.array([numbers.setdefault(word, len(numbers) + 1) for word in words], np.uint64)
        length = min(seed_words, len(own)) if short_items else seed_words
        if not 0 < length <= len(own):
            continue
        places[length].append((len(kept), rolling_hashes(own, length)))
        kept.append((item_id, own))
        chars.append(sum(len(word.decode()) for word in words))
    item_words = np.array([len(own) for _, own in kept], np.int64)
    seeds = []
    for length, of_items in sorted(places.items()):
        hashes = np.concatenate([found for _, found in of_items])
        item = np.concatenate([np.full(len(found), i, np.int64) for i, found in of_items])
        place = np.concatenate([np.arange(len(found)) for _, found in of_items])
        order = np.argsort(hashes, kind="stable")
        values, first = np.unique(hashes[order], return_index=True)
        seeds.append(Seeds(length, values, np.append(first, len(hashes)), item[order], place[order], item_words))
    return Index(kept, chars, numbers, seeds, seed_words)


def benchmark_blocks(benchmark: DataFrame, block_words: int = 2_000_000) -> Iterator[list]:
    """The items in blocks of about ``block_words`` words, dealt by a hash; one block at a time is fetched."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    total = rows.agg(F.sum(word_count("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_words))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    for i in range(n_blocks):
        yield sorted(
            ((row["item_id"], row["text"]) for row in rows.filter(block == i).collect()),
            key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""),
        )


def match_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    min_coverage: float = 0.6,
    seed_words: int = 5,
    block_words: int = 2_000_000,
    carry: Sequence[str] | None = None,
    short_items: bool = False,
) -> DataFrame:
    """The ``carry`` columns of ``docs(text, ...)``, all by default, as the struct ``row`` with ``matches``: the
    benchmark items of ``benchmark(item_id, text)`` that the text covers to ``min_coverage`` or more, with
    their tiles in words.

    An item of fewer than ``seed_words`` words is matched as a whole with ``short_items`` (its one tile covers it),
    else not at all.  Words are cut at white space and ASCII punctuation: in a script without spaces each run
    between them is one word, so that such an item is found only where the text has the same whole runs.

    Null and empty texts and items match nothing; repeated rows and ids are looked at one by one.
    """
    sc = docs.sparkSession.sparkContext
    carry = list(carry or docs.columns)
    rows, again = without_text(docs, carry)
    schema = T.StructType([*rows.schema.fields, MATCHES])
    for block in benchmark_blocks(benchmark, block_words):
        shared = sc.broadcast(build_index(block, seed_words, short_items))
        rows = map_in_arrow(rows, _matcher(shared, min_coverage, "matches" in rows.columns), schema)
    return rows.select(again, "matches")


def _matcher(shared, least: float, has_matches: bool):
    """Add the matches of one block to those of the blocks before it."""

    def match(batches):
        for batch in batches:
            found = [shared.value.matches(text, least) for text in binary_texts(batch.column("seen"))]
            if has_matches:
                found = [a + b for a, b in zip(batch.column("matches").to_pylist(), found, strict=True)]
            matches = pa.array(found, to_arrow_type(MATCHES.dataType))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest"), batch.column("seen"), matches], ["rest", "seen", "matches"]
            )

    return match


def clean_documents(docs: DataFrame, benchmark: DataFrame, min_item_chars: int = 8, **settings) -> DataFrame:
    """The rows of ``docs`` that cover no benchmark item of ``min_item_chars`` letters or more, with all their columns.

    Shorter items, as a plain ``yes``, are in texts of every kind; ``match_documents`` reports them, but no text is
    dropped for them.
    """
    found = match_documents(docs, benchmark, **settings)
    return found.filter(~F.exists("matches", lambda m: m["n_chars"] >= min_item_chars)).select("row.*")
