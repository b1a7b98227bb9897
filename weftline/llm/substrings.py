"""Exact removal of repeated passages by super-k-mers.

A window is ``WINDOW`` consecutive words.  Its minimiser is the smallest hash of ``MINIMISER`` consecutive words
in it.  Consecutive windows mostly share their minimiser; such a run of windows, a super-k-mer, is a unit: two
equal windows have equal minimisers, so they lie in runs of the same bucket.

1. Every document gives its runs as (minimiser, digest of the run's words, first window, number of windows).
2. A minimiser that no two documents share drops out.  Where all runs of a minimiser are equal, the windows of
   the run start first in the smallest document that has the run: later documents lose them.
3. Where the runs of a bucket differ, every distinct run travels once, packed as one string, and the bucket
   sorts the windows of its strings: the first document of each window follows exactly.  A bucket of more than
   ``bucket_windows`` windows is not brought together; its windows are dealt by their own digest instead.
4. The windows that are to go meet their document again, which is cut.

Copies of a document have the same runs and are pre-aggregated by digest, so a group of any size costs one
string.  Words are compared exactly where runs differ, by digests of 128 bits in crowded buckets and of 64 bits
within one minimiser where runs are taken as equal.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import binary_texts, map_in_arrow, whole_row
from weftline.session import stored

WINDOW = 50
MINIMISER = 5
#: Windows of a run at most; a longer one is cut.
PIECE = 2_000
NO_ID = (1 << 63) - 1
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
RUNS = "order_id bigint, tie bigint, mins array<bigint>, digests array<bigint>, firsts array<int>, counts array<int>"
BAD = "min bigint, digest bigint, at int, n int"


def runs_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, number of windows) of each run of windows with one minimiser."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.array(list(map(zlib.crc32, words)), np.uint64)
    hashes = np.zeros(len(words) - MINIMISER + 1, np.uint64)
    for k in range(MINIMISER):
        hashes = hashes * MULTIPLIER + codes[k : k + len(hashes)]
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(29)
    width, reach, low = WINDOW - MINIMISER + 1, 1, hashes
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    low = np.minimum(low[:n], low[width - reach : width - reach + n])
    first = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
    return low[first], first, np.diff(np.append(first, n))


def pieces_of(mins: np.ndarray, firsts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same runs, those of more than ``PIECE`` windows in pieces; the words of two pieces overlap by a window less one.

    A text that repeats one word is a single run of any length, and its pieces are equal and counted once.
    """
    n = -(-counts // PIECE)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    pieces = np.minimum(np.repeat(counts, n) - place * PIECE, PIECE)
    return np.repeat(mins, n), np.repeat(firsts, n) + place * PIECE, pieces


def packed(words: list[bytes], first: int, count: int) -> bytes:
    """The words of a run of windows as one string."""
    return b" ".join(words[first : first + count + WINDOW - 1])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [[], [], [], []]
        for text in binary_texts(batch.column("text")):
            words = [] if text is None else text.split()
            mins, firsts, counts = pieces_of(*runs_of(words))
            pairs = zip(firsts.tolist(), counts.tolist(), strict=True)
            digests = [xxhash.xxh64_intdigest(packed(words, first, count)) for first, count in pairs]
            for column, values in zip(columns, (mins, np.array(digests, np.uint64), firsts, counts), strict=True):
                column.append(values.view(np.int64))
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        arrays = [pa.array(c, kind) for c, kind in zip(columns, (longs, longs, ints, ints), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("order_id"), batch.column("tie"), *arrays],
            ["order_id", "tie", "mins", "digests", "firsts", "counts"],
        )


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(min, digest, owner, packed) of the runs that a text is asked for."""
    for batch in batches:
        for text, wanted, owner in zip(
            binary_texts(batch.column("text")), batch.column("wanted"), batch.column("order_id"), strict=True
        ):
            words, rows = text.split(), wanted.as_py()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["min"] for r in rows], pa.int64()),
                    pa.array([r["digest"] for r in rows], pa.int64()),
                    pa.array([owner.as_py()] * len(rows), pa.int64()),
                    pa.array([packed(words, r["first"], r["n"]) for r in rows], pa.binary()),
                ],
                ["min", "digest", "owner", "packed"],
            )


def windows_of(run: bytes) -> list[bytes]:
    """The windows of a packed run, each as one string."""
    ends = np.append(np.flatnonzero(np.frombuffer(run, np.uint8) == 32), len(run)).tolist()
    starts = [0, *(end + 1 for end in ends[:-1])]
    return [run[a:b] for a, b in zip(starts, ends[WINDOW - 1 :], strict=False)]


def _bad_rows(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    """Rows (min, digest, at, n) for the runs of windows marked in (min, digest, marks)."""
    out = []
    for low, digest, marks in rows:
        edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
        out += [(low, digest, int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    arrays = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(arrays, ["min", "digest", "at", "n"])


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of each bucket in order; those that start in an earlier document are marked."""
    for batch in batches:
        found = []
        for low, strings in zip(batch.column("min").to_pylist(), batch.column("strings"), strict=True):
            strings = strings.as_py()
            windows = []
            for k, run in enumerate(strings):
                windows += [(w, run["owner"], k, i) for i, w in enumerate(windows_of(run["packed"]))]
            windows.sort()
            marks = [np.zeros(run["packed"].count(b" ") + 2 - WINDOW, bool) for run in strings]
            last, owner = None, 0
            for window, own, k, i in windows:
                if window != last:
                    last, owner = window, own
                elif own > owner:
                    marks[k][i] = True
            found += [(low, run["digest"], m) for run, m in zip(strings, marks, strict=True)]
        yield _bad_rows(found)


def _window_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, digest, owner, run in zip(*(batch.column(c).to_pylist() for c in ("min", "digest", "owner", "packed")), strict=True):
            names = [hashlib.md5(w).digest() for w in windows_of(run)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([low] * len(names), pa.int64()), pa.array([digest] * len(names), pa.int64()),
                    pa.array([owner] * len(names), pa.int64()), pa.array(range(len(names)), pa.int32()),
                    pa.array(names, pa.binary()),
                ],
                ["min", "digest", "owner", "at", "window"],
            )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, spans in zip(binary_texts(batch.column("text")), batch.column("spans"), strict=True):
            words = [] if text is None else text.split()
            n_words.append(len(words))
            spans = spans.as_py()
            if spans:
                edges = np.zeros(len(words) + 1, np.int64)
                for span in spans:
                    edges[span["first"]] += 1
                    edges[span["first"] + span["n"] + WINDOW - 1] -= 1
                stay = np.cumsum(edges[:-1]) == 0
                words = [word for word, own in zip(words, stay.tolist(), strict=True) if own]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words).decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            ["row", "n_words", "n_removed", "kept"],
        )


def _joined_places(late: DataFrame) -> DataFrame:
    """(min, digest, at, n): the places of each run, at most ``PIECE``, as stretches of neighbours."""
    places = late.groupBy("min", "digest").agg(F.array_sort(F.collect_list("at")).alias("p"))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("p") - 1), lambda i: (i == 0) | (F.get("p", i) != F.get("p", i - 1) + 1)
    )
    cut = places.select("min", "digest", "p", starts.alias("s"))
    stretches = F.transform(
        "s", lambda i, k: F.struct(F.get("p", i).alias("at"), (F.coalesce(F.get("s", k + 1), F.size("p")) - i).alias("n"))
    )
    return cut.select("min", "digest", F.inline(stretches))


def removable(docs: DataFrame, texts: DataFrame, bucket_windows: int) -> DataFrame:
    """(order_id, tie, first, n): runs of ``n`` windows from word ``first`` on that start in an earlier document."""
    runs = stored(map_in_arrow(docs.select("order_id", "tie", "text"), _runs, RUNS), "runs")
    names = {"mins": "min", "digests": "digest", "firsts": "first", "counts": "n"}
    each = runs.select("order_id", "tie", F.explode(F.arrays_zip(*names)).alias("r"))
    each = each.select("order_id", "tie", *[F.col(f"r.{old}").alias(new) for old, new in names.items()])
    shared = each.groupBy("min").agg(
        F.min("order_id").alias("low"), F.max("order_id").alias("high"),
        (F.min("digest") != F.max("digest")).alias("differ"),
    ).filter("low < high")
    hits = stored(each.join(shared.drop("high"), "min"), "shared-runs")
    span = ["order_id", "tie", "first", "n"]
    equal = hits.filter("not differ and order_id > low").select(*span)

    mixed = hits.filter("differ").select("min", "digest", *span)
    lowest = mixed.groupBy("min", "digest").agg(F.min(F.struct(*span)).alias("own"))
    lowest = stored(lowest.select("min", "digest", "own.*"), "distinct-runs")
    owner = lowest.select("min", "digest", F.col("order_id").alias("owner"))
    owned = mixed.join(owner, ["min", "digest"])
    copies = owned.filter("order_id > owner").select(*span)

    asked = lowest.groupBy("order_id", "tie").agg(F.collect_list(F.struct("min", "digest", "first", "n")).alias("wanted"))
    asked = texts.join(asked, ["order_id", "tie"]).select("row", "order_id", "text", "wanted")
    strings = map_in_arrow(asked, _strings, "min bigint, digest bigint, owner bigint, packed binary")
    sizes = lowest.groupBy("min").agg(F.sum("n").alias("n_windows"))
    strings = stored(strings.join(sizes, "min"), "packed-runs")
    normal = strings.filter(F.col("n_windows") <= bucket_windows).groupBy("min")
    normal = normal.agg(F.collect_list(F.struct("digest", "owner", "packed")).alias("strings"))
    bad = map_in_arrow(normal, _sort_buckets, BAD)
    crowded = strings.filter(F.col("n_windows") > bucket_windows).select("min", "digest", "owner", "packed")
    window = map_in_arrow(crowded, _window_digests, "min bigint, digest bigint, owner bigint, at int, window binary")
    earliest = window.groupBy("window").agg(F.min("owner").alias("earliest"))
    late = window.join(earliest, "window").filter("owner > earliest")
    bad = bad.unionAll(_joined_places(late.select("min", "digest", "at")))
    own = owned.filter("order_id = owner").drop("n").join(bad, ["min", "digest"])
    own = own.select("order_id", "tie", (F.col("first") + F.col("at")).alias("first"), "n")
    return equal.unionAll(copies).unionAll(own)


def remove_repeats(docs: DataFrame, bucket_windows: int = 40_000, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns of every row of ``docs(doc_id, text)`` as the struct ``row``, with ``n_words``,
    ``n_removed`` and ``kept``, the words that stay, joined by a space.

    A word goes when a window that covers it also starts in a document with a smaller id.  A null id is larger
    than all others; rows with an equal id do not take words from each other.  Null and empty texts have no
    words, texts of fewer than ``WINDOW`` words lose none.
    """
    docs = docs.select(
        whole_row(docs.select(*carry)).alias("row"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("order_id"),
        F.xxhash64("text").alias("tie"),
        "text",
    )
    texts = docs.repartition("order_id", "tie")
    spans = removable(docs, texts, bucket_windows).groupBy("order_id", "tie")
    spans = spans.agg(F.collect_list(F.struct("first", "n")).alias("spans"))
    laid = texts.join(spans, ["order_id", "tie"], "left").select("row", "text", "spans")
    kind = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    return map_in_arrow(laid, _cut, T.StructType([docs.schema["row"], *kind, T.StructField("kept", T.StringType())]))
