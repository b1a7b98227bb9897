"""Token ids in files of directly addressable codes.

An id is split into chunks of eight bits.  Level 0 holds the low chunk of every id, with a bitmap that tells
which ids go on; level 1 holds the next chunk of those only, and so on.  A rank directory per bitmap counts
the bits before every block of 512, so the place of an id on the next level, and with it any single id, is
found without decoding a block.

Documents lie in ascending order of their id.  The corpus is dealt by range, every part is encoded in
order and written as segments of whole documents.  A segment is one row of a Parquet table: ids and lengths
of its documents, its place in the part, and the levels as binary columns; Spark's committed writer makes a
rerun of a lost task safe.  A second table has the number of ids before each part.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm.common import arrow_batches, binary_texts, grouped, map_in_arrow
from weftline.llm.pretokens import cut_keys, encode_pieces, keys_of, special_strings

SEGMENT_IDS = 1 << 18
RANK_BLOCK = 512
MEMO_KEYS = 250_000
MEMO_BYTES = 64_000_000
LONG_PIECE = 100
GROUP_BYTES = 1_000_000
#: A batch is held in memory by Spark and by the worker.
BATCH_BYTES = 4_000_000
SOME_RUNS = 1 << 15
#: What makes a text odd: empty, spaces at an end or side by side but for one empty line, spaces that are no space or line
#: feed, NUL.
ODD_SPACES = (
    r"\A\z|\A[ \n]|[ \n]\z| [ \n]|\n |\n\n\n|[\x00\t\x0b\x0c\r\x1c-\x1f]|"
    r"[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
LEVELS = "array<struct<chunks:binary,more:binary,ranks:binary>>"
SEGMENTS = (
    "part int, segment int, before bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, "
    f"starts array<bigint>, levels {LEVELS}"
)
_LEVELS = pa.list_(pa.struct([("chunks", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())]))


def encode_levels(ids: np.ndarray) -> list[dict[str, bytes]]:
    """Unsigned 32-bit ids as levels of chunks, continuation bitmap and rank directory."""
    levels, rest = [], ids.astype("<u4")
    while True:
        on = rest > 0xFF
        more = np.packbits(on, bitorder="little")
        ends = np.add.reduceat(on, np.arange(0, len(on), RANK_BLOCK), dtype=np.int64) if len(on) else on
        ranks = (np.cumsum(ends) - ends).astype("<u4")
        levels.append({"chunks": rest.astype(np.uint8).tobytes(), "more": more.tobytes(), "ranks": ranks.tobytes()})
        rest = rest[on] >> 8
        if not len(rest):
            return levels


def decode_levels(levels: list[dict[str, bytes]]) -> np.ndarray:
    """All ids, in order."""
    ids = np.empty(0, np.uint32)
    for level in reversed(levels):
        low = np.frombuffer(level["chunks"], np.uint8).astype(np.uint32)
        on = np.unpackbits(np.frombuffer(level["more"], np.uint8), count=len(low), bitorder="little").astype(bool)
        if len(ids):
            low[on] |= ids << np.uint32(8)
        ids = low
    return ids


def ids_at(levels: list[dict[str, bytes]], places: np.ndarray) -> np.ndarray:
    """The ids at some places, each by one step per level."""
    at = np.asarray(places, np.int64)
    ids, open_ = np.zeros(len(at), np.uint32), np.arange(len(at))
    for k, level in enumerate(levels):
        chunks, more = np.frombuffer(level["chunks"], np.uint8), np.frombuffer(level["more"], np.uint8)
        ids[open_] |= chunks[at].astype(np.uint32) << np.uint32(8 * k)
        on = (more[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        open_, at = open_[on], at[on]
        if not len(at):
            break
        block = at // RANK_BLOCK
        rank = np.frombuffer(level["ranks"], "<u4")[block].astype(np.int64)
        octets = RANK_BLOCK // 8
        rows = block[:, None] * octets + np.arange(octets)
        bits = np.where(rows < len(more), more[np.minimum(rows, len(more) - 1)], 0)
        inside = (at % RANK_BLOCK)[:, None] - 8 * np.arange(octets)
        mask = np.where(inside >= 8, 255, np.where(inside > 0, (1 << np.clip(inside, 0, 8)) - 1, 0))
        at = rank + np.bitwise_count(bits & mask.astype(np.uint8)).sum(axis=1, dtype=np.int64)
    return ids


def _runs(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of ``pool``, one after the other; ``SOME_RUNS`` at a time, as their places take several times their room."""
    out, done = np.empty(sizes.sum(), pool.dtype), 0
    for i in range(0, len(sizes), SOME_RUNS):
        some = sizes[i : i + SOME_RUNS]
        stops = np.cumsum(some)
        places = np.repeat(starts[i : i + SOME_RUNS] - (stops - some), some) + np.arange(stops[-1])
        out[done : done + len(places)] = pool[places]
        done += len(places)
    return out


class Encoder:
    """Ids of texts as little-endian 32-bit bytes; pieces of pre-tokens seen before are looked up.

    Texts whose words stand between single spaces, line feeds and empty lines are cut by Arrow; other texts are cut by
    ``keys_of``.
    The different pre-tokens of a group of texts are cut into words and signs, and only the pieces that are not
    remembered go through Python.

    The memo is a column of pieces beside the place and number of their ids in one array.  When it has more than twice
    ``MEMO_KEYS`` pieces, or more than ``MEMO_BYTES`` of them, the ``MEMO_KEYS`` that were used last stay, without
    long ones.
    """

    def __init__(self, tokenizer_file: str):
        self.file, self.special = tokenizer_file, special_strings(tokenizer_file)
        self.odd = "|".join([ODD_SPACES, *map(re.escape, self.special)])
        self.pieces, self.ids = pa.array([], pa.string()), np.zeros(0, np.uint32)
        self.sizes, self.starts, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.group = 0

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        try:
            column = pa.array(texts, pa.binary()).cast(pa.string())
            odd = pc.match_substring_regex(column, self.odd).to_numpy(zero_copy_only=False)
            plain = iter(self.encode_plain(column.filter(pa.array(~odd))))
        except pa.ArrowInvalid:  # not UTF-8
            odd, plain = np.ones(len(texts), bool), iter(())
        split = [keys_of(t.decode("utf-8", "replace"), self.special) for t, o in zip(texts, odd, strict=True) if o]
        coded = pa.array([key for keys in split for key in keys], pa.string()).dictionary_encode()
        keys = pc.replace_substring_regex(coded.dictionary, r"\A\x00 ([^\x00 \n])", r"\1")  # with its space: a plain key
        rest = iter(self.joined(keys, coded.indices.to_numpy(), np.cumsum([len(keys) for keys in split])))
        return [next(rest) if o else next(plain) for o in odd]

    def encode_plain(self, column: pa.Array) -> list[bytes]:
        """Ids of texts without odd spaces, which are not empty.

        The tokenizer takes the two line feeds around an empty line one by one, as the keys that come out here.
        """
        if not len(column):
            return []
        pieces = pc.split_pattern(pc.replace_substring(column, "\n", " \n"), " ")
        ends = np.cumsum(pc.list_value_length(pieces).to_numpy())
        first = np.concatenate([[0], ends[:-1]])
        flat = pieces.flatten()
        coded = flat.dictionary_encode()
        index = coded.indices.to_numpy().copy()
        index[first] = len(coded.dictionary) + np.arange(len(first))  # the first piece of a text has no space before it
        starts = pc.binary_join_element_wise("\x00", flat.take(pa.array(first)), "")
        return self.joined(pa.concat_arrays([coded.dictionary, starts]), index, ends)

    def joined(self, keys: pa.Array, index: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The ids of texts that are ``keys[index]``, cut at ``ends``."""
        if not len(keys):
            return [b""] * len(ends)
        pieces, places = cut_keys(self.file, keys)
        at = self.lookup(pieces)
        cut = places >= 0
        at = at[places[cut]]
        pool = _runs(self.ids, self.starts[at], self.sizes[at])
        sizes = np.zeros(places.shape, np.int64)
        sizes[cut] = self.sizes[at]
        sizes = sizes.sum(axis=1)
        n = sizes[index]
        ids = _runs(pool, (np.cumsum(sizes) - sizes)[index], n)
        cuts = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], ends])].tolist()
        return [ids[i:j].tobytes() for i, j in pairwise(cuts)]

    def lookup(self, pieces: pa.Array) -> np.ndarray:
        """The place of each piece in the memo, which then has all of them.

        The different pieces are few beside the memo: the memo is looked up in them, not they in the memo.
        """
        if len(self.pieces) > 2 * MEMO_KEYS or self.pieces.nbytes > MEMO_BYTES:
            self.forget()
        coded = pieces.dictionary_encode()
        found = pc.index_in(self.pieces, value_set=coded.dictionary)
        known = found.is_valid().to_numpy(zero_copy_only=False)
        at = np.full(len(coded.dictionary), -1, np.int64)
        at[found.drop_null().to_numpy()] = np.flatnonzero(known)
        missing = at < 0
        if missing.any():
            missed = coded.dictionary.filter(pa.array(missing))
            new, sizes, ids = encode_pieces(self.file, missed)
            at[missing] = len(self.pieces) + pc.index_in(missed, value_set=new).to_numpy()
            self.pieces = pa.concat_arrays([self.pieces, new])
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])
            self.used = np.concatenate([self.used, np.zeros(len(new), np.int64)])
        self.group += 1
        self.used[at] = self.group
        return at[coded.indices.to_numpy()]

    def forget(self) -> None:
        """Leave the pieces that were used last."""
        short = np.flatnonzero(pc.binary_length(self.pieces).to_numpy() <= LONG_PIECE)
        kept = short[np.argsort(-self.used[short], kind="stable")[:MEMO_KEYS]]
        self.ids = _runs(self.ids, self.starts[kept], self.sizes[kept])
        self.pieces, self.sizes, self.used = self.pieces.take(pa.array(kept)), self.sizes[kept], self.used[kept]
        self.starts = np.cumsum(self.sizes) - self.sizes


_ENCODERS: dict[str, Encoder] = {}


def _encoder(tokenizer_file: str) -> Encoder:
    """One per worker process, so that later tasks find its pre-tokens."""
    if tokenizer_file not in _ENCODERS:
        _ENCODERS[tokenizer_file] = Encoder(tokenizer_file)
    return _ENCODERS[tokenizer_file]


def _segments(tokenizer_file: str, end_id: int, segment_ids: int):
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer_file), TaskContext.get().partitionId()
        names, parts, size, before, number = [], [], 0, 0, 0

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            lengths = [len(p) // 4 for p in parts]
            starts = (np.cumsum(lengths) - lengths).tolist()
            values = [
                ([part], pa.int32()), ([number], pa.int32()), ([before], pa.int64()), ([len(ids)], pa.int64()),
                ([names], pa.list_(pa.int64())), ([lengths], pa.list_(pa.int64())), ([starts], pa.list_(pa.int64())),
                ([encode_levels(ids)], _LEVELS),
            ]
            columns = ["part", "segment", "before", "n_ids", "doc_ids", "lengths", "starts", "levels"]
            return pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in values], columns)

        for batch in batches:
            doc_ids = iter(batch.column("doc_id").to_pylist())
            for group in grouped(binary_texts(batch.column("text")), GROUP_BYTES):
                for ids in encoder(group):
                    names.append(next(doc_ids))
                    parts.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= segment_ids:
                        yield segment()
                        names, parts, before, size, number = [], [], before + size, 0, number + 1
        if names:
            yield segment()

    return write


def write_token_files(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int, segment_ids: int = SEGMENT_IDS
) -> None:
    """Encode ``docs(doc_id, text)`` and write ``path``/segments and ``path``/parts.

    Null texts are empty, every document ends with ``end_id``.  Null ids come first; rows with an equal id
    are ordered by a hash of the text, and equal rows are written one after the other.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    order = [F.asc("doc_id"), F.asc("tie")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    segments = map_in_arrow(dealt, _segments(tokenizer_file, end_id, segment_ids), SEGMENTS)
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        segments.write.parquet(f"{path}/segments")
    written = docs.sparkSession.read.schema(SEGMENTS).parquet(f"{path}/segments")
    sizes = written.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes.withColumn("start", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))).write.parquet(f"{path}/parts")


def _tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    parts = spark.read.schema("part int, n_ids bigint, start bigint").parquet(f"{path}/parts")
    return spark.read.schema(SEGMENTS).parquet(f"{path}/segments"), parts.select("part", "start")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            [row] = batch.slice(i, 1).to_pylist()
            octets = decode_levels(row["levels"]).astype("<u4").tobytes()
            ends = np.cumsum(row["lengths"])
            starts = ends - row["lengths"]
            digests = [zlib.crc32(octets[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["first"], pa.int64()),
                    pa.array(row["lengths"], pa.int64()), pa.array(digests, pa.int64()),
                ],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, decoded from the files."""
    segments, parts = _tables(spark, path)
    placed = segments.join(parts, "part").select(
        (F.col("start") + F.col("before")).alias("first"), "doc_ids", "lengths", "levels"
    )
    return map_in_arrow(placed, _digests, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _lookups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            wanted = row["wanted"]
            ids = ids_at(row["levels"], np.array([w["at"] for w in wanted], np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([w["doc_id"] for w in wanted], pa.int64()), pa.array([w["k"] for w in wanted], pa.int64()),
                    pa.array(ids, pa.int64()),
                ],
                ["doc_id", "k", "id"],
            )


def read_tokens(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(doc_id, k, id) for ``wanted(doc_id, k)``: token ``k``, from 0, of a document.

    Only the segments with such documents are touched, and in them only the places asked for.  Places outside
    a document and unknown documents give no row.
    """
    segments, _ = _tables(spark, path)
    index = segments.select(
        "part", "segment", F.explode(F.arrays_zip("doc_ids", "lengths", "starts")).alias("d")
    ).select("part", "segment", F.col("d.doc_ids").alias("doc_id"), F.col("d.lengths").alias("n"), F.col("d.starts").alias("first"))
    found = wanted.select("doc_id", "k").join(index, "doc_id").filter("k >= 0 and k < n")
    places = F.struct("doc_id", F.col("k").cast("bigint").alias("k"), (F.col("first") + F.col("k")).alias("at"))
    asked = found.groupBy("part", "segment").agg(F.collect_list(places).alias("wanted"))
    rows = segments.select("part", "segment", "levels").join(asked, ["part", "segment"]).select("levels", "wanted")
    return map_in_arrow(rows, _lookups, "doc_id bigint, k bigint, id bigint")
