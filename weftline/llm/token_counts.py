"""Token counts without token ids: pieces are counted once per distinct pre-token.

Documents are read in blocks.  A block keeps how often each of its documents has each pre-token, as a sparse
matrix over the block's own list of pre-tokens.  These lists, with every pre-token once per block, are dealt by
the pre-token; there equal ones lie together, are given to the tokenizer once and the number of their pieces
goes back to the blocks, where matrix times numbers gives the counts.

Pre-tokens that make up one in ``one_in`` of the corpus or more are counted beforehand and broadcast: by
arithmetic there are at most ``one_in`` of them.  A block sums them on the spot, so its matrix holds the rare ones
only.  Which pre-tokens these are decides how much travels and never what comes out.

A pre-token has one row per block, however many documents have it, so no key is hot.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import binary_texts, grouped, map_in_arrow
from weftline.llm.pretokens import encode_keys, keys_of, special_strings
from weftline.session import stored

BLOCK_BYTES = 32_000_000
GROUP_BYTES = 1_000_000
ONE_IN = 1_000_000
PLACE_BITS, BLOCK_BITS = 27, 15
BLOCKS = (
    "block bigint, keys array<string>, doc_ids array<bigint>, n_bytes array<bigint>, "
    "known array<bigint>, ends array<bigint>, places binary, times binary"
)
COUNTS = "doc_id bigint, n_bytes bigint, n_tokens bigint"


def _frequent_in_blocks(tokenizer_file: str, block_bytes: int, one_in: int):
    """(key, n) of the pre-tokens that make up one in ``one_in`` of a block or more."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special, counts, size = special_strings(tokenizer_file), Counter(), 0

        def most() -> pa.RecordBatch:
            least = counts.total() / one_in
            best = [(key, n) for key, n in counts.items() if n >= least]
            keys, times = [key for key, _ in best], [n for _, n in best]
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(times, pa.int64())], ["key", "n"])

        for batch in batches:
            for text in binary_texts(batch.column("text")):
                counts.update(keys_of((text or b"").decode("utf-8", "replace"), special))
                size += len(text or b"")
                if size >= block_bytes:
                    yield most()
                    counts, size = Counter(), 0
        if counts:
            yield most()

    return read


def frequent_pieces(docs: DataFrame, tokenizer_file: str, block_bytes: int, one_in: int) -> dict[str, int]:
    """Number of pieces of the pre-tokens that make up one in ``one_in`` of what the blocks report or more."""
    reader = _frequent_in_blocks(tokenizer_file, block_bytes, one_in)
    found = map_in_arrow(docs.select("text"), reader, "key string, n bigint")
    found = stored(found.groupBy("key").agg(F.sum("n").alias("n")), "frequent-pre-tokens")
    total = found.agg(F.sum("n")).first()[0] or 0
    keys = [row["key"] for row in found.filter(F.col("n") * one_in >= total).select("key").collect()]
    return dict(zip(keys, map(len, encode_keys(tokenizer_file, keys)), strict=True))


class _Block:
    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.places: dict[str, int] = {}
        self.doc_ids, self.n_bytes, self.known, self.ends = [], [], [], []
        self.at, self.times = [], []

    def add(self, doc_id: int | None, text: bytes, pieces: dict[str, int], special: Sequence[str]) -> None:
        known, at, times, places = 0, [], [], self.places
        for key, n in Counter(keys_of(text.decode("utf-8", "replace"), special)).items():
            if key in pieces:
                known += n * pieces[key]
            else:
                at.append(places.setdefault(key, len(places)))
                times.append(n)
        self.at.append(np.array(at, "<u4"))
        self.times.append(np.array(times, "<u4"))
        self.doc_ids.append(doc_id)
        self.n_bytes.append(len(text))
        self.known.append(known)
        self.ends.append((self.ends[-1] if self.ends else 0) + len(at))
        self.size += len(text)

    def row(self) -> pa.RecordBatch:
        if len(self.places) >> PLACE_BITS:
            raise ValueError("too many different pre-tokens in a block")
        longs, at, times = pa.list_(pa.int64()), np.concatenate(self.at), np.concatenate(self.times)
        values = [
            ("block", [self.number], pa.int64()), ("keys", [list(self.places)], pa.list_(pa.string())),
            ("doc_ids", [self.doc_ids], longs), ("n_bytes", [self.n_bytes], longs), ("known", [self.known], longs),
            ("ends", [self.ends], longs), ("places", [at.tobytes()], pa.binary()), ("times", [times.tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays([pa.array(v, kind) for _, v, kind in values], [name for name, _, _ in values])


def _blocks(tokenizer_file: str, block_bytes: int, frequent: Broadcast):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, special = frequent.value, special_strings(tokenizer_file)
        block = _Block(TaskContext.get().partitionId() << BLOCK_BITS)
        for batch in batches:
            doc_ids = iter(batch.column("doc_id").to_pylist())
            for group in grouped(binary_texts(batch.column("text")), GROUP_BYTES):
                for text in group:
                    block.add(next(doc_ids), text, pieces, special)
                if block.size >= block_bytes:
                    yield block.row()
                    block = _Block(block.number + 1)
        if block.doc_ids:
            yield block.row()

    return read


def _pieces(tokenizer_file: str):
    """Number of pieces for rows that come sorted by key; equal keys are encoded once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pieces = None, 0
        for batch in batches:
            runs = batch.column("key").dictionary_encode()
            keys = runs.dictionary.to_pylist()
            new = [key for key in keys if key != last]
            numbers = dict(zip(new, map(len, encode_keys(tokenizer_file, new)), strict=True)) | {last: pieces}
            per_key = np.array([numbers[key] for key in keys], np.int32)
            at = runs.indices.to_numpy()
            if len(at):
                last = keys[at[-1]]
                pieces = numbers[last]
            yield pa.RecordBatch.from_arrays([batch.column("slot"), pa.array(per_key[at], pa.int32())], ["slot", "pieces"])

    return count


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            counted = row["counted"].values.to_numpy(zero_copy_only=False)
            longs = {n: row[n].values.to_numpy(zero_copy_only=False) for n in ("n_bytes", "known", "ends")}
            pieces = np.zeros(len(counted), np.int64)
            pieces[counted >> 32] = counted & 0xFFFFFFFF
            at, times = (np.frombuffer(row[n].as_py(), "<u4") for n in ("places", "times"))
            total = np.concatenate([[0], np.cumsum(pieces[at] * times)])
            ends = np.concatenate([[0], longs["ends"]])
            n_tokens = longs["known"] + total[ends[1:]] - total[ends[:-1]]
            yield pa.RecordBatch.from_arrays(
                [row["doc_ids"].values, pa.array(longs["n_bytes"], pa.int64()), pa.array(n_tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )


def count_tokens(
    docs: DataFrame, tokenizer_file: str, block_bytes: int = BLOCK_BYTES, one_in: int = ONE_IN
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for each row of ``docs(doc_id, text)``.

    Null texts are empty and have no tokens; rows with an equal id are counted one by one.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    pieces = frequent_pieces(texts, tokenizer_file, block_bytes, one_in)
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    blocks = stored(map_in_arrow(texts, _blocks(tokenizer_file, block_bytes, shared), BLOCKS), "token-blocks")
    keys = blocks.select("block", F.posexplode("keys").alias("place", "key"))
    slot = F.shiftleft("block", PLACE_BITS) + F.col("place")  # block and place in one number
    dealt = keys.select(slot.alias("slot"), "key").repartition("key").sortWithinPartitions("key")
    counted = map_in_arrow(dealt, _pieces(tokenizer_file), "slot bigint, pieces int")
    place = F.col("slot").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    answer = (F.shiftleft(place, 32) + F.col("pieces")).alias("counted")
    back = counted.groupBy(F.shiftright("slot", PLACE_BITS).alias("block")).agg(F.collect_list(answer).alias("counted"))
    whole = blocks.drop("keys").join(back, "block", "left")
    whole = whole.withColumn("counted", F.coalesce("counted", F.array().cast("array<bigint>")))
    return map_in_arrow(whole, _sums, COUNTS)
