"""Recommendations for all users at once, without all pairs.

Counting mutual friends for everybody is the product of the membership matrix with itself, and a list of F people has
F * F pairs.  Most of them cannot reach anyone's ten best.  A user's lists are put in order, short ones first, and each
list gets its *reach*: what a candidate can still gain from this list and the longer ones together.  A candidate that is
not on the lists before has a count of at most that reach.

1. The first people by id of every list, its head, give each user a k-th candidate: a count and an id to beat.
2. A list whose reach is above that count is joined whole, one whose reach equals it only as far as smaller ids can win,
   which its head mostly settles, and one below is not joined: its pairs are never made.
3. The candidates found so, cut by what they can reach, are looked up in the lists that were not joined.

So a list is expanded only for the users who need it, and long lists are needed by few.  A user for whom that leaves out
less than half of the pairs has all lists joined whole, which leaves nothing to look up.

Where no list is long, all of this is left out and all lists are joined whole.

Pairs are counted in blocks of users by blocks of candidates.  A row holds the people of one list in two blocks, two bytes
each; all rows of a block of users come to one task, sorted by candidates.  It adds up the lists of one user after the other
over a span of candidates and keeps the candidates that can be among the best, so that no row is made for a pair and no
more than the best of a user leave the task.  Friends come as rows too: the owner of a list and the people on it.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.scalars import id_order, numeric_id
from weftline.operators.ranking import numbered, top_k_per_group
from weftline.session import arrow_batches, drop_stored, ship_package, shuffles_freed, write_stored

#: People in a block at most; a place in a block takes two bytes.
BLOCK = 65536
OFFSET = 32768
#: Entries that name the people of a block, at most about so many; people that are looked at together when blocks are made;
#: people that are counted at once; bytes of a span in memory.
BLOCK_ENTRIES, CELL, SPAN, SPOOL_BYTES = 2_000_000, 256, 65536, 64 << 20
#: Memberships that are sorted at once; bytes and rows that a task which counts gets at once.
PACKED_ROWS, BATCH_BYTES, BATCH_ROWS = 1_000_000, 4 << 20, 256
#: What a row says: what users can gain elsewhere, who is a friend, who is on a list.
LIMITS, KNOWN, COUNTED = 0, 1, 2
#: Lists of more people are not joined for users who do not need them.
LONG_LIST = 1024


def id_key(col: Column | str) -> Column:
    """A value that sorts as ``id_order`` does."""
    number = numeric_id(col)
    return F.struct(number.isNull().alias("named"), number.alias("number"), F.col(col).alias("id"))


def needed_lists(entries: DataFrame, heads: DataFrame, friends: DataFrame, k: int) -> DataFrame:
    """(user, list_id, times, n, gain, least, use) for every entry of a list: ``use`` is whole, head or none.

    ``least`` is the count that the user's k-th candidate of the heads has at least, 0 where there is none.
    """
    lists = entries.groupBy("list_id").agg(F.count("*").alias("n"), F.max("times").alias("most"))
    ordered = Window.partitionBy("user").orderBy("n", "list_id").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    own = entries.join(lists, "list_id").select(
        F.col("friend").alias("user"), "list_id", "times", "n", (F.col("times") * F.col("most")).alias("gain")
    )
    own = own.withColumn("reach", F.sum("gain").over(ordered))
    seen = block_products(own, heads, friends, k)
    kth = top_k_per_group(seen, "user", k, [F.desc("mutual"), *id_order("candidate")]).filter(F.col("rank") == k)
    kth = kth.select("user", F.col("mutual").alias("least"), id_key("candidate").alias("beaten"))
    ends = heads.groupBy("list_id").agg(F.max(id_key("candidate")).alias("end"))
    least = F.coalesce("least", F.lit(0))
    use = F.when((F.col("reach") > least) | ((F.col("reach") == least) & (F.col("beaten") > F.col("end"))), "whole")
    use = use.when(F.col("reach") == least, "head").otherwise("none")
    needed = (
        own.join(kth, "user", "left").join(ends, "list_id")
        .select("user", "list_id", "times", "n", "gain", least.alias("least"), use.alias("use"))
    )
    whole = F.sum(F.when(F.col("use") == "whole", F.col("n")).otherwise(0)).over(Window.partitionBy("user"))
    pays = 2 * whole < F.sum("n").over(Window.partitionBy("user"))
    return needed.withColumn("use", F.when(pays, F.col("use")).otherwise("whole"))


def planned_pairs(needed: DataFrame, head: int) -> DataFrame:
    """One row (pairs, all_pairs): the pairs that the plan makes, and those of the whole product."""
    made = F.when(F.col("use") == "whole", F.col("n")).when(F.col("use") == "head", F.least("n", F.lit(head))).otherwise(0)
    return needed.agg(F.sum(made).alias("pairs"), F.sum("n").alias("all_pairs"))


class _Blocks:
    """Runs of places that are counted together: at most ``BLOCK`` people, and about so many entries that name them at most.

    A span is a run of blocks of at most ``SPAN`` people, whose counts are held at once.
    """

    def __init__(self, n_entries: list[int], n_people: int, cell: int, most: int) -> None:
        starts, held = [0], 0
        for i, n in enumerate(n_entries):
            if i and (held + n > most or (i + 1) * cell - starts[-1] > BLOCK):
                starts.append(i * cell)
                held = 0
            held += n
        self.starts = np.array([*starts, max(n_people, 1)])
        self.span_firsts = [0]
        for block in range(len(starts)):
            if self.starts[block + 1] - self.starts[self.span_firsts[-1]] > SPAN:
                self.span_firsts.append(block)

    def __len__(self) -> int:
        return len(self.starts) - 1

    def of(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block of each place, and the place within the block, in two bytes."""
        block = np.searchsorted(self.starts, place, "right") - 1
        return block.astype(np.int32), (place - self.starts[block] - OFFSET).astype(np.int16)


def _place_people(people: DataFrame) -> tuple[DataFrame, _Blocks, list[str]]:
    """(user, place, block, inside) of ``people(user, n)`` that ``n`` entries name, the blocks, and what is stored for it."""
    spark, cell = people.sparkSession, min(CELL, BLOCK)
    counted, counted_at = write_stored(people, "people")
    placed = numbered(counted, id_order("user"), "place").withColumn("place", F.col("place") - 1)
    placed, placed_at = write_stored(placed, "numbered-people")
    cells = placed.groupBy(F.floor(F.col("place") / cell).alias("cell")).agg(F.sum("n").alias("n"), F.count("*").alias("n_people"))
    cells = sorted(cells.collect())
    n_people, n_entries = sum(row.n_people for row in cells), sum(row.n for row in cells)
    most = min(BLOCK_ENTRIES, n_entries // (3 * spark.sparkContext.defaultParallelism) + 1)
    blocks = _Blocks([row.n for row in cells], n_people, cell, most)
    ship_package(spark)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, inside = blocks.of(batch.column("place").to_numpy())
            yield pa.record_batch([*batch.columns, pa.array(block), pa.array(inside)], [*batch.schema.names, "block", "inside"])

    schema = "user string, place bigint, block int, inside smallint"
    places, places_at = write_stored(placed.select("user", "place").mapInArrow(dealt, schema), "places")
    return places, blocks, [counted_at, placed_at, places_at]


def _piece_rows(kind: int, user_block: Column, candidate_block: Column, **arrays: Column) -> list[Column]:
    """The columns that a task which counts blocks takes; arrays that are not given are null."""
    types = {"users": "smallint", "candidates": "smallint", "user_times": "int", "candidate_times": "int", "more": "bigint", "least": "bigint"}
    kinds = [F.lit(kind).alias("kind"), user_block.alias("user_block"), candidate_block.alias("candidate_block")]
    return kinds + [arrays.get(name, F.lit(None)).cast(f"array<{kind}>").alias(name) for name, kind in types.items()]


def _pieces(entries: DataFrame, side: str) -> DataFrame:
    """(list_id, <side>_block, <side>s, <side>_times) of ``entries(list_id, block, inside, times)``: the people of a list in a block."""
    inside = F.struct("inside", F.col("times").cast("int").alias("times"))
    grouped = entries.groupBy("list_id", F.col("block").alias(f"{side}_block")).agg(F.collect_list(inside).alias("all"))
    return grouped.select("list_id", f"{side}_block", F.col("all.inside").alias(f"{side}s"), F.col("all.times").alias(f"{side}_times"))


def block_products(own: DataFrame, others: DataFrame, friends: DataFrame, k: int) -> DataFrame:
    """(user, candidate, mutual): the candidates of each user over the lists that both sides have, friends left out,
    who can be among the ``k`` best.

    ``own(user, list_id, times)`` may say how much ``more`` the user's candidates can gain elsewhere and the ``least`` count
    of the k-th; who cannot reach the k-th with it is left out.  ``others`` is (list_id, candidate, their_times).
    """
    spark = own.sparkSession
    people = own.select("user").unionAll(others.select(F.col("candidate").alias("user"))).filter("user is not null")
    places, blocks, stored_at = _place_people(people.groupBy("user").agg(F.count("*").alias("n")))
    users = own.join(places, "user").filter("list_id is not null")
    theirs = others.withColumnRenamed("candidate", "user").join(places, "user").filter("list_id is not null")
    theirs = theirs.withColumnRenamed("their_times", "times")
    met = _pieces(users, "user").join(_pieces(theirs, "candidate"), "list_id")
    names = ("users", "candidates", "user_times", "candidate_times")
    rows = met.select(*_piece_rows(COUNTED, F.col("user_block"), F.col("candidate_block"), **{name: F.col(name) for name in names}))
    of_friends = friends.join(places, "user").select(
        F.struct("block", "inside").alias("list_id"), F.col("candidate").alias("user")
    )
    of_friends = of_friends.join(places, "user").withColumn("times", F.lit(1))
    known = _pieces(of_friends, "candidate").select(
        *_piece_rows(
            KNOWN, F.col("list_id.block"), F.col("candidate_block"),
            users=F.array("list_id.inside"), candidates=F.col("candidates"),
        )
    )
    rows = rows.unionByName(known)
    if "more" in own.columns:
        limits = users.select("block", F.struct("inside", "more", "least").alias("limit")).distinct()
        limits = limits.groupBy("block").agg(F.collect_list("limit").alias("all"))
        arrays = {"users": F.col("all.inside"), "more": F.col("all.more"), "least": F.col("all.least")}
        rows = rows.unionByName(limits.select(*_piece_rows(LIMITS, F.col("block"), F.lit(-1), **arrays)))
    found = _counted_blocks(rows, k, blocks)
    user, candidate = (places.select(F.col("user").alias(name), F.col("place").alias(f"{name}_place")) for name in ("user", "candidate"))
    with arrow_batches(spark, BATCH_BYTES, BATCH_ROWS):
        named, _ = write_stored(
            found.join(user, "user_place").join(candidate, "candidate_place").select("user", "candidate", "mutual"), "block-counts"
        )
    for path in stored_at:
        drop_stored(spark, path)
    return named


def _counted_blocks(rows: DataFrame, k: int, blocks: _Blocks) -> DataFrame:
    """(user_place, candidate_place, mutual) from the rows of ``_piece_rows``.  All rows of a block of users come to one task,
    by blocks of candidates."""
    ship_package(rows.sparkSession)
    dealt = rows.repartitionById(len(blocks), "user_block").sortWithinPartitions("user_block", "candidate_block")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _count(batches, k, blocks)

    return dealt.mapInArrow(count, "user_place bigint, candidate_place bigint, mutual bigint")


def _count(batches: Iterator[pa.RecordBatch], k: int, blocks: _Blocks) -> Iterator[pa.RecordBatch]:
    """The counts of the rows of a task: one block of users after the other, a span of candidate blocks at a time."""
    at, span, users = None, None, None
    for batch in batches:
        numbers = batch.column("user_block").to_numpy()
        spans = np.searchsorted(blocks.span_firsts, batch.column("candidate_block").to_numpy(), "right") - 1
        edges = (np.flatnonzero((np.diff(numbers) != 0) | (np.diff(spans) != 0)) + 1).tolist()
        for start, end in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            if start == end:
                continue
            now = int(numbers[start]), int(spans[start])
            if now != at:
                if span is not None:
                    users.add(*span.counted(users))
                if users is None or now[0] != at[0]:
                    if users is not None:
                        yield from users.best()
                    users = _UserBlock(now[0], blocks, k)
                span, at = _Span(now[1], blocks) if now[1] >= 0 else None, now
            part = batch.slice(start, end - start)
            if span is None:
                users.limit(part)
            else:
                span.append(part)
    if users is not None:
        if span is not None:
            users.add(*span.counted(users))
        yield from users.best()


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values of all rows, length of each row) of a list column."""
    return column.flatten().to_numpy(), column.value_lengths().fill_null(0).to_numpy().astype(np.int64)


def _flat_times(column: pa.Array, lengths: np.ndarray) -> np.ndarray | None:
    """The times of all entries; those of a null row are 1, and so are all where None is returned."""
    if column.null_count == len(column):
        return None
    times = np.ones(int(lengths.sum()), np.int64)
    times[np.repeat(column.is_valid().to_numpy(zero_copy_only=False), lengths)] = column.flatten().to_numpy()
    return times


class _Spool:
    """An array that is put together from parts; a long one lies in a temporary file."""

    def __init__(self, dtype: type) -> None:
        self.parts, self.dtype, self.waiting, self.file = [], dtype, 0, None

    def append(self, part: np.ndarray) -> None:
        self.parts.append(part.astype(self.dtype))
        self.waiting += self.parts[-1].nbytes
        if self.waiting > SPOOL_BYTES:
            self.file = self.file or tempfile.TemporaryFile()
            for part in self.parts:
                self.file.write(part.data)
            self.parts, self.waiting = [], 0

    def whole(self) -> np.ndarray:
        if self.file is None:
            return np.concatenate(self.parts) if self.parts else np.zeros(0, self.dtype)
        for part in self.parts:
            self.file.write(part.data)
        self.file.flush()
        return np.memmap(self.file, self.dtype, "r")


class _Span:
    """Rows of a block of users and the candidates of a span."""

    def __init__(self, number: int, blocks: _Blocks) -> None:
        self.starts, self.base = blocks.starts, int(blocks.starts[blocks.span_firsts[number]])
        self.users, self.user_lengths, self.lengths, self.friends = [], [], [], [np.zeros(0, np.uint32)]
        self.candidates, self.user_times, self.times, self.weighted = _Spool(np.uint16), [], _Spool(np.int64), False

    def append(self, rows: pa.RecordBatch) -> None:
        for kind in (KNOWN, COUNTED):
            some = rows.filter(pc.equal(rows.column("kind"), kind))
            if some.num_rows:
                users, user_lengths = _flat(some.column("users"))
                candidates, lengths = _flat(some.column("candidates"))
                shift = self.starts[some.column("candidate_block").to_numpy()] - self.base + OFFSET
                users, candidates = users.astype(np.int64) + OFFSET, candidates + np.repeat(shift, lengths)
                if kind == KNOWN:  # one user or one candidate a row
                    pairs = np.repeat(users, np.repeat(lengths, user_lengths)) << 16 | np.repeat(candidates, np.repeat(user_lengths, lengths))
                    self.friends.append(pairs.astype(np.uint32))
                else:
                    self._append(some, users, user_lengths, candidates, lengths)

    def _append(
        self, rows: pa.RecordBatch, users: np.ndarray, user_lengths: np.ndarray, candidates: np.ndarray, lengths: np.ndarray
    ) -> None:
        user_times = _flat_times(rows.column("user_times"), user_lengths)
        times = _flat_times(rows.column("candidate_times"), lengths)
        if not self.weighted and any(x is not None and (x != 1).any() for x in (user_times, times)):
            self.weighted = True
            self.user_times = [np.ones(len(x), np.int64) for x in self.users]
            for n in self.lengths:
                self.times.append(np.ones(int(n.sum()), np.int64))
        if self.weighted:
            self.user_times.append(np.ones(len(users), np.int64) if user_times is None else user_times)
            self.times.append(np.ones(len(candidates), np.int64) if times is None else times)
        self.users.append(users.astype(np.uint16))
        self.user_lengths.append(user_lengths.astype(np.int32))
        self.lengths.append(lengths)
        self.candidates.append(candidates)

    def counted(self, block: _UserBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(user, candidate, count) of those who can be among the best, as places."""
        nobody = (np.zeros(0, np.int64),) * 3
        if not self.users:
            return nobody
        candidates, lengths = self.candidates.whole(), np.concatenate(self.lengths)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        user_times, times = (np.concatenate(self.user_times), self.times.whole()) if self.weighted else (None, None)
        users = np.concatenate(self.users)
        order = np.argsort(users, kind="stable")
        row = np.repeat(np.arange(len(lengths), dtype=np.int32), np.concatenate(self.user_lengths))[order]
        users = users[order]
        edges = np.flatnonzero(users[1:] != users[:-1]) + 1
        firsts = np.concatenate([[0], edges])
        numbers = users[firsts].astype(np.int64)
        if self.weighted:
            user_times = user_times[order]
        del order, users
        friends = np.concatenate(self.friends)
        friends.sort()
        known = np.searchsorted(friends, np.stack([numbers << 16, (numbers + 1) << 16])).T.tolist()
        friends = friends.astype(np.uint16)
        to_own, found = block.start - self.base, []
        for user, first, last, (s, e) in zip(numbers.tolist(), firsts.tolist(), [*edges.tolist(), len(row)], known, strict=True):
            lists = row[first:last]
            ranges = list(zip(starts[lists].tolist(), ends[lists].tolist(), strict=True))
            met = np.concatenate([candidates[a:b] for a, b in ranges])
            if not len(met):
                continue
            if self.weighted:
                gains = np.repeat(user_times[first:last], lengths[lists]) * np.concatenate([times[a:b] for a, b in ranges])
                counts = np.bincount(met, gains).astype(np.int64)
            else:
                counts = np.bincount(met)
            low = int(met.min())
            known_ones = friends[s:e]
            counts[known_ones[known_ones < len(counts)]] = 0
            if 0 <= to_own + user < len(counts):
                counts[to_own + user] = 0
            counts = counts[low:]
            chosen = _can_win(counts, block.k, int(block.more[user]), int(block.least[user]))
            if len(chosen):
                found.append((user, len(chosen), chosen + low, counts[chosen]))
        if not found:
            return nobody
        numbers, ns, chosen, counts = zip(*found, strict=True)
        return np.repeat(numbers, ns) + block.start, np.concatenate(chosen) + self.base, np.concatenate(counts)


def _where(mask: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` of a mask that is seldom true: eight of its bytes are looked at together."""
    whole = len(mask) // 8 * 8
    words = np.flatnonzero(mask[:whole].view(np.uint64))
    found = (words[:, None] * 8 + np.arange(8))[mask[:whole].reshape(-1, 8)[words]]
    return np.concatenate([found, np.flatnonzero(mask[whole:]) + whole])


def _can_win(counts: np.ndarray, k: int, more: int, least: int) -> np.ndarray:
    """Where the ``k`` best counts are, earlier ones first where they tie; of a user who can gain ``more`` elsewhere, where
    all are that can still reach the k-th."""
    kth = int(counts.max())
    if not kth:
        return np.zeros(0, np.int64)
    small = counts.astype(np.uint8) if kth < 256 else counts
    for _ in range(8):
        if np.count_nonzero(small >= kth) >= k or kth == 1:
            break
        kth -= 1
    else:
        numbers = np.bincount(counts)
        numbers[0] = 0
        kth = max(len(numbers) - 1 - int(np.searchsorted(np.cumsum(numbers[::-1]), k)), 1)
    chosen = _where(small >= kth)
    if more > 0:
        worst = max(kth if len(chosen) >= k else 0, least)
        return np.flatnonzero((counts > 0) & (counts + more >= worst))
    if len(chosen) > k:
        above = counts[chosen] > kth
        chosen = np.concatenate([chosen[above], chosen[~above][: k - int(above.sum())]])
    return chosen


class _UserBlock:
    """The candidates that are found for the users of a block."""

    def __init__(self, number: int, blocks: _Blocks, k: int) -> None:
        self.start, self.k = int(blocks.starts[number]), k
        self.more, self.least = np.zeros((2, int(blocks.starts[number + 1]) - self.start), np.int64)
        self.found, self.waiting = [], 0

    def limit(self, rows: pa.RecordBatch) -> None:
        users = _flat(rows.column("users"))[0].astype(np.int64) + OFFSET
        self.more[users], self.least[users] = _flat(rows.column("more"))[0], _flat(rows.column("least"))[0]

    def add(self, users: np.ndarray, candidates: np.ndarray, counts: np.ndarray) -> None:
        self.found.append((users, candidates, counts))
        self.waiting += len(users)
        if self.waiting > 1 << 20:
            self.cut()

    def cut(self) -> None:
        """Leaves the best of what is found so far, in order; all of users who can gain more elsewhere."""
        users, candidates, counts = (np.concatenate(columns) for columns in zip(*self.found, strict=True))
        order = np.lexsort((candidates, -counts, users))
        users, candidates, counts = users[order], candidates[order], counts[order]
        first = np.concatenate([[True], np.diff(users) != 0]) if len(users) else np.zeros(0, bool)
        at = np.flatnonzero(first)
        rank = np.arange(len(users)) - np.repeat(at, np.diff([*at, len(users)]))
        kept = (rank < self.k) | (self.more[users - self.start] > 0)
        self.found, self.waiting = [(users[kept], candidates[kept], counts[kept])], 0

    def best(self) -> Iterator[pa.RecordBatch]:
        if self.found:
            self.cut()
            users, candidates, counts = self.found[0]
            for start in range(0, len(users), 100_000):
                part = [column[start : start + 100_000] for column in (users, candidates, counts)]
                yield pa.record_batch([pa.array(column) for column in part], ["user_place", "candidate_place", "mutual"])


def placed_members(memberships: DataFrame, places: DataFrame) -> DataFrame:
    """(list_id, owner, place, block) of the memberships."""
    entries = memberships.select(
        F.col("list_id").cast("string").alias("list_id"), F.col("owner").cast("string").alias("owner"),
        F.col("friend").cast("string").alias("user"),
    )
    return entries.join(places, "user").select("list_id", "owner", "place", "block")


def list_pieces(placed: DataFrame, places: DataFrame, blocks: _Blocks) -> DataFrame:
    """(list_id, owner_block, owner_inside, block, people, times): the people of each list in a block, with how often the list
    names them where it names some of them again.  A list may have several pieces in a block."""
    ship_package(placed.sparkSession)
    dealt = placed.repartition("list_id", "block").select("list_id", "owner", "place")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, n = [], 0
        for batch in batches:
            some.append(batch)
            n += batch.num_rows
            if n >= PACKED_ROWS:
                yield _packed(some, blocks)
                some, n = [], 0
        if n:
            yield _packed(some, blocks)

    schema = "list_id string, owner string, block int, people array<smallint>, times array<int>"
    owners = places.select(F.col("user").alias("owner"), F.col("block").alias("owner_block"), F.col("inside").alias("owner_inside"))
    return dealt.mapInArrow(packed, schema).join(owners, "owner", "left").drop("owner")


def _packed(batches: list[pa.RecordBatch], blocks: _Blocks) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches)
    lists, owners = (table.column(name).combine_chunks().dictionary_encode() for name in ("list_id", "owner"))
    list_at, owner_at = (column.indices.fill_null(-1).to_numpy().astype(np.int64) for column in (lists, owners))
    place = table.column("place").to_numpy()
    order = np.argsort(list_at * int(blocks.starts[-1]) + place, kind="stable")
    list_at, owner_at, place = list_at[order], owner_at[order], place[order]
    other = (np.diff(list_at) != 0) | (np.diff(owner_at) != 0)
    first = np.flatnonzero(np.concatenate([[True], other | (np.diff(place) != 0)]))
    times = np.diff([*first, len(place)])
    list_at, owner_at, place = list_at[first], owner_at[first], place[first]
    block, inside = blocks.of(place)
    other = (np.diff(list_at) != 0) | (np.diff(owner_at) != 0) | (np.diff(block) != 0)
    starts = np.flatnonzero(np.concatenate([[True], other]))
    offsets = pa.array([*starts, len(place)], pa.int32())
    columns = {
        "list_id": lists.dictionary.take(pa.array(list_at[starts], mask=list_at[starts] < 0)),
        "owner": owners.dictionary.take(pa.array(owner_at[starts], mask=owner_at[starts] < 0)),
        "block": pa.array(block[starts]),
        "people": pa.ListArray.from_arrays(offsets, pa.array(inside)),
        "times": pa.nulls(len(starts), pa.list_(pa.int32())),
    }
    if (times > 1).any():
        columns["times"] = pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def whole_products(pieces: DataFrame, k: int, blocks: _Blocks) -> DataFrame:
    """(user_place, candidate_place, mutual): the ``k`` best of each user over all lists, friends left out."""
    mine = pieces.filter("list_id is not null").select("list_id", "block", "people", "times")
    met = mine.toDF("list_id", "user_block", "users", "user_times").join(
        mine.toDF("list_id", "candidate_block", "candidates", "candidate_times"), "list_id"
    )
    names = ("users", "candidates", "user_times", "candidate_times")
    rows = met.select(*_piece_rows(COUNTED, F.col("user_block"), F.col("candidate_block"), **{name: F.col(name) for name in names}))
    owned, owner = pieces.filter("owner_block is not null"), F.array("owner_inside")
    named = owned.select(*_piece_rows(KNOWN, F.col("owner_block"), F.col("block"), users=owner, candidates=F.col("people")))
    naming = owned.select(*_piece_rows(KNOWN, F.col("block"), F.col("owner_block"), users=F.col("people"), candidates=owner))
    return _counted_blocks(rows.unionByName(named).unionByName(naming), k, blocks)


def _product(own: DataFrame, others: DataFrame) -> DataFrame:
    """(user, candidate, mutual = 0) over the lists that both sides have: candidates whose count is looked up later."""
    met = own.select("user", "list_id").join(others, "list_id").filter("user <> candidate")
    return met.select("user", "candidate", F.lit(0).cast("bigint").alias("mutual")).distinct()


def _both_ways(memberships: DataFrame) -> DataFrame:
    """(user, candidate): friends by the own list of either."""
    a = memberships.select(F.col("owner").alias("user"), F.col("friend").alias("candidate"))
    return a.unionAll(a.select(F.col("candidate").alias("user"), F.col("user").alias("candidate"))).distinct()


def recommend_everyone(memberships: DataFrame, k: int = 10, head: int = 64, long_list: int = LONG_LIST) -> DataFrame:
    """(user, candidate, mutual, rank): ``social.recommend`` for all who are on a list or own one.

    Where no list has more than ``long_list`` people, all lists are joined whole.
    """
    spark = memberships.sparkSession
    with shuffles_freed(spark):
        memberships, members_at = write_stored(memberships.select("list_id", "owner", "friend"), "memberships")
        named = [F.struct(F.col(c).cast("string").alias("user"), F.lit(n).alias("n")) for c, n in (("friend", 1), ("owner", 0))]
        people = memberships.select(F.inline(F.array(*named))).filter("user is not null")
        places, blocks, stored_at = _place_people(people.groupBy("user").agg(F.sum("n").alias("n")))
        placed, placed_at = write_stored(placed_members(memberships, places), "placed-members")
        pieces, pieces_at = write_stored(list_pieces(placed, places, blocks), "list-pieces")
        drop_stored(spark, placed_at)
        longest = pieces.groupBy("list_id").agg(F.sum(F.size("people")).alias("n")).agg(F.max("n")).first()[0] or 0
        if longest > long_list:
            best = _recommend_by_need(memberships, k, head)
        else:
            with arrow_batches(spark, BATCH_BYTES, BATCH_ROWS):
                found, found_at = write_stored(whole_products(pieces, k, blocks), "block-counts")
            user, candidate = (places.select(F.col("user").alias(c), F.col("place").alias(f"{c}_place")) for c in ("user", "candidate"))
            order = Window.partitionBy("user_place").orderBy(F.desc("mutual"), "candidate_place")
            ranked = found.withColumn("rank", F.row_number().over(order)).join(user, "user_place").join(candidate, "candidate_place")
            best, _ = write_stored(ranked.select("user", "candidate", "mutual", "rank"), "recommended")
            drop_stored(spark, found_at)
    for path in (members_at, *stored_at, pieces_at):
        drop_stored(spark, path)
    return best


def _recommend_by_need(memberships: DataFrame, k: int, head: int) -> DataFrame:
    """``recommend_everyone`` that joins a list only for the users who need it."""
    spark = memberships.sparkSession
    entries, entries_at = write_stored(
        memberships.groupBy("list_id", "friend").agg(F.count("*").alias("times")), "list-entries"
    )
    others = entries.select("list_id", F.col("friend").alias("candidate"), F.col("times").alias("their_times"))
    heads, heads_at = write_stored(
        top_k_per_group(others, "list_id", head, id_order("candidate")).drop("rank"), "list-heads"
    )
    friends, friends_at = write_stored(_both_ways(memberships), "friends")
    needed, needed_at = write_stored(needed_lists(entries, heads, friends, k), "needed-lists")

    open_ = F.when(F.col("use") == "whole", 0).otherwise(F.col("gain"))
    limits = needed.groupBy("user").agg(F.sum(open_).alias("more"), F.max("least").alias("least"))
    whole = needed.filter("use = 'whole'").drop("least").join(limits, "user")
    found = block_products(whole, others, friends, k).unionAll(_product(needed.filter("use = 'head'"), heads))
    found = found.groupBy("user", "candidate").agg(F.sum("mutual").alias("mutual"))
    found = found.join(limits, "user").filter(F.col("mutual") + F.col("more") >= F.col("least"))
    found = found.join(friends, ["user", "candidate"], "left_anti").select("user", "candidate", "mutual")
    found, found_at = write_stored(found, "candidates")

    rest = needed.filter("use <> 'whole'").select("user", "list_id", "times")
    looked_up = found.select("user", "candidate").join(rest, "user").join(others, ["list_id", "candidate"])
    added = looked_up.select("user", "candidate", (F.col("times") * F.col("their_times")).alias("mutual"))
    counts = found.unionAll(added).groupBy("user", "candidate").agg(F.sum("mutual").alias("mutual"))
    counts = counts.filter("mutual > 0")
    best, _ = write_stored(top_k_per_group(counts, "user", k, [F.desc("mutual"), *id_order("candidate")]), "recommended")
    for path in (entries_at, heads_at, friends_at, needed_at, found_at):
        drop_stored(spark, path)
    return best
