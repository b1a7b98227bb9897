"""Conversation structure repair by a survivor-coalescence Viterbi.

A conversation should be an optional system turn and then user and assistant in turn, ``(s?(ua)+)?``, without blank,
repeated or truncated turns.  The cheapest edits that make it so are a shortest path: four states (nothing written,
system, user or assistant written last), for each turn Keep, Rerole or Delete, and Inserts before it.

The survivors of the states are leaves of a tree of back pointers.  Every node counts the nodes and survivors that
refer to it; a node that nothing refers to goes, and with it what only it held.  As soon as all survivors descend from
one node the edits up to there are final: they are emitted and forgotten, so that memory holds the unresolved part of
one conversation and not the conversation.  Of equally cheap paths the one whose edits are ASCII-least wins.  Inserts
stand before the turn they precede, so no survivor's edits are a prefix of another's and their order can only be
decided by what is unresolved.  A survivor that is dearer than another by more than the edits that bring the other to
its state can win no more and goes, else the path that deletes everything would keep all open.  Each survivor has a rank, the place of its complete unresolved suffix among those of
all survivors; a step compares the ranks first and then itself, which compares the whole suffixes.

Conversations are dealt by id and sorted by turn in Spark, which also finds repeated turns, so Python sees one turn
at a time.  One conversation is read by one task, as a stream: its hash is sequential by nature.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from weftline.llm.common import map_in_arrow

WHITE = "\x20\t\n\v\f\r"
STOPS = "[.!?]"
BLANK, DUPLICATE, TRUNCATED, SOUND = 1, 2, 3, 0
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
KINDS = "sua"
LEGAL = ("su", "ua", "au")
BATCH_ROWS = 4096

EDITS = "place bigint, edit string, turn bigint, role string, text string, fault int"
DIGESTS = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
    "repaired_sha256 string"
)


def _inserts(state: int) -> list[tuple[int, str, int]]:
    """(cost, edits, state after) of the inserts that can precede a turn; more than two never pay."""
    out = [(0, "", state)]
    while len(out) < 3:
        cost, edits, at = out[-1]
        out.append((cost + INSERT_COST, edits + "I", ASSISTANT if at == USER else USER))
    return out


def _steps(state: int, kind: str, fault: int) -> list[tuple[int, str, int]]:
    """(cost, edits, state after): the best way from ``state`` over a turn to each state."""
    best: dict[int, tuple[int, str]] = {}
    for cost, edits, at in _inserts(state):
        ways = [(DELETE_COST, "D", at)]
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED_COST if fault == TRUNCATED else 0
            following = ASSISTANT if at == USER else USER
            ways.append((REROLE_COST + more, "R", following))
            if kind == ("a" if at == USER else "u"):
                ways.append((more, "K", following))
            if kind == "s" and at == START:
                ways.append((more, "K", SYSTEM))
        for more, edit, end in ways:
            best[end] = min(best.get(end, (1 << 30, "")), (cost + more, edits + edit))
    return [(cost, edits, end) for end, (cost, edits) in best.items()]


STEPS = {(s, k, f): _steps(s, k, f) for s in range(4) for k in [*KINDS, ""] for f in range(4)}
#: Inserts that end a conversation: nothing written or an assistant last is an end.
CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


#: What it costs at most to go on from the second state as a path from the first one goes on: by inserts, and by the
#: deletion of a system turn that only the start can keep.
SLACK = {
    (START, SYSTEM): 4, (START, USER): 5, (START, ASSISTANT): 3, (SYSTEM, START): 0, (SYSTEM, USER): 2, (SYSTEM, ASSISTANT): 0,
    (USER, START): 2, (USER, SYSTEM): 2, (USER, ASSISTANT): 2, (ASSISTANT, START): 0, (ASSISTANT, SYSTEM): 4, (ASSISTANT, USER): 2,
}


class _Node:
    """The edits of one turn on a path, and the path before it."""

    __slots__ = ("before", "edits", "turn", "after", "references")

    def __init__(self, before: _Node | None, edits: str, turn: tuple | None):
        self.before, self.edits, self.turn = before, edits, turn
        self.after: list[_Node] = []
        self.references = 0
        if before is not None:
            before.after.append(self)
            before.references += 1


class Repair:
    """The repair of one conversation; ``held`` nodes are not resolved yet."""

    def __init__(self):
        self.root = _Node(None, "", None)
        self.root.references = 1
        self.survivors = {START: (0, 0, self.root)}  # state -> (cost, rank, leaf)
        self.held = 0
        self.cost = 0

    def push(self, kind: str, fault: int, turn: tuple) -> Iterator[tuple[str, tuple | None]]:
        """Takes the next turn and yields (edits, turn) of the turns that are resolved by it."""
        best: dict[int, tuple[int, int, str, _Node]] = {}
        for state, (cost, rank, leaf) in self.survivors.items():
            for more, edits, end in STEPS[state, kind, fault]:
                way = (cost + more, rank, edits)
                if end not in best or way < best[end][:3]:
                    best[end] = (*way, leaf)
        leaves = [leaf for _, _, leaf in self.survivors.values()]
        hopeless = {a for (a, b), slack in SLACK.items() if a in best and b in best and best[a][0] > best[b][0] + slack}
        order = sorted(best.keys() - hopeless, key=lambda end: best[end][1:3])
        self.survivors = {}
        for rank, end in enumerate(order):
            cost, _, edits, before = best[end]
            node = _Node(before, edits, turn)
            node.references = 1
            self.held += 1
            self.survivors[end] = (cost, rank, node)
        for leaf in leaves:
            self._release(leaf)
        while self.root.references == 1 and self.root.after:
            self.root = self.root.after[0]
            self.root.before = None
            self.held -= 1
            yield self.root.edits, self.root.turn

    def close(self) -> Iterator[tuple[str, tuple | None]]:
        """Ends the conversation: the rest of the best path and the inserts after its last turn."""
        cost, _, edits, leaf = min(
            (cost + INSERT_COST * len(CLOSING[state]), rank, CLOSING[state], leaf)
            for state, (cost, rank, leaf) in self.survivors.items()
        )
        self.cost = cost
        path = []
        while leaf is not self.root:
            path.append((leaf.edits, leaf.turn))
            leaf = leaf.before
        yield from reversed(path)
        if edits:
            yield edits, None

    def _release(self, node: _Node | None) -> None:
        while node is not None:
            node.references -= 1
            if node.references:
                return
            before = node.before
            if before is not None:
                before.after.remove(node)
                self.held -= 1
            node = before


def damaged(conversations: DataFrame) -> DataFrame:
    """The planned damage: turns dropped (``gone``), emptied, without stops, repeated, or all of the user."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *shown).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", STOPS, "")).otherwise(F.col("text"))
    rows = conversations.select(
        "conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")], kind.alias("kind")
    )
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.col("kind") == 0, F.when(F.col("kind") == 3, 2).otherwise(1))).alias("gone"),
    )


def _ordered(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, fault, gone) dealt by conversation and sorted by turn, nulls first."""
    gone = F.col("gone") if "gone" in turns.columns else F.lit(False)
    rows = turns.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), gone.alias("gone"),
        *[F.when(~gone, F.coalesce(F.col(c), F.lit(" "))).alias(c) for c in ("role", "text")],
    ).repartition("conv_id")
    same = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    bare = F.rtrim("text", F.lit(WHITE))
    fault = (
        F.when(bare == "", BLANK)
        .when(F.row_number().over(same) > 1, DUPLICATE)
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED)
        .otherwise(SOUND)
    )
    rows = rows.withColumn("fault", fault)
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return rows.sortWithinPartitions(*order, F.col("fault") == DUPLICATE)  # of equal turns the repeated one comes later


def _edits(turns: Iterable[tuple], repair: Repair) -> Iterator[tuple[str, tuple | None, str, str]]:
    """(edit, turn, role, text) of every edit; a deleted turn has its own role and text."""
    following = "user"

    def told(steps):
        nonlocal following
        for edits, turn in steps:
            for edit in edits:
                if edit == "D":
                    yield edit, turn, turn[1], turn[2]
                    continue
                role, text = (turn[1], turn[2]) if edit == "K" else (following, turn[2] if edit == "R" else "")
                following = "assistant" if role[:1] == "u" else "user"
                yield edit, None if edit == "I" else turn, role, text

    for turn in turns:
        kind = turn[1][:1]
        yield from told(repair.push(kind if kind in KINDS else "", turn[3], turn))
    yield from told(repair.close())


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, turns that are there), one conversation after the other."""

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "gone")), strict=True)

    for conv_id, own in groupby(rows(), key=lambda row: row[0]):
        yield conv_id, (row[1:5] for row in own if not row[5])


def _edit_rows(conv_id, turns) -> Iterator[tuple]:
    for place, (edit, turn, role, text) in enumerate(_edits(turns, Repair())):
        at, fault = (None, None) if turn is None else (turn[0], turn[3])
        yield conv_id, place, edit, at, role, text, fault


def _digest_row(conv_id, turns) -> Iterator[tuple]:
    faults, illegal, distinct = [0, 0, 0, 0], 0, 0
    first = last = before = None

    def counted():
        nonlocal illegal, distinct, first, last, before
        for turn in turns:
            faults[turn[3]] += 1
            if before is not None and before + turn[1][:1] not in LEGAL:
                illegal += 1
            before = turn[1][:1]
            if turn[0] is not None and turn[0] != last:
                first = turn[0] if first is None else first
                last, distinct = turn[0], distinct + 1
            yield turn

    repair, repaired, audit, n = Repair(), hashlib.sha256(), bytearray(), 0
    for edit, _, role, text in _edits(counted(), repair):
        audit += edit.encode()
        if edit != "D":
            repaired.update(f"{chr(10) if n else ''}{role}:{text}".encode())
            n += 1
    gaps = 0 if first is None else last - first + 1 - distinct
    counts = (faults[BLANK], faults[DUPLICATE], faults[TRUNCATED])
    yield conv_id, gaps, *counts, illegal, repair.cost, audit.decode(), repaired.hexdigest()


def _mapped(turns: DataFrame, function, columns: str) -> DataFrame:
    rows = _ordered(turns)
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(columns)])
    arrow = to_arrow_schema(schema)

    def apply(batches):
        found = (row for conv_id, own in _conversations(batches) for row in function(conv_id, own))
        while ready := list(islice(found, BATCH_ROWS)):
            columns = zip(*ready, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return map_in_arrow(rows, apply, schema)


def repair_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, place, edit, turn, role, text, fault): the edits of each conversation of ``turns(conv_id, turn, role,
    text)`` in order; the repaired conversation is its rows without the ``D`` ones.

    Turns are taken by number, nulls first, equal ones by role and text.  A null id is a conversation of its own, null
    roles and texts are one space.  A role is judged by its first letter; other letters have to be changed or deleted.
    Rows with ``gone``, if there is such a column, only name their conversation.  An empty table gives no rows.
    """
    return _mapped(turns, _edit_rows, EDITS)


def repair_digests(turns: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, illegal neighbours, and cost, edits and hash of its repair.

    A conversation without turns has zeros, no edits and the hash of nothing.
    """
    return _mapped(turns, _digest_row, DIGESTS)
