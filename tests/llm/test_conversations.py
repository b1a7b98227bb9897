"""Conversation repair next to all possible edits."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from weftline.llm.conversations import BLANK, DUPLICATE, KINDS, TRUNCATED, Repair, damaged, repair_conversations, repair_digests
from weftline.llm.oracle import OP11

SCHEMA = "conv_id bigint, turn bigint, role string, text string, fault string, gone_too int, place int, `row` string"


def plain_repair(turns):
    """(cost, edits): the cheapest of all edits of (kind, fault), the ASCII-least of them."""
    best = None
    for inserts in itertools.product(range(3), repeat=len(turns) + 1):
        for edits in itertools.product("DKR", repeat=len(turns)):
            for reroled in itertools.product("ua", repeat=edits.count("R")):
                for new in itertools.product("ua", repeat=sum(inserts)):
                    roles, cost, audit = "", 0, ""
                    reroles, news = iter(reroled), iter(new)
                    for (kind, fault), n, edit in zip(turns, inserts, edits, strict=False):
                        roles += "".join(next(news) for _ in range(n))
                        cost, audit = cost + 2 * n, audit + "I" * n + edit
                        if edit == "D":
                            cost += 3
                            continue
                        if fault in (BLANK, DUPLICATE):
                            cost = 1 << 20
                        cost += (fault == TRUNCATED) + 2 * (edit == "R")
                        roles += (kind or "?") if edit == "K" else next(reroles)
                    roles += "".join(next(news) for _ in range(inserts[-1]))
                    cost, audit = cost + 2 * inserts[-1], audit + "I" * inserts[-1]
                    if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                        best = (cost, audit)
    return best


def streamed(turns):
    repair, audit, held = Repair(), "", 0
    for turn in turns:
        audit += "".join(edits for edits, _ in repair.push(*turn, turn))
        held = max(held, repair.held)
    audit += "".join(edits for edits, _ in repair.close())
    return repair.cost, audit, held


def test_equals_all_edits_of_short_conversations():
    kinds = [(k, f) for k in [*KINDS, ""] for f in range(4)]
    some = [[], *([t] for t in kinds), *(list(p) for p in itertools.product(kinds, repeat=2))]
    rng = random.Random(1)
    some += [[rng.choice(kinds) for _ in range(3)] for _ in range(3)]
    for turns in some:
        assert streamed(turns)[:2] == plain_repair(turns), turns


def test_memory_follows_what_is_unresolved():
    good = [("s", 0), *[("u", 0), ("a", 0)] * 5_000]
    cost, audit, held = streamed(good)
    assert (cost, audit) == (0, "K" * len(good)) and held < 40
    rng = random.Random(2)
    mixed = [(rng.choice("sua"), rng.choice((0, 0, 0, 1, 2, 3))) for _ in range(20_000)]
    assert streamed(mixed)[2] < 200
    # other roles: both alternations stay open to the end, and the whole tied suffixes decide
    cost, audit, held = streamed([("", 0)] * 1_001)
    assert audit == "D" + "R" * 1_000 or (cost, audit) == (2_002 + 2, "I" + "R" * 1_001)
    assert held >= 1_000


@pytest.fixture
def talks(spark):
    return lambda rows: spark.createDataFrame([(*r, "f", 1, 2, "r") for r in rows], SCHEMA)


TALKS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Hello."),
    (2, None, "user", "No turn."), (2, None, "user", "No turn."), (2, 5, "assistant", "cut of"), (2, 9, "tool", "x."),
    (3, 0, None, None), (None, None, None, None), (None, 1, "user", "A null id."), (None, 2, "assistant", "Yes!  \n"),
    (4, 0, "user", ""), (4, 1, "", "no role."), (4, 2, "usher", "Another u."),
    (5, 3, "assistant", "word " * 50_000 + "."), (5, 4, "assistant", "word " * 50_000 + "."),
    (6, 1, "user", "Same."), (6, 2, "assistant", "Same."), (6, 3, "user", "Same."),
]
MANY = [(10 + i, t, random.Random(i * 31 + t).choice(["user", "assistant", "system", "tool"]), f"text {t % 3}" + ".?! "[(i + t) % 4])
        for i in range(80) for t in range(i % 9)]


def kind_of(conv_id, turn):
    return zlib.crc32(f"{conv_id}:{turn}".encode()) % 20


#: Turns that the damage repeats, cut off, sound and of another role.
REPEATED = [
    (conv_id, turn, role, text)
    for conv_id in range(200, 260) for turn in range(4) if any(kind_of(conv_id, t) == 3 for t in range(4))
    for role, text in [(("user", "assistant", "tool")[(conv_id + turn) % 3], f"turn {turn} of {conv_id}" + ("." if conv_id % 2 else ""))]
]


def test_digests_equal_sql(spark, talks):
    assert sum(kind_of(c, t) == 3 for c, t, _, _ in REPEATED) > 8
    turns = talks(TALKS + MANY + REPEATED)
    got = {tuple(r) for r in repair_digests(damaged(turns)).collect()}
    con = duckdb.connect()
    con.register("conversations", turns.select("conv_id", "turn", "role", "text").toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    expected = set(con.sql(OP11).fetchall())
    assert got == expected and len(got) == len({r[0] for r in TALKS + MANY + REPEATED})


def test_edits_give_the_repaired_conversation(spark, talks):
    turns = talks(TALKS + MANY)
    digests = {r.conv_id: r for r in repair_digests(turns).collect()}
    edits = {}
    for r in sorted(repair_conversations(turns).collect(), key=lambda r: r.place):
        edits.setdefault(r.conv_id, []).append(r)
    for conv_id, digest in digests.items():
        own = edits.get(conv_id, [])
        assert "".join(r.edit for r in own) == digest.audit
        kept = [r for r in own if r.edit != "D"]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in kept))
        text = "\n".join(f"{r.role}:{r.text}" for r in kept)
        assert hashlib.sha256(text.encode()).hexdigest() == digest.repaired_sha256
    assert [r.edit for r in edits[1]] == ["K", "K", "K"]


def test_empty_table_and_dropped_conversations(spark, talks):
    assert repair_digests(talks([])).collect() == []
    assert repair_conversations(talks([])).collect() == []
    gone = damaged(talks(MANY)).filter("gone").limit(1).select("conv_id", "turn", "role", "text", "gone")
    row = repair_digests(gone).first()
    assert tuple(row)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
