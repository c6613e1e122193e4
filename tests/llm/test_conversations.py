"""Conversation repair against a search over all edits."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from postroom.llm import block_tables, conversations
from postroom.llm.block_tables import DROP

ALLOWED = re.compile(r"s?(ua)*u?\Z")
DONE = re.compile(r"(s?(ua)+)?\Z")


def search(rows):
    """Cost and least string of edits by trying all of them, cheapest first."""
    heap = [(0, "", 0, "")]
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        if at == len(rows) and DONE.match(roles):
            return cost, audit, roles
        ways = [(5, "I", at, c) for c in "ua"]
        if at < len(rows):
            ways.append((2, "D", at + 1, ""))
            if rows[at] != DROP:
                extra = 5 if rows[at] >= 4 else 0
                ways.append((extra, "K", at + 1, "sua#"[rows[at] % 4]))
                ways += [(1 + extra, "R", at + 1, c) for c in "ua"]
        for more, edit, then, role in ways:
            if ALLOWED.match(roles + role):
                heapq.heappush(heap, (cost + more, audit + edit, then, roles + role))


@pytest.mark.parametrize("block", [1, 3, 4])
def test_edits_equal_the_search_over_all(block):
    for n in range(3):
        for rows in itertools.product(range(9), repeat=n):
            assert block_tables.cheapest(list(rows), block) == search(rows)[:2]
    draw = random.Random(block)
    for _ in range(250):
        rows = [draw.randrange(9) for _ in range(draw.randint(3, 8))]
        assert block_tables.cheapest(rows, block) == search(rows)[:2]


def test_long_sequences_do_not_depend_on_the_block():
    draw = random.Random(8)
    rows = [draw.randrange(9) for _ in range(5000)]
    assert block_tables.cheapest(rows, 4) == block_tables.cheapest(rows, 1)
    assert len(block_tables.tables().vectors) < 100


def plain(rows):
    """What must come out, a row at a time; ``rows`` as (conv_id, turn, role, text)."""
    groups = {}
    for conv, turn, role, text in rows:
        group = groups.setdefault(conv, [])
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        group += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {conv: plain_report(group) for conv, group in groups.items()}


def plain_report(group):
    # Rows of one turn differ in their role only, in these tests.
    group = sorted(group, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    turns = [t for t, _, _ in group if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults, symbols = set(), [], []
    for _, role, text in group:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else None
        if fault is None and body[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        faults.append(fault)
        known = "sua".find(role[:1]) if role[:1] else -1
        base = known if known >= 0 else 3
        symbols.append(DROP if fault in ("blank", "duplicate") else base + 4 * (fault == "truncated"))
    initials = [r[:1] for _, r, _ in group]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, roles = search(symbols)
    at, out, names = 0, [], iter(roles)
    for edit in audit:
        role, text = group[at][1:] if edit != "I" else ("", "")
        at += edit != "I"
        if edit != "D":
            name = next(names)
            out.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[name]}:{text}")
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def talk(n, seed):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t\n", "Stop. \n", "é漢。", "A. b", "Long " * 200 + "end."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    rows = []
    for conv in range(n):
        turn = draw.randint(0, 3)
        for k in range(draw.randint(1, 9)):
            text = draw.choice([*texts, f"Turn {k}.", f"Turn {k}.", None])
            rows.append((conv, None if k == 0 and draw.random() < 0.1 else turn, draw.choice(roles), text))
            turn += draw.choice([1, 1, 1, 2])
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Hi."), (None, None, None, None)]
    rows += [(900, 5, "user", "Again."), (900, 5, "user", "Again."), (900, 5, "assistant", "Again.")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return talk(150, 4)


@pytest.fixture(scope="module")
def table(spark, rows):
    mixed = rows[:]
    random.Random(1).shuffle(mixed)
    df = spark.createDataFrame(mixed, "conv_id long, turn long, role string, text string")
    clashing = {c: F.lit(7) for c in ("part", "at", "present", "gaps", "audit", "c", "w")}
    return df.withColumns(clashing).repartition(3)


def reports(df):
    names = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    found = df.collect()
    assert len({r["conv_id"] for r in found}) == len(found)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in found}


def test_repair(table, rows):
    assert reports(conversations.op12_repair(table)) == plain(rows)


def test_long_conversations_are_cut_and_put_together(table, rows):
    """With a bound of 3 rows nearly every conversation is cut into stretches."""
    damaged = conversations.damage(table)
    assert reports(conversations.repair(damaged, hot_rows=3)) == plain(rows)


def test_one_conversation_holds_most_rows(spark):
    draw = random.Random(6)
    rows = [(1, k, draw.choice(["user", "assistant"]), f"{k % 700}.") for k in range(3000)]
    rows += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Hi.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    damaged = conversations.damage(df)
    whole = reports(conversations.repair(damaged))
    assert reports(conversations.repair(damaged, hot_rows=400)) == whole
    assert whole[1][2] > 1000


def test_turns_that_are_left(table):
    damaged = conversations.damage(table)
    turns = conversations.repaired_turns(damaged)
    lines = F.array_join(
        F.transform(
            F.sort_array(F.collect_list(F.struct("place", "role", "text"))),
            lambda r: F.concat_ws(":", r["role"], r["text"]),
        ),
        "\n",
    )
    got = {r["conv_id"]: r["d"] for r in turns.groupBy("conv_id").agg(F.sha2(lines, 256).alias("d")).collect()}
    want = {i: r[-1] for i, r in reports(conversations.repair(damaged)).items()}
    empty = hashlib.sha256(b"").hexdigest()
    assert got == {i: d for i, d in want.items() if d != empty}


def test_no_conversations(table):
    assert conversations.op12_repair(table.where("false")).count() == 0
