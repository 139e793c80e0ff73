"""Conversation repair against a search over all edits, with chunks of a few rows and of many."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from gridmart.llm import conversations
from gridmart.llm.common import table
from gridmart.llm.queries import QUERIES, damaged

SCHEMA = "conv_id long, turn long, role string, text string, part int, seq string, audit string, codes string"
BLANKS = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, repaired lines) by a shortest-path search; rows are (role, text, fault)."""
    step = {"": "user", "s": "user", "u": "assistant", "a": "user"}
    done, queue = set(), [(0, "", 0, "", ())]
    while True:
        cost, audit, i, last, lines = heapq.heappop(queue)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, lines
        heapq.heappush(queue, (cost + 2, audit + "I", i, step[last][0], (*lines, step[last] + ":")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, last, lines))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if re.fullmatch("s|su|ua|au|u", last + role[:1]) and role[:1] and (last or role[0] in "su"):
                    heapq.heappush(queue, (cost + extra, audit + "K", i + 1, role[0], (*lines, f"{role}:{text}")))
                heapq.heappush(queue, (cost + 2 + extra, audit + "R", i + 1, step[last][0], (*lines, f"{step[last]}:{text}")))


def plain_repair(rows):
    """Report by conversation of (conv_id, turn, role, text)."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, own in groups.items():
        digest = lambda r: hashlib.md5(f"{len(r[1])} {r[1]}{r[2]}".encode()).digest()
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
        seen, told = set(), []
        for _, role, text in own:
            body = text.strip(BLANKS)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            told.append((role, text, fault))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = cheapest(told)
        counts = [sum(f == k for _, _, f in told) for k in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repaired(data, chunk_rows):
    found = conversations.repair(data, chunk_rows)
    digests = dict(conversations.text_digests(found.messages).collect())
    nothing = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digests.get(r.conv_id, nothing)) for r in found.report.collect()}


def dialogues(seed, n, longest):
    r = random.Random(seed)
    out = []
    for conv in range(n):
        for turn in range(r.randint(1, longest)):
            role = r.choice(["user", "assistant"] * 4 + ["system", "tool", "sysop", "", None, "Üser"]) if r.random() < 0.5 else ("user", "assistant")[turn % 2]
            text = r.choice(["Yes.", "no", "", " \t\n", None, "Same text!", f"a {turn}.", f"b {r.random()}?", "e\x85.", f"x {turn} \n"])
            out.append((conv, None if r.random() < 0.05 else turn + r.randint(0, 1) * r.randint(0, 3), role, text))
    return out


@pytest.mark.parametrize("chunk_rows", [1, 3, 1 << 16])
def test_repair(spark, chunk_rows):
    rows = [*dialogues(chunk_rows, 60, 9), *[(500, k, "user", "Copy.") for k in range(40)], *[(501, 7, "assistant", "Copy.")] * 30, (None, 1, "user", "Alone."), (None, None, "assistant", "x"), (502, 1, None, None)]
    rows += [(503, k, "assistant" if k % 2 else "user", "" if 3 < k < 30 else f"Long {k}" + "." * (k % 3 > 0)) for k in range(60)]
    data = spark.createDataFrame([(*x, 1, "s", "a", "c") for x in rows], SCHEMA).repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = repaired(data, chunk_rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == plain_repair(rows)


def test_long_text_and_long_conversation(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"Turn {k}.") for k in range(400)] + [(2, 1, "user", "é" * 2_000_000 + "."), (2, 2, "assistant", "word " * 300_000)]
    data = spark.createDataFrame([(*x, 1, "s", "a", "c") for x in rows], SCHEMA).repartition(3)
    assert repaired(data, 50) == plain_repair(rows)


def test_empty_table(spark):
    found = conversations.repair(spark.createDataFrame([], SCHEMA))
    assert found.report.count() == 0 and found.messages.count() == 0


def test_fix_up_stops_where_vectors_are_parallel(monkeypatch):
    codes = bytes([2, 3] * 1000)
    end = conversations._level(conversations._closed((0, 9, 4, 7)))
    old = conversations.begin(codes, conversations.SPECULATIVE)
    calls, step = [], conversations._step
    monkeypatch.setattr(conversations, "_step", lambda v, symbol: calls.append(v) or step(v, symbol))
    got = conversations.fixed_up(codes, old, conversations.SPECULATIVE, end)
    assert len(calls) < 20
    assert got == conversations.begin(codes, end)


def test_pieces_give_the_whole():
    """Any cut of any row of symbols: vectors by fix-up, states by maps, letters by pieces."""
    r = random.Random(4)
    for _ in range(500):
        codes = bytes(r.choice(range(9)) for _ in range(r.randint(0, 12)))
        m = r.randint(0, len(codes))
        a, b = codes[:m], codes[m:]
        middle = conversations.begin(b, conversations.END)
        front = conversations.fixed_up(a, conversations.begin(a, conversations.SPECULATIVE), conversations.SPECULATIVE, middle)
        assert front == conversations.begin(codes, conversations.END)
        first, cost_a, state = conversations.trace(a, middle, 0)
        second, cost_b, behind = conversations.trace(b, conversations.END, state)
        assert conversations.ends(a, middle)[0] == state
        assert (first + second, cost_a + cost_b, behind) == conversations.trace(codes, conversations.END, 0)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        if fault:
            out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def test_damage(spark):
    rows = [*dialogues(9, 80, 6), (None, 3, "user", None), (None, None, None, "x.y!")]
    data = spark.createDataFrame([(*x, 1, "s", "a", "c") for x in rows], SCHEMA)
    assert sorted(map(tuple, damaged(data).collect()), key=repr) == sorted(plain_damage(rows), key=repr)


def test_query_against_plain_version(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for conv, *_ in rows} | plain_repair(plain_damage(rows))
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in QUERIES["op12_conversation_repair"](spark, sf_dir).collect()}
    assert got == want
