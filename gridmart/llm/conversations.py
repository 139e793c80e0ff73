"""Conversation structure repair: cheapest edits by a parallel Viterbi search over chunks.

Rows are sorted by conversation and turn in ranges, and runs of a conversation become chunks of one byte a row; text
stays behind. A state is what stands last (nothing, system, user, assistant); the cost of the cheapest way to the end
from each state is a vector, computed backwards. All chunks start at once from a speculative vector at their end, and
fix-up passes rerun those whose follower says otherwise, only until old and new vectors differ by a constant: from
there on all choices are the same. Traces from all four states of a chunk give a map of states; maps are composed by
doubling, and each chunk is traced from its true state.

Rows that must be deleted change no vector: chunks of nothing else take no part, so that a long run of copies delays
no convergence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import arrow_batch, staged

#: Costs of edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Rows of a conversation that one chunk holds at most.
CHUNK_ROWS = 1 << 16
_NONE, _BLANK, _DUPLICATE, _TRUNCATED = range(4)
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: A row's symbol is the code of its role's initial, plus 4 if it is truncated; or this one, if it must be deleted.
FORCED = 8
#: State after an insertion or a new role, by state before.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
#: Pairs of initials (4 * first + second) that may stand side by side: su, ua, au.
_FOLLOWS = [4 * _SYSTEM + _USER, 4 * _USER + _ASSISTANT, 4 * _ASSISTANT + _USER]
_LAST_PART = (1 << 31) - 1

Vector = tuple[int, int, int, int]
_FAR = 1 << 20


def _closed(v: Vector) -> Vector:
    """Costs when rows may be inserted first."""
    user, assistant = min(v[2], INSERT + v[3]), min(v[3], INSERT + v[2])
    return min(v[0], INSERT + user), min(v[1], INSERT + user), user, assistant


def _level(v: Vector) -> Vector:
    """The same for all vectors that differ by a constant."""
    return 0, v[1] - v[0], v[2] - v[0], v[3] - v[0]


#: At the end, nothing or an assistant may stand last.
END: Vector = _level(_closed((0, _FAR, _FAR, 0)))
SPECULATIVE: Vector = (0, 0, 0, 0)


def _edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what can be done with a row."""
    out = [("D", DELETE, state)]
    if symbol != FORCED:
        initial, extra = symbol & 3, TRUNCATED * (symbol >> 2)
        if (initial == _SYSTEM and state == _START) or (initial >= _USER and _NEXT[state] == initial):
            out.append(("K", extra, initial))
        out.append(("R", REROLE + extra, _NEXT[state]))
    return out


_EDITS = [[_edits(symbol, state) for state in range(4)] for symbol in range(9)]


Choices = tuple[tuple[str, int, int], ...]
#: Vectors are few, so that each step is computed once.
_steps: dict[tuple[Vector, int], tuple[Vector, Choices]] = {}


def _step(v: Vector, symbol: int) -> tuple[Vector, Choices]:
    """The vector in front of a row, from the one behind it, and the least letter of a cheapest way from each state."""
    if (known := _steps.get((v, symbol))) is not None:
        return known
    front = _closed(tuple(min(cost + v[to] for _, cost, to in _EDITS[symbol][s]) for s in range(4)))
    choices = []
    for s in range(4):
        ways = [(letter, cost, to) for letter, cost, to in _EDITS[symbol][s] if cost + v[to] == front[s]]
        if INSERT + front[_NEXT[s]] == front[s]:
            ways.append(("I", INSERT, _NEXT[s]))
        choices.append(min(ways))
    _steps[v, symbol] = _level(front), tuple(choices)
    return _steps[v, symbol]


def begin(codes: bytes, end: Vector) -> Vector:
    """The vector in front of a chunk, from the one behind it."""
    for symbol in reversed(codes):
        end = _step(end, symbol)[0]
    return end


def fixed_up(codes: bytes, old_begin: Vector, old_end: Vector, end: Vector) -> Vector:
    """The vector in front for a new one behind: a rerun that stops where old and new differ only by a constant."""
    for symbol in reversed(codes):
        if end == old_end:
            return old_begin
        old_end, end = _step(old_end, symbol)[0], _step(end, symbol)[0]
    return end


def _choices(codes: bytes, end: Vector) -> list[Choices]:
    out = []
    for symbol in reversed(codes):
        end, choices = _step(end, symbol)
        out.append(choices)
    return out[::-1]


def trace(codes: bytes, end: Vector, state: int) -> tuple[str, int, int]:
    """Letters of the cheapest edits from ``state``, the least ones among equals, their cost, and the state they end in.

    Insertions behind the last row are left to what follows.
    """
    letters, total = [], 0
    for choices in _choices(codes, end):
        while True:
            letter, cost, state = choices[state]
            letters.append(letter)
            total += cost
            if letter != "I":
                break
    return "".join(letters), total, state


def closing(state: int) -> str:
    """Insertions that end a conversation."""
    out = ""
    while state not in (_START, _ASSISTANT):
        out, state = out + "I", _NEXT[state]
    return out


def ends(codes: bytes, end: Vector) -> list[int]:
    """The state behind a chunk for each state in front of it."""
    states = list(range(4))
    for choices in _choices(codes, end):
        for k, state in enumerate(states):
            letter = "I"
            while letter == "I":
                letter, _, state = choices[state]
            states[k] = state
    return states


@dataclass(frozen=True)
class Repaired:
    """A row for each conversation, and the messages of all after repair, ordered by part, idx and pos."""

    report: DataFrame
    messages: DataFrame


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _chunks(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """Chunks of sorted rows (conv_id, seq, fault, initial): no chunk spans two tasks or two conversations."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, ...]] = []
        out: list[tuple] = []
        last, size = None, 0

        def flush() -> None:
            nonlocal held, size, count
            codes, initials, seqs = (np.concatenate(x) for x in zip(*held))
            pairs = initials[:-1] * 4 + initials[1:]
            illegal = int((~np.isin(pairs, _FOLLOWS)).sum())
            out.append((last, count, len(codes), codes.tobytes(), seqs.tobytes(), bool((codes != FORCED).any()), int(initials[0]), int(initials[-1]), illegal))
            held, size, count = [], 0, count + 1

        def emitted(kind: pa.DataType) -> pa.RecordBatch:
            conv, idx, n, codes, seqs, is_open, first, final, illegal = (list(x) for x in zip(*out))
            out.clear()
            return arrow_batch(
                conv_id=pa.array(conv, kind), part=pa.array([part] * len(idx), pa.int32()), idx=pa.array(idx, pa.int32()), n=pa.array(n, pa.int64()), codes=pa.array(codes, pa.binary()),
                seqs=pa.array(seqs, pa.binary()), open=is_open, first=pa.array(first, pa.int32()), last=pa.array(final, pa.int32()), illegal=pa.array(illegal, pa.int64()),
            )

        kind = None
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, seqs, fault, initials = (batch.column(c) for c in ("conv_id", "seq", "fault", "initial"))
            kind = conv.type
            seqs, fault, initials = (c.to_numpy(zero_copy_only=False) for c in (seqs, fault, initials))
            codes = np.where((fault == _BLANK) | (fault == _DUPLICATE), FORCED, initials + 4 * (fault == _TRUNCATED)).astype(np.uint8)
            same = conv.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            starts = [0, *(np.flatnonzero(np.diff(same)) + 1).tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:]):
                value = conv[a].as_py()
                if held and value != last:
                    flush()
                last = value
                while a < b:
                    upto = min(b, a + chunk_rows - size)
                    held.append((codes[a:upto], initials[a:upto], seqs[a:upto]))
                    size, a = size + upto - a, upto
                    if size == chunk_rows:
                        flush()
            if out:
                yield emitted(kind)
        if held:
            flush()
            yield emitted(kind)

    columns = "part int, idx int, n long, codes binary, seqs binary, open boolean, first int, last int, illegal long"
    return rows.mapInArrow(encode, f"conv_id {_type(rows, 'conv_id')}, {columns}")


_KEY = ["part", "idx"]


def _per_row(df: DataFrame, name: str, kind: str, function) -> DataFrame:
    """``df`` and a column ``name`` of what ``function`` makes of each row (a dict) in a batch."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [function(row) for row in batch.to_pylist()]
            columns = {c: batch.column(c) for c in batch.schema.names}
            yield arrow_batch(**columns, **{name: pa.array(made, pa.list_(pa.int32()))})

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(over, f"{fields}, {name} {kind}")


def _vectors(chunks: DataFrame) -> DataFrame:
    """(part, idx, end): the vector behind each of ``chunks`` (key, codes, next), by speculation and fix-up passes."""
    speculative = F.when(F.col("next").isNull(), F.lit(list(END))).otherwise(F.lit(list(SPECULATIVE))).alias("end")
    guessed = chunks.select(*_KEY, "next", "codes", speculative)
    known = staged(_per_row(guessed, "begin", "array<int>", lambda r: begin(r["codes"], tuple(r["end"]))).drop("codes"), "vectors")
    while True:
        told = known.select(F.struct(*_KEY).alias("next"), F.col("begin").alias("true_end"))
        wrong = staged(known.join(told, "next").where("end <> true_end").select(*_KEY, "begin", "end", "true_end"), "wrong_vectors")
        if wrong.isEmpty():
            return known.select(*_KEY, "end")
        rerun = lambda r: fixed_up(r["codes"], tuple(r["begin"]), tuple(r["end"]), tuple(r["true_end"]))
        again = _per_row(wrong.join(chunks.select(*_KEY, "codes"), _KEY), "new_begin", "array<int>", rerun).select(*_KEY, "new_begin", "true_end")
        columns = [*_KEY, "next", F.coalesce("true_end", "end").alias("end"), F.coalesce("new_begin", "begin").alias("begin")]
        known = staged(known.join(again, _KEY, "left").select(*columns), "vectors")


def _states(chunks: DataFrame) -> DataFrame:
    """(part, idx, state): the state in front of each of ``chunks`` (key, codes, before, end): maps composed by doubling."""
    maps = staged(_per_row(chunks.select(*_KEY, "before", "codes", "end"), "map", "array<int>", lambda r: ends(r["codes"], tuple(r["end"]))).drop("codes"), "maps")
    behind = maps.select(F.struct(*_KEY).alias("before"), F.col("map").alias("f"))
    identity = F.lit([0, 1, 2, 3])
    hops = staged(maps.join(behind, "before", "left").select(*_KEY, "before", F.coalesce("f", identity).alias("f")), "hops")
    while not hops.where("before IS NOT NULL").isEmpty():
        further = hops.select(F.struct(*_KEY).alias("before"), F.col("before").alias("next"), F.col("f").alias("g"))
        composed = F.when(F.col("g").isNull(), F.col("f")).otherwise(F.transform("g", lambda x: F.element_at("f", x + 1)))
        hops = staged(hops.join(further, "before", "left").select(*_KEY, F.col("next").alias("before"), composed.alias("f")), "hops")
    return hops.select(*_KEY, F.element_at("f", 1).alias("state"))


def _traced(chunks: DataFrame) -> DataFrame:
    """Chunks (conv_id, key, codes, seqs, open, final, end, state) with their letters and cost; insertions that end a conversation are a chunk of their own."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, part, idx, codes, seqs, state, audit, cost = ([] for _ in range(8))
            for i, r in enumerate(batch.drop_columns(["conv_id", "seqs"]).to_pylist()):
                if r["open"]:
                    letters, total, behind = trace(r["codes"], tuple(r["end"]), r["state"])
                else:
                    letters, total, behind = "D" * len(r["codes"]), DELETE * len(r["codes"]), _START
                made = [(r["part"], r["idx"], r["codes"], batch.column("seqs")[i].as_py(), r["state"], letters, total)]
                if r["open"] and r["final"] and closing(behind):
                    made.append((_LAST_PART, 0, b"", b"", behind, closing(behind), INSERT * len(closing(behind))))
                for values in made:
                    place.append(i)
                    for column, value in zip((part, idx, codes, seqs, state, audit, cost), values):
                        column.append(value)
            if place:
                i32 = pa.int32()
                yield arrow_batch(
                    conv_id=batch.column("conv_id").take(pa.array(place, i32)), part=pa.array(part, i32), idx=pa.array(idx, i32), codes=pa.array(codes, pa.binary()),
                    seqs=pa.array(seqs, pa.binary()), state=pa.array(state, i32), audit=pa.array(audit, pa.string()), cost=pa.array(cost, pa.int64()),
                )

    return chunks.mapInArrow(over, f"conv_id {_type(chunks, 'conv_id')}, part int, idx int, codes binary, seqs binary, state int, audit string, cost long")


def _kept(traced: DataFrame) -> DataFrame:
    """(conv_id, part, idx, pos, seq, new_role) of the messages that stay (with a role, if it is new) or are inserted (without seq)."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, part, idx, pos, seq, role = ([] for _ in range(6))
            for i, r in enumerate(batch.drop_columns(["conv_id"]).to_pylist()):
                state, at, seqs, first = r["state"], 0, np.frombuffer(r["seqs"], np.int64), len(pos)
                for letter in r["audit"]:
                    if letter != "D":
                        state = r["codes"][at] & 3 if letter == "K" else _NEXT[state]
                        place.append(i)
                        pos.append(len(pos) - first)
                        seq.append(None if letter == "I" else int(seqs[at]))
                        role.append(None if letter == "K" else _ROLES[state])
                    at += letter != "I"
                part += [r["part"]] * (len(pos) - first)
                idx += [r["idx"]] * (len(pos) - first)
            if place:
                i32 = pa.int32()
                yield arrow_batch(
                    conv_id=batch.column("conv_id").take(pa.array(place, i32)), part=pa.array(part, i32), idx=pa.array(idx, i32), pos=pa.array(pos, i32),
                    seq=pa.array(seq, pa.int64()), new_role=pa.array(role, pa.string()),
                )

    columns = "part int, idx int, pos int, seq long, new_role string"
    return traced.select("conv_id", *_KEY, "codes", "seqs", "state", "audit").mapInArrow(over, f"conv_id {_type(traced, 'conv_id')}, {columns}")


def repair(conversations: DataFrame, chunk_rows: int = CHUNK_ROWS) -> Repaired:
    """Conversations (conv_id, turn, role, text) with the cheapest edits that give them a structure.

    Roles' initials shall read as ``(s?(ua)+)?``. A row is kept (K, cost 0), gets the role user or assistant (R, 2) or is
    deleted (D, 3); an empty message of user or assistant may be inserted anywhere (I, 2). A blank row, or one whose role
    and text stood before, must be deleted; a truncated row that stays adds 1. Of equally cheap edits those win whose
    letters, in order, come first.

    The report has conv_id, gaps (turns missing between the least and the greatest; null where that exceeds 64 bits),
    blank, duplicate and truncated (rows by their first fault), illegal (neighbours that may not follow each other),
    cost, and audit (the letters). The messages have conv_id, part, idx, pos (their order), turn (null if inserted),
    role, text.

    Null roles and texts are one space, so the text is blank and the role has to change. A role without a first letter
    s, u or a, the empty one too, cannot be kept. Rows are in order of turn, nulls first; rows of one turn are in order
    of role and then of a hash of role and text, and rows equal in all are duplicates of the first. A null conv_id is a
    conversation. Texts may have any length; other columns are not read. An empty table gives empty tables.
    """
    space = F.lit(" ")
    typed = conversations.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), space).alias(c) for c in ("role", "text")])
    letter = F.substring("role", 1, 1)
    initial = F.when(letter == "s", _SYSTEM).when(letter == "u", _USER).when(letter == "a", _ASSISTANT).otherwise(0)
    both = F.concat(F.length("role").cast("string"), space, "role", "text")
    rows = staged(typed.select("*", F.unhex(F.md5(both)).alias("hash"), initial.alias("initial"), F.monotonically_increasing_id().alias("seq")), "messages")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    truncated = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    flags = rows.select("conv_id", "turn", "role", "hash", "initial", "seq", blank.alias("blank"), truncated.alias("truncated"))
    flags = staged(flags, "message_flags")
    firsts = flags.where("NOT blank").groupBy("conv_id", "hash").agg(F.min(F.struct("turn", "seq")).alias("first"))
    found = staged(firsts.select(F.col("first.seq").alias("seq"), F.lit(True).alias("is_first")), "first_messages")
    fault = F.when(F.col("blank"), _BLANK).when(F.col("is_first").isNull(), _DUPLICATE).when(F.col("truncated"), _TRUNCATED).otherwise(_NONE)
    marked = staged(flags.join(found, "seq", "left").select("conv_id", "turn", "role", "hash", "initial", "seq", fault.alias("fault")), "message_faults")

    order = ["conv_id", "turn", "role", "hash", "seq"]
    ranges = marked.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "seq", "fault", "initial")
    chunks = staged(_chunks(ranges, chunk_rows), "chunks")
    by_place = Window.partitionBy("conv_id").orderBy(*_KEY)
    places = chunks.where("open").select("conv_id", *_KEY).select(*_KEY, F.lead(F.struct(*_KEY)).over(by_place).alias("next"), F.lag(F.struct(*_KEY)).over(by_place).alias("before"))
    linked = staged(places.where("next IS NOT NULL OR before IS NOT NULL"), "chunk_links")
    several = staged(linked.join(chunks.select(*_KEY, "codes"), _KEY), "linked_chunks")
    vectors = _vectors(several)
    states = _states(several.join(vectors, _KEY))
    known = staged(linked.select(*_KEY, "next").join(vectors, _KEY).join(states, _KEY), "chunk_states")
    told = chunks.select("conv_id", *_KEY, "codes", "seqs", "open").join(known, _KEY, "left").select(
        "conv_id", *_KEY, "codes", "seqs", "open", F.col("next").isNull().alias("final"),
        F.coalesce("end", F.lit(list(END))).alias("end"), F.coalesce("state", F.lit(_START)).alias("state"),
    )
    traced = staged(_traced(told), "traced_chunks")

    kept = staged(_kept(traced), "kept_messages")
    place = ["conv_id", *_KEY, "pos"]
    stays = kept.where("seq IS NOT NULL").join(rows.select("seq", "turn", "role", "text"), "seq")
    stays = stays.select(*place, "turn", F.coalesce("new_role", "role").alias("role"), "text")
    added = kept.where("seq IS NULL").select(*place, F.lit(None).cast(_type(rows, "turn")).alias("turn"), F.col("new_role").alias("role"), F.lit("").alias("text"))

    turn = F.col("turn").cast("long")
    missing = F.try_add(F.try_subtract(F.max(turn), F.min(turn)), 1 - F.count_distinct(turn))
    gaps = marked.groupBy("conv_id").agg(F.when(F.count(turn) == 0, 0).otherwise(missing).alias("gaps"))
    counts = marked.groupBy("conv_id").agg(*[F.count_if(F.col("fault") == k).alias(c) for k, c in ((_BLANK, "blank"), (_DUPLICATE, "duplicate"), (_TRUNCATED, "truncated"))])
    seam = F.lag("last").over(by_place) * 4 + F.col("first")
    seams = chunks.select("conv_id", "illegal", (~seam.isin(_FOLLOWS)).cast("int").alias("seam"))
    illegal = seams.groupBy("conv_id").agg(F.sum(F.col("illegal") + F.coalesce("seam", F.lit(0))).alias("illegal"))
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*_KEY, "audit"))), lambda x: x["audit"]), "")
    audits = traced.groupBy("conv_id").agg(F.sum("cost").alias("cost"), letters.alias("audit"))
    parts = [gaps, counts, illegal, audits]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part, allowMissingColumns=True)
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    report = united.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in columns])
    return Repaired(report, stays.unionByName(added))


def text_digests(messages: DataFrame) -> DataFrame:
    """(conv_id, sha256) of each conversation's messages as ``role:text`` lines, streamed in order: a digest cannot be split."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest, kind = None, None, None
        for batch in batches:
            kind, done = batch.column("conv_id").type, []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                line = f"{role}:{text}".encode()
                if digest is not None and conv == last:
                    digest.update(b"\n" + line)
                    continue
                if digest is not None:
                    done.append((last, digest.hexdigest()))
                last, digest = conv, hashlib.sha256(line)
            if done:
                yield arrow_batch(conv_id=pa.array([c for c, _ in done], kind), sha256=pa.array([x for _, x in done], pa.string()))
        if digest is not None:
            yield arrow_batch(conv_id=pa.array([last], kind), sha256=pa.array([digest.hexdigest()], pa.string()))

    place = ["conv_id", *_KEY, "pos"]
    ordered = messages.select(*place, "role", "text").repartition("conv_id").sortWithinPartitions(*place)
    return ordered.mapInArrow(over, f"conv_id {_type(messages, 'conv_id')}, sha256 string")
