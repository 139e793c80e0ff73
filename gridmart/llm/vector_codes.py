"""Vector code compression: codebooks of parts by Lloyd's algorithm that compares only what can have changed.

A row keeps, for each part, its assigned entry and the exact squared distance to it. Where that entry did not move in a
round, only moved entries can have come closer, so the part is compared with those alone; where it moved, the part is
compared with all entries. Ties go to the lower index either way. A round is one pass: a task reads its rows, assigns
them, writes them with their new state, and adds one row of sums for each entry it used. Sums are added by Spark; only
codebooks (entries x dimension numbers) reach the driver and the tasks. A round's rows replace those of the round before.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import arrow_batch
from gridmart.session import discard, scratch_path

#: Fixed value: components are integers, floor(SCALE * x).
SCALE = 1024
_STATE = "x array<int>, codes array<smallint>, distances array<bigint>"
_SUMS = "part int, entry int, n long, sums array<bigint>"


@dataclass(frozen=True)
class Codes:
    """Rows with their codes, and the codebooks: parts x entries x width."""

    rows: DataFrame
    codebooks: np.ndarray


def finite(vector: Column) -> Column:
    """Neither null nor with a null, NaN or infinite component."""
    inner = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(inner, F.lit(False))


def largest_component(width: int) -> int:
    """Bound of a component, so that a part's squared distance is exact in 64 bits."""
    return min(math.isqrt((1 << 61) // max(width, 1)), (1 << 31) - 1)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all entries, in floating point where that is exact."""
    limit = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * x.shape[1] * limit * limit < 1 << 52:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        squares = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
        return squares.astype(np.int64)
    a, out = x.astype(np.int64), np.zeros((len(x), len(entries)), np.int64)
    for k in range(x.shape[1]):
        apart = a[:, k, None] - entries[None, :, k].astype(np.int64)
        out += apart * apart
    return out


def reassign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row and its distance, lower index first, from the nearest one before entries ``moved``.

    ``code`` is -1 for a row without an assignment.
    """
    code, distance = code.copy(), distance.copy()
    stale = (code < 0) | moved[code]
    if stale.any():
        all_of = distances(x[stale], entries)
        code[stale] = all_of.argmin(axis=1)
        distance[stale] = all_of.min(axis=1)
    if moved.any() and not stale.all():
        fixed = np.flatnonzero(~stale)
        active = np.flatnonzero(moved)
        some = distances(x[fixed], entries[active])
        nearest = some.argmin(axis=1)
        best, index = some[np.arange(len(fixed)), nearest], active[nearest]
        closer = (best < distance[fixed]) | ((best == distance[fixed]) & (index < code[fixed]))
        code[fixed[closer]], distance[fixed[closer]] = index[closer], best[closer]
    return code, distance


def _lists(values: np.ndarray) -> pa.ListArray:
    """Rows of a matrix as an Arrow list column."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values).reshape(-1)))


def _matrix(column: pa.ListArray, width: int, dtype) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), width)


def integers(vectors: DataFrame, dimension: int, parts: int, carry: list[str], schema: str) -> DataFrame:
    """``__x`` as integers floor(SCALE * x) of ``dimension`` components, missing ones zero, and an empty state."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column("__x")
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            limit = largest_component(dimension // parts)
            whole = np.clip(np.floor(values * SCALE), -limit, limit).astype(np.int32)
            x = np.zeros((batch.num_rows, dimension), np.int32)
            x[np.arange(dimension)[None, :] < sizes[:, None]] = whole
            codes, apart = np.full((batch.num_rows, parts), -1, np.int16), np.zeros((batch.num_rows, parts), np.int64)
            yield arrow_batch(**{c: batch.column(c) for c in carry}, x=_lists(x), codes=_lists(codes), distances=_lists(apart))

    return vectors.mapInArrow(convert, schema)


def _round(codebooks: np.ndarray, moved: np.ndarray, carry: list[str]):
    """A task's rows with their new state, then its sums by part and entry: ``part`` is null in a row of state."""
    parts, entries, width = codebooks.shape

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        kept = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column("x"), parts * width, np.int32).reshape(n, parts, width)
            codes, apart = _matrix(batch.column("codes"), parts, np.int16).copy(), _matrix(batch.column("distances"), parts, np.int64).copy()
            for p in range(parts):
                for at in range(0, n, 4096):
                    own = slice(at, at + 4096)
                    codes[own, p], apart[own, p] = reassign(x[own, p], codebooks[p], moved[p], codes[own, p], apart[own, p])
                np.add.at(sums[p], codes[:, p], x[:, p])
                counts[p] += np.bincount(codes[:, p], minlength=entries)
            columns = {c: batch.column(c) for c in carry}
            kept = {c: v.type for c, v in columns.items()}
            nothing = {"part": pa.nulls(n, pa.int32()), "entry": pa.nulls(n, pa.int32()), "n": pa.nulls(n, pa.int64()), "sums": pa.nulls(n, pa.list_(pa.int64()))}
            yield arrow_batch(**columns, x=batch.column("x"), codes=_lists(codes), distances=_lists(apart), **nothing)
        if kept is not None:
            part, entry = np.nonzero(counts)
            n = len(part)
            empty = {"x": pa.nulls(n, pa.list_(pa.int32())), "codes": pa.nulls(n, pa.list_(pa.int16())), "distances": pa.nulls(n, pa.list_(pa.int64()))}
            yield arrow_batch(
                **{c: pa.nulls(n, t) for c, t in kept.items()}, **empty, part=part.astype(np.int32), entry=entry.astype(np.int32),
                n=counts[part, entry], sums=_lists(sums[part, entry]),
            )

    return step


def _written(rows: DataFrame, name: str, by: list[str]) -> str:
    path = scratch_path(rows.sparkSession, name)
    rows.write.partitionBy(*by).parquet(path)
    return path


def encode(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", carry: tuple[str, ...] = (), parts: int = 4, entries: int = 256, rounds: int = 4) -> Codes:
    """Codes of all vectors: ``id``, ``carry``, codes (array of entry indexes by part), distances (squared, by part).

    A component x becomes the integer floor(1024 * x); a vector is cut into ``parts`` equal consecutive parts. The
    codebook of a part starts as that part of the ``entries`` (256 at most) smallest ids. Each of ``rounds`` assigns
    parts to nearest entries, lower index first, and moves every used entry to the floor of its parts' mean, component
    by component; a last assignment follows.

    Rows whose vector is null, or holds a null, NaN or infinite component, are left out. A shorter vector than the
    longest counts as if zeros followed, as does a dimension that ``parts`` does not divide. Components beyond
    ``largest_component`` (2^28 for a width of 16) are set to it, so that distances are exact. Equal ids are seeded
    in the order of their vectors, repeated rows each; null ids come last and are kept. Fewer rows than ``entries`` give
    as many entries. Equal entries: the lower index takes all, the others stay where they are. Only the named columns
    are read. An empty table gives an empty one and codebooks without entries.
    """
    if entries > 256:
        raise ValueError(f"entries: 256 at most, not {entries}")
    spark, names = vectors.sparkSession, ["__id", *[f"__carry{i}" for i in range(len(carry))]]
    chosen = vectors.select(*[F.col(f"`{c}`").alias(n) for c, n in zip((id, *carry), names)], F.col(f"`{vector}`").cast("array<double>").alias("__x"))
    kept = chosen.where(finite(F.col("__x")))
    longest = kept.agg(F.max(F.size("__x"))).first()[0] or 0
    dimension = max(1, -(-longest // parts)) * parts
    width = dimension // parts
    typed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.select(*names).schema)
    schema = f"{typed}, {_STATE}"
    path = _written(integers(kept, dimension, parts, names, schema), "vectors", [])
    state = spark.read.schema(schema).parquet(path)

    seeds = state.orderBy(F.asc_nulls_last("__id"), "x").select("x").limit(entries).collect()
    codebooks = np.array([r.x for r in seeds], np.int64).reshape(len(seeds), parts, width).transpose(1, 0, 2)
    moved = np.ones(codebooks.shape[:2], bool)
    for k in range(rounds + 1):
        is_state = F.col("part").isNull().alias("is_state")
        stepped = state.mapInArrow(_round(codebooks, moved, names), f"{schema}, {_SUMS}")
        before, path = path, _written(stepped.select("*", is_state), "assigned", ["is_state"])
        discard(spark, before)
        written = spark.read.schema(f"{schema}, {_SUMS}, is_state boolean").parquet(path)
        state = written.where("is_state").select(*names, "x", "codes", "distances")
        if k < rounds:
            codebooks, moved = _moved(written.where("NOT is_state"), codebooks)
    rows = state.select(*[F.col(n).alias(c) for n, c in zip(names, (id, *carry))], "codes", "distances")
    return Codes(rows, codebooks)


def _moved(sums: DataFrame, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next codebooks, and which entries are others than before."""
    counts = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"))
    totals = sums.select("part", "entry", F.posexplode("sums").alias("pos", "value")).groupBy("part", "entry", "pos").agg(F.sum("value").alias("value"))
    after = codebooks.copy()
    n = {(r.part, r.entry): r.n for r in counts.collect()}
    for r in totals.collect():
        after[r.part, r.entry, r.pos] = r.value // n[r.part, r.entry]
    return after, (after != codebooks).any(axis=2)
