"""Line dedup: hashes of lines in ranges sorted by document and position, streamed once, answered by keep bitmaps.

Text never moves with the lines. A line is a 128-bit hash, a row key and a position; ranges are cut on all of them, so
the lines of one very common key are spread over as many tasks as their number asks for. A task streams its range and
holds no more than the lines of ``min_docs - 1`` documents of one key. A key can only be open at the two ends of a
range: those parts are summed in a second, small step.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.llm.common import ROW, arrow_batch, carried, per_batch, row_key, rows, staged, texts, with_row

#: What is stripped from both ends of a line.
BLANK = b" \t\n\x0b\x0c\r"

_LINE = ("h1", "h2", *ROW, "pos")
_LINES = "h1 long, h2 long, __row_id long, __row_hash long, pos int, n_lines int, counted boolean"
_STREAM = "kind byte, h1 long, h2 long, __row_id long, __row_hash long, pos int, n_lines int, n long, head boolean"
_DROP, _PENDING, _PART = 0, 1, 2


def line_hashes(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """A row for each line whose key has ``min_chars`` code points or more; ``counted`` marks the key's first line in its document."""

    def split(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests, lengths, pos, counted, n_lines = [], [], [], [], []
        for text in texts(batch):
            lines, seen, before = text.split(b"\n"), set(), len(pos)
            for at, line in enumerate(lines):
                key = line.strip(BLANK).lower()
                if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
                    digest = xxhash.xxh3_128_digest(key)
                    digests.append(digest)
                    pos.append(at)
                    counted.append(digest not in seen)
                    seen.add(digest)
            lengths.append(len(pos) - before)
            n_lines.append(len(lines))
        hashes = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        row_id, row_hash = (np.repeat(x, lengths) for x in rows(batch))
        return arrow_batch(
            h1=np.ascontiguousarray(hashes[:, 0]), h2=np.ascontiguousarray(hashes[:, 1]), __row_id=row_id, __row_hash=row_hash,
            pos=np.array(pos, np.int32), n_lines=np.repeat(np.array(n_lines, np.int32), lengths), counted=np.array(counted, bool),
        )

    return docs.select(*row_key(), "text").mapInArrow(per_batch(split), _LINES)


class _Open:
    """The run of equal hashes that a stream is in."""

    def __init__(self, boundary: bool) -> None:
        self.n, self.boundary, self.held, self.head = 0, boundary, [], None


def _streamed(min_docs: int, keep_first: bool):
    """Lines of one range, in order, to decisions. Rows of a run are held only until its documents reach ``min_docs``."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, last = None, None

        def emit(kind: int, lines: np.ndarray, n: int = 0, head: bool = False) -> pa.RecordBatch:
            size = len(lines)
            return arrow_batch(
                kind=np.full(size, kind, np.int8), h1=lines[:, 0], h2=lines[:, 1], __row_id=lines[:, 2], __row_hash=lines[:, 3],
                pos=lines[:, 4].astype(np.int32), n_lines=lines[:, 5].astype(np.int32), n=np.full(size, n, np.int64), head=np.full(size, head, bool),
            )

        def close(run: _Open, boundary: bool) -> Iterator[pa.RecordBatch]:
            if run.boundary or boundary:
                yield emit(_PART, run.head, run.n)
                if run.n < min_docs:
                    yield emit(_PENDING, run.head, head=True)
                    for lines in run.held:
                        yield emit(_PENDING, lines)
                elif not keep_first or run.boundary:
                    yield emit(_PENDING, run.head, head=True)
            elif run.n >= min_docs and not keep_first:
                yield emit(_DROP, run.head)

        for batch in batches:
            if not batch.num_rows:
                continue
            names = (*_LINE, "n_lines")
            lines = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names], axis=1)
            before = np.vstack([lines[:1] if last is None else last, lines[:-1]])
            changed = (lines[:, :2] != before[:, :2]).any(axis=1)
            fresh = (lines[:, :5] != before[:, :5]).any(axis=1)
            if last is None:
                changed[0] = fresh[0] = True
            counts = batch.column("counted").to_numpy(zero_copy_only=False) & fresh
            starts = np.flatnonzero(changed)
            if not changed[0]:
                starts = np.concatenate([[0], starts])
            ends = np.append(starts[1:], len(lines))
            n = np.add.reduceat(counts.astype(np.int64), starts)
            heads = changed[starts]
            # A run of one line, closed within the batch and off the boundary, decides nothing unless one document is enough.
            busy = (ends - starts > 1) | (n >= min_docs)
            busy[0] = busy[-1] = True
            for i in np.flatnonzero(busy):
                a, b = starts[i], ends[i]
                if heads[i]:
                    if run is not None:
                        yield from close(run, False)
                    run = _Open(boundary=last is None and i == 0)
                    run.head, a = lines[a : a + 1], a + 1
                run.n += int(n[i])
                run.held.append(lines[a:b])
                if run.n >= min_docs:
                    for rest in run.held:
                        if len(rest):
                            yield emit(_DROP, rest)
                    run.held = []
            last = lines[-1:]
        if run is not None:
            yield from close(run, True)

    return stream


def dropped_lines(docs: DataFrame, min_docs: int, min_chars: int, keep: str) -> DataFrame:
    """(row key, pos, n_lines) of the lines to drop."""
    lines = staged(line_hashes(docs, min_chars), "line_hashes")
    ranges = lines.repartitionByRange(*[F.col(c) for c in _LINE]).sortWithinPartitions(*_LINE)
    out = staged(ranges.mapInArrow(_streamed(min_docs, keep == "first"), _STREAM), "line_decisions")
    place = F.struct(*ROW, "pos")
    totals = out.where(F.col("kind") == _PART).groupBy("h1", "h2").agg(F.sum("n").alias("total"), F.min(place).alias("first"))
    pending = out.where(F.col("kind") == _PENDING).join(totals, ["h1", "h2"]).where(F.col("total") >= min_docs)
    if keep == "first":
        pending = pending.where(~(F.col("head") & (F.col("first") == place)))
    columns = [*ROW, "pos", "n_lines"]
    return out.where(F.col("kind") == _DROP).select(*columns).unionByName(pending.select(*columns))


@F.pandas_udf(T.BinaryType())
def _bitmap(places: pd.Series, sizes: pd.Series) -> pd.Series:
    return pd.Series([_pack(np.asarray(at), int(n)) for at, n in zip(places, sizes)], dtype=object)


def _pack(dropped: np.ndarray, n_lines: int) -> bytes:
    keep = np.ones(n_lines, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    """A keep bitmap as booleans, one per line."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(docs: DataFrame, min_docs: int = 2, min_chars: int = 1, keep: str = "first") -> DataFrame:
    """Row key, n_lines and the deflated keep bitmap of each document that loses a line; other documents have none."""
    drops = dropped_lines(docs, min_docs, min_chars, keep)
    per_doc = drops.groupBy(*ROW).agg(F.collect_list("pos").alias("at"), F.max("n_lines").alias("n"))
    return per_doc.select(*ROW, F.col("n").alias("n_lines"), _bitmap("at", "n").alias("keep_bitmap"))


def line_dedup(docs: DataFrame, min_docs: int = 2, min_chars: int = 1, keep: str = "first") -> DataFrame:
    """``docs`` without the lines that repeat across documents, and n_lines, n_dropped and keep_bitmap.

    A line's key is the line without blanks at its ends, A-Z lower-cased. A key of ``min_chars`` code points or more that
    stands in ``min_docs`` documents or more is repeated. ``keep="first"`` keeps its first line, by doc_id, then text
    hash, then position; ``keep="none"`` keeps none.

    A null text is one empty line, as is an empty one; the result's text is never null. Rows equal in doc_id and text
    count as one document and get the same result. A null doc_id sorts as 0. Input columns named like the three result
    columns are replaced. An empty table gives an empty one.
    """
    if keep not in ("first", "none"):
        raise ValueError(f"keep: first or none, not {keep!r}")
    bitmaps = keep_bitmaps(docs, min_docs, min_chars, keep).select(*ROW, "keep_bitmap")
    passed = carried(docs, "n_lines", "n_dropped", "keep_bitmap")
    joined = with_row(docs, passed).join(bitmaps, list(ROW), "left").select("__in.*", "keep_bitmap")

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, n_lines, n_dropped = [], [], []
        for text, bitmap in zip(texts(batch), batch.column("keep_bitmap").to_pylist()):
            if bitmap is None:
                kept.append(text)
                n_lines.append(text.count(b"\n") + 1)
                n_dropped.append(0)
                continue
            lines = text.split(b"\n")
            mask = unpack(bitmap, len(lines))
            kept.append(b"\n".join([x for x, stays in zip(lines, mask) if stays]))
            n_lines.append(len(lines))
            n_dropped.append(int(len(lines) - mask.sum()))
        columns = {c: batch.column(c) for c in passed}
        columns["text"] = pa.array(kept, pa.binary()).cast(pa.string())
        return arrow_batch(**columns, n_lines=pa.array(n_lines, pa.int64()), n_dropped=pa.array(n_dropped, pa.int64()), keep_bitmap=batch.column("keep_bitmap"))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.drop("keep_bitmap").schema)
    return joined.mapInArrow(per_batch(apply), f"{fields}, n_lines long, n_dropped long, keep_bitmap binary")
