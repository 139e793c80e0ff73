"""Substring dedup by sliding sentence spans: every run of consecutive sentences is hashed, and later copies are cut.

For every sentence two runs are hashed, the shortest that begins there and the shortest that ends there with enough
sentences and words: equal passages give equal runs wherever they stand, and each sentence of a passage is in one of them. Rows that move are hashes and offsets; text is read once to make them, and once more
only where passages are cut out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import ROW, arrow_batch, boxed, carried, per_batch, row_key, rows, staged
from gridmart.llm.shingles import mixed, words_of

_BREAK = re.compile(r"\n\s*|[.!?…]+[\"')\]”’»]*\s+")
_TOKEN = re.compile(r"\S+\s*")
_SPANS = "h1 long, h2 long, __row_id long, __row_hash long, start int, end int"
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
LONG_SENTENCE = 32  # words; a longer sentence is taken in pieces
NEAR = 2  # words on either side that decide whether a long sentence is cut after a word; pieces between such cuts have more
LONG_PIECE = 12  # written words at most in a piece


def _cuts(hashes: np.ndarray) -> np.ndarray:
    """After which words a long sentence is cut: where a word's hash is the minimum of its neighbourhood, the first of equal ones.

    The neighbourhood alone decides, so equal text is cut alike wherever it stands. Where no word is such a minimum for
    long, cuts are counted from the last one.
    """
    n = len(hashes)
    least = np.ones(n, bool)
    for k in range(1, NEAR + 1):
        least[k:] &= hashes[k:] < hashes[:-k]
        least[:-k] &= hashes[:-k] <= hashes[k:]
    own = np.concatenate([np.flatnonzero(least) + 1, [n]])
    counted = [np.arange(a + LONG_PIECE, b, LONG_PIECE) for a, b in zip([0, *own[:-1]], own)]
    return np.unique(np.concatenate([own, *counted]))


def sentences(text: str) -> tuple[list[int], list[bytes], list[int]]:
    """Ends (code points), folded words and word counts of the sentences, which cover the text without gaps."""
    ends, folded, counts = [], [], []

    def add(start: int, end: int) -> None:
        words = words_of(text[start:end].encode())
        if len(words) > LONG_SENTENCE:
            # Marks that are no words go with the word before them.
            tokens = [(t.start(), w) for t in _TOKEN.finditer(text, start, end) if (w := words_of(t[0].encode()))]
            cuts = _cuts(np.array([xxhash.xxh3_64_intdigest(b" ".join(w)) for _, w in tokens], np.uint64)).tolist()
            for a, b in zip([0, *cuts], cuts):
                words = [x for _, w in tokens[a:b] for x in w]
                ends.append(tokens[b][0] if b < len(tokens) else end)
                folded.append(b" ".join(words))
                counts.append(len(words))
        else:
            ends.append(end)
            folded.append(b" ".join(words))
            counts.append(len(words))

    at = 0
    for mark in _BREAK.finditer(text):
        if mark.end() > at:
            add(at, mark.end())
            at = mark.end()
    if at < len(text):
        add(at, len(text))
    return ends, folded, counts


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def runs(text: str, min_sentences: int, min_words: int) -> tuple[np.ndarray, ...]:
    """h1, h2, start and end of each run. Sentences without words belong to the run they stand in."""
    ends, folded, counts = sentences(text)
    ends, counts = np.array(ends, np.int64), np.array(counts, np.int64)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    worded = np.flatnonzero(counts)
    total = np.concatenate([[0], np.cumsum(counts[worded])])
    n = len(worded)
    at = np.arange(n)
    last = np.maximum(at + min_sentences, np.searchsorted(total, total[:-1] + min_words))
    first = np.minimum(at + 1 - min_sentences, np.searchsorted(total, total[1:] - min_words, side="right") - 1)
    found = np.concatenate([(at * (n + 1) + last)[last <= n], (first * (n + 1) + at + 1)[first >= 0]])
    first, last = np.divmod(np.unique(found), n + 1)
    if not len(first):
        return tuple(np.empty(0, np.int64) for _ in range(4))
    digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(folded[i]) for i in worded), "<u8").reshape(-1, 2)
    hashes = []
    for column, base in enumerate(_BASES):
        base |= 1
        power, inverse = _powers(base, len(worded) + 1), _powers(pow(base, -1, 1 << 64), len(worded) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(digests[:, column]) * power[: len(worded)], dtype=np.uint64)])
        hashes.append(mixed((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64)).view(np.int64))
    return hashes[0], hashes[1], starts[worded[first]], ends[worded[last - 1]]


def _keys() -> list[Column]:
    """``row_key``, the last bit of whose hash tells whether the id is null, which counts as 0 otherwise."""
    row_id, row_hash = row_key()
    none = F.col("doc_id").isNull().cast("long")
    return [row_id, row_hash.bitwiseAND(F.lit(-2)).bitwiseOR(none).alias(ROW[1])]


def known_id(row_id: Column, row_hash: Column) -> Column:
    """The id of a row's key: null where the document's is null."""
    return F.when(row_hash.bitwiseAND(F.lit(1)) == 0, row_id)


def span_table(docs: DataFrame, min_sentences: int, min_words: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [runs(text or "", min_sentences, min_words) for text in batch.column("text").to_pylist()]
            if not found:
                continue
            lengths = [len(f[0]) for f in found]
            row_id, row_hash = (np.repeat(x, lengths) for x in rows(batch))
            h1, h2, start, end = (np.concatenate(x) for x in zip(*found))
            yield arrow_batch(
                h1=h1, h2=h2, __row_id=row_id, __row_hash=row_hash, start=start.astype(np.int32), end=end.astype(np.int32)
            )

    return docs.select(*_keys(), "text").mapInArrow(scan, _SPANS)


def repeated_spans(docs: DataFrame, min_sentences: int = 2, min_words: int = 24) -> DataFrame:
    """Row key, start, end (code points) and first_doc_id of each passage to cut: maximal, in no overlap.

    A run that stands elsewhere before, in doc_id, text hash and offset, is a later copy; sentences that any later copy
    covers go. A passage's first_doc_id is the smallest id among the first places of its runs, null if none has one.
    Repeated rows are one document; a null id stands in order where 0 does, and is told apart from it (``known_id``).
    Ties between places are settled by id, text hash and offset. A text of any length is read whole, by one task.
    """
    spans = staged(span_table(docs, min_sentences, min_words), "sentence_runs")
    # Keys are written, so that each join below shuffles both sides, and a hot key's rows can be split.
    often = staged(spans.groupBy("h1").agg(F.count("*").alias("n")).where("n > 1").select("h1"), "repeated_keys")
    shared = staged(spans.join(often, "h1", "left_semi"), "shared_runs")
    place = F.struct(*ROW, "start")
    first = shared.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last")
    later = shared.join(staged(first, "first_places"), ["h1", "h2"]).where(place != F.col("first"))
    covered = later.groupBy(*ROW).agg(F.sort_array(F.collect_set(F.struct("start", "end", known_id(*(F.col(f"first.{c}") for c in ROW)).alias("id")))).alias("at"))
    return covered.mapInArrow(per_batch(_merged), "__row_id long, __row_hash long, start int, end int, first_doc_id long")


def _merged(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Documents' intervals, in order, with those that touch made one."""
    at, out = [], []
    for i, ordered in enumerate(batch.column("at").to_pylist()):
        begun = len(out)
        for s in ordered:
            if len(out) > begun and s["start"] <= out[-1][1]:
                start, end, first = out[-1]
                out[-1] = (start, max(end, s["end"]), min((x for x in (first, s["id"]) if x is not None), default=None))
            else:
                out.append((s["start"], s["end"], s["id"]))
                at.append(i)
    index = pa.array(at, pa.int64())
    kinds = (pa.int32(), pa.int32(), pa.int64())
    values = {k: pa.array([x[j] for x in out], kind) for j, (k, kind) in enumerate(zip(("start", "end", "first_doc_id"), kinds))}
    return arrow_batch(**{c: batch.column(c).take(index) for c in ROW}, **values)


def substring_dedup(docs: DataFrame, min_sentences: int = 2, min_words: int = 24) -> DataFrame:
    """``docs`` without the passages of ``repeated_spans``; added: ``removed``, the passages' starts, ends and first_doc_id.

    A null text stays null. Sentences end at a line feed, or at a sentence mark before white space; one of more than 32
    words is taken in pieces of 12 words at most, cut where its words say so. Words are compared without case and punctuation. Texts with less than a run are left
    alone. Rows equal in doc_id and text are one document and get the same result. Input columns named like the result are
    replaced. An empty table gives an empty one.
    """
    passed = carried(docs, "removed")
    spans = repeated_spans(docs, min_sentences, min_words)
    per_row = spans.groupBy(*ROW).agg(F.sort_array(F.collect_list(F.struct("start", "end", "first_doc_id"))).alias("removed"))
    out = docs.select(boxed(passed), *_keys()).join(per_row, list(ROW), "left").select("__in.*", "removed")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("removed").to_pylist()):
            if text is not None and spans:
                starts, ends = [0, *(s["end"] for s in spans)], [*(s["start"] for s in spans), len(text)]
                text = "".join(text[a:b] for a, b in zip(starts, ends))
            kept.append(text)
        columns = {c: batch.column(c) for c in passed} | {"text": pa.array(kept, pa.string())}
        return arrow_batch(**columns, removed=batch.column("removed"))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    return out.mapInArrow(per_batch(cut), fields)
