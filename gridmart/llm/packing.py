"""Packing by powers of two: a document's tokens are cut into pieces of binary lengths, and each piece is a sequence.

No sequence crosses documents and none needs padding. Equal lengths are numbered one after the other, so a trainer can
take batches of one length. Numbers come from counts by file and length, not from a sort of the corpus.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from gridmart.llm.common import arrow_batch, staged

#: Fixed value: how byte-level BPE vocabularies of this kind split a text before merging.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of a task's memory of words; it is emptied when full.
MEMORY = 200_000


def _byte_characters() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte, to the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder(dict):
    """Token ids of texts under a byte-level BPE file, as little-endian 32-bit bytes.

    The merges run in a faster library that is built from the same file; texts that spell a special token go through
    the file's own library, which gives those ids of their own. A space between two characters that are not white space
    always starts a new unit, so units are remembered by what stands between such spaces; any other text is encoded whole.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        byte = _byte_characters()
        vocabulary = {k: v for k, v in spec["model"]["vocab"].items() if k not in self.special}
        ranks = {bytes(byte[c] for c in token): rank for token, rank in vocabulary.items()}
        self.merges = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.path, self.exact = path, None

    def _bytes(self, text: str) -> bytes:
        return np.array(self.merges.encode_ordinary(text), "<u4").tobytes()

    def __missing__(self, unit: str) -> bytes | None:
        if len(self) >= MEMORY:
            self.clear()
        safe = unit and not unit[0].isspace() and not unit[-1].isspace()
        self[unit] = known = self._bytes(" " + unit) if safe else None
        return known

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            self.exact = self.exact or Tokenizer.from_file(self.path)
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *units = text.split(" ")
        if not units or not first or first[0].isspace() or first[-1].isspace():
            return self._bytes(text)
        try:
            return self._bytes(first) + b"".join(map(self.__getitem__, units))
        except TypeError:  # a unit with white space at its edge
            return self._bytes(text)


def binary_pieces(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: as many of ``longest`` as fit, then falling powers of two."""
    out, at = [], 0
    while n - at >= longest:
        out.append((at, longest))
        at += longest
    while at < n:
        length = 1 << ((n - at).bit_length() - 1)
        out.append((at, length))
        at += length
    return out


def pieces(docs: DataFrame, tokenizer: str, longest: int, end_id: int, tokens: bool) -> DataFrame:
    """doc_id, start, length, doc_tokens and ids_crc32 of each piece, longest first in each task, and its ``tokens`` if asked for."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"longest: a power of two, not {longest}")
    last = np.array([end_id], "<u4").tobytes()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            at, start, length, total, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                data = encoder.encode(text or "") + last
                n = len(data) // 4
                for s, k in binary_pieces(n, longest):
                    piece = data[4 * s : 4 * (s + k)]
                    at.append(i)
                    start.append(s)
                    length.append(k)
                    total.append(n)
                    crc.append(zlib.crc32(piece))
                    if tokens:
                        ids.append(piece)
            columns = {k: pa.array(v, pa.int64()) for k, v in (("start", start), ("length", length), ("doc_tokens", total), ("ids_crc32", crc))}
            more = {"tokens": pa.array(ids, pa.binary())} if tokens else {}
            yield arrow_batch(doc_id=batch.column("doc_id").take(pa.array(at, pa.int64())), **columns, **more)

    schema = f"doc_id {kind}, start long, length long, doc_tokens long, ids_crc32 long" + ", tokens binary" * tokens
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer: str, longest: int = 2048, end_id: int = 1, tokens: bool = True) -> DataFrame:
    """A row for each sequence: its document's piece, sequence_id and offset.

    Columns: doc_id, start, length, doc_tokens (with the closing ``end_id``), ids_crc32, tokens (little-endian unsigned
    32-bit ids; left out with ``tokens=False``), sequence_id and offset (0, as a sequence is one piece). Ids run from 0
    through the sequences of the longest length, then those of the next.

    A null text counts as empty and gives one sequence that holds ``end_id`` alone. Each row is a document of its own,
    also if its id is null or shared or the whole row is repeated. A text of any length is cut whole. Other columns are not
    read. An empty table gives an empty one.
    """
    cut = pieces(docs, tokenizer, longest, end_id, tokens).sortWithinPartitions(F.desc("length"))
    written = staged(cut, "pieces").select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    counts = written.groupBy("length", "__file").agg(F.count("*").alias("n"), F.min("__row").alias("__first"))
    # One row for each file and length: few, so one task can add them up.
    before = F.sum("n").over(W.orderBy(F.desc("length"), "__file")) - F.col("n")
    starts = counts.select("length", "__file", (before - F.col("__first")).alias("__shift"))
    numbered = written.join(starts, ["length", "__file"])
    columns = ["doc_id", "start", "length", "doc_tokens", "ids_crc32", *["tokens"] * tokens]
    return numbered.select(*columns, (F.col("__row") + F.col("__shift")).cast(T.LongType()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
