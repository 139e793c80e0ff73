"""SimHash near-duplicates: an inverted index on bytes and their positions, with count filtering.

Two fingerprints of 64 bits that differ in ``max_bits`` bits agree in at least ``8 - max_bits`` of their eight bytes: the
guaranteed minimum of matches. A posting list holds the fingerprints that have the same bytes at some positions. The
more fingerprints there are, the more positions a list fixes, so that lists stay short: whoever shares enough bytes
shares the list of its first shared positions. In a list, the shared positional bytes of every two fingerprints are
tallied as arrays; pairs that reach the minimum are verified bit by bit. No pair leaves a task, only a forest.

A first pass over lists that fix seven bytes (256 fingerprints at most) joins dense groups of near copies; the second
one passes over lists, and pairs, that are one group by then.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import arrow_batch, per_batch, staged, texts
from gridmart.llm.components import components

#: Fixed value: the seed of the shingles' XXH64.
SEED = 42
BYTES = 8
#: Members that a posting list may have on average, and that one block of a long list holds on average.
LIST_MEMBERS = 16
BLOCK_MEMBERS = 4096
_CHUNK = 1 << 16


def fingerprint(text: bytes, n: int = 4) -> int:
    """SimHash of a UTF-8 text: a bit is 1 if it is set in over half of the hashes of its ``n``-word shingles, repeats included.

    Words are runs of other than ASCII white space, A-Z lower-cased. Fewer than ``n`` words are one shingle; no word
    gives zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = min(n, len(words))
    first, last = starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(first), _CHUNK):
        spans = zip(first[at : at + _CHUNK], last[at : at + _CHUNK])
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(first), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, n: int = 4) -> DataFrame:
    """(doc_id, fp) of each row; ``fp`` holds the 64 bits as a signed number."""

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        signed = np.array([fingerprint(text, n) for text in texts(batch)], np.uint64).view(np.int64)
        return arrow_batch(doc_id=batch.column("doc_id"), fp=signed)

    chosen = docs.select("doc_id", "text")
    return chosen.mapInArrow(per_batch(sign), f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, fp long")


def first_positions(depth: int, least: int) -> list[tuple[int, ...]]:
    """The byte positions that can be the first ``depth`` of ``least`` shared ones or more."""
    return [at for at in itertools.combinations(range(BYTES), depth) if all(p <= BYTES - least + i for i, p in enumerate(at))]


def _list_of(positions: list[tuple[int, ...]], least: int) -> np.ndarray:
    """For each set of shared positions, as bits: the number of the list a pair belongs to, -1 below ``least`` matches."""
    number = {at: i for i, at in enumerate(positions)}
    depth = len(positions[0])
    shared = [tuple(p for p in range(BYTES) if mask >> p & 1) for mask in range(1 << BYTES)]
    return np.array([number[at[:depth]] if len(at) >= least else -1 for at in shared], np.int64)


class _Forest:
    """Edges, fewer than nodes, that join what all edges given so far join."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up.setdefault(y, y)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _tally(positions: list[tuple[int, ...]], least: int, max_bits: int):
    """Links between labels in whole posting lists that come one after the other."""
    belongs = _list_of(positions, least)
    place = (1 << np.arange(BYTES)).astype(np.int64)

    def links(rows: dict[str, np.ndarray], first: np.ndarray) -> Iterator[pa.RecordBatch]:
        size = len(first)
        ends = np.append(np.flatnonzero(first)[1:], size)[np.cumsum(first) - 1]
        i, step, forest, out = np.arange(size), 1, _Forest(), []
        fp, label, own, minor = (rows[c] for c in ("fp", "label", "own", "minor"))
        while len(i := i[i + step < ends[i]]):
            j = i + step
            step += 1
            # Members that are replicated to all blocks of a list meet in the first one's own block.
            meet = (label[i] != label[j]) & ~(minor[i] & minor[j] & (own[i] != rows["block"][i]))
            a, b = i[meet], j[meet]
            if not len(a):
                continue
            apart = fp[a] ^ fp[b]
            shared = (apart.view(np.uint8).reshape(-1, BYTES) == 0) @ place
            kept = np.flatnonzero(belongs[shared] == rows["positions"][a])
            kept = kept[np.bitwise_count(apart[kept].view(np.uint64)) <= max_bits]
            for x, y in np.unique(np.stack([label[a[kept]], label[b[kept]]], axis=1), axis=0).tolist():
                if forest.join(x, y):
                    out.append((x, y))
        if out:
            edges = np.array(out, np.int64)
            yield arrow_batch(a=np.ascontiguousarray(edges[:, 0]), b=np.ascontiguousarray(edges[:, 1]))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("positions", "masked", "block", "fp", "label", "own", "minor")
        held: list[dict[str, np.ndarray]] = []

        def whole() -> tuple[dict[str, np.ndarray], np.ndarray]:
            rows = {c: np.concatenate([h[c] for h in held]) for c in names}
            first = np.ones(len(rows["fp"]), bool)
            first[1:] = np.any([rows[c][1:] != rows[c][:-1] for c in names[:3]], axis=0)
            return rows, first

        for batch in batches:
            held.append({c: batch.column(c).to_numpy(zero_copy_only=False) for c in names})
            if sum(len(h["fp"]) for h in held) < _CHUNK:
                continue
            rows, first = whole()
            cut = int(np.flatnonzero(first)[-1])
            if cut:
                yield from links({c: x[:cut] for c, x in rows.items()}, first[:cut])
            held = [{c: x[cut:] for c, x in rows.items()}]
        if held and len(held[0]["fp"]):
            yield from links(*whole())

    return stream


def _signed(positions: tuple[int, ...]) -> int:
    mask = sum(255 << 8 * p for p in positions)
    return mask - (1 << 64) if mask >> 63 else mask


def links(nodes: DataFrame, depth: int, least: int, max_bits: int, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """Edges (a, b) between the labels of ``nodes`` (fp, label): a forest per task, of pairs that share ``least`` bytes or more.

    A list of one label has nothing to find and is left out. A long list is cut into blocks: members of its most
    frequent label stand in one block each, all others in every block, so a large group that is joined already is
    compared with what is new, not with itself.
    """
    positions = first_positions(depth, least)
    masks = F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(at))) for at in positions])
    postings = nodes.select("fp", "label", F.posexplode(masks).alias("positions", "masked"))
    key = ["positions", "masked"]
    lists = postings.groupBy(*key).agg(F.count("*").alias("members"), F.min("label").alias("low"), F.max("label").alias("high"))
    lists = staged(lists.where("low <> high").select(*key, F.ceil(F.col("members") / block_members).cast("int").alias("blocks")), "posting_lists")
    met = staged(postings.join(lists, key), "postings")
    long = met.where("blocks > 1").groupBy(*key, "label").agg(F.count("*").alias("n"))
    major = staged(long.groupBy(*key).agg(F.max_by("label", F.struct("n", "label")).alias("major")), "long_lists")
    own = F.pmod(F.xxhash64("fp"), "blocks").cast("int").alias("own")
    parts = met.where("blocks > 1").join(major, key).select("*", own, (F.col("label") != F.col("major")).alias("minor"))
    everywhere = F.when(F.col("minor"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("own"))
    columns = [*key, "fp", "label", "own", "minor", "block"]
    parts = parts.withColumn("block", F.explode(everywhere)).select(*columns)
    short = met.where("blocks = 1").withColumns({"own": F.lit(0), "minor": F.lit(True), "block": F.lit(0)}).select(*columns)
    placed = short.unionByName(parts).repartition(*key, "block").sortWithinPartitions(*key, "block", "fp")
    return placed.mapInArrow(_tally(positions, least, max_bits), "a long, b long")


def index_depth(n: int, least: int) -> int:
    """Positions that a list fixes, so that ``n`` fingerprints make lists of ``LIST_MEMBERS`` on average."""
    depth = 1
    while depth < least and n > LIST_MEMBERS * 256**depth:
        depth += 1
    return depth


def simhash_components(docs: DataFrame, n: int = 4, max_bits: int = 4, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """A row for each row of ``docs``: doc_id, fp (64 bits as a signed number), component_id.

    Fingerprints that differ in ``max_bits`` bits or fewer (0 to 7) are linked; component_id is the smallest doc_id that
    links reach, the row's own included. ``fingerprint`` states how texts become bits.

    Null, empty and wordless texts have fingerprint zero, and are linked like any other. A text may have any length and
    is read whole. Repeated rows give repeated results; equal fingerprints are compared once. A null doc_id stays null
    and is never a component_id, unless all of its component are null. Other columns are not read. An empty table gives
    an empty one.
    """
    if not 0 <= max_bits < BYTES:
        raise ValueError(f"max_bits: 0 to {BYTES - 1}, not {max_bits}")
    least = BYTES - max_bits
    signed = staged(fingerprints(docs, n), "fingerprints")
    nodes = staged(signed.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fingerprint_nodes")
    labelled = nodes.select("fp", F.col("fp").alias("label"))
    if max_bits:
        for need in dict.fromkeys((max(least, BYTES - 1), least)):
            depth = need if need == BYTES - 1 else index_depth(nodes.count(), need)
            joined = components(staged(links(labelled, depth, need, max_bits, block_members), "simhash_links"))
            moved = joined.select(F.col("node").alias("label"), F.col("label").alias("to"))
            told = labelled.join(moved, "label", "left").select("fp", F.coalesce("to", "label").alias("label"))
            labelled = staged(told, "simhash_labels")
    known = nodes.join(labelled, "fp")
    chosen = known.groupBy("label").agg(F.min("least_id").alias("component_id"))
    told = staged(known.join(chosen, "label").select("fp", "component_id"), "simhash_components")
    return signed.join(told, "fp").select("doc_id", "fp", "component_id")
