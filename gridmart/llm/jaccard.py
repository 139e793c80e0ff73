"""N-gram Jaccard join: banded min-hashes find pairs, full n-gram sets verify them, and rows stay linear in the input.

Texts with the same n-gram set are one node, however many copies there are. Buckets hold nodes by band key; a bucket of
many nodes is cut into blocks, and each pair of blocks is a task's work. A task compares all pairs it holds as arrays and
returns no pairs, only a forest that joins its nodes and a count for each. Sketches choose the sets that must meet, so a
full set travels once, to its cluster of likely partners (or to each of the cluster's blocks).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import ROW, arrow_batch, per_batch, row_key, rows, staged, texts, with_row
from gridmart.llm.components import components
from gridmart.llm.shingles import MinHash, choose_bands, ngram_hashes, words_of

#: Nodes, and n-gram hashes, that one block of a bucket or cluster holds on average.
BLOCK_NODES = 256
BLOCK_HASHES = 1 << 20

_SKETCHES = "__row_id long, __row_hash long, node binary, keys array<long>, sketch binary"
_EDGES = "a binary, b binary"
_VERIFIED = "a binary, b binary, links long"


def _node(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def sketches(docs: DataFrame, n: int, minhash: MinHash) -> DataFrame:
    """Row key, node (hash of the n-gram set), band keys and sketch of each document that has a word."""

    def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
        nodes, minima, filled = [], [], []
        for i, text in enumerate(texts(batch)):
            hashes = np.unique(ngram_hashes(words_of(text), n))
            if len(hashes):
                filled.append(i)
                nodes.append(_node(hashes))
                minima.append(minhash.minima(hashes))
        drawn = np.array(minima, np.uint64).reshape(len(filled), minhash.bands * minhash.rows)
        keys = minhash.band_keys(drawn)
        low = drawn.astype(np.uint8)
        row_id, row_hash = (x[filled] for x in rows(batch))
        offsets = np.arange(len(filled) + 1, dtype=np.int32) * minhash.bands
        return arrow_batch(
            __row_id=row_id, __row_hash=row_hash, node=pa.array(nodes, pa.binary()),
            keys=pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1))), sketch=pa.array([x.tobytes() for x in low], pa.binary()),
        )

    return docs.select(*row_key(), "text").mapInArrow(per_batch(sketch), _SKETCHES)


def _blocks(members: DataFrame, key: str, weight: Column) -> DataFrame:
    """``members`` once for each pair of blocks they belong to: columns own, x and y, with x <= y.

    ``weight`` is the number of blocks the members of a key ask for, together.
    """
    sizes = members.groupBy(key).agg(F.ceil(weight).cast("int").alias("__blocks"))
    own = F.when(F.col("__blocks") > 1, F.pmod(F.xxhash64("node"), F.col("__blocks"))).otherwise(0).cast("int")
    placed = members.join(sizes, key).withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
    paired = placed.withColumn("__other", other).drop("__blocks")
    x, y = F.least("own", "__other").alias("x"), F.greatest("own", "__other").alias("y")
    return paired.select("*", x, y).drop("__other")


def _by_group(blocks: DataFrame, key: str, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on each group (key, x, y): groups are streamed in order, and only one is held at a time."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in (key, "x", "y")]
            changed = np.zeros(batch.num_rows, bool)
            for c in columns:
                changed[1:] |= c[1:] != c[:-1]
            first = tuple(c[0] for c in columns)
            if last is not None and first != last:
                yield from work(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held = []
            starts = [0, *np.flatnonzero(changed)]
            for a, b in zip(starts, starts[1:]):
                yield from work(pa.Table.from_batches([*held, batch.slice(a, b - a)]).combine_chunks().to_batches()[0] if held else batch.slice(a, b - a))
                held = []
            held.append(batch.slice(starts[-1]))
            last = tuple(c[-1] for c in columns)
        if held:
            yield from work(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return blocks.repartition(key, "x", "y").sortWithinPartitions(key, "x", "y", "node").mapInArrow(stream, schema)


def _meeting(batch: pa.RecordBatch) -> np.ndarray:
    """Which pairs of a group are its own: those between its two blocks, each pair once."""
    own = batch.column("own").to_numpy()
    x, y = batch.column("x")[0].as_py(), batch.column("y")[0].as_py()
    pairs = np.triu(np.ones((len(own), len(own)), bool), 1)
    if x != y:
        pairs &= own[:, None] != own[None, :]
    return pairs


def _forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """Edges, fewer than nodes, that join what the pairs join; from the first nodes outward, so that groups that share nodes share edges."""
    linked = pairs | pairs.T
    seen, out = np.zeros(len(pairs), bool), []
    for root in np.flatnonzero(linked.any(axis=1)):
        if seen[root]:
            continue
        seen[root], todo = True, [int(root)]
        while todo:
            i = todo.pop()
            for j in np.flatnonzero(linked[i] & ~seen).tolist():
                seen[j] = True
                out.append((i, j))
                todo.append(j)
    return out


def _likely(least: float):
    """Edges among a bucket's nodes whose sketches agree in a share ``least`` of their bytes or more."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if batch.num_rows < 2:
            return
        nodes = batch.column("node").to_pylist()
        drawn = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(len(nodes), -1)
        alike = np.zeros((len(nodes), len(nodes)), bool)
        for i in range(len(nodes) - 1):
            alike[i, i + 1 :] = (drawn[i + 1 :] == drawn[i]).mean(axis=1) >= least
        edges = _forest(alike & _meeting(batch))
        if edges:
            yield arrow_batch(a=pa.array([nodes[i] for i, _ in edges], pa.binary()), b=pa.array([nodes[j] for _, j in edges], pa.binary()))

    return work


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of every two sorted sets, by products of membership matrices, some columns at a time."""
    sizes = [len(s) for s in sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times > 1
    column, owner = (np.cumsum(common) - 1)[column[common[column]]], owner[common[column]]
    shared = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for low in range(0, int(common.sum()), 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        member = np.zeros((len(sets), min(4096, int(common.sum()) - low)), np.float32)
        member[owner[a:b], column[a:b] - low] = 1
        shared += member @ member.T
    return shared.astype(np.int64)


def _verified(threshold: Fraction):
    """A group's forest of true links, and how many documents each of its nodes is linked to; rows with a null b carry the counts."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if batch.num_rows < 2:
            return
        nodes = batch.column("node").to_pylist()
        sets = [np.frombuffer(s, np.uint64) for s in batch.column("hashes").to_pylist()]
        size = np.array([len(s) for s in sets])
        up, down = threshold.numerator, threshold.denominator
        alike = (up + down) * shared_counts(sets) >= up * (size[:, None] + size[None, :])
        pairs = alike & _meeting(batch)
        copies = batch.column("copies").to_numpy()
        links = (pairs | pairs.T) @ copies
        edges, counted = _forest(pairs), np.flatnonzero(links).tolist()
        if counted:
            yield arrow_batch(
                a=pa.array([nodes[i] for i, _ in edges] + [nodes[i] for i in counted], pa.binary()),
                b=pa.array([nodes[j] for _, j in edges] + [None] * len(counted), pa.binary()),
                links=pa.array([0] * len(edges) + links[counted].tolist(), pa.int64()),
            )

    return work


def similar_documents(docs: DataFrame, n: int = 5, threshold: Fraction = Fraction(4, 5), recall: float = 0.999, rows_per_band: int = 6) -> DataFrame:
    """A row for each distinct (doc_id, text) of ``docs``: its class and its number of links.

    Columns: doc_id, class_id (smallest doc_id of the class), n_links (other rows whose set of ``n`` consecutive words
    has a Jaccard similarity of ``threshold`` or more, copies included), n_copies (rows with the same set, itself
    included), is_first (one document of each class) and the row key. A class is what links join. Words are runs of
    letters and digits, A-Z lower-cased; a text of fewer than ``n`` words is one n-gram. Bands are as many as find a pair at
    the threshold with probability ``recall``; sketches rule out a pair five standard deviations below it.

    Null, empty and wordless texts have no n-grams: each is alone, with n_copies 1. Repeated rows (same id, same text)
    are copies of one row. Ties in doc_id are broken by text hash; a null doc_id sorts as 0 and stays null. Other
    columns are not read. An empty table gives an empty one.
    """
    minhash = MinHash(choose_bands(float(threshold), recall, rows_per_band), rows_per_band)
    least = float(threshold) - 5 * (float(threshold * (1 - threshold)) / (minhash.bands * rows_per_band)) ** 0.5
    drawn = staged(sketches(docs, n, minhash), "sketches")

    keyed = drawn.select("node", F.explode("keys").alias("key"))
    first = F.xxhash64("node")
    shared = keyed.groupBy("key").agg(F.min(first).alias("a"), F.max(first).alias("b")).where("a <> b").select("key")
    # The keys are written, so that the join shuffles both sides, and a hot key's rows can be split.
    members = staged(keyed.join(staged(shared, "shared_keys"), "key", "left_semi").distinct(), "bucket_members")
    sketch = drawn.join(members.select("node").distinct(), "node", "left_semi").select("node", "sketch").dropDuplicates(["node"])
    buckets = _blocks(members, "key", F.count("*") / BLOCK_NODES).join(sketch, "node")
    likely = components(staged(_by_group(buckets, "key", _likely(least), _EDGES), "likely_edges"))

    clusters = staged(likely, "clusters")
    copies = drawn.groupBy("node").agg(F.count("*").alias("copies"), F.min(F.struct(*ROW)).alias("row"))
    wanted = clusters.join(copies, "node").select("node", F.col("label").alias("cluster"), "copies", "row.*")

    def full(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [np.unique(ngram_hashes(words_of(text), n)) for text in texts(batch)]
        return arrow_batch(
            node=batch.column("node"), cluster=batch.column("cluster"), copies=batch.column("copies"),
            n=pa.array([len(s) for s in sets], pa.int64()), hashes=pa.array([s.tobytes() for s in sets], pa.binary()),
        )

    read = docs.select(*row_key(), "text").join(wanted, list(ROW)).select("node", "cluster", "copies", "text")
    sets = read.mapInArrow(per_batch(full), "node binary, cluster binary, copies long, n long, hashes binary")
    sets = staged(sets.dropDuplicates(["node"]), "ngram_sets")
    weight = F.greatest(F.count("*") / BLOCK_NODES, F.sum("n") / BLOCK_HASHES)
    blocks = _blocks(sets.select("node", "cluster", "n"), "cluster", weight).drop("n").join(sets.select("node", "copies", "hashes"), "node")
    verified = staged(_by_group(blocks, "cluster", _verified(threshold), _VERIFIED), "verified")

    classes = components(verified.where("b IS NOT NULL"))
    links = verified.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    linked = classes.join(links, F.col("node") == F.col("a")).select("node", "label", "links")
    groups = drawn.groupBy("node", *ROW).agg(F.count("*").alias("repeats"))
    return _rows(docs, groups, linked)


def first_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` for each class of ``similar_documents``: that of the smallest doc_id, repeated rows once."""
    firsts = similar_documents(docs, **options).where("is_first").select(*ROW)
    return with_row(docs, docs.columns).join(firsts, list(ROW), "left_semi").dropDuplicates(list(ROW)).select("__in.*")


def _rows(docs: DataFrame, groups: DataFrame, linked: DataFrame) -> DataFrame:
    """Nodes' classes and links brought back to documents."""
    nodes = groups.groupBy("node").agg(F.sum("repeats").alias("n_copies"), F.min(F.struct(*ROW)).alias("least"))
    known = nodes.join(linked, "node", "left").withColumns({"label": F.coalesce("label", "node"), "links": F.coalesce("links", F.lit(0))})
    known = staged(known, "nodes")
    chosen = known.groupBy("label").agg(F.min("least").alias("chosen"))
    told = known.join(chosen, "label").select("node", "n_copies", (F.col("links") + F.col("n_copies") - 1).alias("n_links"), "chosen")
    per_row = groups.select("node", *ROW).join(told, "node").drop("node")
    distinct = docs.select("doc_id", *row_key()).distinct()
    own = F.struct(*ROW)
    joined = distinct.join(per_row, list(ROW), "left").withColumn("chosen", F.coalesce("chosen", own))
    return joined.select(
        "doc_id",
        F.when(F.col("doc_id").isNull() & (F.col("chosen") == own), F.lit(None)).otherwise(F.col(f"chosen.{ROW[0]}")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        (F.col("chosen") == own).alias("is_first"),
        *ROW,
    )
