"""Sharding by balanced label propagation: linked documents move towards the shard most of their group is in.

Spark's own functions only. Rounds work on cells, a fourth of the documents of one group that start in one shard, so a
group has four times as many rows as there are shards, however many documents it holds. What reaches the driver is one number per shard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridmart.llm.common import ROW, row_key, staged

GROUP = ("__k1", "__k2")
LAW = "rows"
#: Cells of a group in each shard it starts in: smaller ones fit where a larger one has no room.
PIECES = 4


def _facts(docs: DataFrame, shards: int, carry: tuple[str, ...]) -> DataFrame:
    """What sharding needs of each document, without its text. A document starts in the shard its hash names: its cell, modulo shards."""
    text = F.coalesce(F.col("text"), F.lit(""))
    light = docs.select(
        "doc_id",
        *carry,
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias(GROUP[0]),
        F.xxhash64(F.lit(1), text).alias(GROUP[1]),
        *row_key(),
    )
    return light.withColumn("__cell", F.pmod(F.xxhash64(F.lit(2), *ROW), F.lit(PIECES * shards)).cast("int"))


def _at(values: list[float], index: Column) -> Column:
    """Element of a list with one number per shard."""
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def _by_shard(df: DataFrame, amount: Column, shards: int) -> list[int]:
    """Sum of ``amount`` for each shard: as many numbers as shards."""
    sums = dict(df.groupBy("shard").agg(F.sum(amount)).collect())
    return [sums.get(j) or 0 for j in range(shards)]


def _draw(round_number: int, *columns: str) -> Column:
    """A number in 0 to 1 that the columns decide."""
    return F.pmod(F.xxhash64(F.lit(round_number), *columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _small(capacity: int, shards: int) -> Column:
    """Groups that move whole; there are 20 larger ones to a shard at most."""
    return F.col("total") <= max(shards, capacity // 20)


def _wanted(state: DataFrame, room: list[int], capacity: int, shards: int) -> DataFrame:
    """A group's documents by shard, and which of its shards it wants: the first ones that together have room for all of it.

    First come, for a small group, those that hold most of it, and for a large one those where it could have most.

    ``outside`` marks shards beyond as many as the group fills. A group has a row for each shard it is in, so no window
    holds more rows than there are shards.
    """
    summed = state.groupBy(*GROUP, "shard").agg(F.sum("n").alias("held"), F.first("total").alias("total"))
    open_room = _at(room, F.col("shard")).cast("long").alias("room")
    ranked = summed.select(*GROUP, "shard", "held", "total", open_room, F.xxhash64(*GROUP, "shard").alias("tie"))
    first = F.col("held") + F.when(_small(capacity, shards), F.lit(0)).otherwise(F.col("room"))
    order = W.partitionBy(*GROUP).orderBy(first.desc(), F.desc("tie"), "shard")
    fullest = W.partitionBy(*GROUP).orderBy(F.desc("held"), F.desc("tie"), "shard")
    fits = F.sum(F.col("held") + F.col("room")).over(order) - F.col("held") - F.col("room")
    placed = ranked.withColumns({"wanted": fits < F.col("total"), "outside": F.row_number().over(fullest) > F.ceil(F.col("total") / capacity)})
    before = F.sum(F.when(F.col("wanted"), F.col("room")).otherwise(0)).over(order)
    return placed.withColumns({"upto": before, "from": before - F.col("room")})


def propagate(cells: DataFrame, capacity: int, shards: int) -> DataFrame:
    """Cells (group, cell, n, total) with the shard each ends in.

    Each round tallies a group's documents by shard. A group asks for as many shards as have room for all of it:
    one, if it is small, and all that it fills at once, if it is large. Its cells elsewhere ask to move there, one after the
    other into the room of these shards. A shard accepts as many documents as it has room for; where more ask, a hash
    decides, for whole groups where they are small. Ties in a tally are broken by a hash of group and shard: cells of one
    group agree, and groups do not all favour the same shards. Rounds go on until the number of documents outside their
    group's shards, as many as it fills, has stopped falling: for two rounds, as the draw changes from one to the next.
    """
    state = staged(cells.withColumn("shard", F.col("__cell") % shards), "shard_state")
    best, best_outside, still, number = state, None, 0, 0
    while True:
        room = [max(0, capacity - load) for load in _by_shard(state, F.col("n"), shards)]
        tallies = staged(_wanted(state, room, capacity, shards), "shard_tallies")
        outside = tallies.agg(F.sum(F.when(F.col("outside"), F.col("held")))).first()[0] or 0
        if best_outside is None or outside < best_outside:
            best, best_outside, still = state, outside, 0
        else:
            still += 1
        if not outside or still == 2:
            return best
        own = state.join(tallies.select(*GROUP, "shard", "wanted"), [*GROUP, "shard"])
        movers = own.where("NOT wanted").select(*GROUP, "__cell", "n", "total")
        queue = movers.withColumn("__at", F.sum("n").over(W.partitionBy(*GROUP).orderBy("__cell")) - F.col("n"))
        places = tallies.where("wanted AND room > 0").select(*GROUP, "shard", "from", "upto")
        asking = queue.join(places, list(GROUP)).where((F.col("__at") >= F.col("from")) & (F.col("__at") < F.col("upto")))
        asking = asking.select(*GROUP, "__cell", "n", "total", "shard")
        asking = staged(asking, "shard_asking")
        if asking.isEmpty():
            return best
        # Large groups are few: 20 to a shard at most, of four cells for each shard. Their cells are taken in order while there is room.
        small = _small(capacity, shards)
        in_order = F.sum("n").over(W.partitionBy("shard").orderBy(F.desc("total"), *GROUP, "__cell"))
        large = asking.where(~small).withColumn("__sum", in_order).where(F.col("__sum") <= _at(room, F.col("shard"))).drop("__sum")
        large = staged(large, "shard_moves")
        left = [r - t for r, t in zip(room, _by_shard(large, F.col("n"), shards))]
        asked = _by_shard(asking.where(small), F.col("n"), shards)
        share = [min(1.0, r / a) if a else 0.0 for r, a in zip(left, asked)]
        accepted = asking.where(small & (_draw(number, *GROUP) < _at(share, F.col("shard")))).unionByName(large)
        moved = accepted.select(*GROUP, "__cell", F.col("shard").alias("__to"))
        joined = state.join(moved, [*GROUP, "__cell"], "left").withColumn("shard", F.coalesce("__to", "shard"))
        state, number = staged(joined.drop("__to"), "shard_state"), number + 1


def balanced_shards(docs: DataFrame, shards: int = 40, bucket_rows: int = 10_000, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the ``carry`` columns, size, text_crc32, law, shard, slot and grown_shard of each row of ``docs``.

    The law is ``rows``: shards' counts differ by one at most. Documents of equal text are linked; after propagation,
    shards with too many rows give up their last ones, unlinked documents first, to those with too few. Slots are
    numbered in buckets of about ``bucket_rows`` rows, so no task sees a whole shard.

    A null text counts as empty: 16 bytes, linked to the empty texts. Texts may have any length; ties are broken by hash. Rows may repeat, share an id or have none: each
    gets a slot of its own. More shards than rows leave some empty; an empty table gives an empty one.
    """
    facts = staged(_facts(docs, shards, tuple(carry)), "shard_facts")
    n_rows = facts.count()
    capacity = math.ceil(n_rows / shards)
    counted = facts.groupBy(*GROUP, "__cell").agg(F.count("*").alias("n"))
    cells = counted.withColumn("total", F.sum("n").over(W.partitionBy(*GROUP))).where("total > 1")
    state = propagate(cells, capacity, shards).select(*GROUP, "__cell", F.col("shard").alias("__to"))

    buckets = max(1, math.ceil(capacity / bucket_rows))
    linked = F.col("__to").isNotNull()
    placed = facts.join(state, [*GROUP, "__cell"], "left").withColumns({
        "shard": F.coalesce("__to", F.col("__cell") % shards),
        "__bucket": F.pmod(F.xxhash64(F.lit(3), *ROW), F.lit(buckets)) + F.when(linked, F.lit(0)).otherwise(F.lit(buckets)),
    })
    placed = staged(placed.drop("__to", "__cell"), "shard_placed")
    counts = placed.groupBy("shard", "__bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("__bucket")) - F.col("n")
    offsets = counts.select("shard", "__bucket", before.alias("__offset"))
    order = W.partitionBy("shard", "__bucket").orderBy(*GROUP, *ROW)
    numbered = placed.withColumn("slot", F.row_number().over(order) - 1).join(offsets, ["shard", "__bucket"])
    numbered = numbered.withColumn("slot", F.col("slot") + F.col("__offset"))

    sizes = _by_shard(placed, F.lit(1), shards)
    larger = sorted(range(shards), key=lambda j: (-sizes[j], j))[: n_rows % shards]
    target = [n_rows // shards + (j in larger) for j in range(shards)]
    # Surplus rows and free places are numbered from 0 through all shards; the k-th row takes the k-th place.
    surplus_from, free_from = [0], [0]
    for size, wanted in zip(sizes, target):
        surplus_from.append(surplus_from[-1] + max(0, size - wanted))
        free_from.append(free_from[-1] + max(0, wanted - size))
    place = _at(surplus_from, F.col("shard")) + F.col("slot") - _at(target, F.col("shard"))
    surplus = numbered.withColumn("__k", F.when(F.col("slot") >= _at(target, F.col("shard")), place).cast("long"))
    free = F.array(*[F.lit(v).cast("long") for v in free_from[1:]])
    to = F.when(F.col("__k").isNotNull(), F.size(F.filter(free, lambda end: end <= F.col("__k"))))
    settled = surplus.withColumn("__to", to)
    return settled.select(
        "doc_id",
        *carry,
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        F.coalesce("__to", "shard").cast("int").alias("shard"),
        F.coalesce(_at(sizes, F.col("__to")) + F.col("__k") - _at(free_from, F.col("__to")), "slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
