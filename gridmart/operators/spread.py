"""Exact median by counting."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.sources.tables import stager

#: Parts an interval is cut into in a round.
BINS = 256


def _bin(value: Column, low: Column, high: Column) -> Column:
    """Part of the interval that a value is in. The ends have parts of their own, so an interval of two values is cut in any case."""
    share = (value / 2 - low / 2) / F.nullif(high / 2 - low / 2, F.lit(0.0))
    inner = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * (BINS - 1)), F.lit(BINS - 2))
    return F.when(value == low, 0).when(value == high, BINS - 1).otherwise(inner).cast("int")


def _holding(bins: Column, rank: Column) -> Column:
    """Of the parts in order (_bin, _n, _low, _high): the one that holds a rank, and the rank within it."""
    kind = "struct<rank: bigint, low: double, high: double>"
    nothing = F.lit(None).cast("double")

    def state(at: Column, low: Column, high: Column) -> Column:
        return F.struct(at.alias("rank"), low.alias("low"), high.alias("high")).cast(kind)

    def step(found: Column, part: Column) -> Column:
        here = F.when(found["rank"] <= part["_n"], state(found["rank"], part["_low"], part["_high"]))
        return F.when(found["low"].isNotNull(), found).otherwise(here.otherwise(state(found["rank"] - part["_n"], nothing, nothing)))

    return F.aggregate(bins, state(rank, nothing, nothing), step)


def exact_median(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Median of ``value`` by ``keys``; NULLs, NaN and infinite values are ignored.

    Rows are reduced to counts of equal values, combined before the shuffle. Then the values of the two middle ranks are
    searched by counting: a round cuts the interval that holds a rank into 256 parts, counts the rows of each, again
    combined before the shuffle, and goes on with the least and greatest value of one part, until they are the same.
    Nothing is sorted, and no task holds more than the 256 counts of a rank. ``stage`` writes the counts and each round's
    intervals, two rows for each key.
    """
    stage = stage or stager(df.sparkSession, "median")
    group = [*keys, "_all"]
    usable = F.abs(F.col(value)) < float("inf")
    rows = df.where(usable).select(*keys, F.lit(0).alias("_all"), F.col(value).cast("double").alias("_value"))
    counts = stage(rows.groupBy(*group, "_value").agg(F.count("*").alias("_rows")))
    ranks = F.array(F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2))
    whole = counts.groupBy(*group).agg(F.sum("_rows").alias("_n"), F.min("_value").alias("_low"), F.max("_value").alias("_high"))
    found = stage(whole.select(*group, "_low", "_high", F.posexplode(ranks).alias("_middle", "_rank")))
    while not (wide := found.where("_low < _high")).isEmpty():
        same = [F.col(f"c.{key}").eqNullSafe(F.col(f"t.{key}")) for key in group]
        inside = [F.col("_value") >= F.col("_low"), F.col("_value") <= F.col("_high")]
        met = counts.alias("c").join(wide.alias("t"), [*same, *inside])
        part = _bin(F.col("_value"), F.col("_low"), F.col("_high")).alias("_bin")
        placed = met.select(*[F.col(f"t.{key}").alias(key) for key in group], "_middle", "_rank", part, "_value", "_rows")
        target = [*group, "_middle", "_rank"]
        counted = placed.groupBy(*target, "_bin").agg(F.sum("_rows").alias("_n"), F.min("_value").alias("_low"), F.max("_value").alias("_high"))
        bins = counted.groupBy(*target).agg(F.array_sort(F.collect_list(F.struct("_bin", "_n", "_low", "_high"))).alias("_bins"))
        held = bins.select(*group, "_middle", _holding(F.col("_bins"), F.col("_rank")).alias("_at"))
        narrowed = held.select(*group, "_middle", F.col("_at.rank").alias("_rank"), F.col("_at.low").alias("_low"), F.col("_at.high").alias("_high"))
        found = stage(narrowed.unionByName(found.where("_low = _high")))
    return found.groupBy(*group).agg((F.sum("_low") / 2).alias("median")).drop("_all")
