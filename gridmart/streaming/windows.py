"""Energy per fixed-size slot, with a bound on lateness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LATENESS = "2 hours"


def energy_by_slot(
    readings: DataFrame,
    instant: str,
    measures: Sequence[Column],
    keys: Sequence[str] = (),
    slot: str = "15 minutes",
    lateness: str = LATENESS,
) -> DataFrame:
    """Aggregates per key and tumbling slot. State is dropped once a slot is older than ``lateness``;
    readings later than that are in the log all the same and count at the next rebuild."""
    return (
        readings.withWatermark(instant, lateness)
        .groupBy(*keys, F.window(instant, slot).alias("slot"))
        .agg(*measures)
        .withColumns({"slot_start": F.col("slot.start"), "slot_end": F.col("slot.end")})
        .drop("slot")
    )
