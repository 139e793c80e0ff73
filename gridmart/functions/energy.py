"""Power, energy, shares and relative changes."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmart import feeds


def slot_minutes(dataset: Column) -> Column:
    """Length of a slot: 15 minutes in the real-time dataset, 30 in any other (also when unknown)."""
    return F.when(dataset == feeds.DATASET_REALTIME, feeds.REALTIME_MINUTES).otherwise(feeds.CONSOLIDATED_MINUTES)


def energy_of_slot(power: Column, minutes: Column) -> Column:
    """Energy (MWh) of a power (MW) held for some minutes, as an exact decimal; no power of 32 bits overflows on the way."""
    return ((power.cast("bigint") * minutes).cast("decimal(12,0)") / F.lit(Decimal("60.0"))).cast("decimal(17,6)")


def energy_of_sum(power: Column, slot_hours: str = "0.5") -> Column:
    """Energy of the summed power of equal slots; NULL when no slot of the group has a value."""
    return F.sum(power) * F.lit(Decimal(slot_hours))


def zero_filled_sum(*columns: Column) -> Column:
    """Row total in which a missing member counts as zero."""
    return reduce(add, [F.coalesce(c, F.lit(0)) for c in columns])


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, NULL when ``whole`` is zero; not rounded."""
    return part / F.nullif(whole, F.lit(0)) * 100


def percent_change(value: Column, before: Column) -> Column:
    """Change from ``before`` in percent, rounded to 2 digits, NULL when ``before`` is zero."""
    return F.round(percent_of(value - before, before), 2)


def version_rank(level: Column, best_first: tuple[str, ...]) -> Column:
    """1 for the best level, 2 for the next...; unknown and NULL levels share the last rank."""
    rank = F.when(level == best_first[0], 1)
    for position, name in enumerate(best_first[1:], start=2):
        rank = rank.when(level == name, position)
    return rank.otherwise(len(best_first) + 1)
