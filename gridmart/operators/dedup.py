"""One version per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which every one of the columns has a value; for stored columns the scan does it."""
    return df.where(reduce(and_, [F.col(column).isNotNull() for column in columns]))


def best_version(df: DataFrame, keys: Sequence[str | Column], best_first: Sequence[Column]) -> DataFrame:
    """Row of each key that sorts first; NULL key members are equal to each other.

    Rows that must not compete (no key, no measure) have to be filtered out before, and conditions
    that must not change the winner applied after. End the order with a column that tells versions of
    one load apart, otherwise the winner among them is arbitrary.

    Catalyst limits each task to one row per key before the shuffle (``WindowGroupLimit``), so a key
    with many versions costs at most one row per task, not one large group.
    """
    window = Window.partitionBy(*keys).orderBy(*best_first)
    return df.withColumn("_position", F.row_number().over(window)).where("_position = 1").drop("_position")
