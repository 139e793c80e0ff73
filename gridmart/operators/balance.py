"""What a version choice takes in and gives out, counted while a table is written."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

LEDGER_SCHEMA = (
    "table_name string, rows_in long, rows_out long, rows_lost long, newest_in long, newest_out long, "
    "total_in decimal(38,6), total_out decimal(38,6), balanced boolean"
)


@dataclass
class Balance:
    """Counts around the version choice of one table.

    A row may only lose to a newer load, or to a more consolidated one. So every row of the newest load (at its best level,
    ``top``) has to come out again, and with it the total of ``measure``: a key that lacks a column makes rows of one load
    compete, and some are lost although the key of what is left is unique.
    """

    table: str
    measure: str
    newest: datetime | None
    top: Column | None = None
    _sides: dict[str, Observation] = field(default_factory=dict)

    def _counted(self, df: DataFrame, side: str) -> DataFrame:
        own = F.lit(False) if self.newest is None else F.col("ingested_at") == F.lit(self.newest)
        if self.top is not None:
            own &= self.top
        seen = self._sides[side] = Observation()
        total = F.sum(F.when(own, F.col(self.measure)).cast("decimal(28,6)"))
        return df.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(own).alias("newest"), total.alias("total"))

    def taken_in(self, versions: DataFrame) -> DataFrame:
        return self._counted(versions, "in")

    def given_out(self, rows: DataFrame) -> DataFrame:
        return self._counted(rows, "out")

    def row(self) -> tuple:
        """The ledger's row, once the table is written. A side without rows may have no counts: its plan was left out."""
        counts = [self._sides[side].get or {} for side in ("in", "out")]
        (n_in, own_in, total_in), (n_out, own_out, total_out) = (
            (c.get("n") or 0, c.get("newest") or 0, Decimal(c.get("total") or 0)) for c in counts
        )
        balanced = own_in == own_out and total_in == total_out
        return self.table, n_in, n_out, n_in - n_out, own_in, own_out, total_in, total_out, balanced
