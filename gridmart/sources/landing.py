"""Landed files and their ledger: what each file holds is noted once, so a load opens the files of its request alone."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.casts import as_instant, as_text, month_of_period
from gridmart.operators.parse import json_texts
from gridmart.sources import landed

LEDGER_SCHEMA = "file string, key string, first_day string, last_day string, first timestamp, last timestamp, records long"

FILE = "__file"


@dataclass(frozen=True)
class Kind:
    """How a feed's files hold their records, and the JSON keys its requests are cut by."""

    form: str  # lines, exports or sdmx
    key: str
    instant: str
    day: str | None = None
    month: bool = False  # the instant is a period YYYY-MM


# Published keys of each feed
POWER = Kind("exports", "code_insee_region", "date_heure", "date")
POWER_LINES = Kind("lines", "code_insee_region", "date_heure", "date")
INDEX = Kind("sdmx", "idbank", "time_period", month=True)
SURVEY = Kind("lines", "series_key", "time_period", month=True)


def _plain_name(name: Column) -> Column:
    """A file's path as it was given: ``_metadata`` has it with escapes."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _literal(path: str) -> str:
    """A path whose special characters do not choose other files."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


@dataclass(frozen=True)
class Landing:
    """A folder of landed files of one feed. Its ledger stands beside it and has a row for each file and key.

    A file is noted once and is not expected to change; a file that no row names is read by no request, so ``register`` runs
    after files land. A file without records is noted without a key, so it is not looked at again. Requests get the names of
    the chosen files on the driver, as any scan does.
    """

    spark: SparkSession
    path: str
    kind: Kind

    @property
    def ledger_path(self) -> str:
        return f"{self.path.rstrip('/')}__files"

    def ledger(self) -> DataFrame:
        """One row for each file and region or series: least and greatest local day (text) and instant, and records."""
        self.spark.createDataFrame([], LEDGER_SCHEMA).write.mode("ignore").parquet(self.ledger_path)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.ledger_path)

    def _records(self, files: Sequence[str]) -> DataFrame:
        """Records of some files: their payload, or the columns of an SDMX observation, and their file."""
        if not files:
            empty = self.spark.createDataFrame([], f"document string, payload string, {FILE} string")
            return landed.sdmx_records(empty, [FILE]) if self.kind.form == "sdmx" else empty.select("payload", FILE)
        whole = self.kind.form != "lines"
        texts = self.spark.read.text([_literal(f) for f in files], wholetext=whole)
        texts = texts.select("value", _plain_name(F.col("_metadata.file_path")).alias(FILE))
        if not whole:
            return texts.where("trim(value) <> ''").select(F.col("value").alias("payload"), FILE)
        documents = texts.withColumnRenamed("value", "document")
        return landed.sdmx_records(documents, [FILE]) if self.kind.form == "sdmx" else landed.export_records(documents, [FILE])

    def _fields(self, records: DataFrame) -> DataFrame:
        """file, key, day and instant of each record."""
        kind = self.kind
        names = [kind.key, kind.instant, *([kind.day] if kind.day else [])]
        if kind.form == "sdmx":
            fields = records.select(FILE, *names)
        else:
            fields = json_texts(records, names, [FILE]).toDF(FILE, *names)
        instant = month_of_period(F.col(kind.instant)).cast("timestamp") if kind.month else as_instant(F.col(kind.instant))
        day = as_text(F.col(kind.day)) if kind.day else F.lit(None).cast("string")
        return fields.select(F.col(FILE).alias("file"), F.col(kind.key).alias("key"), day.alias("day"), instant.alias("instant"))

    def register(self) -> int:
        """Note the files that the ledger does not know yet; their number. Repeated after a failure, it goes on."""
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.path)
        listed = listed.select(_plain_name(F.col("_metadata.file_path")).alias("file"))
        files = [r.file for r in listed.join(self.ledger().select("file"), "file", "left_anti").collect()]
        if not files:
            return 0
        held = self._fields(self._records(files)).groupBy("file", "key").agg(
            F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.min("instant").alias("first"),
            F.max("instant").alias("last"), F.count("*").alias("records"),
        )
        noted = self.spark.createDataFrame([(f,) for f in files], "file string").join(held, "file", "left")
        rows = noted.withColumn("records", F.coalesce("records", F.lit(0)))
        rows.select("file", "key", "first_day", "last_day", "first", "last", "records").hint("rebalance").write.mode("append").parquet(self.ledger_path)
        return len(files)

    def files(self, wanted: Column) -> list[str]:
        return sorted(r.file for r in self.ledger().where(wanted).select("file").distinct().collect())

    def _chosen(self, wanted: Column) -> DataFrame:
        return self._records(self.files(wanted)).drop(FILE)

    def of_day(self, key: str, day: date) -> DataFrame:
        """Records of all files that may hold a local day of a region; a load cuts them to the day."""
        text = F.lit(day.isoformat())
        return self._chosen((F.col("key") == key) & (F.col("first_day") <= text) & (F.col("last_day") >= text))

    def of_window(self, key: str, first: date | datetime, after: date | datetime) -> DataFrame:
        """Records of all files that may hold an instant of a half-open window."""
        return self._chosen((F.col("key") == key) & self._meets(first, after))

    def of_series(self, keys: Sequence[str], start: str | None = None, end: str | None = None) -> DataFrame:
        """Records of all files that may hold months of some series, both bounds included."""
        bounds = [F.col("last") >= F.lit(f"{start}-01").cast("timestamp")] if start else []
        bounds += [F.col("first") <= F.lit(f"{end}-01").cast("timestamp")] if end else []
        return self._chosen(reduce(Column.__and__, bounds, F.col("key").isin(*keys)))

    def _meets(self, first: date | datetime, after: date | datetime) -> Column:
        lower, upper = (F.lit(bound.isoformat()).cast("timestamp") for bound in (first, after))
        return (F.col("last") >= lower) & (F.col("first") < upper)
