"""Bronze: the append-only log of raw records, one contract for every feed."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.session import PACKED


def _column(name: str, kind: T.DataType, comment: str) -> T.StructField:
    return T.StructField(name, kind, metadata={"comment": comment})


BRONZE_SCHEMA = T.StructType(
    [
        _column("source_dataset", T.StringType(), "Dataset the record was published in"),
        _column("extracted_for", T.StringType(), "Day, year or period that was requested"),
        _column("payload", T.StringType(), "Record as published, JSON text"),
        _column("ingested_at", T.TimestampType(), "UTC time of the load"),
    ]
)
BRONZE_COLUMNS = tuple(BRONZE_SCHEMA.names)

# Folders of the stored log: dataset, then day of the load
FOLDERS = ("source_dataset", "ingest_day")
# Ending of the folder of a log's ledger of loads
LEDGER = "__loads"
STORED_SCHEMA = T.StructType([*BRONZE_SCHEMA.fields, _column("ingest_day", T.DateType(), "Day of the load")])


def stored(records: DataFrame) -> DataFrame:
    """Bronze records with the folder column of the stored log."""
    return records.select(*BRONZE_COLUMNS, F.to_date("ingested_at").alias("ingest_day"))


def record_json(records: DataFrame) -> Column:
    """JSON object of all columns: NULLs are kept, times are written in full."""
    texts = [
        F.col(f"`{f.name}`").cast("string").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
        else F.col(f"`{f.name}`")
        for f in records.schema.fields
    ]
    return F.to_json(F.struct(*texts), {"ignoreNullFields": "false"})


def envelope(
    records: DataFrame,
    dataset: str | Column,
    extracted_for: str | Column,
    ingested_at: datetime | Column | None = None,
) -> DataFrame:
    """Wrap records in the Bronze contract.

    ``records`` has either a ``payload`` text column, kept as it is, or the columns of the record.
    All records of one load share one ``ingested_at``, by default the start of the query.
    """
    payload = F.col("payload") if "payload" in records.columns else record_json(records)
    if ingested_at is None:
        ingested_at = F.current_timestamp()
    elif isinstance(ingested_at, datetime):
        ingested_at = F.lit(ingested_at.isoformat()).cast("timestamp")
    return records.select(
        (F.lit(dataset) if isinstance(dataset, str) else dataset).alias("source_dataset"),
        (F.lit(extracted_for) if isinstance(extracted_for, str) else extracted_for).alias("extracted_for"),
        payload.alias("payload"),
        ingested_at.alias("ingested_at"),
    )


def records(rows: DataFrame, late: Mapping[str, Column]) -> DataFrame:
    """Bronze records of rows that hold some columns of the contract, and the rest as expressions."""
    return rows.select(*[late[c].alias(c) if c in late else F.col(c) for c in BRONZE_COLUMNS])


LOADS_SCHEMA = "source_dataset string, n long, newest timestamp"


def append(load: DataFrame, path: str, late: Mapping[str, Column] | None = None) -> int:
    """Append a load to the log and return its number of rows; an empty load adds no file.

    The load is computed once: rows are counted as they are written. Files are laid out by dataset and day of load, and
    the rows of a folder are gathered first, so a folder gets as many files as its size asks for and not one for each
    task. A load repeated after a failure only adds versions that the Silver step removes, so a load can always be run
    again. Once it is written, the ledger of loads gets a row for each of its datasets.

    ``late`` names columns of the contract that are worked out from the load's rows once they are gathered and sorted: a
    record's text is several times as long as what it is made from, and then neither moves nor waits in a sort.
    """
    seen = Observation()
    metrics = {
        "n": F.count(F.lit(1)), "newest": F.max("ingested_at"), "oldest": F.min("ingested_at"),
        "first": F.min("source_dataset"), "last": F.max("source_dataset"), "known": F.count("source_dataset"),
    }
    # Counted above the shuffle: below it, the count goes with the plan that AQE drops for an empty load.
    rows = load.withColumn("ingest_day", F.to_date("ingested_at")) if late else stored(load)
    gathered = rows.hint("rebalance", *FOLDERS).observe(seen, *[m.alias(name) for name, m in metrics.items()])
    if late:
        columns = [late[c].alias(c) if c in late else F.col(c) for c in STORED_SCHEMA.names]
        gathered = gathered.sortWithinPartitions(*FOLDERS).select(*columns)
    gathered.write.options(**PACKED).mode("append").partitionBy(*FOLDERS).parquet(path)
    got = seen.get
    if got["n"]:
        _enter(load.sparkSession, path, got)
    return got["n"]


def _enter(spark: SparkSession, path: str, seen: dict) -> None:
    """The ledger's rows of a load. Only a load of several datasets is looked at again, in two columns of its own days."""
    if seen["first"] == seen["last"] and seen["known"] == seen["n"]:
        rows = spark.createDataFrame([(seen["first"], seen["n"], seen["newest"])], LOADS_SCHEMA)
    else:
        oldest, newest = (F.lit(seen[k]).cast("timestamp") for k in ("oldest", "newest"))
        own = F.col("ingest_day").between(F.to_date(oldest), F.to_date(newest)) & F.col("ingested_at").between(oldest, newest)
        load = spark.read.schema(STORED_SCHEMA).parquet(path).where(own)
        rows = load.groupBy("source_dataset").agg(F.count("*").alias("n"), F.max("ingested_at").alias("newest"))
    enter(rows, path)


def enter(rows: DataFrame, path: str) -> None:
    """Add rows to a log's ledger of loads."""
    rows.coalesce(1).write.mode("append").parquet(f"{path}{LEDGER}")


def loads(spark: SparkSession, path: str) -> DataFrame:
    """The ledger of a log's loads: source_dataset, n (rows) and newest (time of the load); a few rows for each load."""
    empty = spark.createDataFrame([], LOADS_SCHEMA)
    empty.write.mode("ignore").parquet(f"{path}{LEDGER}")
    return spark.read.schema(LOADS_SCHEMA).parquet(f"{path}{LEDGER}")


def newest_streamed(spark: SparkSession, path: str) -> DataFrame:
    """(source_dataset, newest) of what a stream appended; of each dataset only the last day's files are read."""
    log = spark.read.schema(STORED_SCHEMA).parquet(path)
    days: dict[str, str] = {}
    for name in log.inputFiles():
        dataset, day = (unquote(unquote(part.split("=", 1)[1])) for part in name.split("/")[-3:-1])
        days[dataset] = max(day, days.get(dataset, ""))
    places = F.array(*[F.concat_ws("/", F.lit(dataset), F.lit(day)) for dataset, day in days.items()]).cast("array<string>")
    last = log.where(F.array_contains(places, F.concat_ws("/", "source_dataset", F.col("ingest_day").cast("string"))))
    return last.groupBy("source_dataset").agg(F.max("ingested_at").alias("newest"))


def rows_loaded(spark: SparkSession, path: str) -> int:
    """Rows of all loads so far, by the ledger."""
    return loads(spark, path).agg(F.sum("n")).first()[0] or 0


def read(spark: SparkSession, path: str) -> DataFrame:
    """The log in its contract; filters on ``source_dataset`` prune folders."""
    return spark.read.schema(STORED_SCHEMA).parquet(path).select(*BRONZE_COLUMNS)
