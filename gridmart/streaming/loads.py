"""Landed files to the Bronze log, each record once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridmart import feeds
from gridmart.functions.casts import as_instant
from gridmart.operators.parse import json_texts
from gridmart.sources.bronze import FOLDERS, envelope, stored
from gridmart.sources.landed import ARRIVED, export_records

EVERY_QUARTER_HOUR = {"processingTime": "15 minutes"}
UNTIL_CAUGHT_UP = {"availableNow": True}


def start_log_stream(
    records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append a stream of Bronze records to the log at ``path``.

    Re-reads that overlap earlier ones are welcome: a slot is loaded again once it is filled, and the
    Silver step keeps one version. The file sink commits each micro-batch once per checkpoint, so a restart
    after a failure adds nothing twice. Run one query per checkpoint.
    """
    return (
        stored(records)
        .writeStream.format("parquet")
        .partitionBy(*FOLDERS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or EVERY_QUARTER_HOUR))
        .start()
    )


def recent_power(
    documents: DataFrame,
    minutes: int = 120,
    now: Column | None = None,
    region: str = feeds.REGION_CODE,
    dataset: str = feeds.DATASET_REALTIME,
) -> DataFrame:
    """Bronze records of landed JSON-array exports (column ``document``, batch or stream): one region's last ``minutes``.

    The window ends when a document was asked for: its ``arrived`` (see ``sources.landed``), or ``now`` for documents
    without one. It is never the time of the micro-batch, so a stream that stood still, or reads an old landing folder
    again, takes the same records as one that read each file at once. That time is also the load's, and a load is
    labelled with its UTC day. Records without a usable time are left out.
    """
    if now is None and ARRIVED not in documents.columns:
        raise ValueError(f"documents need a column {ARRIVED}, or give now")
    asked = (F.col(ARRIVED) if now is None else now).alias("asked")
    exports = export_records(documents, [asked])
    records = json_texts(exports, ["code_insee_region", "date_heure"], ["payload", "asked"]).toDF("payload", "asked", "region", "instant")
    start, end = as_instant(F.col("instant")), F.col("asked")
    wanted = records.where((F.col("region") == region) & (start >= end - F.make_dt_interval(mins=F.lit(minutes))) & (start < end))
    return envelope(wanted, dataset, F.date_format(end, "yyyy-MM-dd"), end)


def start_power_stream(
    documents: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, minutes: int = 120
) -> StreamingQuery:
    """Landed exports (``landed.stream_documents``) to the log at ``path`` every quarter of an hour, cut to the last ``minutes``."""
    return start_log_stream(recent_power(documents, minutes), path, checkpoint, trigger)
