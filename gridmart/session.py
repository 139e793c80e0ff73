"""Session settings the results depend on, and the shared folder jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# UTC: naive source timestamps are UTC and year(instant) is a UTC year.
# ANSI: results never silently overflow; every tolerant cast is explicit.
PINNED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Sizing is left to AQE: start from many shuffle partitions, merge small ones, split skewed ones.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


# By default each folder is a task of the job that lists it, up to 10,000: with many folders, scheduling is all that it does.
LISTING, LISTING_TASKS_PER_CORE = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 4
# Records of text, packed well, are many to a part of the default 128 MB, and a task may sort all that it reads.
READ_PART, READ_PART_BYTES = "spark.sql.files.maxPartitionBytes", str(48 * 1024**2)
UNCHOSEN = {LISTING: ("10000",), READ_PART: ("134217728", "134217728b", "128m", "128MB")}

SHUFFLE_PARTITION_BYTES = 256 * 1024**2
LEAST_SHUFFLE_PARTITIONS = 200


def shuffle_partitions(shuffle_bytes: int) -> int:
    """Partitions for the largest shuffle of a job, about 256 MB each.

    AQE merges partitions that turn out small and splits skewed ones, but it cannot add any for a shuffle that is
    large throughout, so a job over much data has to start with enough.
    """
    return max(LEAST_SHUFFLE_PARTITIONS, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(
    app_name: str = "gridmart", master: str | None = None, shuffle_bytes: int | None = None, **conf: str
) -> SparkSession:
    """Session for a job of this package; ``conf`` keys use ``__`` for dots.

    ``shuffle_bytes`` estimates the largest shuffle: for a rebuild, the typed slots after one version per
    task was kept, a fraction of the log.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = {"spark.sql.shuffle.partitions": str(shuffle_partitions(shuffle_bytes))} if shuffle_bytes else {}
    overrides = {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in {**DEFAULTS, **PINNED, **sized, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session somebody else built."""
    for key, value in PINNED.items():
        spark.conf.set(key, value)
    return spark


def size_session(spark: SparkSession) -> SparkSession:
    """Set sizes for tables of many folders and packed records, where the session has left them at Spark's defaults."""
    listing = LISTING_TASKS_PER_CORE * max(spark.sparkContext.defaultParallelism, 8)
    for key, value in ((LISTING, str(listing)), (READ_PART, READ_PART_BYTES)):
        if spark.conf.get(key) in UNCHOSEN[key]:
            spark.conf.set(key, value)
    return spark


#: How tables and logs are written. Records are text, and several times smaller for it.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


def release_shuffles(spark: SparkSession) -> None:
    """Have the files of finished shuffles removed now: Spark removes them when the driver's collector finds a shuffle unused.

    Between steps that each shuffle much, so that the disk holds the shuffles of one step and not of all.
    """
    spark._jvm.System.gc()


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"gridmart-{application}-")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local_folder(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """New, unused path in the shared folder."""
    return f"{shared_folder(spark)}/gridmart/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that ``scratch_path`` named and nothing reads any more."""
    if not path.startswith(f"{shared_folder(spark)}/gridmart/"):
        raise ValueError(f"not a scratch path: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
