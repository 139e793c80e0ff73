"""Registry of queries, table access, and the plain types results are compared in."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.session import pin_session, size_session

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Catalogue:
    queries: dict[str, Query] = field(default_factory=dict)
    oracles: dict[str, str] = field(default_factory=dict)

    def query(self, name: str, oracle: str | None = None) -> Callable[[Query], Query]:
        """Register a query, with its SQL where SQL can state the result."""

        def register(function: Query) -> Query:
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return function(size_session(pin_session(spark)), sf_dir)

            self.queries[name] = run
            if oracle:
                self.oracles[name] = oracle
            return function

        return register


CATALOGUE = Catalogue()
query = CATALOGUE.query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a part: most, as a task may sort all that it builds from them; and so many before there is another part.
MOST_ROWS = 2**20
LEAST_ROWS = 20_000


def parts_of(rows: int, cores: int) -> int:
    """Parts for so many rows: one for each core if they are worth it, and more once the parts would get large."""
    return max(-(-rows // MOST_ROWS), min(cores, -(-rows // LEAST_ROWS)), 1)


def spread(df: DataFrame, parts: int | None = None) -> DataFrame:
    """A table in parts of a bounded number of rows, or so many, before costly work on each row: a single file is one task otherwise.

    Rows are counted (Parquet has the count in its footers), as parts of equal bytes differ in rows as much as in how well
    they are compressed. They are dealt by a hash of the whole row, which needs no sort and is no key's, so a key with many
    rows, or none, makes no large part.
    """
    if parts:
        return df.repartition(parts)
    return df.repartition(parts_of(df.count(), df.sparkSession.sparkContext.defaultParallelism), *[f"`{c}`" for c in df.columns])


def as_read(df: DataFrame) -> DataFrame:
    """A table in the parts that it is read in, without a shuffle; if they would not keep the cores busy, it is spread.

    For work on each row that goes straight to a shuffle or to files: no task holds its part, so rows need no bound. Rows
    are counted by part, from the footers.
    """
    rows = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    share = max(sum(rows) // df.sparkSession.sparkContext.defaultParallelism, LEAST_ROWS)
    return df if max(rows, default=0) <= 2 * share else spread(df)


def money(column: str) -> Column:
    """Two-digit amount as an exact decimal, so sums do not depend on the order of addition."""
    return F.col(column).cast("decimal(18,2)")


def plain(df: DataFrame) -> DataFrame:
    """Numbers as double and times as text: the same in every engine."""

    def as_plain(f: T.StructField) -> Column:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.NumericType):
            column = column.cast("double")
        elif isinstance(f.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return column.alias(f.name)

    return df.select(*[as_plain(f) for f in df.schema.fields])


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round doubles whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def half_up(sql: str, digits: int = 2) -> str:
    """SQL that rounds a double the way Spark does: half up, on its shortest decimal text."""
    return f"CAST(round(CAST(CAST({sql} AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)"
