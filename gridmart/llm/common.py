"""What the operators share: table access, row identity, staged tables, Arrow columns as bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.session import pin_session, scratch_path

#: Names of the two columns that identify a row; an input may hold any other names.
ROW = ("__row_id", "__row_hash")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query of this subpackage, with its SQL where SQL can state the result."""

    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: function(pin_session(spark), sf_dir)
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two longs that identify a row by its id and text.

    Rows equal in both are the same document, repeated: every operator gives them the same result. Rows that share an
    id but not the text, or have no id, are documents of their own.
    """
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias(ROW[0]),
        F.xxhash64(F.col(doc_id).isNull(), F.col(text).isNull(), F.col(text)).alias(ROW[1]),
    ]


def boxed(columns: list[str]) -> Column:
    """The columns as one, ``__in``, so that their names clash with none an operator uses; ``__in.*`` gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__in")


def with_row(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of ``docs`` in a box, and the two columns of ``row_key``."""
    return docs.select(boxed(columns), *row_key())


def carried(docs: DataFrame, *results: str) -> list[str]:
    """Columns of ``docs`` that an operator passes on: all whose names no result column takes."""
    taken = {r.lower() for r in results}
    return [c for c in docs.columns if c.lower() not in taken]


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """Texts of a batch in UTF-8; a null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ROW)


def arrow_batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def per_batch(function: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of one batch as one for ``mapInArrow``."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return over
