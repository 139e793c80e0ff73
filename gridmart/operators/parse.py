"""JSON records to typed columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.functions.casts import as_text


@dataclass(frozen=True)
class Field:
    """One output column: the JSON key it comes from and the cast applied to its text."""

    key: str
    column: str
    convert: Callable[[Column], Column] = as_text


def json_texts(records: DataFrame, keys: Sequence[str], carry: Sequence[str | Column] = ()) -> DataFrame:
    """Chosen keys of ``payload`` as text columns ``json_<key>``, next to the carried columns.

    A missing key, a JSON null and a malformed document all give NULL. Every key is read as text
    because sources quote numbers and write words into them. ``inline`` keeps the parse at one per
    record: a filter on a struct column would copy ``from_json`` into each pushed-down condition.
    """
    schema = T.StructType([T.StructField(key, T.StringType()) for key in keys])
    row = F.inline(F.array(F.from_json("payload", schema)))
    return records.select(*carry, row.alias(*[f"json_{key}" for key in keys]))


def may_hold(*texts: str) -> Column:
    """Whether a value of ``payload`` can be one of these plain texts: a cheap test before the parse, which leaves out no record.

    A value stands in the document as it is, unless part of it is written as an escape; records with a backslash stay.
    """
    return reduce(or_, [F.col("payload").contains(text) for text in (*texts, "\\")])


def parse_records(
    records: DataFrame,
    fields: Sequence[Field],
    carry: Sequence[str | Column] = ("source_dataset", "ingested_at"),
) -> DataFrame:
    """Typed columns of the payload, then the carried columns."""
    keys = list(dict.fromkeys(field.key for field in fields))
    texts = json_texts(records, keys, carry)
    kept = texts.columns[: len(texts.columns) - len(keys)]
    typed = [field.convert(F.col(f"json_{field.key}")).alias(field.column) for field in fields]
    return texts.select(*typed, *kept)
