"""From raw documents to packed token sequences: five operators, each on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.common import ROW, staged, table, with_row
from gridmart.llm.decontaminate import leaks
from gridmart.llm.jaccard import first_of_each
from gridmart.llm.line_dedup import line_dedup
from gridmart.llm.packing import pack
from gridmart.llm.quality_rules import quality_rules
from gridmart.session import pin_session

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _with_text(docs: DataFrame, changed: DataFrame, text: str) -> DataFrame:
    """``changed`` with the columns of ``docs``: ``text`` as the text, and n_chars as it now is."""
    values = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return changed.select(*[values[c].alias(c) if c in values else F.col(f"`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that fail.

    Null and empty texts fail. Rows are judged one by one: repeated rows stay repeated, null ids stay null, long texts are
    read whole. Columns of any other name pass. An empty table gives an empty one.
    """
    return _with_text(docs, quality_rules(docs).where("kept"), "clean_text")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stand in ten of them or more.

    A null text becomes an empty one. Rows equal in id and text count as one document and stay repeated; a null id stays
    null. Columns of any other name pass. An empty table gives an empty one.
    """
    return _with_text(docs, line_dedup(docs, min_docs=10, min_chars=1, keep="none"), "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id; of equal ids, that of the smallest text hash.

    Repeated rows become one. Null, empty and wordless texts are alike to none. A null id sorts as 0 and stays null. All
    columns pass. An empty table gives an empty one.
    """
    return first_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; an item of a few words that stands in many documents counts as none.

    Null and empty texts hold nothing and stay. Rows equal in id and text stay or go together, null ids too. All columns
    pass. An empty table, or an empty benchmark, changes nothing.
    """
    found = leaks(docs, table(spark, sf_dir, "benchmark")).where("kind <> 'short'").select(*ROW).distinct()
    return with_row(docs, docs.columns).join(found, list(ROW), "left_anti").select("__in.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of all documents, with their tokens; a null or empty text has the end token alone."""
    return pack(docs, TOKENIZER, longest=2048, end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("packing", packing),
]

#: Min-hash classes and token ids are beyond SQL; a test compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table; each stage's result is written and read again by the next."""
    docs = table(pin_session(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
