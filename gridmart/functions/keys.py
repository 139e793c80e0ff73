"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text a NULL member stands for, so that NULL and empty text give different keys
NULL_MEMBER = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*members: str | Column) -> Column:
    """MD5 over the text of the members, in order, joined by a dash."""
    columns = [F.col(m) if isinstance(m, str) else m for m in members]
    texts = [F.coalesce(c.cast("string"), F.lit(NULL_MEMBER)) for c in columns]
    return F.md5(F.concat_ws("-", *texts))
