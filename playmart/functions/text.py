"""Texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncate_utf8_bytes(column: str | Column, n: int | Column) -> Column:
    """At most n bytes of a text, never part of a character."""
    c = F.col(column) if isinstance(column, str) else column
    n = F.lit(n) if isinstance(n, int) else n
    n = F.greatest(n, F.lit(0)).cast("int")
    raw = c.cast("binary")
    # a character has four bytes at most, so one of the last four cuts is between characters
    cuts = [F.try_validate_utf8(F.substring(raw, F.lit(1), F.greatest(n - k, F.lit(0))).cast("string")) for k in range(4)]
    return F.when(F.octet_length(c) <= n, c).otherwise(F.coalesce(*cuts))
