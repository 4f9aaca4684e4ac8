"""Person-name parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_word(c: str | Column) -> Column:
    """Text before the first space (the whole value if it has none)."""
    return F.split(_col(c), " ").getItem(0)


def last_word(c: str | Column) -> Column:
    """Text after the last space; middle words are dropped."""
    return F.element_at(F.split(_col(c), " "), -1)
