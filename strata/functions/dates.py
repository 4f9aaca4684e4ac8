"""Date parsing and date parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.contracts import PARTITION_COLUMNS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: str | Column) -> Column:
    """Lenient ISO date parse; an unparseable value gives null.

    ``try_to_date`` keeps the null-on-failure contract under ANSI mode,
    where ``to_date`` raises. A value that already is a date passes through.
    """
    return F.try_to_date(_col(c))


def date_parts(c: str | Column) -> dict[str, Column]:
    """Year, month and day of a date (or date text) as the partition columns."""
    d = parse_date(c)
    year_col, month_col, day_col = PARTITION_COLUMNS
    return {year_col: F.year(d), month_col: F.month(d), day_col: F.dayofmonth(d)}

