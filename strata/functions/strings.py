"""String standardisation expressions (JVM-side, whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_whitespace(c: str | Column) -> Column:
    """Replace every run of whitespace by one space."""
    return F.regexp_replace(_col(c), r"\s+", " ")


def clean_text(c: str | Column) -> Column:
    """Collapse whitespace, trim, and turn an empty result into null.

    Collapsing first means a value made only of tabs or newlines becomes
    null, and leading tabs are removed, instead of surviving as a lone space.
    """
    cleaned = F.trim(collapse_whitespace(c))
    return F.nullif(cleaned, F.lit(""))


def is_blank(c: str | Column) -> Column:
    """Missing-value test: null, or only spaces once trimmed.

    Non-string columns are cast to string first, as ``trim`` would do.
    """
    col = _col(c)
    return col.isNull() | (F.trim(col.cast("string")) == "")


def title_case(c: str | Column) -> Column:
    """Lower-case, then capitalise the first letter after each space."""
    return F.initcap(_col(c))


def canonical_label(c: str | Column, canonical: dict[str, str]) -> Column:
    """Map a value case-insensitively onto a canonical label.

    Unmatched values pass through unchanged; null stays null. A map lookup
    evaluates the value once (a ``CASE`` chain would re-evaluate it in every
    branch after the first).
    """
    col = _col(c)
    if not canonical:
        return col
    labels = F.create_map(*[F.lit(x) for pair in canonical.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, F.lower(col)), col)
