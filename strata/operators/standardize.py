"""Projection and standardisation operators (P1, P2, P4, P6-P8; job C2).

Everything here is narrow: one ``select`` per operator, no shuffle, and the
expressions stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata.contracts import (
    LINEAGE_COLUMNS,
    RAW_COLUMNS,
    RAW_DATE_TEXTS,
    SHIP_MODE_CANONICAL,
    SILVER_COLUMNS,
    SILVER_RENAMES,
)
from strata.functions import canonical_label, clean_text, date_parts, parse_date, title_case


def project(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Ordered contract projection: extras are dropped, a missing column fails."""
    return df.select(*columns)


def rename(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Rename columns; names absent from ``df`` are ignored."""
    return df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})


def string_columns(df: DataFrame) -> list[str]:
    """Columns whose type is string (date texts and lineage included)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def standardize_strings(df: DataFrame) -> DataFrame:
    """Clean every string column: collapse whitespace, trim, blank -> null."""
    targets = set(string_columns(df))
    return df.select(*[clean_text(c).alias(c) if c in targets else F.col(c) for c in df.columns])


def with_date_partitions(df: DataFrame, date_column: str = "order_date") -> DataFrame:
    """Add year/month/day partition columns of ``date_column`` (text or date)."""
    return df.withColumns(date_parts(date_column))


# Business rules of the orders data set, applied to already-cleaned values.
BUSINESS_RULES: dict[str, Callable[[Column], Column]] = {
    "customer_name": title_case,
    "country": F.upper,
    "segment": F.upper,
    "order_date": parse_date,
    "shipment_date": parse_date,
    "shipment_mode": lambda v: canonical_label(v, SHIP_MODE_CANONICAL),
}


def cleaning_rules(base: DataFrame) -> dict[str, Column]:
    """Every string column cleaned; other columns (a numeric ``row_id``) as they are."""
    strings = set(string_columns(base))
    return {c: clean_text(c) if c in strings else F.col(c) for c in base.columns}


def silver_rules(base: DataFrame) -> dict[str, Column]:
    """The full Silver expression of every column of ``base`` (renamed raw and lineage columns)."""
    cleaned = cleaning_rules(base)
    return {c: BUSINESS_RULES.get(c, _identity)(cleaned[c]) for c in base.columns}


def _identity(c: Column) -> Column:
    return c


def to_silver(df: DataFrame, *, raw_dates: bool = False) -> DataFrame:
    """Standardise Bronze-shaped rows into Silver shape (job C2).

    With ``raw_dates`` the source's date texts are kept as they are, in
    columns of their own behind the others.

    Contract projection of the raw and lineage columns and renames; one
    projection cleans every string column, the next applies name/country/
    segment casing, date parsing and shipment-mode canonicalisation to the
    cleaned values; then the partition columns. Keeping the cleaning in its
    own projection evaluates each regular expression once per value (Catalyst
    does not inline a non-cheap expression it would have to repeat).
    """
    texts = RAW_DATE_TEXTS if raw_dates else {}
    raw = df.select(*RAW_COLUMNS, *LINEAGE_COLUMNS, *[F.col(c).alias(t) for c, t in texts.items()])
    base = rename(raw, SILVER_RENAMES)
    rules = cleaning_rules(base) | {t: F.col(t) for t in texts.values()}
    cleaned = base.select(*[e.alias(c) for c, e in rules.items()])
    out = cleaned.select(*[BUSINESS_RULES.get(c, _identity)(F.col(c)).alias(c) for c in cleaned.columns])
    return project(with_date_partitions(out, "order_date"), (*SILVER_COLUMNS, *texts.values()))
