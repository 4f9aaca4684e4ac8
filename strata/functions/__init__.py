"""Column expressions built only from ``pyspark.sql.functions``."""

from strata.functions.dates import date_parts, parse_date
from strata.functions.names import first_word, last_word
from strata.functions.strings import (
    canonical_label,
    clean_text,
    collapse_whitespace,
    is_blank,
    title_case,
)

__all__ = [
    "canonical_label",
    "clean_text",
    "collapse_whitespace",
    "date_parts",
    "first_word",
    "is_blank",
    "last_word",
    "parse_date",
    "title_case",
]
