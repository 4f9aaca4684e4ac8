"""Declared contracts: layer schemas, expected headers, rule sets and periods.

Operators in this package are generic ``DataFrame -> DataFrame`` functions.
Which columns are required, unique, dates, or restricted to an allow-list is
configuration, declared here once for the orders data set.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------

# Source header, in order.
RAW_COLUMNS: tuple[str, ...] = (
    "row_id",
    "order_id",
    "order_date",
    "ship_date",
    "ship_mode",
    "customer_id",
    "customer_name",
    "segment",
    "country",
    "city",
)

# Hive-style partition columns derived from order_date.
PARTITION_COLUMNS: tuple[str, ...] = ("order_date_year", "order_date_month", "order_date_day")

# Lineage columns stamped on every written layer.
LINEAGE_COLUMNS: tuple[str, ...] = ("file_path", "execution_datetime")

# Canonical shipment modes (the allow-list), matched case-insensitively
# when standardising: lower-cased spelling -> canonical label.
SHIP_MODE_CANONICAL: dict[str, str] = {
    "first class": "First Class",
    "second class": "Second Class",
    "standard class": "Standard Class",
    "same day": "Same Day",
}
ALLOWED_SHIP_MODES: tuple[str, ...] = ("First Class", "Second Class", "Standard Class", "Same Day")

# Quality layers accepted by the audit.
QUALITY_LAYERS: tuple[str, ...] = ("bronze", "silver")

# Audit rule names and descriptions, as written into the report; "{c}" is the
# checked column.
RULE_NOT_NULL = ("{c}_not_null", "{c} must be present and not blank.")
RULE_UNIQUE = ("{c}_unique", "{c} must be unique across the input dataset.")
RULE_DATE_VALID = ("{c}_valid", "{c} must parse as a valid date.")
RULE_CHRONOLOGY = ("shipment_date_on_or_after_order_date", "shipment_date must not be earlier than order_date.")
RULE_MODE_ALLOWED = ("shipment_mode_allowed", "shipment_mode must match an allowed canonical classification.")
STATUS_PASS, STATUS_FAIL = "PASS", "FAIL"

# Error messages.
MSG_BAD_LAYER = "Data-quality layer must be either 'bronze' or 'silver'."
MSG_NO_ORDER_DAY = "The source data does not contain any valid order_dates."
MSG_BAD_HEADER = "Header validation failed. Expected={expected}, Actual={actual}"
MSG_SOURCE_MISSING = "Source file not found: {path}"
MSG_SOURCE_EMPTY = "Input file is empty: {path}"
MSG_LAYER_MISSING = "Dataset not found at {path}"
MSG_MALFORMED = "Source has {count} malformed row(s): {path}"

# Columns that the audit's not-null rules cover, in report order; those that a
# valid row must have; keys whose repeated values disqualify every copy.
AUDIT_REQUIRED: tuple[str, ...] = (
    "row_id",
    "order_id",
    "customer_id",
    "customer_name",
    "country",
    "segment",
    "city",
)
VALID_REQUIRED: tuple[str, ...] = AUDIT_REQUIRED + ("order_date", "shipment_date")
UNIQUE_KEYS: tuple[str, ...] = ("row_id", "order_id")
AUDIT_UNIQUE: tuple[str, ...] = UNIQUE_KEYS

# Lake layout under the base path.
BRONZE_DIR = ("bronze", "raw_sales")
SILVER_DIR = ("silver", "sales")
QUARANTINE_NAME = "rejected_records"
GOLD_DIR = ("gold",)
GOLD_SALES_NAME, GOLD_CUSTOMER_NAME, GOLD_QUALITY_NAME = "sales", "customer", "data_quality"
CUSTOMER_STATE_NAME = "customer_days"

# Column renames applied on the way to Silver and to the customer table.
SILVER_RENAMES: dict[str, str] = {"ship_date": "shipment_date", "ship_mode": "shipment_mode"}
CUSTOMER_RENAMES: dict[str, str] = {"segment": "customer_segment"}

# Output column order of each layer.
BRONZE_COLUMNS: tuple[str, ...] = RAW_COLUMNS + LINEAGE_COLUMNS + PARTITION_COLUMNS
SILVER_COLUMNS: tuple[str, ...] = (
    "row_id",
    "order_id",
    "order_date",
    "shipment_date",
    "shipment_mode",
    "customer_id",
    "customer_name",
    "segment",
    "country",
    "city",
) + LINEAGE_COLUMNS + PARTITION_COLUMNS
# What a quarantined row has besides the Silver columns: the names of the rules
# that it fails, and its dates as the source wrote them.
RAW_DATE_TEXTS: dict[str, str] = {"order_date": "order_date_text", "ship_date": "shipment_date_text"}
FAILED_RULES = "failed_rules"
QUARANTINE_COLUMNS: tuple[str, ...] = SILVER_COLUMNS + (FAILED_RULES, *RAW_DATE_TEXTS.values())
GOLD_SALES_COLUMNS: tuple[str, ...] = (
    "order_id",
    "order_date",
    "shipment_date",
    "shipment_mode",
    "city",
) + LINEAGE_COLUMNS + PARTITION_COLUMNS
CUSTOMER_KEY_COLUMNS: tuple[str, ...] = (
    "customer_id",
    "customer_first_name",
    "customer_last_name",
    "segment",
    "country",
)
CUSTOMER_COLUMNS: tuple[str, ...] = (
    "customer_id",
    "customer_first_name",
    "customer_last_name",
    "customer_segment",
    "country",
    "orders_last_month",
    "orders_last_6_months",
    "orders_last_12_months",
    "total_orders",
) + PARTITION_COLUMNS
QUALITY_COLUMNS: tuple[str, ...] = (
    "layer",
    "rule_name",
    "status",
    "checked_records",
    "failed_records",
    "rule_description",
    "file_path",
    "execution_datetime",
)

# Source schema. ``row_id`` is declared 64-bit: at large scale the ids that
# feed it exceed 2**31 (the reference declares a 32-bit int).
RAW_SCHEMA = StructType(
    [StructField("row_id", LongType(), True)]
    + [StructField(name, StringType(), True) for name in RAW_COLUMNS[1:]]
)

QUALITY_SCHEMA = StructType(
    [
        StructField("layer", StringType(), False),
        StructField("rule_name", StringType(), False),
        StructField("status", StringType(), False),
        StructField("checked_records", LongType(), False),
        StructField("failed_records", LongType(), False),
        StructField("rule_description", StringType(), False),
        StructField("file_path", StringType(), False),
        StructField("execution_datetime", StringType(), False),
    ]
)


# ---------------------------------------------------------------------------
# Rule sets (what the split and the audit check) and periods (what the
# customer summary counts).
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RuleSet:
    """Validity rules of one data set.

    ``required``: columns that must be present; ``unique``: keys whose
    repeated values disqualify every copy; ``dates``: columns that must hold
    a date; ``chronology``: (earlier, later) pairs where later >= earlier;
    ``allowed``: column -> allowed values (case-sensitive).
    """

    required: tuple[str, ...]
    unique: tuple[str, ...]
    dates: tuple[str, ...]
    chronology: tuple[tuple[str, str], ...] = ()
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)


# Rules the Silver split applies (validity of one standardised row).
SILVER_RULES = RuleSet(
    required=VALID_REQUIRED,
    unique=UNIQUE_KEYS,
    dates=("order_date", "shipment_date"),
    chronology=(("order_date", "shipment_date"),),
    allowed={"shipment_mode": ALLOWED_SHIP_MODES},
)

# What the audit checks, by layer. Bronze still holds texts of the source's names.
AUDIT_RULES: dict[str, RuleSet] = {
    "bronze": RuleSet(required=AUDIT_REQUIRED, unique=AUDIT_UNIQUE, dates=("order_date", "ship_date")),
    "silver": RuleSet(
        required=AUDIT_REQUIRED,
        unique=AUDIT_UNIQUE,
        dates=SILVER_RULES.dates,
        chronology=SILVER_RULES.chronology,
        allowed=SILVER_RULES.allowed,
    ),
}


@dataclass(frozen=True)
class Period:
    """A reporting period ending at the latest order day.

    ``start`` maps the latest-day column to the first day of the period
    (inclusive). The period ends at the latest day, which is the maximum of
    the data, so no upper bound needs testing.
    """

    name: str
    start: Callable[[Column], Column]


# Fixed periods: trailing 30 days, and the calendar months covering the
# latest month and the 5 (resp. 11) before it.
CUSTOMER_PERIODS: tuple[Period, ...] = (
    Period("orders_last_month", lambda latest: F.date_sub(latest, 30)),
    Period("orders_last_6_months", lambda latest: F.trunc(F.add_months(latest, -5), "MM")),
    Period("orders_last_12_months", lambda latest: F.trunc(F.add_months(latest, -11), "MM")),
)
