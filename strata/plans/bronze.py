"""Bronze ingest (job C1): checked CSV scan -> partitions + lineage -> Parquet.

The Bronze audit's row-level counts (missing values, unparseable dates) are
observed by the write job itself, together with the malformed rows and how many
key values Silver standardisation would change; the uniqueness counts then come from the Silver
duplicate sets, or from one aggregate over the key columns when a key changes.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.contracts import AUDIT_UNIQUE, BRONZE_COLUMNS, PARTITION_COLUMNS, RAW_SCHEMA, SILVER_RENAMES
from strata.operators.lineage import child, stamp
from strata.operators.quality import key_surplus, row_rule_metrics
from strata.operators.standardize import project, rename, silver_rules, with_date_partitions
from strata.session import work_folder
from strata.sinks import write_layer
from strata.sources import check_headers, check_source, parsed_rows
from strata.sources.csv import CORRUPT_COLUMN, malformed, refuse_malformed

log = logging.getLogger(__name__)


@dataclass
class BronzeResult:
    rows: int
    failures: dict[str, int]
    schema: StructType | None = None
    key_changes: dict[str, int] | None = None


def to_bronze(raw: DataFrame, bronze_path: str, run_ts: str, *more: str) -> DataFrame:
    """Raw rows -> Bronze shape: raw columns, lineage, order-day partitions; and ``more`` columns as they are."""
    return project(stamp(with_date_partitions(raw, "order_date"), bronze_path, run_ts), (*BRONZE_COLUMNS, *more))


def ingest_bronze(
    spark: SparkSession, source_path: str, bronze_path: str, run_ts: str, schema: StructType = RAW_SCHEMA
) -> BronzeResult:
    """Validate the source, then replace the Bronze table.

    Presence, bytes and headers are checked before a row is read. The rows are
    parsed and written once, as a version that is published only if no row was
    malformed; a bad file leaves the previous data in place. The days' sizes
    come from a scan that parses the date column alone.
    """
    check_source(spark, source_path)
    with work_folder(spark) as work:
        check_headers(spark, source_path, schema.names, child(work, "csv_heads"))
    rows = parsed_rows(spark, source_path, schema)
    bronze = to_bronze(rows, bronze_path, run_ts, CORRUPT_COLUMN)
    changes = key_changes(bronze)
    metrics = {"rows": F.count(F.lit(1)), "_bad": malformed(), **row_rule_metrics("bronze"), **changes}
    days = with_date_partitions(rows.select("order_date"), "order_date")
    observed = write_layer(
        bronze, bronze_path, partition_by=PARTITION_COLUMNS, metrics=metrics, sizes=days, unwritten=[CORRUPT_COLUMN],
        accept=lambda seen: refuse_malformed(seen["_bad"], source_path),
    )
    observed.pop("_bad")
    values = {k: int(v or 0) for k, v in observed.items()}
    rows = values.pop("rows")
    changed = {k: values.pop(name) for k, name in zip(AUDIT_UNIQUE, changes)}
    log.info("Bronze written: %s rows to %s", rows, bronze_path)
    return BronzeResult(rows, values, bronze.drop(CORRUPT_COLUMN).schema, changed)


def key_changes(bronze: DataFrame) -> dict[str, F.Column]:
    """Per audited key: rows whose value Silver standardisation would change.

    When none changes, the raw key's duplicate count equals the Silver one,
    so the Bronze audit can reuse the Silver duplicate-key sets.
    """
    rules = silver_rules(rename(bronze, SILVER_RENAMES))
    return {f"_{k}_changed": F.count_if(~F.col(k).eqNullSafe(rules[k])) for k in AUDIT_UNIQUE}


def bronze_uniqueness(
    bronze: DataFrame, key_changes: dict[str, int] | None = None, silver_surplus: dict[str, int] | None = None
) -> dict[str, int]:
    """Copies beyond the first of each audited raw key.

    Taken from the Silver duplicate sets for keys that standardisation leaves
    unchanged on every row; each of the others is counted by an aggregate
    that reads only its column.
    """
    key_changes, silver_surplus = key_changes or {}, silver_surplus or {}
    out = {f"{k}_unique": silver_surplus[k] for k in AUDIT_UNIQUE
           if key_changes.get(k) == 0 and k in silver_surplus}
    for k in AUDIT_UNIQUE:
        if f"{k}_unique" not in out:
            out[f"{k}_unique"] = key_surplus(bronze, k).first()["failed_records"]
    return out
