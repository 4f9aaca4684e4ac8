"""Silver job (C4): standardise, split, write quarantined and valid rows, audit.

Rows are flagged once and staged, laid out by day, whatever the size of the
duplicate-key sets. The staging write observes, above its exchange, the input
and valid counts, the latest valid order day and every row-level audit count;
the uniqueness counts come from the duplicate-key sets. Quarantine and then
Silver are map-only filters of the staged table, so a run that fails between
the two has lost no reject. A quarantined row names the rules that it fails
and keeps its dates as the source wrote them. Working tables live in a folder of the run's own.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.contracts import (
    AUDIT_UNIQUE,
    FAILED_RULES,
    PARTITION_COLUMNS,
    QUARANTINE_COLUMNS,
    SILVER_COLUMNS,
    SILVER_RULES,
)
from strata.operators.lineage import child, qualified_path, stamp
from strata.operators.quality import (
    FAILED_MASK,
    VALID_FLAG,
    duplicate_sets,
    failed_names,
    flag_failed,
    key_surplus,
    report_from_counts,
    row_rule_metrics,
)
from strata.operators.standardize import project, to_silver
from strata.plans.layout import Lake
from strata.session import stage_table, work_folder
from strata.sinks.parquet import day_layout, write_layer
from strata.sources import layer_exists

log = logging.getLogger(__name__)


@dataclass
class SilverResult:
    input_rows: int
    valid_rows: int
    rejected_rows: int
    quarantine_written: bool
    quality: DataFrame
    latest_day: date | None = None
    schema: StructType | None = None
    surplus: dict[str, int] | None = None


def run_silver(
    spark: SparkSession,
    bronze: DataFrame,
    lake: Lake,
    run_ts: str,
    *,
    broadcast_max_bytes: int | None = None,
) -> SilverResult:
    with work_folder(spark) as work:
        return _run_silver(spark, bronze, lake, run_ts, work, broadcast_max_bytes)


def _run_silver(
    spark: SparkSession, bronze: DataFrame, lake: Lake, run_ts: str, work: str, broadcast_max_bytes: int | None
) -> SilverResult:
    standardized = to_silver(bronze, raw_dates=True)
    sets = duplicate_sets(
        standardized, SILVER_RULES.unique, broadcast_max_bytes=broadcast_max_bytes,
        paths={k: child(work, f"duplicate_{k}") for k in SILVER_RULES.unique},
    )
    flagged = flag_failed(standardized, SILVER_RULES, sets=sets)
    metrics = {
        "rows": F.count(F.lit(1)),
        "valid": F.count_if(F.col(VALID_FLAG)),
        "latest_day": F.max(F.when(F.col(VALID_FLAG), F.col("order_date"))),
        **row_rule_metrics("silver"),
    }
    # Bronze has the same days in its partition columns: counting them reads no row.
    laid_out = day_layout(flagged, PARTITION_COLUMNS, sizes=bronze, folder=child(work, "day_sizes"))
    staged, values = stage_table(laid_out, "flagged", metrics, child(work, "flagged"))
    latest_day = values.pop("latest_day")
    values = {k: int(v or 0) for k, v in values.items()}
    input_rows, valid_rows = values.pop("rows"), values.pop("valid")
    rejected_rows = input_rows - valid_rows
    log.info("Silver: %s input, %s valid, %s rejected", input_rows, valid_rows, rejected_rows)

    # Quarantine: skipped when there is nothing to store and no earlier table
    # exists; an existing table is overwritten, so stale rejects never linger.
    write_quarantine = rejected_rows > 0 or layer_exists(spark, lake.rejected)
    if write_quarantine:
        rejected = staged.where(~F.col(VALID_FLAG)).withColumn(FAILED_RULES, failed_names(FAILED_MASK, SILVER_RULES))
        write_layer(project(rejected, QUARANTINE_COLUMNS), lake.rejected)
    else:
        log.info("No rejected records found.")
    silver = stamp(project(staged.where(F.col(VALID_FLAG)), SILVER_COLUMNS), lake.silver, run_ts)
    write_layer(silver, lake.silver, partition_by=PARTITION_COLUMNS, lay_out=False)

    surplus = {f"{d.key}_unique": d.surplus for d in sets}
    missing = [k for k in AUDIT_UNIQUE if f"{k}_unique" not in surplus]
    surplus.update({f"{k}_unique": key_surplus(standardized, k).first()["failed_records"] for k in missing})
    quality = report_from_counts(
        spark, layer="silver", checked=input_rows, failures={**values, **surplus},
        file_path=qualified_path(spark, lake.silver), run_ts=run_ts,
    )
    return SilverResult(input_rows, valid_rows, rejected_rows, write_quarantine, quality, latest_day, silver.schema,
                        {d.key: d.surplus for d in sets})
