"""End-to-end run (job C7): Bronze -> Silver -> Gold.

Each layer is read back from its written table before the next one starts,
so later stages never re-run earlier ones and an executor loss only repeats
work of the current stage.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from strata.contracts import MSG_NO_ORDER_DAY
from strata.operators.lineage import qualified_path, run_timestamp
from strata.operators.quality import report_from_counts
from strata.plans.bronze import bronze_uniqueness, ingest_bronze
from strata.plans.gold import run_gold
from strata.plans.layout import Lake
from strata.plans.silver import run_silver
from strata.sources import read_layer

log = logging.getLogger(__name__)


@dataclass
class RunResult:
    run_ts: str
    lake: Lake
    counts: dict[str, int] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)


def run_pipeline(
    spark: SparkSession,
    source_path: str,
    base_path: str,
    *,
    run_ts: str | None = None,
    broadcast_max_bytes: int | None = None,
) -> RunResult:
    """Ingest ``source_path`` (CSV) into a lake rooted at ``base_path``.

    The Gold quality table holds the audit of both the Bronze and the Silver
    layer; its counts are gathered by the Bronze and Silver writes. Errors are
    logged and re-raised.
    """
    run_ts = run_ts or run_timestamp()
    lake = Lake(str(base_path))
    result = RunResult(run_ts=run_ts, lake=lake)
    try:
        bronze_run = ingest_bronze(spark, source_path, lake.bronze, run_ts)
        result.counts["bronze"] = bronze_run.rows
        bronze = read_layer(spark, lake.bronze, bronze_run.schema)

        silver_run = run_silver(spark, bronze, lake, run_ts, broadcast_max_bytes=broadcast_max_bytes)
        result.counts.update(
            silver_input=silver_run.input_rows, silver=silver_run.valid_rows, rejected=silver_run.rejected_rows
        )
        if silver_run.valid_rows == 0:
            # Nothing to summarise: fail before any Gold table is touched.
            raise ValueError(MSG_NO_ORDER_DAY)
        bronze_quality = report_from_counts(
            spark, layer="bronze", checked=bronze_run.rows,
            failures={**bronze_run.failures,
                      **bronze_uniqueness(bronze, bronze_run.key_changes, silver_run.surplus)},
            file_path=qualified_path(spark, lake.bronze), run_ts=run_ts,
        )
        quality = bronze_quality.unionByName(silver_run.quality)

        silver = read_layer(spark, lake.silver, silver_run.schema)
        gold = run_gold(silver, quality, lake, run_ts, latest=silver_run.latest_day)
        result.tables = {"bronze": bronze, "silver": silver, **gold}
        if silver_run.quarantine_written:
            result.tables["rejected"] = read_layer(spark, lake.rejected)
        log.info("Run %s finished: %s", run_ts, result.counts)
        return result
    except Exception:
        log.exception("Pipeline run %s failed.", run_ts)
        raise
