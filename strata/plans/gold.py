"""Gold job (C6): order table, customer summary and the quality table."""

from __future__ import annotations

import logging
from datetime import date

from pyspark.sql import DataFrame

from strata.contracts import GOLD_SALES_COLUMNS, PARTITION_COLUMNS, SILVER_RULES
from strata.operators.lineage import stamp
from strata.operators.standardize import project
from strata.operators.summary import customer_summary, latest_order_day
from strata.plans.layout import Lake
from strata.sinks import write_layer
from strata.sources import read_layer

log = logging.getLogger(__name__)


def build_sales(silver: DataFrame, path: str, run_ts: str) -> DataFrame:
    return stamp(project(silver, GOLD_SALES_COLUMNS), path, run_ts)


def run_gold(
    silver: DataFrame, quality: DataFrame, lake: Lake, run_ts: str, latest: date | None = None
) -> dict[str, DataFrame]:
    """Write the three Gold tables and return them as written.

    Raises before any write when no order day exists.

    ``latest`` is the maximum Silver order day when already known (the Silver
    write observes it); otherwise it is computed from ``silver``.
    """
    if latest is None:
        latest = latest_order_day(silver)
    sales = build_sales(silver, lake.gold_sales, run_ts)
    # Silver keeps no repeated order id (the split rejects every copy), so
    # distinct order counts are row counts: no per-order shuffle.
    orders_unique = "order_id" in SILVER_RULES.unique
    customer = stamp(customer_summary(silver, latest, orders_unique=orders_unique), lake.gold_customer, run_ts)

    # A projection of Silver, which is laid out by the same day columns: map-only.
    write_layer(sales, lake.gold_sales, partition_by=PARTITION_COLUMNS, lay_out=False)
    # All customer rows share one partition value (the latest day).
    write_layer(customer, lake.gold_customer, partition_by=PARTITION_COLUMNS, lay_out=False)
    write_layer(quality, lake.gold_quality)
    log.info("Gold written under %s (latest order day %s)", lake.gold, latest)
    spark = silver.sparkSession
    return {
        "sales": read_layer(spark, lake.gold_sales, sales.schema),
        "customer": read_layer(spark, lake.gold_customer, customer.schema),
        "data_quality": read_layer(spark, lake.gold_quality, quality.schema),
    }
