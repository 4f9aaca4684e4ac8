"""The customer table kept up to date from new days alone.

The state is orders per customer and day, for the days that a period can still
count, and one row a customer (without a day) for all days before. A refresh
reads the days of Silver after the state's last one, adds them, folds what has
left the longest period into the row without a day, and publishes state and
customer table. Counts are sums, so merging loses nothing; the latest day only
grows, so a folded day is never counted again.

Silver's earlier days must be as they were when the state was made; after a
change of theirs, ``rebuild=True`` starts from all days.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.contracts import CUSTOMER_KEY_COLUMNS, CUSTOMER_PERIODS, MSG_NO_ORDER_DAY, PARTITION_COLUMNS, Period
from strata.operators.lineage import stamp
from strata.operators.summary import customer_day_counts, customer_table, period_starts
from strata.plans.layout import Lake
from strata.sinks import write_layer
from strata.sources import layer_exists, read_layer

log = logging.getLogger(__name__)


def days_after(silver: DataFrame, day: dt.date | None) -> DataFrame:
    """The rows of later days; the filter is on the partition columns, so earlier days are not read."""
    if day is None:
        return silver
    later = F.lit(False)
    for column, value in reversed(list(zip(PARTITION_COLUMNS, (day.year, day.month, day.day), strict=True))):
        later = (F.col(column) > value) | ((F.col(column) == value) & later)
    return silver.where(later)


def merge_days(
    state: DataFrame | None, days: DataFrame, latest: dt.date, periods: tuple[Period, ...] = CUSTOMER_PERIODS,
    keys: tuple[str, ...] = CUSTOMER_KEY_COLUMNS,
) -> DataFrame:
    """State and new ``(keys, order_date, orders)`` rows as one state whose last day is ``latest``."""
    every = days if state is None else state.select(*days.columns).unionByName(days)
    if periods:
        oldest = F.least(*starts) if len(starts := list(period_starts(latest, periods).values())) > 1 else starts[0]
        every = every.withColumn("order_date", F.when(F.col("order_date") >= oldest, F.col("order_date")))
    return every.groupBy(*keys, "order_date").agg(F.sum("orders").alias("orders"))


def refresh_customers(spark: SparkSession, lake: Lake, run_ts: str, *, rebuild: bool = False) -> DataFrame:
    """Brings state and Gold customer table up to Silver's last day; returns the table as written.

    Without new days only the customer table is written again. Raises before
    any write when there is no order day at all.
    """
    silver = read_layer(spark, lake.silver)
    state, since = None, None
    if not rebuild and layer_exists(spark, lake.customer_state):
        state = read_layer(spark, lake.customer_state)
        since = state.agg(F.max("order_date")).first()[0]
    fresh = days_after(silver, since)
    latest = fresh.agg(F.max("order_date")).first()[0] or since
    if latest is None:
        raise ValueError(MSG_NO_ORDER_DAY)
    if latest != since:
        write_layer(merge_days(state, customer_day_counts(fresh, orders_unique=True), latest), lake.customer_state)
        log.info("Customer state: days after %s up to %s merged", since, latest)
    table = stamp(customer_table(read_layer(spark, lake.customer_state), latest), lake.gold_customer, run_ts)
    write_layer(table, lake.gold_customer, partition_by=PARTITION_COLUMNS, lay_out=False)
    return read_layer(spark, lake.gold_customer, table.schema)
