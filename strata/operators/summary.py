"""Customer summary: latest order day and distinct order counts per period
(A5-A10, P2, P5, X6, X7; job C5).

One pass over the rows reduces them to orders per (customer keys, order day);
that smaller table is staged, and the latest day, the periods and the totals
all come from it. Distinct counts need no ``count_distinct`` (which Catalyst
expands into one copy of each row per distinct aggregate): on Silver rows,
whose order ids are unique, an order is a row; else ``max(order_date)`` per
order comes first. An order counts in a period iff any of its rows falls in
the period, i.e. iff its latest day does, because every period ends at the
data's maximum day. All stages aggregate partially before their shuffle, so a
customer holding a large share of the rows does not concentrate in one task.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.contracts import (
    CUSTOMER_COLUMNS,
    CUSTOMER_KEY_COLUMNS,
    CUSTOMER_PERIODS,
    CUSTOMER_RENAMES,
    MSG_NO_ORDER_DAY,
    PARTITION_COLUMNS,
    Period,
)
from strata.functions import first_word, last_word
from strata.session import stage_table


def latest_order_day(df: DataFrame, column: str = "order_date") -> date:
    """A5: the maximum order day; raises when there is none.

    A single value comes back to the driver; the aggregate runs distributed.
    """
    latest = df.agg(F.max(column).alias("latest_day")).first()["latest_day"]
    if latest is None:
        raise ValueError(MSG_NO_ORDER_DAY)
    return latest


def with_name_parts(df: DataFrame) -> DataFrame:
    """``customer_first_name`` and ``customer_last_name`` from ``customer_name``."""
    return df.withColumns(
        {"customer_first_name": first_word("customer_name"), "customer_last_name": last_word("customer_name")}
    )


def period_starts(latest: date, periods: tuple[Period, ...] = CUSTOMER_PERIODS) -> dict[str, F.Column]:
    """First day of every period, as date columns folded to constants."""
    anchor = F.lit(latest)
    return {p.name: p.start(anchor) for p in periods}


def customer_day_counts(
    df: DataFrame, keys: tuple[str, ...] = CUSTOMER_KEY_COLUMNS, *, orders_unique: bool = False
) -> DataFrame:
    """``(keys..., order_date, orders)``: distinct orders per customer key and day.

    Groups on the derived first/last names, like the output, so that one
    order is counted once per output row. With ``orders_unique`` (every
    non-null ``order_id`` is on one row, as in Silver, whose split rejects
    repeated ids) the per-order stage, a shuffle of every row, is skipped.
    """
    rows = with_name_parts(df).select(*keys, "order_id", "order_date")
    if not orders_unique:
        rows = rows.groupBy(*keys, "order_id").agg(F.max("order_date").alias("order_date"))
    return rows.groupBy(*keys, "order_date").agg(F.count("order_id").alias("orders"))


def customer_days(
    df: DataFrame, keys: tuple[str, ...] = CUSTOMER_KEY_COLUMNS, *, orders_unique: bool = False
) -> DataFrame:
    """``customer_day_counts``, staged."""
    return stage_table(customer_day_counts(df, keys, orders_unique=orders_unique), "customer_days")[0]


def period_counts(
    days: DataFrame,
    latest: date,
    periods: tuple[Period, ...] = CUSTOMER_PERIODS,
    keys: tuple[str, ...] = CUSTOMER_KEY_COLUMNS,
) -> DataFrame:
    """Per customer key, orders per period and in total, from ``customer_days``."""
    zero = F.lit(0).cast("bigint")
    return days.groupBy(*keys).agg(
        *[
            F.sum(F.when(F.col("order_date") >= start, F.col("orders")).otherwise(zero)).alias(name)
            for name, start in period_starts(latest, periods).items()
        ],
        F.sum("orders").alias("total_orders"),
    )


def order_counts(
    df: DataFrame,
    latest: date | None = None,
    periods: tuple[Period, ...] = CUSTOMER_PERIODS,
    keys: tuple[str, ...] = CUSTOMER_KEY_COLUMNS,
    *,
    orders_unique: bool = False,
) -> DataFrame:
    """Per customer key, distinct orders per period and in total.

    ``latest`` is the maximum ``order_date`` of ``df`` where it is known.
    """
    days = customer_days(df, keys, orders_unique=orders_unique)
    return period_counts(days, latest or latest_order_day(days), periods, keys)


def customer_summary(
    df: DataFrame,
    latest: date | None = None,
    periods: tuple[Period, ...] = CUSTOMER_PERIODS,
    *,
    orders_unique: bool = False,
) -> DataFrame:
    """The Gold customer table, partitioned by the latest order day."""
    days = customer_days(df, orders_unique=orders_unique)
    return customer_table(days, latest or latest_order_day(days), periods)


def customer_table(days: DataFrame, latest: date, periods: tuple[Period, ...] = CUSTOMER_PERIODS) -> DataFrame:
    """The Gold customer table from orders per customer and day."""
    year_col, month_col, day_col = PARTITION_COLUMNS
    return (
        period_counts(days, latest, periods)
        .withColumnsRenamed(CUSTOMER_RENAMES)
        .withColumns({year_col: F.lit(latest.year), month_col: F.lit(latest.month), day_col: F.lit(latest.day)})
        .select(*CUSTOMER_COLUMNS)
    )
