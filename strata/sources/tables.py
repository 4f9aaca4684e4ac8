"""Orders-shaped source rows derived from the driver's TPC-H-like tables.

The driver ships no orders CSV, so the pipeline's raw rows are derived at
order grain from ``orders``, ``customer``, ``nation``, ``region`` and the
first ship day per order from ``lineitem``. The dirt injected below is a
deterministic function of the order key, so Spark and the SQL oracle agree.

Plan shape: ``lineitem`` is pruned to two columns and aggregated by order key
(partial aggregation before the shuffle), then joined to ``orders`` on the
same key. ``customer`` joins on the customer key. ``nation`` and ``region``
are left to the planner's size-based broadcast; all joins are left joins so
every order yields exactly one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.contracts import RAW_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _iso(d) -> F.Column:
    return F.date_format(d, "yyyy-MM-dd")


def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw source rows ``(row_id, order_id, ..., city)``, one per order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    first_ship = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_shipdate")
        .groupBy("l_orderkey")
        .agg(F.min("l_shipdate").alias("first_ship"))
    )
    geography = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("n_nationkey", "n_name", "r_name")
    )
    customers = (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        .join(geography, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    )
    rows = orders.join(first_ship, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(
        customers, F.col("o_custkey") == F.col("c_custkey"), "left"
    )

    k = F.col("o_orderkey")
    order_day = F.col("o_orderdate").cast("date")
    prio = F.col("o_orderpriority")
    derived = {
        "row_id": F.when(k % 211 == 1, k - 1).otherwise(k),
        "order_id": F.concat(F.lit("ORD-"), F.when(k % 223 == 1, k - 1).otherwise(k).cast("string")),
        "order_date": F.when(k % 127 == 0, F.lit("bad-date")).otherwise(_iso(order_day)),
        "ship_date": F.when(k % 131 == 0, F.lit("bad-date"))
        .when(k % 3 == 0, _iso(F.col("first_ship").cast("date")))
        .otherwise(_iso(F.date_add(order_day, (k % 7).cast("int")))),
        "ship_mode": F.when(prio == "1-URGENT", F.lit("same day"))
        .when(prio == "2-HIGH", F.lit("  First   Class "))
        .when(prio == "3-MEDIUM", F.lit("SECOND CLASS"))
        .when(prio == "5-LOW", F.lit("Standard Class"))
        .when(k % 5 == 0, F.lit("Express"))
        .otherwise(F.lit("standard class")),
        "customer_id": F.when(k % 137 == 0, F.lit("")).otherwise(
            F.concat(F.lit("C-"), F.col("c_custkey").cast("string"))
        ),
        "customer_name": F.when(k % 139 == 0, F.lit("   ")).otherwise(
            F.replace(F.lower(F.col("c_name")), F.lit("#"), F.lit("   "))
        ),
        "segment": F.lower(F.col("c_mktsegment")),
        "country": F.lower(F.col("n_name")),
        "city": F.concat(F.lit(" "), F.col("r_name"), F.lit("  city ")),
    }
    return rows.select(*[derived[c].alias(c) for c in RAW_COLUMNS])
