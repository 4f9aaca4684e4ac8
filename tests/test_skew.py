"""Hot keys: one customer, and the null key, each holding a third of the rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.contracts import SILVER_RULES
from strata.operators.quality import split_valid_rejected
from strata.operators.summary import customer_summary

N = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    base = spark.range(N).select(
        F.when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).alias("row_id"),
        F.concat(F.lit("O"), (F.col("id") % 2000).cast("string")).alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit("C-HOT")).otherwise(F.concat(F.lit("C-"), (F.col("id") % 50).cast("string"))
                                                                 ).alias("customer_id"),
        F.lit("Ann Lee").alias("customer_name"),
        F.lit("INDIA").alias("country"),
        F.lit("CONSUMER").alias("segment"),
        F.lit("PUNE").alias("city"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 700).cast("int")).alias("order_date"),
        F.date_add(F.lit(dt.date(2020, 1, 2)), (F.col("id") % 700).cast("int")).alias("shipment_date"),
        F.lit("First Class").alias("shipment_mode"),
    )
    return base


def brute_force(rows):
    from collections import Counter

    rid = Counter(r["row_id"] for r in rows if r["row_id"] is not None)
    oid = Counter(r["order_id"] for r in rows if r["order_id"] is not None)
    valid = [r for r in rows if r["row_id"] is not None and rid[r["row_id"]] == 1 and oid[r["order_id"]] == 1]
    return len(valid), len(rows) - len(valid)


@pytest.mark.parametrize("budget", [None, -1])
def test_split_with_hot_null_key(spark, skewed, budget):
    rows = [r.asDict() for r in skewed.collect()]
    valid, rejected = split_valid_rejected(skewed, SILVER_RULES, broadcast_max_bytes=budget)
    assert (valid.count(), rejected.count()) == brute_force(rows)


def test_summary_with_hot_customer(spark, skewed):
    out = {r.customer_id: r for r in customer_summary(skewed).collect()}
    rows = [r.asDict() for r in skewed.collect()]
    hot = {r["order_id"] for r in rows if r["customer_id"] == "C-HOT"}
    assert out["C-HOT"].total_orders == len(hot)
    latest = max(r["order_date"] for r in rows)
    start = latest - dt.timedelta(days=30)
    recent = {r["order_id"] for r in rows if r["customer_id"] == "C-HOT" and r["order_date"] >= start}
    assert out["C-HOT"].orders_last_month == len(recent)
