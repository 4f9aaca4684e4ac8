"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF_DIR = os.environ.get("STRATA_TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    from strata.queries.spark_side import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql())
    assert len(QUERIES) == 44


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean",
                 "DOUBLE": "double"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_DIR)
    rel = con.sql(E.oracle_sql()[name])
    assert dict(df.dtypes) == {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    want = canon(rel.columns, rel.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


@pytest.mark.parametrize("name", ["src_header_check", "src_inventory"])
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF_DIR).count() >= 1


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_orders" in df.columns


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="driver tables not present")
def test_sf001_golden_counts(spark):
    """Quantities measured independently for the derived sf0.01 rows."""
    d = "/root/testdata/sf0.01"
    q = E.queries()
    counts = {r.layer: r.row_count for r in q["layer_row_counts"](spark, d).collect()}
    assert counts == {"bronze": 15000, "silver": 10213, "rejected": 4787}
    assert q["customer_order_summary"](spark, d).count() == 1498
    assert str(q["latest_order_date"](spark, d).first()[0]) == "2001-08-01"
    fails = {r.rule_name: r.failed_records for r in q["dq_report_silver"](spark, d).collect()}
    assert fails["shipment_date_on_or_after_order_date"] == 3681
    assert (fails["row_id_unique"], fails["order_id_unique"]) == (72, 68)
    assert fails["order_date_valid"] == 119
    assert fails["shipment_mode_allowed"] == 607


def test_period_count_invariants(spark):
    from pyspark.sql import functions as F

    df = E.queries()["customer_order_summary"](spark, SF_DIR)
    broken = df.where(
        (F.col("orders_last_month") > F.col("orders_last_6_months"))
        | (F.col("orders_last_6_months") > F.col("orders_last_12_months"))
        | (F.col("orders_last_12_months") > F.col("total_orders"))
        | (F.col("total_orders") < 1)
    )
    assert broken.count() == 0
    assert df.select(F.countDistinct("order_date_year", "order_date_month", "order_date_day")).first()[0] == 1


def test_header_check_and_inventory_cover_every_file_and_row(spark, con):
    files = E.queries()["src_header_check"](spark, SF_DIR)
    listing = E.queries()["src_inventory"](spark, SF_DIR)
    orders = con.execute("SELECT count(*) FROM orders").fetchone()[0]
    assert tuple(files.select("conforming_rows", "other_files").first()) == (orders, 0)
    assert tuple(listing.select("non_empty", "row_count").first()) == (True, orders)
