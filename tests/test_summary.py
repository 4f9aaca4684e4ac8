import datetime as dt

import pytest

from strata.contracts import CUSTOMER_COLUMNS
from strata.operators.summary import customer_summary, latest_order_day

SCHEMA = "customer_id string, customer_name string, segment string, country string, order_id string, order_date date"
D = dt.date


def summary(spark, rows):
    out = customer_summary(spark.createDataFrame(rows, SCHEMA))
    return {(r.customer_id, r.customer_first_name, r.customer_last_name, r.customer_segment): r for r in out.collect()}


def counts(r):
    return (r.orders_last_month, r.orders_last_6_months, r.orders_last_12_months, r.total_orders)


def test_counts_all_periods(spark):
    rows = [
        ("C1", "John Doe", "CONSUMER", "INDIA", "O1", D(2018, 12, 20)),
        ("C1", "John Doe", "CONSUMER", "INDIA", "O2", D(2018, 12, 1)),
        ("C1", "John Doe", "CONSUMER", "INDIA", "O3", D(2018, 8, 1)),
        ("C1", "John Doe", "CONSUMER", "INDIA", "O4", D(2018, 1, 1)),
        ("C1", "John Doe", "CONSUMER", "INDIA", "O5", D(2017, 12, 31)),
    ]
    out = customer_summary(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == list(CUSTOMER_COLUMNS)
    r = out.first()
    assert counts(r) == (2, 3, 4, 5)
    assert (r.order_date_year, r.order_date_month, r.order_date_day) == (2018, 12, 20)
    assert (r.customer_first_name, r.customer_last_name) == ("John", "Doe")


def test_period_start_boundaries(spark):
    # latest 2018-12-20: trailing start 2018-11-20, 6-month start 2018-07-01, 12-month start 2018-01-01.
    rows = [("C1", "A B", "S", "X", "L", D(2018, 12, 20))]
    for oid, day in [("on30", D(2018, 11, 20)), ("before30", D(2018, 11, 19)),
                     ("on6", D(2018, 7, 1)), ("before6", D(2018, 6, 30)),
                     ("on12", D(2018, 1, 1)), ("before12", D(2017, 12, 31))]:
        rows.append(("C1", "A B", "S", "X", oid, day))
    r = next(iter(summary(spark, rows).values()))
    # latest + on30 | + before30, on6 | + before6, on12 | all 7
    assert counts(r) == (2, 4, 6, 7)


def test_order_on_both_sides_of_a_start_counts_once(spark):
    rows = [
        ("C1", "A B", "S", "X", "O1", D(2018, 12, 20)),
        ("C1", "A B", "S", "X", "O2", D(2018, 11, 1)),
        ("C1", "A B", "S", "X", "O2", D(2018, 12, 5)),
    ]
    r = next(iter(summary(spark, rows).values()))
    assert counts(r) == (2, 2, 2, 2)


def test_repeated_order_and_middle_names_count_once(spark):
    rows = [
        ("C1", "Ann B Lee", "S", "X", "O1", D(2018, 12, 20)),
        ("C1", "Ann Q Lee", "S", "X", "O1", D(2018, 12, 20)),
        ("C1", "Ann Lee", "S", "X", "O1", D(2018, 12, 19)),
    ]
    out = summary(spark, rows)
    assert list(out) == [("C1", "Ann", "Lee", "S")]
    assert counts(out[("C1", "Ann", "Lee", "S")]) == (1, 1, 1, 1)


def test_null_order_id_is_not_counted(spark):
    rows = [("C1", "A B", "S", "X", None, D(2018, 12, 20)), ("C1", "A B", "S", "X", "O1", D(2018, 12, 1))]
    r = next(iter(summary(spark, rows).values()))
    assert counts(r) == (1, 1, 1, 1)


def test_two_segments_give_two_rows(spark):
    rows = [("C1", "A B", "S1", "X", "O1", D(2018, 12, 20)), ("C1", "A B", "S2", "X", "O2", D(2018, 12, 1))]
    assert set(summary(spark, rows)) == {("C1", "A", "B", "S1"), ("C1", "A", "B", "S2")}


def test_no_order_day_raises(spark):
    with pytest.raises(ValueError, match="valid order_dates"):
        latest_order_day(spark.createDataFrame([], SCHEMA))
    with pytest.raises(ValueError):
        customer_summary(spark.createDataFrame([("C1", "A", "S", "X", "O1", None)], SCHEMA))


def test_unique_orders_shortcut_equals_two_stage(spark):
    rows = [
        ("C1", "Ann B Lee", "S", "X", "O1", D(2018, 12, 20)),
        ("C1", "Ann Q Lee", "S", "X", "O2", D(2018, 11, 1)),
        ("C1", "Ann Lee", "S", "X", None, D(2018, 12, 19)),
        ("C2", "Bo Ek", "T", "Y", "O3", D(2018, 1, 1)),
        ("C2", "Bo Ek", "T", "Y", "O4", D(2017, 6, 1)),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    two_stage = sorted(map(tuple, customer_summary(df).collect()))
    shortcut = sorted(map(tuple, customer_summary(df, orders_unique=True).collect()))
    assert shortcut == two_stage
