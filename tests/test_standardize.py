import datetime as dt

from strata.contracts import SILVER_COLUMNS
from strata.operators.lineage import RUN_TS_FORMAT, qualified_path, run_timestamp, stamp, stamp_literal
from strata.operators.standardize import project, rename, standardize_strings, to_silver, with_date_partitions

COLS = "row_id string, order_id string, order_date string, ship_date string, ship_mode string, customer_id string, " \
       "customer_name string, segment string, country string, city string, file_path string, execution_datetime string"


def test_to_silver_standardises_values(spark):
    df = spark.createDataFrame(
        [("41 ", "\tG-9", "2020-02-29", "2020-03-01", " SECOND \n class", "H-3\t", "mary-ann \t o'NEIL", "home   office",
          "côte d'ivoire", "\n abidjan", "/lake/bronze", "2025-01-01T00:00:00.000000Z")],
        COLS,
    )
    row = to_silver(df).first().asDict()
    assert list(to_silver(df).columns) == list(SILVER_COLUMNS)
    assert (row["row_id"], row["order_id"], row["customer_id"]) == ("41", "G-9", "H-3")
    assert row["customer_name"] == "Mary-ann O'neil"
    assert (row["segment"], row["country"]) == ("HOME OFFICE", "CÔTE D'IVOIRE")
    assert row["city"] == "abidjan"  # cleaned, not upper-cased
    assert row["shipment_mode"] == "Second Class"
    assert (row["order_date"], row["shipment_date"]) == (dt.date(2020, 2, 29), dt.date(2020, 3, 1))
    assert (row["order_date_year"], row["order_date_month"], row["order_date_day"]) == (2020, 2, 29)


def test_to_silver_blanks_become_null_and_bad_dates_null(spark):
    df = spark.createDataFrame(
        [("2", "", "bad-date", "  ", "Express", "", "   ", "", "", "", "p", "t")], COLS
    )
    row = to_silver(df).first().asDict()
    for c in ("order_id", "order_date", "shipment_date", "customer_id", "customer_name", "segment", "country", "city"):
        assert row[c] is None, c
    assert row["shipment_mode"] == "Express"
    assert row["order_date_year"] is None


def test_to_silver_fails_on_missing_column(spark):
    df = spark.createDataFrame([("1",)], "row_id string")
    import pytest
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        to_silver(df)


def test_projection_and_renames(spark):
    df = spark.createDataFrame([(1, "a", "b", "x")], "row_id int, ship_date string, ship_mode string, extra string")
    out = project(rename(df, {"ship_date": "shipment_date", "ship_mode": "shipment_mode", "nope": "z"}),
                  ["shipment_mode", "row_id"])
    assert out.columns == ["shipment_mode", "row_id"]


def test_standardize_strings_only_touches_strings(spark):
    df = spark.createDataFrame([(7, "  a  b ", "")], "n int, s string, e string")
    row = standardize_strings(df).first()
    assert (row["n"], row["s"], row["e"]) == (7, "a b", None)


def test_date_partitions_from_text(spark):
    df = spark.createDataFrame([("2018-12-30",), ("bad-date",)], "order_date string")
    rows = with_date_partitions(df).orderBy("order_date").collect()
    assert (rows[0]["order_date_year"], rows[0]["order_date_month"], rows[0]["order_date_day"]) == (2018, 12, 30)
    assert rows[1]["order_date_year"] is None


def test_run_timestamp_is_utc_with_microseconds():
    cet = dt.timezone(dt.timedelta(hours=1))
    assert run_timestamp(dt.datetime(2021, 1, 1, 0, 30, 0, 7, cet)) == "2020-12-31T23:30:00.000007Z"
    assert run_timestamp(dt.datetime(2021, 7, 9, tzinfo=dt.timezone.utc)) == "2021-07-09T00:00:00.000000Z"
    text = run_timestamp()
    assert dt.datetime.strptime(text, RUN_TS_FORMAT).strftime(RUN_TS_FORMAT) == text and len(text) == 27


def test_stamps_name_the_table_as_hadoop_does(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1,)], "a int")
    assert stamp_literal(df, "any text", "then").first()[1:] == ("any text", "then")
    assert stamp(df, f"{tmp_path}/x/", "then").first()["file_path"] == f"file:{tmp_path}/x"
    assert qualified_path(spark, f"file:{tmp_path}/x") == qualified_path(spark, f"file://{tmp_path}/x") == f"file:{tmp_path}/x"
    monkeypatch.chdir(tmp_path)  # a relative path is the file system's matter, not the driver's
    assert qualified_path(spark, "x") == qualified_path(spark, "./x/")


def test_layers_below_any_root():
    from strata.plans import Lake

    for root in ("wasb://c@a.host/l", "/l", "rel/l", "hdfs://n:1"):
        lake, same = Lake(root), Lake(root + "/")
        assert (lake.silver, lake.gold_quality) == (f"{root}/silver/sales", f"{root}/gold/data_quality")
        assert lake.rejected == same.rejected == f"{root}/silver/rejected_records"
