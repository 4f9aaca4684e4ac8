import pytest
from pyspark.sql import functions as F

from strata.contracts import RAW_COLUMNS
from strata.plans import ingest_bronze
from strata.sinks import write_csv
from strata.sources import check_source, file_heads, parsed_rows, read_checked, read_layer, source_files, validate_header
from tests.conftest import CLEAN_CSV, write_text

HEADER = ",".join(RAW_COLUMNS)
GOOD = "1,O1,2025-01-01,2025-01-02,First Class,C1,John Doe,Consumer,India,Pune"


def test_header_contract():
    validate_header(RAW_COLUMNS)
    with pytest.raises(ValueError, match="Header validation failed"):
        validate_header(["wrong_column", "order_id"])


def test_reads_typed_rows(spark, clean_csv):
    assert [r["head"] for r in file_heads(spark, clean_csv).collect()] == [HEADER]
    df = read_checked(spark, clean_csv)
    assert df.count() == 8
    assert dict(df.dtypes)["row_id"] == "bigint"


def test_blank_fields_arrive_as_null(spark, tmp_path):
    path = write_text(tmp_path / "b.csv", f"{HEADER}\n1,O1,2025-01-01,2025-01-02,First Class,,John Doe,,India,\n")
    row = read_checked(spark, path).first()
    assert (row.customer_id, row.segment, row.city) == (None, None, None)


@pytest.mark.parametrize("line", [
    "x1,O1,2025-01-01,2025-01-02,First Class,C1,John Doe,Consumer,India,Pune",  # bad int
    "1.0,O1,2025-01-01,2025-01-02,First Class,C1,John Doe,Consumer,India,Pune",  # a fraction
    "1,O1,2025-01-01,2025-01-02,First Class,C1,John Doe,Consumer,India",        # short row
    GOOD + ",extra",                                                             # long row
])
def test_malformed_rows_are_counted_and_refused(spark, tmp_path, line):
    path = write_text(tmp_path / "bad.csv", f"{HEADER}\n{GOOD}\n{line}\n")
    with pytest.raises(ValueError, match="1 malformed"):
        read_checked(spark, path)


def test_reordered_header_fails(spark, tmp_path):
    cols = list(RAW_COLUMNS)
    cols[1], cols[2] = cols[2], cols[1]
    path = write_text(tmp_path / "r.csv", ",".join(cols) + "\n" + GOOD + "\n")
    with pytest.raises(ValueError, match="Header validation failed"):
        read_checked(spark, path)


def test_missing_and_empty_sources(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        check_source(spark, str(tmp_path / "nope.csv"))
    empty = write_text(tmp_path / "empty.csv", "")
    with pytest.raises(ValueError, match="empty"):
        check_source(spark, empty)
    with pytest.raises(FileNotFoundError):
        read_layer(spark, str(tmp_path / "no_layer"))


def test_failed_ingest_keeps_previous_bronze(spark, tmp_path, clean_csv):
    bronze = str(tmp_path / "lake" / "bronze")
    assert ingest_bronze(spark, clean_csv, bronze, "t1").rows == 8
    bad = write_text(tmp_path / "bad" / "s.csv", CLEAN_CSV + "x9,O9,2025-01-01,2025-01-02,Same Day,C9,A B,C,D,E\n")
    with pytest.raises(ValueError):
        ingest_bronze(spark, bad, bronze, "t2")
    again = read_layer(spark, bronze)
    assert again.count() == 8
    assert again.select(F.max("execution_datetime")).first()[0] == "t1"


def test_csv_round_trip_keeps_padding(spark, tmp_path):
    df = spark.createDataFrame([(1, "  First   Class ", "   ")], "row_id long, a string, b string")
    path = str(tmp_path / "rt")
    write_csv(df, path)
    back = spark.read.option("header", True).schema("row_id long, a string, b string").csv(path).first()
    assert (back.a, back.b) == ("  First   Class ", "   ")


def test_multi_file_source(spark, tmp_path):
    write_text(tmp_path / "multi" / "a.csv", CLEAN_CSV)
    write_text(tmp_path / "multi" / "b.csv", CLEAN_CSV.replace("KX-", "KY-"))
    assert check_source(spark, str(tmp_path / "multi")).files == 2
    assert read_checked(spark, str(tmp_path / "multi")).count() == 16


def test_reordered_header_in_a_later_file_fails(spark, tmp_path):
    cols = list(RAW_COLUMNS)
    cols[6], cols[7] = cols[7], cols[6]
    write_text(tmp_path / "m" / "a.csv", CLEAN_CSV)
    write_text(tmp_path / "m" / "b.csv", ",".join(cols) + "\n" + GOOD + "\n")
    with pytest.raises(ValueError, match="Header validation failed.*b.csv"):
        read_checked(spark, str(tmp_path / "m"))


def test_folder_with_only_empty_files_is_empty(spark, tmp_path):
    write_text(tmp_path / "e" / "part-0.csv", "")
    write_text(tmp_path / "e" / "_SUCCESS", "")
    with pytest.raises(ValueError, match="empty"):
        check_source(spark, str(tmp_path / "e"))


@pytest.mark.parametrize("header", [
    ",".join(c.upper() for c in RAW_COLUMNS), HEADER + ",more", ",".join(RAW_COLUMNS[:-1]), HEADER.replace("city", " city"),
])
def test_every_file_must_have_the_exact_header(spark, tmp_path, header):
    for k in range(3):
        write_text(tmp_path / "m" / f"{k}.csv", (header if k == 2 else HEADER) + f"\n{GOOD}\n")
    with pytest.raises(ValueError, match="Header validation failed.*2.csv"):
        read_checked(spark, str(tmp_path / "m"))


def test_a_zero_byte_part_among_others_is_reported(spark, tmp_path):
    write_text(tmp_path / "m" / "a.csv", CLEAN_CSV)
    write_text(tmp_path / "m" / "b.csv", "")
    with pytest.raises(ValueError, match="b.csv"):
        check_source(spark, str(tmp_path / "m"))


def test_a_quoted_header_conforms(spark, tmp_path):
    path = write_text(tmp_path / "q.csv", ",".join(f'"{c}"' for c in RAW_COLUMNS) + f"\r\n{GOOD}\r\n")
    assert read_checked(spark, path).count() == 1


def test_inventory_of_nested_folders_and_odd_names(spark, tmp_path):
    root = tmp_path / "deep"
    for name in ("a.csv", "x/b c.csv", "x/y=1/ü%20.csv", "x/y=1/z/d.csv"):
        write_text(root / name, f"{HEADER}\n{GOOD}\n")
    write_text(root / "x" / "_SUCCESS", "")
    write_text(root / "x" / ".hidden.csv", "")
    size = len(f"{HEADER}\n{GOOD}\n".encode())
    assert sorted(r["length"] for r in source_files(spark, str(root)).collect()) == [size] * 4
    seen = check_source(spark, str(root))
    assert (seen.files, seen.bytes) == (4, 4 * size)
    assert read_checked(spark, str(root)).count() == 4
    write_text(root / "x" / "y=1" / "z" / "empty.csv", "")
    with pytest.raises(ValueError, match="z/empty.csv"):
        check_source(spark, str(root))


def test_inventory_makes_no_call_a_file(spark, tmp_path, monkeypatch):
    client = spark.sparkContext._gateway._gateway_client
    calls, send = [], client.send_command
    monkeypatch.setattr(client, "send_command", lambda *a, **k: (calls.append(1), send(*a, **k))[1])
    counts = []
    for n in (3, 60):
        for k in range(n):
            write_text(tmp_path / str(n) / f"{k}.csv", f"{HEADER}\n{GOOD}\n")
        calls.clear()
        assert check_source(spark, str(tmp_path / str(n))).files == n
        counts.append(len([c for c in calls]))
    assert 0 < counts[1] <= counts[0] + 20


def test_a_wrong_header_fails_before_any_row_is_read(spark, tmp_path, monkeypatch):
    from strata.plans import bronze

    for k in range(5):
        write_text(tmp_path / "m" / f"{k}.csv", (HEADER.upper() if k == 4 else HEADER) + f"\n{GOOD}\n")
    read = []
    monkeypatch.setattr(bronze, "parsed_rows", lambda *a, **k: read.append(a))
    with pytest.raises(ValueError, match="Header validation failed.*4.csv"):
        ingest_bronze(spark, str(tmp_path / "m"), str(tmp_path / "lake"), "t")
    assert not read and not (tmp_path / "lake").exists()


def test_only_the_head_of_a_file_is_read(spark, tmp_path):
    write_text(tmp_path / "big.csv", f"\n{HEADER}\n" + f"{GOOD}\n" * 200_000)
    assert [r["head"] for r in file_heads(spark, str(tmp_path / "big.csv")).collect()] == [HEADER]


def test_days_are_counted_from_the_date_column_alone(spark, clean_csv):
    plan = parsed_rows(spark, clean_csv).select("order_date")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<order_date:string>" in plan


def test_one_write_per_ingest(spark, tmp_path, clean_csv, monkeypatch):
    """The rows are written once; working tables hold heads and days' sizes only."""
    from strata import session
    from strata.sinks import parquet

    staged = []
    stage = session.stage_table
    monkeypatch.setattr(parquet, "stage_table", lambda df, name, *a: (staged.append((name, df.columns)), stage(df, name, *a))[1])
    assert ingest_bronze(spark, clean_csv, str(tmp_path / "lake"), "t").rows == 8
    assert [name for name, _ in staged] == ["day_sizes"] and "order_id" not in staged[0][1]
