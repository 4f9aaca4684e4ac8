import pytest

from strata.cli import DEFAULT_BASE_PATH, main, parse_args


def test_arguments():
    args = parse_args(["--input-path", "in.csv"])
    assert (args.input_path, args.base_path, args.log_dir) == ("in.csv", DEFAULT_BASE_PATH, None)
    args = parse_args(["--input-path", "s3a://b/in/", "--base-path", "s3a://b/lake", "--log-dir", "logs",
                       "--app-name", "x"])
    assert (args.base_path, args.log_dir, args.app_name) == ("s3a://b/lake", "logs", "x")
    with pytest.raises(SystemExit):
        parse_args([])


def test_main_runs_the_pipeline(spark, tmp_path, clean_csv, capsys):
    counts = main(["--input-path", clean_csv, "--base-path", str(tmp_path / "lake"),
                   "--log-dir", str(tmp_path / "logs")], spark=spark)
    assert counts == {"bronze": 8, "silver_input": 8, "silver": 8, "rejected": 0}
    assert '"silver": 8' in capsys.readouterr().out
    assert (tmp_path / "logs" / "pipeline.log").exists()
