"""Failure-atomic overwrites: what readers see when a write dies at any point."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from strata import versions
from strata.plans import Lake, run_pipeline
from strata.sinks import write_layer
from strata.sources import layer_exists, read_layer

LAYERS = ("bronze", "silver", "rejected", "gold_sales", "gold_customer", "gold_quality")


def rows(spark, n, tag):
    return spark.range(n).select("id", F.lit(tag).alias("tag"), (F.col("id") % 3).alias("day"))


def tags(spark, path):
    return {(r["tag"], r["count"]) for r in read_layer(spark, path).groupBy("tag").count().collect()}


def folders(path, name):
    return sorted(os.listdir(os.path.join(path, name)))


def test_versions_follow_each_other_and_old_ones_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(4):
        write_layer(rows(spark, 10 + k, f"w{k}"), path, partition_by=["day"])
        assert tags(spark, path) == {(f"w{k}", 10 + k)}
    assert len(folders(path, versions.VERSIONS)) == versions.KEPT
    assert [n for n in folders(path, versions.COMMITS) if not n.startswith(".")] == folders(path, versions.VERSIONS)


def test_a_reader_at_the_version_before_can_finish(spark, tmp_path):
    path = str(tmp_path / "t")
    write_layer(rows(spark, 10, "old"), path)
    reader = read_layer(spark, path)
    write_layer(rows(spark, 20, "new"), path)
    assert reader.count() == 10 and read_layer(spark, path).count() == 20


def failing(spark, n):
    """Rows whose last task fails, after others have written their files."""
    bad = F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))).otherwise(F.lit("new"))
    return spark.range(0, n, numPartitions=4).select("id", bad.cast("string").alias("tag"), (F.col("id") % 3).alias("day"))


def test_a_write_that_fails_leaves_the_rows_before(spark, tmp_path):
    path = str(tmp_path / "t")
    write_layer(rows(spark, 10, "old"), path, partition_by=["day"])
    with pytest.raises(Exception, match="lost"):
        write_layer(failing(spark, 100), path, partition_by=["day"], lay_out=False)
    assert tags(spark, path) == {("old", 10)}
    assert len(folders(path, versions.VERSIONS)) == 1  # the broken one is gone


def test_refused_metrics_keep_the_rows_before(spark, tmp_path):
    path = str(tmp_path / "t")
    write_layer(rows(spark, 10, "old"), path)

    def accept(seen):
        raise ValueError(f"{seen['n']} rows refused")

    with pytest.raises(ValueError, match="20 rows refused"):
        write_layer(rows(spark, 20, "new"), path, metrics={"n": F.count(F.lit(1))}, accept=accept)
    assert tags(spark, path) == {("old", 10)}


def test_columns_that_only_metrics_read_are_not_written(spark, tmp_path):
    path = str(tmp_path / "t")
    seen = write_layer(rows(spark, 10, "x"), path, metrics={"days": F.max("day")}, unwritten=["day"])
    assert seen == {"days": 2} and read_layer(spark, path).columns == ["id", "tag"]


def test_a_first_write_that_dies_leaves_no_layer(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="lost"):
        write_layer(failing(spark, 100), path)
    assert versions.current_version(spark, path) is None


KILLED = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from strata import versions
from strata.plans import run_pipeline
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {scratch!r}).getOrCreate())
from strata.sinks import parquet
publish = parquet.publish
def killed(session, table, name):
    if table.endswith({layer!r}):
        os._exit(9)  # the version is written whole, but never committed
    publish(session, table, name)
parquet.publish = killed
run_pipeline(spark, {source!r}, {base!r}, run_ts="t2")
"""


ORDER = ("bronze", "rejected", "silver", "gold_sales", "gold_customer", "gold_quality")


def stamps(spark, lake):
    """Run that each layer's rows come from; quarantined rows carry Bronze's stamp."""
    return {name: {r[0] for r in read_layer(spark, getattr(lake, name)).select("execution_datetime").distinct().collect()}
            for name in ORDER if name != "rejected"}


def test_a_run_that_dies_at_any_commit_leaves_every_layer_readable(spark, tmp_path, dirty_csv, monkeypatch):
    """That layer and those after it keep the rows before; the next run is whole."""
    from strata.sinks import parquet

    lake = Lake(str(tmp_path / "lake"))
    run_pipeline(spark, dirty_csv, lake.base, run_ts="t1")
    before = {name: read_layer(spark, getattr(lake, name)).count() for name in LAYERS}
    publish, last = parquet.publish, dict.fromkeys(ORDER, "t1")
    for k, layer in enumerate(ORDER):

        def dies(session, table, name, at=getattr(lake, layer)):
            if table == at:
                raise KeyboardInterrupt  # the version is written whole, but never committed
            publish(session, table, name)

        monkeypatch.setattr(parquet, "publish", dies)
        with pytest.raises(KeyboardInterrupt):
            run_pipeline(spark, dirty_csv, lake.base, run_ts=f"k{k}")
        last |= dict.fromkeys(ORDER[:k], f"k{k}")
        assert stamps(spark, lake) == {n: {t} for n, t in last.items() if n != "rejected"}
        assert {name: read_layer(spark, getattr(lake, name)).count() for name in LAYERS} == before
    monkeypatch.setattr(parquet, "publish", publish)
    run_pipeline(spark, dirty_csv, lake.base, run_ts="t3")
    assert set().union(*stamps(spark, lake).values()) == {"t3"}
    for name in LAYERS:
        assert len(folders(getattr(lake, name), versions.VERSIONS)) == versions.KEPT


def test_a_killed_driver_leaves_the_rows_before(spark, tmp_path, dirty_csv):
    lake = Lake(str(tmp_path / "lake"))
    run_pipeline(spark, dirty_csv, lake.base, run_ts="t1")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = KILLED.format(root=root, scratch=str(tmp_path / "s"), source=dirty_csv, base=lake.base,
                           layer=lake.silver[len(lake.base):])
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert done.returncode == 9, done.stderr[-2000:]
    assert stamps(spark, lake) == {"bronze": {"t2"}} | {n: {"t1"} for n in ORDER if n not in ("bronze", "rejected")}


def test_a_plain_folder_is_a_table_of_its_own_files(spark, tmp_path):
    path = str(tmp_path / "plain")
    rows(spark, 7, "plain").write.parquet(path)
    assert layer_exists(spark, path) and tags(spark, path) == {("plain", 7)}
    write_layer(rows(spark, 8, "new"), path)
    assert tags(spark, path) == {("new", 8)}
