"""Plan-shape checks: the operators keep the plans we want at scale."""

import os

import pytest

from strata.queries.spark_side import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["customer_order_summary", "orders_last_month", "customer_total_orders"])
def test_distinct_counts_do_not_expand(spark, name):
    assert "Expand" not in optimized(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_evaluation_in_plans(spark, name):
    text = optimized(QUERIES[name](spark, SF_DIR))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in text, node


def test_split_flags_are_broadcast_when_small(spark):
    df = QUERIES["valid_rows"](spark, SF_DIR)
    df.collect()
    text = plan(df)
    assert "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text


def test_key_aggregate_reads_only_the_key(spark):
    df = QUERIES["duplicate_keys"](spark, SF_DIR)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<row_id:bigint>" in text or "struct<row_id:bigint>" in text


def _silver_write_frame(spark, budget):
    from pyspark.sql import functions as F

    from strata.contracts import SILVER_RULES
    from strata.operators.quality import VALID_FLAG, duplicate_set, flag_valid
    from strata.operators.standardize import to_silver
    from strata.queries.spark_side import bronze_rows

    std = to_silver(bronze_rows(spark, SF_DIR))
    sets = [duplicate_set(std, k, broadcast_max_bytes=budget) for k in SILVER_RULES.unique]
    return sets, flag_valid(std, SILVER_RULES, sets=sets).where(F.col(VALID_FLAG))


@pytest.mark.parametrize("budget", [None, -1])
def test_flags_are_joined_once_per_run(spark, tmp_path, monkeypatch, budget):
    """Quarantine and Silver are map-only filters of the staged flagged rows, whatever the sets' size."""
    from strata.contracts import PARTITION_COLUMNS
    from strata.plans import Lake, silver
    from strata.queries.spark_side import bronze_rows
    from strata.sources import read_layer

    staged, written = [], []
    stage, write = silver.stage_table, silver.write_layer
    monkeypatch.setattr(silver, "stage_table", lambda df, *a: (staged.append(optimized(df)), stage(df, *a))[1])
    monkeypatch.setattr(silver, "write_layer", lambda df, *a, **k: (written.append(optimized(df)), write(df, *a, **k))[1])
    lake = Lake(str(tmp_path / "lake"))
    silver.run_silver(spark, bronze_rows(spark, SF_DIR), lake, "t", broadcast_max_bytes=budget)
    assert [text.count("Join LeftOuter") for text in staged] == [2]
    assert len(written) == 2
    for text in written:
        assert "Join" not in text and "Repartition" not in text and "Aggregate" not in text
    assert set(PARTITION_COLUMNS) <= set(read_layer(spark, lake.silver).columns)


def test_sort_merge_fallback_beyond_budget(spark):
    sets, df = _silver_write_frame(spark, -1)
    assert not any(d.broadcast for d in sets)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text or "ShuffledHashJoin" in text


def test_duplicate_scan_pushes_not_null(spark):
    from strata.operators.standardize import to_silver
    from strata.queries.spark_side import bronze_rows

    df = to_silver(bronze_rows(spark, SF_DIR)).select("row_id").where("row_id IS NOT NULL").groupBy("row_id").count()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(row_id)]" in text
    assert "ReadSchema: struct<row_id:bigint>" in text


def test_job_observation_sees_every_row_before_the_filter(spark):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from strata.contracts import SILVER_RULES
    from strata.operators.quality import VALID_FLAG, flag_valid
    from strata.operators.standardize import to_silver
    from strata.queries.spark_side import bronze_rows

    sets, _ = _silver_write_frame(spark, None)
    flagged = flag_valid(to_silver(bronze_rows(spark, SF_DIR)), SILVER_RULES, sets=sets)
    obs = Observation("plan_check")
    df = flagged.observe(obs, F.count(F.lit(1)).alias("rows")).where(F.col(VALID_FLAG))
    df.write.format("noop").mode("overwrite").save()
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    filter_at = next(i for i, line in enumerate(lines) if f"Filter {VALID_FLAG}" in line)
    metrics_at = next(i for i, line in enumerate(lines) if "CollectMetrics" in line)
    assert filter_at < metrics_at  # the filter sits above the observation
    assert not [line for line in lines if "Exchange" in line and "BroadcastExchange" not in line]
    assert obs.get["rows"] == flagged.count()


def test_write_metrics_are_observed_above_the_exchange(spark, tmp_path):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from strata.contracts import PARTITION_COLUMNS
    from strata.queries.spark_side import bronze_rows
    from strata.sinks.parquet import day_layout

    obs = Observation("write_plan_check")
    df = day_layout(bronze_rows(spark, SF_DIR), PARTITION_COLUMNS).observe(obs, F.count(F.lit(1)).alias("n"))
    df.write.format("noop").mode("overwrite").save()
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    metrics_at = next(i for i, line in enumerate(lines) if "CollectMetrics" in line)
    exchange_at = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert metrics_at < exchange_at  # evaluated by the result tasks, after the shuffle
    assert obs.get["n"] == bronze_rows(spark, SF_DIR).count()


def test_day_writes_use_all_tasks_and_split_a_hot_day(spark, tmp_path):
    from pyspark.sql import functions as F

    from strata.sinks.parquet import write_layer, write_tasks
    from strata.sources import read_layer
    from strata.versions import table_path

    rows = spark.range(6_000).select(
        "id", F.when(F.col("id") % 3 == 0, 2_000).otherwise(F.lit(1_900) + (F.col("id") % 40).cast("int")).alias("year"),
        F.lit(1).alias("day"),
    )
    path = str(tmp_path / "t")
    write_layer(rows, path, partition_by=("year", "day"))
    files = {}
    for folder, _, names in os.walk(table_path(spark, path)):
        for name in names:
            if name.endswith(".parquet"):
                files.setdefault(folder.split("year=")[1][:4], []).append(name.split("-")[1])
    tasks = {task for names in files.values() for task in names}
    assert len(tasks) >= write_tasks(rows)
    assert len(set(files["2000"])) > 1  # a third of all rows, several tasks
    assert all(len(names) == 1 for year, names in files.items() if year != "2000")
    assert read_layer(spark, path).count() == 6_000


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("dq_")))
def test_audits_do_not_expand_rows(spark, name):
    assert "Expand" not in optimized(QUERIES[name](spark, SF_DIR))


def test_flagship_scans_the_rows_once(spark):
    text = optimized(QUERIES["customer_order_summary"](spark, SF_DIR))
    assert text.count("Relation [") == 1 and "customer_name#" not in text  # orders per customer and day alone


def test_twenty_thousand_days_and_tasks_plan_at_once(spark, tmp_path):
    """No list of days on the driver or in the plan: the salts are a table that is joined by day."""
    import time

    from pyspark.sql import functions as F

    from strata.sinks.parquet import day_layout

    days = spark.range(0, 1_000_000, numPartitions=4).select("id", (F.col("id") * F.col("id") % 20_011).alias("day"))
    began = time.perf_counter()
    out = day_layout(days, ["day"], tasks=20_000)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert time.perf_counter() - began < 60
    assert "CASE" not in text and len(text) < 20_000
    assert "BroadcastHashJoin" in text and "REPARTITION_BY_NUM" in text
    assert out.columns == ["id", "day"]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_many_hot_days_are_split_and_keep_their_rows(spark, threshold):
    """Broadcast or shuffled, null days too: every row once, no task with more than a few shares."""
    from pyspark.sql import functions as F

    from strata.sinks.parquet import day_layout

    tasks = 64
    rows = spark.range(60_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(None).cast("int")).otherwise((F.col("id") % 100).cast("int")).alias("day"),
        F.lit(1).alias("month"),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = day_layout(rows, ["day", "month"], tasks=tasks)
        assert ("BroadcastHashJoin" in plan(out)) == (threshold != "-1")
        sizes = out.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert sum(r["count"] for r in sizes) == 60_000 and len(sizes) > tasks / 2
        assert max(r["count"] for r in sizes) < 5 * 60_000 / tasks  # the null day alone has a third
        assert out.select("id").distinct().count() == 60_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
