"""Lineage columns (P3): which table a row was written to, and in which run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.contracts import LINEAGE_COLUMNS

RUN_TS_FORMAT = "%Y-%m-%dT%H:%M:%S.%fZ"


def run_timestamp(now: dt.datetime | None = None) -> str:
    """Text of an instant (default: now) in UTC with microseconds.

    Taken once per run on the driver and passed to every stamp, so that all
    layers of one run carry the same value.
    """
    instant = now if now is not None else dt.datetime.now(dt.timezone.utc)
    return instant.astimezone(dt.timezone.utc).strftime(RUN_TS_FORMAT)


def child(root: str, *names: str) -> str:
    """A path below ``root``; Hadoop paths use ``/`` whatever their scheme."""
    return "/".join([str(root).rstrip("/"), *names])


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path as the cluster's file systems name it: scheme, authority, absolute path.

    Hadoop resolves it, so a path without a scheme belongs to the default
    file system, not to the driver's working directory. A session without a
    JVM of its own (Spark Connect) keeps the text as given.
    """
    try:
        context = spark.sparkContext
    except Exception as no_jvm:
        if type(no_jvm).__name__ != "PySparkNotImplementedError" and not isinstance(no_jvm, AttributeError):
            raise
        return str(path)
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(str(path))
    file_system = hadoop_path.getFileSystem(context._jsc.hadoopConfiguration())
    return file_system.makeQualified(hadoop_path).toString()


def stamp_literal(df: DataFrame, file_path: str, run_ts: str) -> DataFrame:
    """Set ``file_path`` and ``execution_datetime`` to the given texts."""
    return df.withColumns(dict(zip(LINEAGE_COLUMNS, (F.lit(file_path), F.lit(run_ts)), strict=True)))


def stamp(df: DataFrame, path: str, run_ts: str) -> DataFrame:
    """Stamp rows with the root of the table that they are written to."""
    return stamp_literal(df, qualified_path(df.sparkSession, path), run_ts)
