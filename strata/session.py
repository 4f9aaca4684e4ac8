"""Session-level helpers: the shared checkpoint folder and working tables in it.

Lineage is cut with written tables under the folder that the cluster names in
``spark.checkpoint.dir``. Where a session names none, a folder under its
warehouse, which is shared too, takes its place. Each application has one
folder there; ``clear_scratch`` deletes it, ``work_folder`` gives a run one of
its own that goes when the run ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from strata.operators.lineage import child
from strata.operators.observe import collected

SCRATCH_NAME = "strata-scratch"


def shared_root(spark: SparkSession) -> str:
    """The folder for working tables: the configured one, else one under the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or child(spark.conf.get("spark.sql.warehouse.dir"), "_checkpoints")


def session_id(spark: SparkSession) -> str:
    """Identifier of the running application (stable for the session)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's folder for a written table."""
    return child(shared_root(spark), SCRATCH_NAME, session_id(spark), uuid.uuid4().hex, name)


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder through its Hadoop file system, if it is there."""
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes this application's working tables; frames that read them can't be used after."""
    delete_path(spark, child(shared_root(spark), SCRATCH_NAME, session_id(spark)))


@contextmanager
def work_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for one run's working tables, deleted when the run ends, well or not."""
    path = scratch_path(spark, "work")
    try:
        yield path
    finally:
        delete_path(spark, path.rsplit("/", 1)[0])


def stage_table(
    df: DataFrame, name: str, metrics: dict[str, Column] | None = None, path: str | None = None
) -> tuple[DataFrame, dict]:
    """Write ``df`` as a Parquet table under the shared folder and read it back.

    Cuts lineage and survives executor loss (the files live in shared
    storage). Without ``path`` a fresh scratch location is used; a given
    ``path`` is overwritten. ``metrics`` are aggregate expressions observed by
    the write job itself (computed from the written table if adaptive
    execution dropped them).
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    obs = Observation(f"{name}_{uuid.uuid4().hex[:8]}") if metrics else None
    (df.observe(obs, *[e.alias(k) for k, e in metrics.items()]) if obs else df).write.mode("overwrite").parquet(path)
    # The schema is known: nothing is inferred, so an empty table reads as one.
    table = spark.read.schema(df.schema).parquet(path)
    return table, (collected(obs, table, metrics) if metrics else {})
