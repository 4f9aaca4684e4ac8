"""Layer writers (K1-K6).

A table partitioned by day is laid out before it is written: rows are dealt
by day over as many tasks as the session shuffles to, a number that adaptive
execution leaves alone. What a day costs is its file, not its bytes, so days
that are small in bytes must not end in one task. A hot day is split: one that
holds more than a task's share of all rows is dealt under several salts, in
proportion. How many salts a day has stands in a table, joined by day
(broadcast within the budget, else shuffled), so neither the plan nor the
driver holds a list of days.

A write goes to a version of its own and is published when it is whole (see
``strata.versions``); until then, and if it fails, readers have the rows of
the version before.

Metrics observed on a write are attached *above* the exchange, so they are
computed by the write's result tasks. Result-task accumulator updates are
applied once per partition even when tasks or stages are re-run after an
executor loss; updates from a shuffle-map stage are not.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.operators.lineage import child
from strata.operators.observe import collected
from strata.operators.quality import broadcast_budget
from strata.session import stage_table, work_folder
from strata.versions import discard, new_version, publish, version_path

#: Estimated bytes of a day in a broadcast table of salts.
SALT_ROW_BYTES = 160


def write_tasks(df: DataFrame) -> int:
    """Tasks a laid-out write is dealt to."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def hot_days(sizes: DataFrame, keys: Sequence[str], tasks: int, folder: str | None = None) -> tuple[DataFrame, int]:
    """``(_hot_0, ..., _salts)`` of every value of ``keys`` with over half a task's share; and their number.

    At most ``2 * tasks`` values are hot. The counts are staged in ``folder``.
    """
    counts = sizes.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    counts, seen = stage_table(counts, "day_sizes", {"total": F.sum("_rows")}, folder)
    share = max(1, math.ceil((seen["total"] or 0) / (2 * tasks)))
    hot = counts.where(F.col("_rows") > share).select(
        *[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)],
        F.ceil(F.col("_rows") / F.lit(share)).cast("bigint").alias("_salts"),
    )
    return hot, hot.count()


def day_layout(
    df: DataFrame, keys: Sequence[str], sizes: DataFrame | None = None, tasks: int | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Rows dealt by ``keys`` over ``tasks`` tasks, hot values over several.

    ``sizes`` is a frame with the same rows per key that is cheaper to count
    (a written table, a pruned scan); by default ``df`` itself is counted.
    """
    keys, n = list(keys), tasks or write_tasks(df)
    hot, n_hot = hot_days(df if sizes is None else sizes, keys, n, folder)
    if not n_hot:
        return df.repartition(n, *keys)
    small = n_hot * SALT_ROW_BYTES <= broadcast_budget(df, None)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & df[k].eqNullSafe(hot[f"_hot_{i}"])
    salted = df.join(F.broadcast(hot) if small else hot.hint("merge"), same, "left")
    # The salt is taken from the row itself: a recomputed task deals its rows alike.
    of_row = F.xxhash64(*([c for c in df.columns if c not in keys] or keys))
    salt = F.pmod(of_row, F.coalesce(F.col("_salts"), F.lit(1)))
    return salted.repartition(n, *keys, salt).select(*df.columns)


def write_layer(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    metrics: dict[str, Column] | None = None,
    lay_out: bool = True,
    sizes: DataFrame | None = None,
    unwritten: Sequence[str] = (),
    accept: Callable[[dict], None] | None = None,
) -> dict:
    """Replace the table at ``path`` by ``df``, Hive-partitioned by ``partition_by``.

    ``metrics`` (aggregate expressions by name) are observed by the write job
    itself and returned, without a separate scan; they may read columns in
    ``unwritten``, which the table does not get. ``accept`` sees them before
    the new version is published and raises to keep the old one.
    ``lay_out=False`` skips the shuffle: for a map-only derivation of a table
    laid out by the same partition columns, and for constant partition
    columns. ``sizes`` is passed to ``day_layout``.
    """
    spark, path = df.sparkSession, str(path)
    name = new_version(spark, path)
    try:
        with work_folder(spark) as work:
            out = df
            if partition_by and lay_out:
                out = day_layout(df, partition_by, sizes, folder=child(work, "day_sizes"))
            obs = None
            if metrics:
                obs = Observation(f"write_{uuid.uuid4().hex[:8]}")
                out = out.observe(obs, *[e.alias(k) for k, e in metrics.items()])
            writer = out.drop(*unwritten).write
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.parquet(version_path(path, name))
            values = collected(obs, df, metrics) if metrics else {}
        if accept:
            accept(values)
    except BaseException:
        discard(spark, path, name)
        raise
    publish(spark, path, name)
    return values
