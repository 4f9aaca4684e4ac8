"""Exact deduplication: a stream over disk-backed keyed state, bytes checked on hits.

Documents are read as a stream of files. Each is normalised (A-Z lower-cased),
and its digest is the key of a streaming aggregation whose state lives in
RocksDB under the operator's folder and never expires. The state of a digest
is the number of its rows and, of the row with the largest id, the stable
identifier and the content locator (file, row in the file). Rows of a task
are aggregated before they are shuffled, so a digest that holds a third of
all rows arrives as a row a task. Every micro-batch writes the states that it
changed to a ledger; a batch that is run again overwrites its part, and a
later run takes up the files that came since.

A digest seen more than once is a hit. The full bytes of its rows are compared
then: rows whose digest may be a hit (a Bloom filter of the hits, where that
is small) are grouped by digest and bytes, again aggregated per task first. A
digest that stands for several contents falls apart into one class for each.

Cases: null and empty texts are equal; a null id is smaller than any other;
of rows with the largest id the one with the last locator stays, so repeated
rows keep one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.text import LOWER_ASCII, raw
from strata.operators.keyfilter import filter_bytes, key_filter, may_hold
from strata.operators.lineage import child
from strata.operators.quality import broadcast_budget
from strata.session import scratch_path, stage_table

#: Least number of micro-batches that a run deals its files to: a lost driver repeats one of them.
BATCHES = 4
DIGEST_BYTES = 32
#: Where state is kept: on disk, checkpointed by its changes, without space taken in advance for each of many stores.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
PLACED = "doc_id long, file string, row long, digest binary, sha256 string"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB; the session's settings come back."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def placed(docs: DataFrame) -> DataFrame:
    """Id, text and content locator of every row of a file scan, batch or stream."""
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *place)


def with_digests(rows: DataFrame, digest_bytes: int = DIGEST_BYTES, bodies: bool = False) -> DataFrame:
    """doc_id, locator, digest (a prefix of the SHA-256) and on request the normalised bytes; map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                texts = [raw(t.as_py()).translate(LOWER_ASCII) for t in part.column(1)]
                full = [hashlib.sha256(t) for t in texts]
                digest = pa.array([h.digest()[:digest_bytes] for h in full], pa.binary())
                columns = [part.column(0), part.column(2), part.column(3), digest, pa.array([h.hexdigest() for h in full])]
                names = ["doc_id", "file", "row", "digest", "sha256"]
                if bodies:
                    columns, names = [*columns, pa.array(texts, pa.binary())], [*names, "body"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, PLACED + (", body binary" if bodies else ""))


def last_row() -> F.Column:
    """Id and locator of the row that stays: the largest id, then the last locator."""
    return F.max(F.struct("doc_id", "file", "row"))


def absorb(
    spark: SparkSession, path: str, folder: str, *, batches: int = BATCHES, digest_bytes: int = DIGEST_BYTES
) -> None:
    """Streams the Parquet files of ``path`` that ``folder``'s state has not seen into it."""
    known = spark.read.parquet(path)
    files = max(1, math.ceil(len(known.inputFiles()) / batches))
    # A pattern: the source would take a path that is one file for a folder.
    stream = spark.readStream.schema(known.schema).option("maxFilesPerTrigger", files).parquet(f"{path[:-1]}[{path[-1]}]")
    state = with_digests(placed(stream), digest_bytes).groupBy("digest").agg(
        F.count(F.lit(1)).alias("rows"), last_row().alias("keep")
    )

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(child(folder, "ledger", f"batch={batch}"))

    with state_on_disk(spark):
        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", child(folder, "state"))
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
        )
    query.awaitTermination()


def classes(spark: SparkSession, folder: str) -> DataFrame:
    """digest, rows and the row that stays, as the last batch that touched a digest left them."""
    kind = "digest binary, rows long, keep struct<doc_id:long, file:string, row:long>, batch long"
    spark.createDataFrame([], kind).drop("batch").write.mode("overwrite").parquet(child(folder, "ledger", "batch=-1"))
    ledger = spark.read.schema(kind).parquet(child(folder, "ledger"))
    last = ledger.groupBy("digest").agg(F.max_by(F.struct("rows", "keep"), "batch").alias("last"))
    return last.select("digest", "last.rows", "last.keep")


def mixed_bodies(docs: DataFrame, hits: DataFrame, n_hits: int, digest_bytes: int) -> DataFrame:
    """digest, body, rows, keep of the contents of those hits that stand for more than one."""
    bodies = with_digests(placed(docs), digest_bytes, bodies=True)
    if filter_bytes(n_hits) <= broadcast_budget(docs, None):
        bodies = may_hold(bodies, "digest", key_filter(hits, "digest", n_hits), n_hits)
    # Grouped by the bytes themselves: that is the check.
    found = bodies.join(hits.select("digest"), "digest", "left_semi").groupBy("digest", "body").agg(
        F.count(F.lit(1)).alias("rows"), last_row().alias("keep")
    )
    found = stage_table(found, "dedup_bodies")[0]
    several = found.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    return found.join(several, "digest", "left_semi")


def exact_classes(
    spark: SparkSession, path: str, *, folder: str | None = None, batches: int = BATCHES, digest_bytes: int = DIGEST_BYTES
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document of ``path``."""
    folder = folder or scratch_path(spark, "exact_dedup")
    absorb(spark, path, folder, batches=batches, digest_bytes=digest_bytes)
    metrics = {"hits": F.count_if(F.col("rows") > 1)}
    found, counted = stage_table(classes(spark, folder), "dedup_classes", metrics)
    docs = spark.read.parquet(path)
    rows = with_digests(placed(docs), digest_bytes)
    if counted["hits"]:
        mixed, counted = stage_table(
            mixed_bodies(docs, found.where("rows > 1"), counted["hits"], digest_bytes), "dedup_mixed",
            {"mixed": F.count(F.lit(1))},
        )
        if counted["mixed"]:
            apart = mixed.select("digest").distinct()
            split = with_digests(placed(docs), digest_bytes, bodies=True).join(mixed, ["digest", "body"])
            whole = rows.join(apart, "digest", "left_anti").join(found, "digest")
            return answer(whole).unionByName(answer(split))
    return answer(rows.join(found, "digest"))


def answer(rows: DataFrame) -> DataFrame:
    stays = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
    return rows.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("rows").alias("group_size"), stays.alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )
