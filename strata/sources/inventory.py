"""Source presence and emptiness checks (S3, S4) over Spark's own file listing.

Spark lists a source's folders (as a job, where there are many) and scans the
listing as a table; a scan leaves out files without bytes, so those are the
names that the listing has and the scan has not. Names stay in the JVM: one
row of figures comes back, whatever the number of files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.classic.column import Column as ClassicColumn

from strata.contracts import MSG_SOURCE_EMPTY, MSG_SOURCE_MISSING


def _missing(e: AnalysisException) -> bool:
    return (e.getCondition() or "") == "PATH_NOT_FOUND" or "Path does not exist" in str(e)


@dataclass(frozen=True)
class Inventory:
    files: int
    bytes: int


def source_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, length)`` of every file of a source at any depth, those without bytes too.

    Marker and hidden files are not part of a source. Globs may be used. A
    missing path raises ``FileNotFoundError``. No file is opened.
    """
    try:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(path))
    except AnalysisException as e:
        if _missing(e):
            raise FileNotFoundError(MSG_SOURCE_MISSING.format(path=path)) from e
        raise
    # The names become a literal inside the JVM: none is fetched one by one.
    names = ClassicColumn(spark.sparkContext._jvm.org.apache.spark.sql.functions.lit(listing._jdf.inputFiles()))
    every = spark.range(1).select(F.explode(names).alias("path"))
    sized = listing.select(F.col("_metadata.file_path").alias("_scanned"), F.col("_metadata.file_size").alias("_size"))
    found = every.join(sized, _one_form("path") == _one_form("_scanned"), "left")
    return found.select("path", F.coalesce("_size", F.lit(0)).cast("bigint").alias("length"))


def _one_form(path: str) -> Column:
    """``file:/x`` and ``file:///x`` are one path."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def check_source(spark: SparkSession, path: str) -> Inventory:
    """Raise when the source is missing, has no file, or has one without bytes; else its size."""
    seen = source_files(spark, path).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
        F.min(F.when(F.col("length") == 0, F.col("path"))).alias("empty"),
    ).first()
    if seen["empty"] is not None or not seen["files"]:
        raise ValueError(MSG_SOURCE_EMPTY.format(path=seen["empty"] or path))
    return Inventory(seen["files"], seen["bytes"])
