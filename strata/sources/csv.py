"""Strict typed CSV source.

* Headers are checked first, from the head of every file and nothing else: the
  first line must be the contract's header, exactly and in order, case
  included. A file with another header fails the source before a row is read.
* Rows are parsed once, where they are used, into the contract's types. A row
  with fewer or more fields, or with a text where a number belongs, is
  malformed and kept beside its text, so that whoever writes the rows counts
  such rows in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.contracts import MSG_BAD_HEADER, MSG_MALFORMED, RAW_COLUMNS, RAW_SCHEMA
from strata.operators.lineage import child
from strata.session import scratch_path

CORRUPT_COLUMN = "_corrupt_record"
#: More bytes than a file has: no file is cut, and each is a task of its own.
WHOLE_FILE = 1 << 45


def validate_header(columns: Sequence[str], expected: Sequence[str] = RAW_COLUMNS) -> None:
    """Exact, ordered equality with the contract; else ``ValueError``."""
    if tuple(columns) != tuple(expected):
        raise ValueError(MSG_BAD_HEADER.format(expected=tuple(expected), actual=tuple(columns)))


def file_heads(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """``(file, head)``: the first line with text of every file, staged; null where there is none.

    A session of its own reads each file as one task, which stops at that
    line; the rest of the file is not read.
    """
    reader = spark.newSession()
    reader.conf.set("spark.sql.files.maxPartitionBytes", str(WHOLE_FILE))
    reader.conf.set("spark.sql.files.openCostInBytes", str(WHOLE_FILE))
    reader.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")

    def first_line(batches):
        for batch in batches:
            if batch.num_rows and batch.column(1)[0].as_py().strip():
                yield batch.slice(0, 1)
                return

    lines = reader.read.option("recursiveFileLookup", True).text(str(path))
    heads = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("head"))
    folder = folder or child(scratch_path(spark, "csv_heads"))
    heads.mapInArrow(first_line, heads.schema).write.mode("overwrite").parquet(folder)
    return spark.read.schema(heads.schema).parquet(folder)


def conforms(head: str | Column, names: Sequence[str] = RAW_COLUMNS) -> Column:
    """Whether a line is the header ``names``; false for null."""
    kind = ", ".join(f"`{c}` string" for c in [*names, CORRUPT_COLUMN])
    fields = F.from_csv(head, kind, {"columnNameOfCorruptRecord": CORRUPT_COLUMN, "mode": "PERMISSIVE"})
    same = fields.isNotNull() & fields[CORRUPT_COLUMN].isNull()
    for name in names:
        same = same & fields[name].eqNullSafe(F.lit(name))
    return F.coalesce(same, F.lit(False))


def check_headers(
    spark: SparkSession, path: str, names: Sequence[str] = RAW_COLUMNS, folder: str | None = None
) -> None:
    """S2 for every file: raises with the header of the first one that differs."""
    other = file_heads(spark, path, folder).where(~conforms("head", names)).orderBy("file").first()
    if other is not None:
        found = tuple((other["head"] or "").split(","))
        raise ValueError(MSG_BAD_HEADER.format(expected=tuple(names), actual=found) + f" in {other['file']}")


def parsed_rows(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA) -> DataFrame:
    """The rows behind the headers, typed; ``_corrupt_record`` holds a malformed row's text, else null.

    Lazy, and pruned: a query that needs one column parses that column alone.
    """
    kind = StructType([*schema.fields, StructField(CORRUPT_COLUMN, StringType(), True)])
    reader = spark.read.schema(kind).option("header", True).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN).option("recursiveFileLookup", True)
    return reader.csv(str(path))


def malformed() -> Column:
    """Malformed rows, as an aggregate over ``parsed_rows``."""
    return F.count_if(F.col(CORRUPT_COLUMN).isNotNull())


def refuse_malformed(count: int | None, path: str) -> None:
    if count:
        raise ValueError(MSG_MALFORMED.format(count=int(count), path=path))


def read_checked(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA) -> DataFrame:
    """The source's rows, once all headers and rows have passed.

    For readers; a job that writes the rows counts the malformed ones on its
    write instead (``plans.bronze``) and parses them once.
    """
    check_headers(spark, path, schema.names)
    rows = parsed_rows(spark, path, schema)
    # Every column takes part, else the parser would leave out what makes a row malformed.
    full = rows.select("*", F.xxhash64(*schema.names).alias("_row"))
    seen = full.agg(malformed().alias("bad"), F.max("_row").alias("_row")).first()
    refuse_malformed(seen["bad"], path)
    return rows.drop(CORRUPT_COLUMN)
