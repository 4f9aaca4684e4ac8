"""Versions of a table: a write that dies leaves the rows before it in place.

A table's folder holds one folder for each version under ``_versions`` and an
empty file for each committed one under ``_commits``. The file's name is the
version's, and creating it is the commit: one call that a file system or an
object store either does or doesn't do. Names begin with a number that grows,
so the current version is the last name. A version without a commit is never
read; the next commit deletes it, and all but the last ``KEPT`` versions (the
one before is kept for readers that are still at it). A table has one writer
at a time.

A folder without commits is a plain table: its own files are its rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from strata.operators.lineage import child

VERSIONS, COMMITS = "_versions", "_commits"
KEPT = 2


def _place(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(str(path))
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; there are a handful of versions at most."""
    file_system, place = _place(spark, folder)
    if not file_system.exists(place):
        return []
    names = [status.getPath().getName() for status in file_system.listStatus(place)]
    return sorted(n for n in names if not n.startswith((".", "_")))


def _delete(spark: SparkSession, path: str) -> None:
    file_system, place = _place(spark, path)
    file_system.delete(place, True)


def _number(name: str) -> int:
    return int(name.split("-")[0])


def current_version(spark: SparkSession, table: str) -> str | None:
    """Name of the version that was committed last."""
    return (_names(spark, child(table, COMMITS)) or [None])[-1]


def version_path(table: str, name: str) -> str:
    return child(table, VERSIONS, name)


def table_path(spark: SparkSession, table: str) -> str:
    """The folder that holds a table's rows now."""
    name = current_version(spark, table)
    return str(table) if name is None else version_path(table, name)


def new_version(spark: SparkSession, table: str) -> str:
    """Name of a version to be written next."""
    last = current_version(spark, table)
    return f"{1 + (_number(last) if last else 0):012d}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, table: str, name: str) -> None:
    """Deletes a version that was not committed."""
    _delete(spark, version_path(table, name))


def publish(spark: SparkSession, table: str, name: str) -> None:
    """Commits a written version, then deletes what no reader needs any more."""
    file_system, place = _place(spark, child(table, COMMITS, name))
    file_system.mkdirs(place.getParent())
    if not file_system.createNewFile(place):
        raise FileExistsError(f"Version {name} of {table} is there already")
    committed = _names(spark, child(table, COMMITS))
    for old in committed[:-KEPT]:
        _delete(spark, child(table, COMMITS, old))
    for old in _names(spark, child(table, VERSIONS)):
        if old not in committed[-KEPT:] and _number(old) <= _number(name):
            _delete(spark, version_path(table, old))
