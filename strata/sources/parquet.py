"""Partitioned Parquet layer scan."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.contracts import MSG_LAYER_MISSING
from strata.sources.inventory import _missing
from strata.versions import current_version, table_path


def read_layer(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a layer's current version with partition discovery; a missing layer raises ``FileNotFoundError``.

    Partition columns come back typed as integers and placed last. With
    ``schema`` (the schema the layer was written with) nothing is inferred, so
    an empty layer reads as an empty frame.
    """
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(table_path(spark, str(path)))
    except AnalysisException as e:
        if _missing(e):
            raise FileNotFoundError(MSG_LAYER_MISSING.format(path=path)) from e
        raise


def layer_exists(spark: SparkSession, path: str) -> bool:
    """Whether the layer has a version, or its folder is there, with files or without."""
    if current_version(spark, str(path)) is not None:
        return True
    try:
        read_layer(spark, path)
    except FileNotFoundError:
        return False
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
    return True
