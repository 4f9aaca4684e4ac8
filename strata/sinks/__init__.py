"""Sinks: partitioned Parquet layers and byte-exact CSV."""

from strata.sinks.csv import write_csv
from strata.sinks.parquet import write_layer

__all__ = ["write_csv", "write_layer"]
