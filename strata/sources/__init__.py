"""Sources: strict CSV, file inventory, Parquet layers, driver-table adapter."""

from strata.sources.csv import check_headers, conforms, file_heads, parsed_rows, read_checked, validate_header
from strata.sources.inventory import Inventory, check_source, source_files
from strata.sources.parquet import layer_exists, read_layer
from strata.sources.tables import orders_source, table

__all__ = [
    "Inventory",
    "check_headers",
    "check_source",
    "conforms",
    "file_heads",
    "layer_exists",
    "orders_source",
    "parsed_rows",
    "read_checked",
    "read_layer",
    "source_files",
    "table",
    "validate_header",
]
