"""Sources: schema conformance, header-aware CSV batches, staged tables and fixtures."""

from fleetsight.sources.conform import conform_to_schema, union_all
from fleetsight.sources.csv import discover_batch_files, file_headers, read_csv_batches
from fleetsight.sources.tables import load_optional_tables, read_table

__all__ = [
    "conform_to_schema",
    "union_all",
    "discover_batch_files",
    "file_headers",
    "read_csv_batches",
    "load_optional_tables",
    "read_table",
]
