"""Sources and sinks: bronze CSV catalogue, landing ingest, test-data adapter."""

from marketlake.sources.catalog import SOURCES, bronze_schema
from marketlake.sources.csv import discover_landing, read_bronze, read_bronze_all
from marketlake.sources.sinks import ingest_bronze, register_views, write_table
from marketlake.sources.testdata import bronze_from_testdata

__all__ = [
    "SOURCES", "bronze_schema", "read_bronze", "read_bronze_all", "discover_landing",
    "ingest_bronze", "write_table", "register_views", "bronze_from_testdata",
]
