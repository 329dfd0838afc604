"""Scans, the districts fixture, and sinks."""

from hearth.sources.fixtures import DISTRICTS_SQL, RAW_AVERAGES_SQL, districts, raw_averages
from hearth.sources.tables import TABLES, read_table, scan_table, table_path

__all__ = ["DISTRICTS_SQL", "RAW_AVERAGES_SQL", "TABLES", "districts", "raw_averages", "read_table", "scan_table", "table_path"]
