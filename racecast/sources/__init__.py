"""Reading the race tables and looking at what was read."""

from racecast.sources.csv_files import CsvTable, found_types, infer, read_csv
from racecast.sources.schemas import SCHEMAS
from racecast.sources.tables import load_all, load_table, preview, schema_report

__all__ = [
    "SCHEMAS", "CsvTable", "found_types", "infer", "load_all", "load_table", "preview", "read_csv", "schema_report",
]
