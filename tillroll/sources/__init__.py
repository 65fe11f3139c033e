"""Entity sources and sinks."""

from tillroll.sources.audit import append_audit, audit_row, merge_audit, read_audit
from tillroll.sources.files import read_csv_with_header, read_files
from tillroll.sources.publish import Staged, publish_table, stage_table
from tillroll.sources.sinks import write_output, write_outputs
from tillroll.sources.tables import CatalogTables, MappedTables, ParquetTables, SessionTables, Tables

__all__ = [
    "CatalogTables",
    "MappedTables",
    "ParquetTables",
    "SessionTables",
    "Staged",
    "Tables",
    "append_audit",
    "audit_row",
    "merge_audit",
    "publish_table",
    "read_audit",
    "read_csv_with_header",
    "read_files",
    "stage_table",
    "write_output",
    "write_outputs",
]
