"""Writers."""

from tierforge.sinks.sheet_files import export_files
from tierforge.sinks.sheets import export_path, export_sheets, newest_run, read_findings
from tierforge.sinks.snapshots import ConcurrentWrite, drop_old, newest, read_table, show
from tierforge.sinks.tables import (
    create_if_missing,
    create_or_replace,
    create_table,
    merge_into,
    overwrite,
    upsert_native,
    upsert_partitions,
    upsert_path,
    upsert_table,
    write_by_contract,
)

__all__ = [
    "ConcurrentWrite",
    "create_if_missing",
    "create_or_replace",
    "create_table",
    "drop_old",
    "export_files",
    "export_path",
    "export_sheets",
    "merge_into",
    "newest",
    "newest_run",
    "overwrite",
    "read_findings",
    "read_table",
    "show",
    "upsert_native",
    "upsert_partitions",
    "upsert_path",
    "upsert_table",
    "write_by_contract",
]
