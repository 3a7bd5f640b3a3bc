"""Readers."""

from tierforge.sources.delimited import layouts, text_rows, text_sheets
from tierforge.sources.files import (
    contract_scan,
    csv_quarantine,
    csv_scan,
    read_if_exists,
    table_scan,
)
from tierforge.sources.spreadsheets import (
    SPREADSHEET_GLOB,
    discover,
    parse_files,
    workbook_files,
)

__all__ = [
    "SPREADSHEET_GLOB",
    "contract_scan",
    "csv_quarantine",
    "csv_scan",
    "discover",
    "layouts",
    "parse_files",
    "read_if_exists",
    "table_scan",
    "text_rows",
    "text_sheets",
    "workbook_files",
]
