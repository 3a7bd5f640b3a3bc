"""The layers: spreadsheets -> CSV -> bronze -> silver -> gold."""

from tierforge.plans.bronze import bronze_load, bronze_rows, load_bronze
from tierforge.plans.gold import days_of, load_gold, refresh_gold, sales_summary, touched_days
from tierforge.plans.silver import fact_rows, load_facts, load_silver, silver_merge
from tierforge.plans.spreadsheet_ingest import exported_scan, spreadsheet_ingest
from tierforge.plans.statements import UnsupportedStatement, run_statement
from tierforge.plans.sql_template import load_from_template, run_template

__all__ = [
    "UnsupportedStatement",
    "bronze_load",
    "bronze_rows",
    "days_of",
    "exported_scan",
    "fact_rows",
    "load_bronze",
    "load_facts",
    "load_from_template",
    "load_gold",
    "load_silver",
    "refresh_gold",
    "run_statement",
    "run_template",
    "sales_summary",
    "silver_merge",
    "spreadsheet_ingest",
    "touched_days",
]
