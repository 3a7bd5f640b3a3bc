"""Spreadsheets -> CSV files, with a manifest of what became of every file."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.sinks.sheet_files import export_files
from tierforge.sinks.sheets import export_path, export_sheets, read_findings
from tierforge.sources.delimited import layouts, text_rows
from tierforge.sources.files import csv_scan
from tierforge.sources.spreadsheets import SPREADSHEET_GLOB, parse_files, workbook_files


def spreadsheet_ingest(
    spark: SparkSession,
    src: str,
    dst: str,
    *,
    first_sheet_only: bool = False,
    encoding: str = "utf-8-sig",
    glob: str = SPREADSHEET_GLOB,
    text_encoding: str | None = None,
    one_file: bool = False,
) -> DataFrame:
    """Export every sheet below ``src`` as CSV below ``dst``; returns the manifest.

    The manifest has a row per sheet (``status`` ok), per file that was really delimited
    text (``text``) and per file that could not be read (``failed``, with the ``error``);
    such a file does not stop the others. It tells what was written; nothing is read again. The
    number of jobs does not depend on the number of files or layouts. ``text_encoding``: see
    ``layouts``. ``one_file``: write plain files, one for each sheet or text file, named as in
    ``export_files``; the manifest then has their names in ``file``.
    """
    found = layouts(spark, src, glob, text_encoding)
    books = [r["path"] for r in found.where("kind = 'workbook'").select("path").collect()]
    files, too_long = workbook_files(spark, books)
    bare = found.where("kind = 'text' and bare").select(
        "path", "header", F.lit(None).cast("array<string>").alias("cells")
    )
    rows = text_rows(spark, found)
    if one_file:
        text = rows.unionByName(bare, allowMissingColumns=True)
        parsed = parse_files(files, first_sheet_only)
        listed = export_files(parsed, src, dst, first_sheet_only, encoding, text)
        failed = found.where("kind = 'failed'").select("path", "error").unionByName(too_long)
        return listed.unionByName(
            failed.withColumn("status", F.lit("failed")), allowMissingColumns=True
        )
    run = export_sheets(
        parse_files(files, first_sheet_only),
        src,
        dst,
        first_sheet_only,
        encoding,
        rows.drop("place").unionByName(bare),
    )
    written = read_findings(spark, run)
    text = written.where("kind = 'text'").groupBy("path").agg(F.sum("rows").alias("rows"))
    failed = found.where("kind = 'failed'").select("path", "error").unionByName(too_long)
    sheets = written.where("kind in ('sheet', 'failed')").select(
        "path",
        "sheet",
        "rows",
        F.when(F.col("kind") == "sheet", "ok").otherwise("failed").alias("status"),
        "error",
    )
    return sheets.unionByName(
        text.withColumn("status", F.lit("text")), allowMissingColumns=True
    ).unionByName(failed.withColumn("status", F.lit("failed")), allowMissingColumns=True)


def exported_scan(
    spark: SparkSession,
    dst: str,
    glob: str = "*.csv",
    columns: Sequence[str] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The files of the newest run whose name matches ``glob``, as ``csv_scan`` reads them.

    Cells may run over lines. The files need not be split for that: none holds more than a
    sheet, or one split of a text file.
    """
    return csv_scan(
        spark, export_path(spark, dst, glob), "*", columns, {"multiLine": "true", **(options or {})}
    )
