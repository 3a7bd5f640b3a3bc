"""Find spreadsheet files and parse them, one file per row, inside tasks."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import unquote

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from tierforge.functions.cells import na_cell
from tierforge.sources import ooxml

# Executors need not have this package installed: the parsing code travels with the task.
for _module in (ooxml, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

# The extensions taken for spreadsheets.
SPREADSHEET_GLOB = "*.{xlsx,xlsm,xls,xlx,xlsb}"

ROOT_FOLDER = "_root"

# Columns of ours that stand beside those of a text file, which therefore gets no such names.
PATH_COLUMN = "__path"
RECORD_COLUMN = "__record"
EXPORT_COLUMNS = ("export_kind", "export_folder", "export_file")
RESERVED = (PATH_COLUMN, RECORD_COLUMN, *EXPORT_COLUMNS)

_ORIGIN = re.compile("^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?")

_GLOB_CHARS = re.compile(r"([\[\]{}*?\\])")
_BATCH_ROWS = 4096
_LEGACY_MAGIC = b"\xd0\xcf\x11\xe0"

PARSED = (
    "path string, kind string, sheet string, sheet_idx int, row_idx int, cells array<string>, "
    "rows bigint, error string"
)
_FIELDS = [f.split()[0] for f in PARSED.split(", ")]


def discover(spark: SparkSession, root: str, glob: str = SPREADSHEET_GLOB) -> DataFrame:
    """``path, length`` of the matching files below ``root``; none of their content is read.

    A scan passes over files without bytes, its listing, which the driver holds, does not.
    """
    files = _files(spark, glob).load(root)
    listed = [(re.sub("^file:/+", "file:/", unquote(p)),) for p in files.inputFiles()]
    names = spark.createDataFrame(listed, "path string")
    return names.join(files.select("path", "length"), "path", "left").na.fill(0, ["length"])


def workbook_files(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``path, content`` of the given files, and ``path, error`` of those that do not fit a value.

    The scan packs files into partitions by size (``spark.sql.files.maxPartitionBytes``), so no
    shuffle is needed to spread them. How large a value may be is Spark's own setting.
    """
    if not paths:
        empty = spark.createDataFrame([], "path string, content binary, error string")
        return empty.select("path", "content"), empty.select("path", "error")
    files = _files(spark, None).load([escaped(p) for p in paths])
    most = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength"))
    error = F.concat(F.lit("a workbook is read as one value; too long with "), "length")
    return (
        files.where(F.col("length") <= most).select("path", "content"),
        files.where(F.col("length") > most).select("path", error.alias("error")),
    )


def escaped(path: str) -> str:
    """A path as a reader takes it, whose globs it does not mean."""
    return _GLOB_CHARS.sub(r"\\\1", path)


def _files(spark: SparkSession, glob: str | None) -> DataFrameReader:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader if glob is None else reader.option("pathGlobFilter", glob)


def parse_files(files: DataFrame, first_sheet_only: bool = False) -> DataFrame:
    """Rows and findings of a frame of ``(path, content)``, told apart by ``kind``:

    ``row``     one row of a sheet in ``cells``; ``row_idx`` 0 is the header
    ``sheet``   one per sheet, with the number of data ``rows``
    ``failed``  a file that is no sound workbook, with the ``error``

    A bad file yields its one ``failed`` record and no rows; the others are not touched.
    Missing-value texts in data rows become NULL.
    """

    parse = _parser(first_sheet_only)
    cells = F.when(F.col("row_idx") > 0, F.transform("cells", na_cell)).otherwise(F.col("cells"))
    return files.select("path", "content").mapInPandas(parse, PARSED).withColumn("cells", cells)


def _parser(first_sheet_only: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending = []
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                for record in _records(path, content, first_sheet_only):
                    pending.append(record)
                    if len(pending) == _BATCH_ROWS:
                        yield pd.DataFrame(pending, columns=_FIELDS)
                        pending = []
        if pending:
            yield pd.DataFrame(pending, columns=_FIELDS)

    return parse


def _records(path: str, content: bytes, first_sheet_only: bool) -> Iterator[tuple]:
    def record(kind: str, **values) -> tuple:
        return tuple(map({"path": path, "kind": kind, **values}.get, _FIELDS))

    try:
        book = _open(content)
        # Measuring reads every sheet to its end, so a damaged one shows before any row is out.
        sheets = [_Sheet(book, *s) for s in (book.sheets[:1] if first_sheet_only else book.sheets)]
    except Exception as problem:
        yield record("failed", error=f"{type(problem).__name__}: {problem}")
        return

    for number, sheet in enumerate(sheets):
        yield record("sheet", sheet=sheet.name, sheet_idx=number, rows=max(sheet.length - 1, 0))
        for i, cells in enumerate(sheet.rows()):
            if i == 0:
                cells = ooxml.header_names(cells, sheet.width)
            else:
                cells = cells + [None] * (sheet.width - len(cells))
            yield record("row", sheet=sheet.name, sheet_idx=number, row_idx=i, cells=cells)


def text_header(cells: list[str]) -> list[str]:
    """Column names of a text file, fit for a Spark schema."""
    return ooxml.header_names(cells, len(cells), fold_case=True, reserved=RESERVED)


def _open(content: bytes) -> ooxml.Workbook:
    if content.startswith(_LEGACY_MAGIC):
        raise ValueError("legacy binary workbook")
    if not content.startswith(b"PK\x03\x04"):
        raise ValueError("not a workbook")
    return ooxml.Workbook(content)


class _Sheet:
    """A sheet that has been read once, to its end, to be measured; reading it again holds no row."""

    def __init__(self, book: ooxml.Workbook, name: str, part: str):
        self.name, self._book, self._part = name, book, part
        self.length = self.width = 0
        for cells in book.rows(part):
            self.length += 1
            self.width = max(self.width, len(cells))

    def rows(self) -> Iterator[list[str | None]]:
        return self._book.rows(self._part)


def split_path(path: Column, root: str) -> tuple[Column, Column]:
    """Expressions for the folder of a file below ``root`` (``_root`` at the top) and its name.

    ``root`` is a full path, without globs: where it ends could not be told otherwise.
    """
    if _GLOB_CHARS.search(root):
        raise ValueError(f"{root}: folders cannot be told below a pattern")
    inner = _ORIGIN.sub("", root).strip("/")
    below = f"/{inner}/" if inner else "/"
    bare = F.regexp_replace(path, _ORIGIN.pattern, "")
    outside = F.raise_error(F.concat(path, F.lit(f" is not below {root}"))).cast("string")
    relative = F.when(F.startswith(bare, F.lit(below)), F.substr(bare, F.lit(len(below) + 1)))
    relative = relative.otherwise(outside)
    folder = F.regexp_extract(relative, "^(.*)/[^/]*$", 1)
    return (
        F.when(folder == "", F.lit(ROOT_FOLDER)).otherwise(folder),
        F.substring_index(relative, "/", -1),
    )
