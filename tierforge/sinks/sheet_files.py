"""Export of sheets as plain CSV files, one a sheet: ``<subfolder>/<workbook>__<sheet slug>.csv``.

A Python data source writes them. Each task writes its sheets below a folder of its own attempt; what
it has written travels with its commit message, and when all tasks are done the files are moved to
their names, which two tasks may have chosen alike. A task that fails or is repeated leaves nothing
to be seen. The messages are the manifest, so nothing is read again to make it.

One file means one writer: a sheet is parsed by one task anyway, but the lines of a text file are
brought to one task and sorted there. ``export_sheets`` writes such files in parts instead.
"""

from __future__ import annotations

import codecs
import json
import re
import sys
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tierforge.functions.cells import csv_line
from tierforge.functions.names import slug
from tierforge.sources.spreadsheets import ROOT_FOLDER, split_path
from tierforge.storage import Folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SCHEMA = "path string, folder string, stem string, book string, slug string, kind string, sheet string, rows long, error string, line string"
MANIFEST = "path string, sheet string, rows long, status string, file string, error string"
_MANIFESTS = "_manifests"


def export_files(
    parsed: DataFrame,
    root: str,
    dst: str,
    first_sheet_only: bool = False,
    encoding: str = "utf-8-sig",
    text: DataFrame | None = None,
) -> DataFrame:
    """Write every sheet, and every ``text`` file, as one CSV file below ``dst``; returns the manifest.

    ``text`` has ``path, header, cells, place``, the place being that of a row in its file; a row
    without ``cells`` stands for a file that has but a header. The manifest has a row for each sheet
    (``status`` ok), text file (``text``) and file that could not be parsed or written (``failed``). Of
    sheets whose names come out alike, the first by path keeps the short name; the others get the
    whole name of their workbook, and if need be the number of their sheet. An empty sheet is
    listed, not written. Files of earlier runs stay, unless a new one takes their name.
    """
    spark = parsed.sparkSession
    codecs.lookup(encoding)
    spark.dataSource.register(SheetFiles)
    folder, book = split_path(F.col("path"), Folder(spark, root).path)
    stem = F.regexp_replace(book, r"\.[^.]*$", "")
    named = F.when(F.lit(first_sheet_only) | F.col("sheet").isNull(), "").otherwise(slug(F.col("sheet")))
    lines = parsed.select(
        "path", folder.alias("folder"), stem.alias("stem"), book.alias("book"), named.alias("slug"),
        "kind", "sheet", "rows", "error", csv_line(F.col("cells")).alias("line"),
    )
    if text is not None:
        lines = lines.unionByName(
            _text_lines(text).select(
                "path", folder.alias("folder"), stem.alias("stem"), book.alias("book"),
                F.lit("").alias("slug"), "kind", "line",
            ),
            allowMissingColumns=True,
        )
    run, place = uuid.uuid4().hex, Folder(spark, dst).path
    lines.write.format("sheet_files").mode("append").options(
        target=place, encoding=encoding, run=run
    ).save()
    return spark.read.schema(MANIFEST).json(f"{place}/{_MANIFESTS}/{run}.json")


def _text_lines(text: DataFrame) -> DataFrame:
    """``path, kind, line``: a file's header, then its rows in their order, in one task."""
    rows = text.select(
        "path",
        F.col("place").alias("at"),
        F.when(F.col("cells").isNotNull(), csv_line(F.col("cells"))).alias("line"),
        csv_line(F.col("header")).alias("head"),
    )
    ordered = rows.repartition("path").sortWithinPartitions("path", F.col("at").asc_nulls_first())
    # The first row of a file brings the header along.
    first = "path string, kind string, line string"

    def with_heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for batch in batches:
            out = []
            for path, line, head in zip(batch["path"], batch["line"], batch["head"], strict=True):
                if path != last:
                    last = path
                    out.append((path, "head", head))
                if line is not None:
                    out.append((path, "text row", line))
            yield pd.DataFrame(out, columns=["path", "kind", "line"])

    return ordered.select("path", "line", "head").mapInPandas(with_heads, first)


@dataclass
class _Written(WriterCommitMessage):
    """What a task has written: the entries of the manifest, and where the files are."""

    entries: list[dict]


class SheetFiles(DataSource):
    """Lines of sheets, each sheet's in one piece, as files."""

    @classmethod
    def name(cls) -> str:
        return "sheet_files"

    def schema(self) -> str:
        return _SCHEMA

    def writer(self, schema, overwrite: bool) -> SheetWriter:
        return SheetWriter(self.options["target"], self.options["encoding"], self.options["run"])


class SheetWriter(DataSourceWriter):
    def __init__(self, target: str, encoding: str, run: str):
        self.target, self.encoding, self.run = target, encoding, run

    def _place(self) -> tuple[pyarrow.fs.FileSystem, str]:
        fs, base = pyarrow.fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", self.target))
        return fs, base.rstrip("/")

    def write(self, iterator: Iterable[Row]) -> _Written:
        fs, base = self._place()
        attempt = f"{base}/_attempt-{self.run}/{uuid.uuid4().hex}"
        fs.create_dir(attempt)
        entries: list[dict] = []
        now: dict | None = None
        stream = None

        def close() -> None:
            nonlocal stream
            if stream is not None:
                stream.close()
                stream = None

        for row in iterator:
            if row["kind"] in ("failed", "sheet", "head"):
                close()
                now = {k: row[k] for k in ("path", "folder", "stem", "book", "slug", "sheet", "rows", "error")}
                now |= {"status": {"failed": "failed", "sheet": "ok", "head": "text"}[row["kind"]], "temp": None}
                entries.append(now)
                if row["kind"] == "head":
                    now["rows"] = 0
            if row["line"] is None or now["status"] == "failed":
                continue
            if now["temp"] is None:
                now["temp"] = f"{attempt}/{len(entries)}"
                stream = fs.open_output_stream(now["temp"], compression=None)
                if self.encoding.lower() in ("utf-8-sig", "utf_8_sig"):
                    stream.write(codecs.BOM_UTF8)
            try:
                stream.write((row["line"] + "\n").encode(self._plain()))
            except UnicodeEncodeError as problem:
                close()
                fs.delete_file(now["temp"])
                now |= {"status": "failed", "temp": None, "rows": None, "error": str(problem)}
                continue
            if row["kind"] == "text row":
                now["rows"] += 1
        close()
        return _Written(entries)

    def _plain(self) -> str:
        return "utf-8" if self.encoding.lower() in ("utf-8-sig", "utf_8_sig") else self.encoding

    def commit(self, messages: list[_Written | None]) -> None:
        fs, base = self._place()
        entries = [e for m in messages if m is not None for e in m.entries]
        taken: set[str] = set()
        number: dict[str, int] = {}
        lines = []
        for entry in sorted(entries, key=lambda e: e["path"]):
            number[entry["path"]] = number.get(entry["path"], -1) + 1
            name = None
            if entry["temp"] is not None:
                end = f"__{entry['slug']}" if entry["slug"] else ""
                choices = (f"{entry['stem']}{end}", f"{entry['book']}{end}", f"{entry['book']}{end}_{number[entry['path']]}")
                folder = "" if entry["folder"] == ROOT_FOLDER else f"{entry['folder']}/"
                name = next(n for c in choices if (n := f"{folder}{c}.csv").lower() not in taken)
                taken.add(name.lower())
                fs.create_dir(f"{base}/{folder}".rstrip("/"))
                fs.move(entry["temp"], f"{base}/{name}")
            lines.append(json.dumps({k: entry[k] for k in ("path", "sheet", "rows", "status", "error")} | {"file": name}))
        fs.create_dir(f"{base}/{_MANIFESTS}")
        with fs.open_output_stream(f"{base}/{_MANIFESTS}/{self.run}.json") as out:
            out.write("".join(line + "\n" for line in lines).encode())
        self._clear(fs, base)

    def abort(self, messages: list[_Written | None]) -> None:
        self._clear(*self._place())

    def _clear(self, fs: pyarrow.fs.FileSystem, base: str) -> None:
        if fs.get_file_info(f"{base}/_attempt-{self.run}").type != pyarrow.fs.FileType.NotFound:
            fs.delete_dir(f"{base}/_attempt-{self.run}")


__all__ = ["MANIFEST", "SheetFiles", "export_files"]
