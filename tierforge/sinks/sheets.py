"""CSV export of parsed spreadsheets.

Every run writes into a folder of its own below the destination, and is then published as the
newest (a small numbered file in ``_published``); reading back takes the newest run, so a workbook
or sheet that is gone leaves nothing behind. Layout of a run::

    export_kind=csv/export_folder=<subfolder or _root>/export_file=<file>/part-...
    export_kind=findings/...

``<file>`` is ``<workbook>__<nr>_<sheet slug>.csv`` or ``<text file>.csv``; the findings are what
was parsed and written, as JSON lines. File names keep the whole workbook name and the sheet's
number, so that ``a.xls`` next to ``a.xlsx``, or two sheets whose names slug alike, never share a
file.
"""

from __future__ import annotations

import datetime as dt
import json
import sys
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierforge.functions.cells import csv_line
from tierforge.functions.names import slug
from tierforge.sources.spreadsheets import EXPORT_COLUMNS, split_path
from tierforge.storage import Folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FINDINGS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("path", "kind", "sheet")]
    + [T.StructField("sheet_idx", T.IntegerType()), T.StructField("rows", T.LongType())]
    + [T.StructField("error", T.StringType())]
)

_PUBLISHED = "_published"
_BOM = "\ufeff"

# Accepted encoding names, and what Spark calls them.
_ENCODINGS = {
    "utf-8": "UTF-8",
    "utf-8-sig": "UTF-8",
    "latin-1": "ISO-8859-1",
    "iso-8859-1": "ISO-8859-1",
    "ascii": "US-ASCII",
}


def newest_run(spark: SparkSession, dst: str) -> str | None:
    """The folder of the run published last."""
    published = Folder(spark, f"{dst.rstrip('/')}/{_PUBLISHED}")
    marks = [n for n in published.names() if n.endswith(".json")]
    return f"{dst.rstrip('/')}/{json.loads(published.read(max(marks)))['run']}" if marks else None


def export_path(spark: SparkSession, dst: str, glob: str = "*.csv") -> str:
    """Path pattern of the files of the newest run whose name matches ``glob``."""
    run = newest_run(spark, dst)
    if run is None:
        raise LookupError(f"nothing has been exported to {dst}")
    return f"{run}/export_kind=csv/export_folder=*/export_file={glob}"


def export_sheets(
    parsed: DataFrame,
    root: str,
    dst: str,
    first_sheet_only: bool = False,
    encoding: str = "utf-8-sig",
    text: DataFrame | None = None,
) -> str:
    """Write the rows of sheets, and of ``text`` files, as CSV, and all findings, in one job.

    ``text`` has ``path, header, cells``; a row without ``cells`` stands for a file that has but a
    header. Returns the folder of the run.

    A sheet is parsed by one task and sorted there, so it becomes one file, header first. A large
    text file comes in many splits and becomes as many part files, each with the header. Tasks
    write side by side and nothing is shuffled.
    """
    spark = parsed.sparkSession
    charset = _charset(encoding)
    folder, book = split_path(F.col("path"), Folder(spark, root).path)
    number = F.col("sheet_idx").cast("string")
    sheet = F.concat(F.lit("__"), number, F.lit("_"), slug(F.col("sheet")))
    named = F.when(F.col("sheet_idx").isNull() | F.lit(first_sheet_only), "").otherwise(sheet)
    lines = parsed.withColumn("value", csv_line(F.col("cells"))).drop("cells")
    if text is not None:
        lines = lines.unionByName(_text_lines(text), allowMissingColumns=True)
    line = F.col("value")
    if encoding.lower() == "utf-8-sig":
        line = F.when(F.col("row_idx") == 0, F.concat(F.lit(_BOM), line)).otherwise(line)
    if charset != "UTF-8":
        line = F.encode(line, charset).cast("string")
    is_row = F.col("kind") == "row"
    finding = F.to_json(F.struct(*(F.col(c) for c in FINDINGS.names)))
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    run = f"run-{stamp}-{uuid.uuid4().hex[:12]}"
    (
        lines.select(
            F.when(is_row, "csv").otherwise("findings").alias("export_kind"),
            _known(F.when(is_row, folder)).alias("export_folder"),
            _known(F.when(is_row, F.concat(book, named, F.lit(".csv")))).alias("export_file"),
            F.coalesce("row_idx", F.lit(0)).cast("long").alias("row_idx"),
            F.when(is_row, line).otherwise(finding).alias("value"),
        )
        .sortWithinPartitions(*EXPORT_COLUMNS, "row_idx")
        .select("value", *EXPORT_COLUMNS)
        .write.partitionBy(*EXPORT_COLUMNS)
        .text(f"{dst.rstrip('/')}/{run}")
    )
    published = Folder(spark, f"{dst.rstrip('/')}/{_PUBLISHED}")
    while True:
        marks = [n for n in published.names() if n.endswith(".json")]
        nth = 1 + int(max(marks).removesuffix(".json")) if marks else 1
        if published.create(f"{nth:012d}.json", json.dumps({"run": run})):
            return f"{dst.rstrip('/')}/{run}"


def read_findings(spark: SparkSession, run: str) -> DataFrame:
    """What a run found and wrote: ``kind`` sheet, text (a row for each part written) or failed."""
    place = f"{run}/export_kind=findings"
    if "export_kind=findings" not in Folder(spark, run).names():
        return spark.createDataFrame([], FINDINGS)
    return spark.read.schema(FINDINGS).option("recursiveFileLookup", True).json(place)


def _text_lines(text: DataFrame) -> DataFrame:
    """Lines of text files: in each task, a file's header before its first row, and at the end a
    finding of how many rows there were."""
    schema = "path string, kind string, row_idx long, rows long, value string"

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        for batch in batches:
            out = []
            for path, head, value in zip(batch["path"], batch["head"], batch["value"]):
                if path not in seen:
                    seen[path] = 0
                    out.append((path, "row", 0, None, head))
                if value is not None:
                    seen[path] += 1
                    out.append((path, "row", seen[path], None, value))
            yield _frame(out)
        yield _frame([(path, "text", None, n, None) for path, n in seen.items()])

    def _frame(rows: list[tuple]) -> pd.DataFrame:
        names = [f.split()[0] for f in schema.split(", ")]
        return pd.DataFrame(rows, columns=names).astype({"row_idx": "Int64", "rows": "Int64"})

    head, value = csv_line(F.col("header")), F.when(F.col("cells").isNotNull(), csv_line(F.col("cells")))
    return text.select("path", head.alias("head"), value.alias("value")).mapInPandas(lines, schema)


def _known(name):
    return F.coalesce(name, F.lit("_"))


def _charset(encoding: str) -> str:
    try:
        return _ENCODINGS[encoding.lower()]
    except KeyError:
        known = ", ".join(sorted(_ENCODINGS))
        raise ValueError(f"cannot write CSV as {encoding!r}; use one of {known}") from None
