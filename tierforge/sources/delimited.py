"""Text that goes by a spreadsheet's name: find each file's layout, then read it as CSV.

One pass over the lines of all files tells, for each file, its header line, whether it is UTF-8,
how often each delimiter occurs, and whether quoted cells may run over lines. The lines are those of
Spark's splittable text scan and are added up by file on the executors, so a file of any size is
read by many tasks and no part of it is a sample. Files that are not UTF-8 are read once more to
tell their encoding (see :mod:`tierforge.sources.encodings`). Rows are then read by a CSV scan for
each delimiter and encoding that Spark reads line by line, and by one scan for all others, which
cuts and decodes records in parallel (see :mod:`tierforge.sources.records`), whatever the number of
files or of different headers: cells come by position, and get their names from the file's header
in a join. Only UTF-16 is read by a task a file.
"""

from __future__ import annotations

import codecs
import csv
import sys
from collections.abc import Collection, Iterator, Mapping
from functools import reduce
from operator import or_

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierforge.functions.cells import na_cell
from tierforge.scratch import stage
from tierforge.sources.encodings import codec_of, encodings
from tierforge.sources.records import Way, file_path, records, split_starts, unclosed
from tierforge.sources.spreadsheets import (
    PATH_COLUMN,
    SPREADSHEET_GLOB,
    discover,
    escaped,
    text_header,
)

# As with the parser of workbooks, this code travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The delimiters tried, in order of preference.
DELIMITERS = (",", ";", "\t", "|")
# Byte order marks and what Spark calls the encodings, then the starts of workbooks.
_MARKS = ((b"\xef\xbb\xbf", "UTF-8"), (b"\xff\xfe", "UTF-16"), (b"\xfe\xff", "UTF-16"))
# The encodings whose lines Spark's reader of CSV takes apart and decodes.
_BY_LINE = ("UTF-8", "ISO-8859-1", "US-ASCII")
_WORKBOOKS = (b"PK\x03\x04", b"\xd0\xcf\x11\xe0")

LAYOUT = (
    "path string, kind string, separator string, encoding string, multi_line boolean, "
    "header array<string>, bare boolean, error string"
)
_FIELDS = [f.split()[0] for f in LAYOUT.split(", ")]


def file_facts(spark: SparkSession, root: str, glob: str = SPREADSHEET_GLOB) -> DataFrame:
    """``path`` and what its lines say, a row for each file below ``root`` that has any.

    ``head``: the first line that is not blank; ``utf8``: all are; ``nul``: one has a zero byte;
    ``odd``: one has an odd number of quotes; ``most_<n>``: the most that delimiter ``n`` occurs
    outside of quotes in a line, ends aside; ``some_<n>`` and ``lines``: how many lines have it,
    and how many there are.
    """
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root)
    line = F.rtrim(F.col("value"), F.lit("\r"))
    rows = text.select(
        file_path().alias("path"),
        # Lines of a split come in order, and a file's first split has its first line.
        F.struct(
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("place"),
        line.cast("binary").alias("line"),
        F.is_valid_utf8("value").alias("utf8"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
        F.when(F.contains("value", F.lit('"')), F.regexp_replace(line, '"[^"]*"', "x"))
        .otherwise(line)
        .alias("bare"),
    ).where(F.length("line") > 0)
    counts = {
        n: F.length(_trimmed(d)) - F.length(F.replace(_trimmed(d), F.lit(d), F.lit("")))
        for n, d in enumerate(DELIMITERS)
    }
    counted = rows.select("*", *[c.alias(f"count_{n}") for n, c in counts.items()])
    return counted.groupBy("path").agg(
        F.min_by("line", "place").alias("head"),
        F.bool_and("utf8").alias("utf8"),
        F.bool_or(F.position(F.lit(b"\x00"), F.col("line")) > 0).alias("nul"),
        F.bool_or(F.col("quotes") % 2 == 1).alias("odd"),
        F.count(F.lit(1)).alias("lines"),
        *[F.max(f"count_{n}").alias(f"most_{n}") for n in counts],
        *[F.count(F.when(F.col(f"count_{n}") > 0, 1)).alias(f"some_{n}") for n in counts],
    )


def _trimmed(delimiter: str) -> Column:
    """A line without the delimiters, which stand for empty cells, at its end."""
    return F.rtrim(F.col("bare"), F.lit(delimiter))


def layouts(
    spark: SparkSession, root: str, glob: str = SPREADSHEET_GLOB, encoding: str | None = None
) -> DataFrame:
    """``LAYOUT`` of every file below ``root``, by ``kind``: ``text``, ``workbook``, or ``failed``
    with the ``error``.

    A file that has no byte order mark and is not UTF-8 is in the ``encoding`` given, by default in
    the one that its bytes tell; where they leave it unclear, it is ``failed``. A quoted cell that
    is never closed fails its file too.
    """
    if encoding is not None:
        codecs.lookup(codec_of(encoding))

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_layout(row) for row in batch.to_dict("records")]
            yield pd.DataFrame(found, columns=_FIELDS)

    facts = stage(file_facts(spark, root, glob), "facts")
    other = [r["path"] for r in facts.where(_unmarked()).select("path").collect()]
    if not other:
        told = facts.withColumn("told", F.lit(None).cast("string"))
    elif encoding is not None:
        told = facts.withColumn("told", F.when(_unmarked(), F.lit(encoding)))
    else:
        names = encodings(spark, other, file_path()).withColumnRenamed("encoding", "told")
        told = facts.join(names, "path", "left")
    told = _with_wide_heads(stage(told, "told") if other else told)
    found = stage(told.mapInPandas(tell, LAYOUT), "layouts")
    # Quoted cells over several lines are counted by reading those files as what they are.
    quoted_lines = found.where("kind = 'text' and multi_line")
    if not quoted_lines.isEmpty():
        n = F.size("header")
        surplus = F.exists(
            F.slice("every", n + 1, F.size("every")), lambda c: c.isNotNull() & (c != "")
        )
        ways = _ways(quoted_lines)
        never = unclosed(spark, _by_record(ways))
        bad = _cells_by_place(spark, quoted_lines, set(never)).where(surplus).select("path").distinct()
        error = F.lit("a row has more cells than there are column names").alias("surplus")
        bad = bad.select("path", error)
        if never:
            error = F.lit("a quoted cell is not closed")
            bad = bad.unionByName(
                spark.createDataFrame([(p,) for p in never], "path string").withColumn("surplus", error)
            )
        marked = found.join(bad, "path", "left")
        is_bad = F.col("surplus").isNotNull()
        found = marked.select(
            "path",
            F.when(is_bad, "failed").otherwise(F.col("kind")).alias("kind"),
            *[F.when(~is_bad, F.col(c)).alias(c) for c in _FIELDS[2:-1]],
            F.coalesce("error", "surplus").alias("error"),
        )
    empty = discover(spark, root, glob).join(found, "path", "left_anti")
    nothing = F.lit("no columns to parse from file").alias("error")
    return stage(
        found.unionByName(
            empty.select("path", F.lit("failed").alias("kind"), nothing), allowMissingColumns=True
        ),
        "layouts",
    )


def _with_wide_heads(told: DataFrame) -> DataFrame:
    """The facts with the first lines of UTF-16 files, one byte of whose characters may be that of a
    line end, cut at whole characters instead."""
    spark, head = told.sparkSession, F.col("head")
    little = F.startswith(head, F.lit(bytearray(b"\xff\xfe"))) | F.col("told").eqNullSafe(F.lit("UTF-16LE"))
    big = F.startswith(head, F.lit(bytearray(b"\xfe\xff"))) | F.col("told").eqNullSafe(F.lit("UTF-16BE"))
    heads = []
    for is_wide, end in ((little, "\n\0"), (big, "\0\n")):
        if paths := [escaped(r["path"]) for r in told.where(is_wide).select("path").collect()]:
            lines = spark.read.option("lineSep", end).text(paths).select(
                file_path().alias("path"),
                F.col("_metadata.file_block_start").alias("split"),
                F.monotonically_increasing_id().alias("line"),
                F.col("value").cast("binary").alias("value"),
            )
            blank = F.length(F.regexp_replace(F.hex("value"), "^(FFFE|FEFF)|(0D00|000D)$", "")) == 0
            first = lines.where((F.col("split") == 0) & ~blank).groupBy("path")
            heads.append(first.agg(F.min_by("value", "line").alias("wide_head")))
    if not heads:
        return told
    found = told.join(reduce(DataFrame.unionByName, heads), "path", "left")
    return found.withColumn("head", F.coalesce("wide_head", "head")).drop("wide_head")


def _unmarked() -> Column:
    """No workbook, no byte order mark, and not UTF-8."""
    starts = [*_WORKBOOKS, *(mark for mark, _ in _MARKS)]
    marked = reduce(or_, (F.startswith(F.col("head"), F.lit(bytearray(m))) for m in starts))
    return ~marked & (~F.col("utf8") | F.col("nul"))


def _layout(facts: dict) -> tuple:
    """A file's record of ``LAYOUT``; ``bare`` means that there is nothing below the header."""
    head, path = bytes(facts["head"]), facts["path"]
    nothing = (None,) * 5
    if head.startswith(_WORKBOOKS):
        return (path, "workbook", *nothing, None)
    try:
        layout = text_layout(head, facts)
    except (ValueError, csv.Error) as problem:
        return (path, "failed", *nothing, str(problem))
    return (path, "text", *layout, facts["lines"] == 1, None)


def text_layout(head: bytes, facts: dict) -> tuple[str, str, bool, list[str]]:
    """Delimiter, encoding, whether lines cannot be told apart by themselves, and column names."""
    marked = next((name for mark, name in _MARKS if head.startswith(mark)), None)
    told = facts["told"]
    if facts["nul"] and marked != "UTF-16" and not (told or "").startswith("UTF-16"):
        raise ValueError("neither a workbook nor text")
    encoding = marked or told or ("UTF-8" if facts["utf8"] else None)
    if encoding is None:
        raise ValueError("the encoding is unclear; it can be given")
    if encoding.startswith("UTF-16"):
        big = encoding == "UTF-16BE" or head.startswith(b"\xfe\xff")
        rest = head[2:] if marked else head
        text = rest.decode("utf-16-be" if big else "utf-16-le", "ignore").split("\n")[0].rstrip("\r\x00")
    else:
        text = head.decode("utf-8-sig" if encoding == "UTF-8" else codec_of(encoding))
    in_head = [_cells(text, d) for d in DELIMITERS]
    best = max(
        range(len(DELIMITERS)),
        # More cells in the first line; of equal ones, the delimiter that more lines have.
        key=lambda n: (len(in_head[n]) > 1, facts[f"some_{n}"] if len(in_head[n]) > 1 else 0, -n),
    )
    cells = in_head[best]
    whole = facts["odd"] or encoding.startswith("UTF-16")
    most = 1 + facts[f"most_{best}"]
    if not whole and most > max(len(cells), 1):
        raise ValueError(f"a line has {most} cells under {len(cells)} column names")
    if len(cells) == 1 and not whole:
        # Not one column: a delimiter that the first line lacks would be taken for text.
        split = [d for n, d in enumerate(DELIMITERS) if 2 * facts[f"some_{n}"] > facts["lines"]]
        if split and facts["lines"] > 1:
            raise ValueError(f"most lines are split by {split[0]!r}, the first one is not")
    return DELIMITERS[best], encoding, whole, text_header(cells)


def _cells(line: str, delimiter: str) -> list[str]:
    csv.field_size_limit(max(csv.field_size_limit(), len(line) + 1))
    row = next(csv.reader([line], delimiter=delimiter), [])
    while len(row) > 1 and not row[-1]:
        row.pop()
    return row


def _ways(found: DataFrame) -> dict[str, Way]:
    """How each ``text`` file is read: a path for each, which a reader's listing of files holds on
    the driver anyway."""
    rows = found.select("path", "separator", "encoding", "multi_line").collect()
    return {path: Way(*way) for path, *way in rows}


def _by_record(ways: Mapping[str, Way]) -> dict[str, Way]:
    """The files whose records are cut and decoded one by one."""
    return {
        p: w
        for p, w in ways.items()
        if not w.encoding.startswith("UTF-16") and (w.quoted or w.encoding not in _BY_LINE)
    }


def _cells_by_place(
    spark: SparkSession, found: DataFrame, but: Collection[str] = ()
) -> DataFrame:
    """``path, header, place, every`` of all rows below the headers of ``text`` files.

    ``every`` has a cell more than the longest header names; ``place`` orders the rows of a file.
    ``but`` are paths left out.
    """
    ways = {p: w for p, w in _ways(found).items() if p not in but}
    if not ways:
        return spark.createDataFrame(
            [], "path string, header array<string>, place struct<split:long,line:long>, every array<string>"
        )
    width = 1 + found.agg(F.max(F.size("header"))).first()[0]
    names = [f"c{k}" for k in range(width)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    by_record = _by_record(ways)
    by_way: dict[Way, list[str]] = {}
    for path, way in ways.items():
        if path not in by_record:
            by_way.setdefault(way, []).append(path)
    parts = []
    for (separator, encoding, multi_line), paths in sorted(by_way.items()):
        rows = (
            spark.read.schema(schema)
            .option("header", True)
            .option("sep", separator)
            .option("encoding", encoding)
            .option("multiLine", multi_line)
            .option("escape", '"')
            .csv([escaped(p) for p in paths])
        )
        place = F.struct(
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("line"),
        )
        parts.append(
            rows.select(file_path().alias("path"), place.alias("place"), F.array(*names).alias("every"))
        )
    if by_record:
        cut = records(spark, by_record, split_starts(spark, by_record))
        fields = ", ".join(f"{n} string" for n in names)
        cells = reduce(
            lambda other, d: F.when(
                F.col("separator") == d,
                F.from_csv("record", fields, {"sep": d, "escape": '"', "multiLine": "true"}),
            ).otherwise(other),
            DELIMITERS,
            F.lit(None),
        )
        every = F.array(*[F.col("cells")[n] for n in names]).alias("every")
        place = F.struct("split", "line").alias("place")
        parts.append(cut.select("path", place, cells.alias("cells")).select("path", "place", every))
    rows = reduce(DataFrame.union, parts)
    return rows.join(found.select("path", "header"), "path").select("path", "header", "place", "every")


def text_rows(spark: SparkSession, found: DataFrame) -> DataFrame:
    """``path, header, place, cells`` of all rows of the ``text`` files among the layouts.

    ``cells`` has one for each name in ``header``; missing-value texts are NULL. ``place`` orders the
    rows of a file.
    """
    rows = _cells_by_place(spark, found.where("kind = 'text'"))
    cells = F.transform(F.slice("every", F.lit(1), F.size("header")), na_cell)
    return rows.select("path", "header", "place", cells.alias("cells"))


def text_sheets(
    spark: SparkSession,
    root: str,
    glob: str = SPREADSHEET_GLOB,
    path_column: str = "path",
    encoding: str | None = None,
) -> tuple[DataFrame | None, DataFrame]:
    """All delimited text below ``root``, one table: columns by name, NULL where a file lacks one;
    and ``path, error`` of the files that could not be read.

    The table is None where there is no text. Workbooks are neither. ``encoding``: see ``layouts``.
    """
    found = layouts(spark, root, glob, encoding)
    failures = found.where("kind = 'failed'").select("path", "error")
    text = found.where("kind = 'text'")
    # The columns of the result, in the order of the files that first have them.
    order = text.select("path", F.posexplode("header")).groupBy("col").agg(
        F.min(F.struct("path", "pos")).alias("first")
    )
    names = [r["col"] for r in order.orderBy("first").collect()]
    if not names:
        return None, failures
    if path_column.lower() in map(str.lower, names):
        raise ValueError(f"a file has a column named {path_column}; name the path otherwise")
    rows = text_rows(spark, text).select(
        F.map_from_arrays("header", "cells").alias("by_name"), F.col("path").alias(PATH_COLUMN)
    )
    columns = [F.col("by_name")[n].alias(n) for n in names]
    return rows.select(*columns, F.col(PATH_COLUMN).alias(path_column)), failures
