"""Cut files of text into records in parallel, where quoted cells run over lines.

Whether a line begins a record depends on all quotes before it. So each split is first read for
what it does to either state (a quoted cell is open at its start, or not); one row a split. Put
one after the other, these rows say how each split really starts. Then every split cuts its own
records, and only those that lie over the end of a split are put together from their parts. A cell
is quoted if its first character is a quote; a quote elsewhere is a character like any other.

As lines are decoded in the tasks that cut them, any encoding that keeps line ends apart can be read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.sources.encodings import codec_of
from tierforge.sources.spreadsheets import escaped

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BATCH = 4096
_LAST = 1 << 62


class Way(NamedTuple):
    """How a file is read; ``quoted``: cells may run over lines."""

    separator: str
    encoding: str
    quoted: bool


def closing(text: str, at: int) -> int:
    """The place behind the quote that ends a quoted cell, -1 if the text does not have it."""
    while True:
        at = text.find('"', at)
        if at < 0 or not text.startswith('"', at + 1):
            return at + 1 if at >= 0 else -1
        at += 2


def open_after(line: str, is_open: bool, separator: str) -> bool:
    """Whether a quoted cell is open at the end of a line."""
    if '"' not in line:
        return is_open
    opening = separator + '"'
    at = 0 if is_open else 1 if line.startswith('"') else -1
    while True:
        if at >= 0:
            at = closing(line, at)
            if at < 0:
                return True
        at = line.find(opening, max(at, 0))
        if at < 0:
            return False
        at += len(opening)


def file_path() -> Column:
    """Path of the file a row is from, as the file listing spells it."""
    encoded = F.col("_metadata.file_path")
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All lines; reading the same paths again comes upon the same splits."""
    return (
        spark.read.text([escaped(p) for p in paths])
        .select(
            file_path().alias("path"),
            F.col("_metadata.file_block_start").alias("split"),
            F.col("value").cast("binary").alias("line"),
        )
    )


def _decoded(batches: Iterator[pa.RecordBatch], ways: Mapping[str, Way]) -> Iterator[tuple]:
    """``path, split, line`` of every row; the byte order mark of a first line is left out."""
    codecs = {path: codec_of(way.encoding) for path, way in ways.items()}
    for batch in batches:
        columns = (batch.column(n).to_pylist() for n in ("path", "split", "line"))
        for path, split, line in zip(*columns, strict=True):
            yield path, split, line.decode(codecs[path], "replace").removeprefix("\ufeff")


def split_starts(spark: SparkSession, ways: Mapping[str, Way]) -> dict[tuple[str, int], int]:
    """For each split that starts within a quoted cell, the split that has the record's start."""
    return _starts(spark, ways)[0]


def unclosed(spark: SparkSession, ways: Mapping[str, Way]) -> list[str]:
    """The files that end within a quoted cell."""
    return _starts(spark, ways)[1]


def _starts(
    spark: SparkSession, ways: Mapping[str, Way]
) -> tuple[dict[tuple[str, int], int], list[str]]:
    """Both. What reaches the driver is a row a split; a reader's own plan there has as many."""
    quoted = {p: w for p, w in ways.items() if w.quoted}
    if not quoted:
        return {}, []

    def effect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # End state from either state, and whether a record ends from the open one.
        now: tuple[str, int] | None = None
        state = [False, True, False]

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (*now, *state)], ["path", "split", "shut", "open", "ends"]
            )

        for path, split, line in _decoded(batches, quoted):
            if (path, split) != now:
                if now is not None:
                    yield row()
                now, state = (path, split), [False, True, False]
            separator = quoted[path].separator
            after = open_after(line, state[1], separator)
            state = [open_after(line, state[0], separator), after, state[2] or not after]
        if now is not None:
            yield row()

    rows = _lines(spark, list(quoted)).mapInArrow(
        effect, "path string, split long, shut boolean, open boolean, ends boolean"
    )
    starts: dict[tuple[str, int], int] = {}
    path, is_open, opener = None, False, 0
    never = []
    for r in rows.orderBy("path", "split").collect():
        if r["path"] != path:
            if is_open:
                never.append(path)
            path, is_open = r["path"], False
        if is_open:
            starts[path, r["split"]] = opener
        after = r["open"] if is_open else r["shut"]
        # Open at the end: by a record of this split, unless it went through from an earlier one.
        if after and not (is_open and not r["ends"]):
            opener = r["split"]
        is_open = after
    if is_open:
        never.append(path)
    return starts, never


def records(
    spark: SparkSession, ways: Mapping[str, Way], starts: Mapping[tuple[str, int], int]
) -> DataFrame:
    """``path, split, line, separator, record`` of all records but each file's first, its header;
    ``split`` and ``line`` order the records of a file."""
    schema = "path string, split long, line long, part long, separator string, head boolean, record string"
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = pa.schema(
        [("path", pa.string()), ("split", pa.int64()), ("line", pa.int64()), ("part", pa.int64()),
         ("separator", pa.string()), ("head", pa.bool_()), ("record", pa.string())]
    )

    def cut(batches: Iterator[pa.RecordBatch], over: bool) -> Iterator[pa.RecordBatch]:
        """The records within splits, or (``over``) the parts of those that lie over their ends."""
        out: list[tuple] = []
        now, lines, is_open, opener, head, nth = None, [], False, None, False, 0

        def done(part: bool) -> None:
            nonlocal head, nth
            nth += 1
            text = "\n".join(lines)
            if part or text.strip():
                if part == over:
                    # What lies over the end of its split comes last there.
                    place = (opener, _LAST) if part else (now[1], nth)
                    out.append((now[0], *place, now[1], ways[now[0]].separator, head, text))
                head = False
            lines.clear()

        for path, split, line in _decoded(batches, ways):
            if (path, split) != now:
                if lines:
                    opener = now[1] if opener is None else opener
                    done(True)
                now, head, nth = (path, split), split == 0, 0
                opener = starts.get(now)
                is_open = opener is not None
            lines.append(line)
            is_open = ways[path].quoted and open_after(line, is_open, ways[path].separator)
            if not is_open:
                done(opener is not None)
                opener = None
            if len(out) >= _BATCH:
                yield _batch(out)
                out.clear()
        if lines:
            opener = now[1] if opener is None else opener
            done(True)
        if out:
            yield _batch(out)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=kinds)

    quoted = [p for p, w in ways.items() if w.quoted]
    found = []
    for paths in (quoted, [p for p in ways if p not in set(quoted)]):
        if paths:
            found.append(_lines(spark, paths).mapInArrow(lambda b: cut(b, False), schema).drop("part"))
    if starts:
        ends = {(p, s) for p, s in starts} | {(p, opener) for (p, _), opener in starts.items()}
        known = spark.createDataFrame(sorted(ends), "path string, split long")
        at_ends = _lines(spark, quoted).join(F.broadcast(known), ["path", "split"], "left_semi")
        parts = at_ends.mapInArrow(lambda b: cut(b, True), schema)
        text = F.array_join(F.transform(F.array_sort("parts"), lambda p: p["record"]), "\n")
        joined = parts.groupBy("path", "split", "line", "separator").agg(
            F.collect_list(F.struct("part", "record")).alias("parts"), F.bool_or("head").alias("head")
        )
        found.append(joined.withColumn("record", text).drop("parts"))
    return reduce(DataFrame.unionByName, found).where(~F.col("head")).drop("head")
