"""Rows of one OOXML workbook, as strings. Runs inside a task, on one file's bytes."""

from __future__ import annotations

import datetime as dt
import io
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterator
from typing import IO
from xml.etree import ElementTree as ET
from xml.parsers import expat

# The built-in number formats that show a date, a time or a duration.
DATE_FORMAT_IDS = frozenset([14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 47])
DURATION_FORMAT_IDS = frozenset([46])

# An error cell is a missing value; this text is one of those read as such.
_ERROR = "#N/A"

_NOT_FORMAT = re.compile(r'"[^"]*"|\\.|_.|\*.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', re.IGNORECASE)
_ELAPSED = re.compile(r"\[(h+|m+|s+)\]", re.IGNORECASE)
_CHUNK = 1 << 18
_INTEGER = re.compile(r"\s*[+-]?[0-9]+\s*")


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _relation_id(sheet: ET.Element) -> str | None:
    """The sheet's ``r:id``, whichever of the two namespaces of the standard it is in."""
    return next((v for k, v in sheet.attrib.items() if k.endswith("}id")), None)


def _part_name(target: str) -> str:
    """Name within the archive of a part the workbook refers to."""
    return posixpath.normpath(posixpath.join("/xl", target)).lstrip("/")


def _parse(
    stream: IO[bytes],
    on_start: Callable[[str, dict], None],
    on_end: Callable[[str], None],
    text: list[str],
) -> Iterator[None]:
    """Feed a part to the parser, giving way after every chunk.

    The handlers see tags without prefix; what stands in values and text runs, phonetic
    guides aside, is added to ``text`` in between.
    """
    keep = phonetic = False

    def start(tag: str, attributes: dict) -> None:
        nonlocal keep, phonetic
        if ":" in tag:
            tag = tag.rsplit(":", 1)[1]
        if tag == "v" or tag == "t":
            keep = not phonetic
        elif tag == "rPh":
            phonetic = True
        else:
            on_start(tag, attributes)

    def end(tag: str) -> None:
        nonlocal keep, phonetic
        if ":" in tag:
            tag = tag.rsplit(":", 1)[1]
        if tag == "v" or tag == "t":
            keep = False
        elif tag == "rPh":
            phonetic = False
        else:
            on_end(tag)

    def data(chars: str) -> None:
        if keep:
            text.append(chars)

    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler = start
    parser.EndElementHandler = end
    parser.CharacterDataHandler = data
    while chunk := stream.read(_CHUNK):
        parser.Parse(chunk, False)
        yield
    parser.Parse(b"", True)
    yield


class Workbook:
    """A workbook opened from bytes; sheets are streamed, never held whole."""

    def __init__(self, content: bytes):
        self._zip = zipfile.ZipFile(io.BytesIO(content))
        book = self._part("xl/workbook.xml")
        if book is None:
            raise ValueError("not an OOXML workbook")
        relations = self._part("xl/_rels/workbook.xml.rels")
        targets = {
            r.get("Id"): _part_name(r.get("Target", ""))
            for r in (relations if relations is not None else [])
            if r.get("Type", "").endswith("/worksheet")
        }
        properties = next((n for n in book if _local(n.tag) == "workbookPr"), None)
        since_1904 = properties is not None and properties.get("date1904") in ("1", "true")
        self._epoch = dt.datetime(1904, 1, 1) if since_1904 else dt.datetime(1899, 12, 30)
        self.sheets = []
        for group in book:
            if _local(group.tag) == "sheets":
                for s in group:
                    part = targets.get(_relation_id(s))
                    if part is not None:
                        self.sheets.append((s.get("name"), part))
        self._kinds = self._style_kinds()
        self._strings = self._shared_strings()

    def _part(self, name: str) -> ET.Element | None:
        try:
            with self._zip.open(name) as part:
                return ET.parse(part).getroot()
        except KeyError:
            return None

    def _shared_strings(self) -> list[str]:
        out: list[str] = []
        text: list[str] = []

        def start(tag: str, _: dict) -> None:
            if tag == "si":
                text.clear()

        def end(tag: str) -> None:
            if tag == "si":
                out.append("".join(text))

        try:
            part = self._zip.open("xl/sharedStrings.xml")
        except KeyError:
            return out
        with part:
            for _ in _parse(part, start, end, text):
                pass
        return out

    def _style_kinds(self) -> list[str]:
        """Per cell style: ``date``, ``duration`` or empty."""
        styles = self._part("xl/styles.xml")
        codes: dict[int, str] = {}
        kinds: list[str] = []
        for group in styles if styles is not None else []:
            if _local(group.tag) == "numFmts":
                codes = {int(f.get("numFmtId", 0)): f.get("formatCode", "") for f in group}
        for group in styles if styles is not None else []:
            if _local(group.tag) == "cellXfs":
                kinds = [_kind(int(x.get("numFmtId", 0)), codes) for x in group]
        return kinds

    def rows(self, part: str) -> Iterator[list[str | None]]:
        """Every row up to the last one with a value; gaps are empty rows."""
        done: list[tuple[int, list[str | None]]] = []
        text: list[str] = []
        cells: list[str | None] = []
        number = column = 0
        cell: dict = {}
        numbers = _ColumnNumbers()

        def start(tag: str, attributes: dict) -> None:
            nonlocal number, column, cells, cell
            if tag == "c":
                cell = attributes
                place = cell.get("r")
                column = numbers[place.rstrip("0123456789")] if place else column + 1
                text.clear()
            elif tag == "row":
                number = int(attributes.get("r", number + 1))
                column, cells = -1, []

        def end(tag: str) -> None:
            if tag == "c":
                value = self._value(cell, "".join(text))
                if value is not None:
                    if column > len(cells):
                        cells.extend([None] * (column - len(cells)))
                    cells.append(value)
            elif tag == "row":
                done.append((number, cells))

        written = 0
        with self._zip.open(part) as xml:
            for _ in _parse(xml, start, end, text):
                for number_, row in done:
                    if row:
                        for _ in range(number_ - written - 1):
                            yield []
                        yield row
                        written = number_
                done.clear()

    def _value(self, cell: dict, raw: str) -> str | None:
        kind = cell.get("t", "n")
        if raw == "":
            return None
        if kind == "inlineStr" or kind == "str":
            return raw
        if kind == "s":
            return self._strings[int(raw)] or None
        if kind == "e":
            return _ERROR
        if kind == "b":
            return "True" if raw.strip() == "1" else "False"
        if kind == "d":
            return str(dt.datetime.fromisoformat(raw.strip().rstrip("Z")))
        style = int(cell.get("s", 0))
        shown = self._kinds[style] if style < len(self._kinds) else ""
        return self._number(raw, shown)

    def _number(self, raw: str, shown: str) -> str:
        value = float(raw)
        if not shown:
            if _INTEGER.fullmatch(raw):
                return str(int(raw))
            return str(int(value)) if value.is_integer() else str(value)
        since = dt.timedelta(milliseconds=round(value * 86_400_000))
        if shown == "duration":
            return str(since)
        if 0 <= value < 1 and since.days == 0:
            return str((dt.datetime.min + since).time())
        # The 1900 calendar counts a 29 February 1900 that never was.
        if self._epoch.year == 1899 and 0 < value < 60:
            since += dt.timedelta(days=1)
        return str(self._epoch + since)


def _kind(number_format: int, codes: dict[int, str]) -> str:
    code = codes.get(number_format)
    if code is None:
        if number_format in DURATION_FORMAT_IDS:
            return "duration"
        return "date" if number_format in DATE_FORMAT_IDS else ""
    plain = _NOT_FORMAT.sub("", code.split(";")[0])
    if _ELAPSED.search(plain):
        return "duration"
    return "date" if re.search("[dmhysDMHYS]", plain) else ""


class _ColumnNumbers(dict):
    """Column letters to numbers from 0, worked out once each."""

    def __missing__(self, letters: str) -> int:
        number = 0
        for letter in letters:
            number = number * 26 + ord(letter) - 64
        self[letters] = number - 1
        return number - 1


def header_names(
    cells: list[str | None], width: int, fold_case: bool = False, reserved: tuple[str, ...] = ()
) -> list[str]:
    """Column names of a sheet: unnamed ones numbered, repeated ones given a suffix.

    ``fold_case`` also tells apart names that differ in case only, as a Spark schema must;
    names in ``reserved`` count as used.
    """
    taken = set(reserved)
    names = []
    for i in range(width):
        base = (cells[i] if i < len(cells) else None) or f"Unnamed: {i}"
        name, k = base, 0
        while (name.lower() if fold_case else name) in taken:
            k += 1
            name = f"{base}.{k}"
        taken.add(name.lower() if fold_case else name)
        names.append(name)
    return names
