"""Make workbooks out of table rows, for the spreadsheet queries and tests."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"


class Raw(str):
    """A cell given as XML."""


def _reference(row: int, column: int) -> str:
    letters = ""
    column += 1
    while column:
        column, rest = divmod(column - 1, 26)
        letters = chr(65 + rest) + letters
    return f"{letters}{row + 1}"


def _cell(row: int, column: int, value) -> str:
    place = _reference(row, column)
    if value is None:
        return ""
    if isinstance(value, Raw):
        return value.replace("<c ", f'<c r="{place}" ', 1)
    if isinstance(value, (int, float)):
        return f'<c r="{place}"><v>{value!r}</v></c>'
    return f'<c r="{place}" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'


def workbook_bytes(
    sheets: Sequence[tuple[str, Sequence[Sequence]]],
    strings: Sequence[str] = (),
    styles: str = "",
    properties: str = "",
) -> bytes:
    """An OOXML workbook of ``(sheet name, rows)``; ``strings`` are XML string items."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        names = "".join(
            f'<sheet name={quoteattr(name)} sheetId="{i}" r:id="rId{i}"/>'
            for i, (name, _) in enumerate(sheets, 1)
        )
        z.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{_MAIN}" xmlns:r="{_RELATIONS}">{properties}'
            f"<sheets>{names}</sheets></workbook>",
        )
        links = "".join(
            f'<Relationship Id="rId{i}" Type="{_RELATIONS}/worksheet" '
            f'Target="worksheets/sheet{i}.xml"/>'
            for i in range(1, len(sheets) + 1)
        )
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{_PACKAGE}/relationships">{links}</Relationships>',
        )
        if strings:
            items = "".join(f"<si>{s}</si>" for s in strings)
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{_MAIN}">{items}</sst>')
        if styles:
            z.writestr("xl/styles.xml", f'<styleSheet xmlns="{_MAIN}">{styles}</styleSheet>')
        for i, (_, rows) in enumerate(sheets, 1):
            body = "".join(
                f'<row r="{r + 1}">{"".join(_cell(r, c, v) for c, v in enumerate(row))}</row>'
                for r, row in enumerate(rows)
            )
            z.writestr(
                f"xl/worksheets/sheet{i}.xml",
                f'<worksheet xmlns="{_MAIN}"><sheetData>{body}</sheetData></worksheet>',
            )
    return out.getvalue()


def pack(df: DataFrame, sheet: str, folder: str, name: str) -> DataFrame:
    """``(path, content)``: all rows of ``df`` as workbooks, one per Arrow batch.

    The first column names the file, so it must be a key.
    """
    columns = df.columns
    from workload import books

    cloudpickle.register_pickle_by_value(books)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                rows = [columns, *batch.astype(object).where(batch.notna(), None).values.tolist()]
                path = f"books:{folder}/{name}{batch.iloc[0, 0]}.xlsx"
                yield pd.DataFrame({"path": [path], "content": [workbook_bytes([(sheet, rows)])]})

    return df.mapInPandas(build, "path string, content binary")
