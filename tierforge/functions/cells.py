"""Expressions on spreadsheet cells, which are strings or NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierforge.functions.names import quoted

# The texts that stand for a missing cell.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def na_cell(cell: Column) -> Column:
    return F.when(~cell.isin(*NA_TOKENS), cell)


def na_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace the missing-value texts by NULL in the given (default: all) string columns."""
    wanted = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    if columns is not None:
        wanted &= set(columns)
    return df.select(
        *(na_cell(quoted(c)).alias(c) if c in wanted else quoted(c) for c in df.columns)
    )


def csv_line(cells: Column) -> Column:
    """One CSV record of an array of cells, quoted only where needed; NULL cells are empty.

    A record of one empty cell is written as ``""``, since a blank line would be skipped.
    """

    def field(cell: Column) -> Column:
        doubled = F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(cell.isNull(), "").when(cell.rlike('[",\r\n]'), doubled).otherwise(cell)

    line = F.array_join(F.transform(cells, field), ",")
    return F.when((F.size(cells) == 1) & (line == ""), '""').otherwise(line)
