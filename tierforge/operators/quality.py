"""Not-null rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.functions.names import quoted

REASON_COLUMN = "null_columns"


def all_present(columns: Sequence[str]) -> Column:
    return reduce(and_, (quoted(c).isNotNull() for c in columns), F.lit(True))


def split_not_null(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the rejected ones with the list of their missing columns.

    Both are filters over the same input, so neither moves data.
    """
    if not columns:
        return df, df.where(F.lit(False)).withColumn(REASON_COLUMN, F.array().cast("array<string>"))
    ok = all_present(columns)
    missing = F.filter(
        F.array(*(F.when(quoted(c).isNull(), F.lit(c)) for c in columns)), lambda c: c.isNotNull()
    )
    return df.where(ok), df.where(~ok).withColumn(REASON_COLUMN, missing)


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The input, failing the query at the first row that lacks one of ``columns``."""

    def checked(name: str) -> Column:
        error = F.raise_error(F.lit(f"column {name} is declared not null"))
        return F.coalesce(quoted(name), error.cast(df.schema[name].dataType)).alias(name)

    rules = set(columns)
    return df.select(*(checked(c) if c in rules else quoted(c) for c in df.columns))
