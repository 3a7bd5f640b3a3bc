"""Columns that an operator adds on its way must not meet columns of the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spare(docs: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as ``docs`` has such a column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def own(docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` by name, whatever the names are."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
