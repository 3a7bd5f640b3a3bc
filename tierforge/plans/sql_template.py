"""Parameterised SQL: relations in braces, values as named parameters."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tierforge.contract import Contract
from tierforge.operators.conform import conform
from tierforge.sinks.tables import write_by_contract


def run_template(
    spark: SparkSession,
    text: str,
    relations: Mapping[str, DataFrame] | None = None,
    values: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run one statement in which ``{name}`` stands for a DataFrame and ``:name`` for a value.

    Values are bound, never pasted into the text. Any other brace is plain SQL text, a JSON
    literal for example.
    """
    relations = dict(relations or {})
    if relations:
        text = text.replace("{", "{{").replace("}", "}}")
        for name in relations:
            text = text.replace("{{" + name + "}}", "{" + name + "}")
    return spark.sql(text, args=dict(values or {}), **relations)


def load_from_template(
    spark: SparkSession,
    contract: Contract,
    text: str,
    root: str,
    relations: Mapping[str, DataFrame] | None = None,
    values: Mapping[str, Any] | None = None,
    *,
    fmt: str = "parquet",
    buckets: int | None = None,
) -> None:
    """Store what a statement returns as the contract's table, as its write mode says.

    Any silver or gold table is a text and a contract. Columns of the contract are cast to their
    types; its keys must be there.
    """
    rows = conform(run_template(spark, text, relations, values), contract)
    write_by_contract(rows, contract, root, fmt, buckets=buckets)
