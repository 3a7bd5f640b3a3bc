"""Silver: merged dimensions and cleansed facts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession

from tierforge.contract import AUDIT_COLUMN, Contract
from tierforge.functions.names import quoted
from tierforge.operators.conform import conform
from tierforge.operators.dedupe import dedupe_on_keys
from tierforge.operators.merge import merge_rows
from tierforge.operators.quality import split_not_null
from tierforge.operators.summary import flag_orphans
from tierforge.scratch import stage
from tierforge.sinks.layout import is_shuffled, rows_by
from tierforge.sinks.tables import write_by_contract


def silver_merge(
    bronze: DataFrame, silver: DataFrame | None, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """The silver table after merging the given columns of a bronze table into it."""
    return merge_rows(silver, bronze.select(*map(quoted, columns)), keys, ignore=(AUDIT_COLUMN,))


def load_silver(
    spark: SparkSession,
    contract: Contract,
    bronze: str | DataFrame,
    root: str,
    columns: Sequence[str],
    *,
    fmt: str = "parquet",
    buckets: int | None = None,
) -> None:
    """Merge a bronze table, given by its rows or its name, into the contract's silver table.

    The name must be known to the session; ``read_table`` finds the rows by path.
    """
    rows = spark.table(bronze) if isinstance(bronze, str) else bronze
    write_by_contract(
        rows.select(*map(quoted, columns)),
        replace(contract, dedupe=True, write_mode="merge"),
        root,
        fmt,
        buckets=buckets,
    )


def load_facts(
    raw: DataFrame,
    contract: Contract,
    dim: DataFrame,
    foreign_key: str,
    root: str,
    *,
    fmt: str = "parquet",
    buckets: int | None = None,
    **options,
) -> DataFrame:
    """Store the cleansed facts by contract (keys, partitions); returns the rejects.

    ``options`` are those of ``fact_rows``.
    """
    facts, rejected = fact_rows(raw, contract, dim, foreign_key, **options)
    # The lookup adds no facts and drops none, so they are counted without it; rows that take a
    # shuffle to make are left to be staged and counted in one.
    expected = None
    if contract.partitions and not is_shuffled(raw):
        valid, _ = split_not_null(conform(raw, contract), contract.required)
        expected = rows_by(valid, contract.partitions)
    write_by_contract(
        facts, contract, root, fmt, keys_present=True, keys_unique=True, buckets=buckets,
        expected=expected,
    )
    return rejected


def fact_rows(
    raw: DataFrame,
    contract: Contract,
    dim: DataFrame,
    foreign_key: str,
    *,
    dim_key: str | None = None,
    order_by: Sequence[str | Column] = (),
    keys_unique: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Cleansed facts with an ``is_orphan`` flag, and the rejected rows.

    Typed by the contract, checked for missing values, one row per key; a fact whose
    foreign key is not in ``dim`` is kept and flagged. Columns outside the contract may
    order the choice between rows of equal key and are dropped after it.

    The distinct keys of ``dim`` are staged; their size then decides how they are joined.
    ``keys_unique`` says that no key of ``raw`` repeats, as in a table stored by its keys.
    """
    known = stage(dim.select(quoted(dim_key or foreign_key).alias(foreign_key)).distinct(), "keys")
    valid, rejected = split_not_null(conform(raw, contract), contract.required)
    facts = valid if keys_unique else dedupe_on_keys(valid, contract.keys, order_by)
    facts = facts.select(*(quoted(c.name) for c in contract.columns))
    return flag_orphans(facts, known, foreign_key, lookup_unique=True), rejected
