"""Bronze: raw strings -> typed, checked, stamped rows -> keyed upsert."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierforge.contract import AUDIT_COLUMN, Contract
from tierforge.operators.conform import add_audit, conform
from tierforge.operators.dedupe import are_spread, dedupe_on_keys
from tierforge.operators.merge import merge_options, merge_rows
from tierforge.operators.quality import require_not_null, split_not_null
from tierforge.scratch import stage, staging
from tierforge.sinks.layout import rows_by
from tierforge.sinks.tables import write_by_contract
from tierforge.sources.files import contract_root, contract_scan, csv_quarantine


def bronze_rows(
    raw: DataFrame,
    contract: Contract,
    *,
    at: dt.datetime | None = None,
    strict: bool = False,
    nulls: str = "reject",
) -> tuple[DataFrame, DataFrame]:
    """Rows under the contract, and the rows rejected for a missing required value.

    Required are the columns declared not nullable and the keys: a row with a NULL key
    matches nothing, so every rerun would insert it again. A required column that the input
    lacks, and that has no default, is missing in all rows. With ``nulls="fail"`` the first such
    row fails the query instead.
    """
    return _checked(_conformed(raw, contract, strict), contract, at, nulls)


def _conformed(raw: DataFrame, contract: Contract, strict: bool = False) -> DataFrame:
    """The rows under the contract's names and types, with all required columns."""
    rows = conform(raw, contract, strict=strict)
    types = {c.name: c.spark_type for c in contract.columns}
    # A required column that the input lacks is missing in every row.
    for name in contract.required:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(types.get(name) or "string"))
    return rows


def _checked(
    rows: DataFrame, contract: Contract, at: dt.datetime | None, nulls: str = "reject"
) -> tuple[DataFrame, DataFrame]:
    """The stamped rows that miss no required value, and the others."""
    if nulls == "fail":
        valid, rejected = require_not_null(rows, contract.required), split_not_null(rows, [])[1]
    elif nulls == "reject":
        valid, rejected = split_not_null(rows, contract.required)
    else:
        raise ValueError(f"unknown way with missing values: {nulls!r}")
    return (add_audit(valid, at) if contract.audit else valid), rejected


def bronze_load(
    raw: DataFrame,
    contract: Contract,
    target: DataFrame | None = None,
    *,
    at: dt.datetime | None = None,
) -> DataFrame:
    """The bronze table after loading ``raw``: into ``target`` (None on the first load), or in
    its place if the contract says to overwrite."""
    valid, _ = bronze_rows(raw, contract, at=at)
    if contract.write_mode == "overwrite":
        return _replacement(valid, contract)
    return merge_rows(target, valid, contract.keys, keys_present=True, **merge_options(contract))


def load_bronze(
    spark: SparkSession,
    contract: Contract,
    roots: Mapping[str, str],
    root: str,
    *,
    raw: DataFrame | None = None,
    at: dt.datetime | None = None,
    fmt: str = "parquet",
    buckets: int | None = None,
    quarantine: bool = False,
    figures: dict[str, int] | None = None,
) -> DataFrame:
    """Read the contract's source, write its bronze table below ``root``; returns the rejects.

    ``raw`` takes the place of the source, exported sheets for example. The rejects are stored
    below ``<root>/<table>__rejected``, a folder for each load. ``quarantine``: rows of CSV files
    that have more cells than the contract has headers are not cut to size, but left out and stored
    as they are below ``<root>/<table>__quarantined``. ``buckets``: see ``write_by_contract``.
    ``figures`` gets the numbers of rows ``read``, ``quarantined``, ``rejected``, ``inserted`` and
    ``updated``: each job counts the rows it handles anyway.

    The source is read and cast once: its rows are staged before they are looked at again.
    """
    seen = {name: Observation() for name in ("read", "quarantined", "rejected")} if figures is not None else {}

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.observe(seen[name], F.count(F.lit(1)).alias(name)) if seen else rows

    if raw is None and quarantine:
        if contract.source_format != "csv":
            raise ValueError(f"{contract.table}: only rows of CSV files can be quarantined")
        options = contract.reader_options
        place = contract_root(contract, roots)
        source, odd = csv_quarantine(spark, place, contract.glob, contract.headers, options)
        counted(odd, "quarantined").write.parquet(f"{root.rstrip('/')}/{contract.table}__quarantined/load={uuid.uuid4().hex}")
    else:
        source = contract_scan(spark, contract, roots) if raw is None else raw
    with staging(spark):
        rows = stage(_conformed(counted(source, "read"), contract), "conformed")
        valid, rejected = _checked(rows, contract, at)
        kept = f"{root.rstrip('/')}/{contract.table}__rejected/load={uuid.uuid4().hex}"
        counted(rejected, "rejected").write.parquet(kept)
        if seen:
            written = ["read", "rejected"] + (["quarantined"] if raw is None and quarantine else [])
            figures |= {name: seen[name].get[name] for name in written}
        # Of rows with equal keys one is left, so there are that many at most.
        expected = rows_by(valid, contract.partitions) if contract.partitions else None
        spread = bool(contract.dedupe and contract.keys) and are_spread(valid, contract.keys)
        if contract.write_mode == "overwrite":
            valid = _replacement(valid, contract, spread)
        write_by_contract(
            valid, contract, root, fmt, keys_present=True, buckets=buckets, figures=figures,
            expected=expected, spread=spread,
        )
    return spark.read.schema(rejected.schema).parquet(kept)


def _replacement(valid: DataFrame, contract: Contract, spread: bool = False) -> DataFrame:
    if contract.dedupe and contract.keys:
        return dedupe_on_keys(valid, contract.keys, ignore=[AUDIT_COLUMN], spread=spread)
    return valid
