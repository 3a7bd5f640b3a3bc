"""Bring raw rows under a contract: names, types, defaults, audit column."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.contract import AUDIT_COLUMN, Contract
from tierforge.functions.casts import cast_leniently
from tierforge.functions.names import quoted


def conform(df: DataFrame, contract: Contract, *, strict: bool = False) -> DataFrame:
    """Rename source headers, cast, and fill defaults, in one projection.

    By default drift is tolerated: contract columns the input lacks are left out (unless
    they have a default), input columns the contract lacks are kept, and a type the
    contract names but we do not know leaves its column as read. Column names match without regard to
    case, source headers exactly. ``strict`` returns exactly
    the contract's columns in order and raises on either kind of gap.
    """
    # Spark takes names that differ in case for the same, so the contract's spelling is given to all.
    spelled = {c.name.lower(): c.name for c in contract.columns}
    rename = {c.source: c.name for c in contract.columns if c.source}
    names = [rename.get(c) or spelled.get(c.lower(), c) for c in df.columns]
    clashes = [n for n, k in Counter(n.lower() for n in names).items() if k > 1]
    if clashes:
        raise ValueError(f"{contract.table}: several input columns would be named {clashes}")

    declared = {c.name: c for c in contract.columns}
    if strict:
        _check_strict(contract, names)

    out: dict[str, Column] = {}
    for field, name in zip(df.schema.fields, names):
        value = quoted(field.name)
        spec = declared.get(name)
        if spec is not None:
            if spec.spark_type is not None:
                value = cast_leniently(value, field.dataType, spec.spark_type)
            if spec.default is not None:
                value = F.coalesce(value, _default(spec))
        out[name] = value.alias(name)
    for spec in contract.columns:
        if spec.name not in out and spec.default is not None:
            out[spec.name] = _default(spec).alias(spec.name)

    return df.select(*([out[c.name] for c in contract.columns] if strict else out.values()))


def add_audit(df: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    """Stamp every row with the time of the load; pass ``at`` for a reproducible value."""
    stamp = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return df.withColumn(AUDIT_COLUMN, stamp)


def _default(spec) -> Column:
    value = F.lit(spec.default)
    return value if spec.spark_type is None else value.cast(spec.spark_type)


def _check_strict(contract: Contract, present: list[str]) -> None:
    unknown = [c.name for c in contract.columns if c.spark_type is None]
    if unknown:
        raise ValueError(f"{contract.table}: unknown types for columns {unknown}")
    missing = [c.name for c in contract.columns if c.name not in present and c.default is None]
    if missing:
        raise ValueError(f"{contract.table}: input lacks columns {missing}")
