"""Keyed upsert as a pure function over DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierforge.contract import AUDIT_COLUMN, Contract
from tierforge.functions.names import quoted
from tierforge.operators.dedupe import dedupe_on_keys, require_unique
from tierforge.operators.quality import all_present
from tierforge.operators.widening import wider
from tierforge.scratch import stage

_HIT = "__hit"
_OLD = "__old"
_IN = "__in_"


def key_predicate(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Every key equals its counterpart, so NULL keys match nothing."""
    return reduce(and_, (a == b for a, b in zip(left, right, strict=True)))


def spelled_like(source: DataFrame, names: Sequence[str]) -> DataFrame:
    """``source`` with those of its columns that are in ``names`` but for case named likewise."""
    known = {n.lower(): n for n in names}
    return source.select(*(quoted(c).alias(known.get(c.lower(), c)) for c in source.columns))


def merge_options(contract: Contract) -> dict:
    """How rows are merged into a contract's table.

    The load time is equal in all rows of a load and does not order them; columns that are
    new in the source widen the table.
    """
    return {
        "ignore": (AUDIT_COLUMN,),
        "duplicates": "first" if contract.dedupe else "raise",
        "add_columns": True,
    }


def unique_rows(
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] = (),
    ignore: Sequence[str] = (),
    duplicates: str = "first",
    keys_present: bool = False,
    spread: bool = False,
) -> DataFrame:
    """One row per key, and every row that has a NULL key, since those match nothing.

    The latter take a scan of their own; ``keys_present`` says that there are none. ``spread``: see
    ``dedupe_on_keys``.
    """
    if duplicates not in ("first", "raise"):
        raise ValueError(f"unknown way with duplicate keys: {duplicates!r}")
    keyed = source if keys_present else source.where(all_present(keys))
    if duplicates == "first":
        keyed = dedupe_on_keys(keyed, keys, order_by, ignore, spread=spread)
    else:
        keyed = require_unique(keyed, keys)
    return keyed if keys_present else keyed.unionByName(source.where(~all_present(keys)))


def merge_rows(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    *,
    order_by: Sequence[str | Column] = (),
    ignore: Sequence[str] = (),
    duplicates: str = "first",
    keys_present: bool = False,
    add_columns: bool = False,
    colocated: bool = False,
    observed: Observation | None = None,
) -> DataFrame:
    """Target after an upsert of ``source``; ``target=None`` is the first load.

    Rows whose keys match take every source column and keep the columns only the target
    has; source rows without a match are inserted. Columns only the source has raise,
    unless ``add_columns`` widens the result. Rows with a NULL key match nothing and are all
    kept; ``keys_present`` spares the search for them in a source that has none. Column names are
    matched without regard to case. A column whose types differ gets the one that holds both without
    loss (see ``wider``); if there is none, the merge raises before any job runs.

    A source key must occur once, on the first load too. ``duplicates`` says how that is
    brought about: keep the ``first`` row (see ``dedupe_on_keys``), ``raise`` when a key is
    repeated, or ``trust`` the caller.

    The result is two joins under a union rather than one full outer join. A full outer
    join always shuffles and sorts the whole target, and Spark neither broadcasts into it
    nor splits its skewed partitions. Here the updates are ``target left join source`` and
    the inserts are an anti join against the matched keys only, so a source small enough
    to broadcast leaves a large target where it is, and a hot target key is split. What the two
    joins share, the source made unique and the matched keys, is staged.

    ``colocated`` says that the target already lies by its keys: it is stored in buckets by them, or
    has just been made unique on them. Then a full outer join moves none of it, and everything is
    read once, with nothing staged. ``observed`` gets the numbers of rows ``inserted`` and ``updated``
    from the job that runs the merge.
    """
    check_merge(target, source, keys, add_columns)
    names = list(target.columns) if target is not None else []
    source = spelled_like(source, [*keys, *names])
    keys = [c for k in keys for c in (names or source.columns) if c.lower() == k.lower()]
    if duplicates != "trust":
        source = unique_rows(source, keys, order_by, ignore, duplicates, keys_present)
    if target is None:
        return observe_merge(source, observed, F.lit(False))
    if duplicates != "trust" and not colocated:
        source = stage(source, "merge")

    types = {f.name: f.dataType for f in source.schema.fields}
    types |= merged_types(target, source)
    columns = names + [c for c in source.columns if c not in names]
    key_columns = [quoted(k) for k in keys]

    incoming = source.select(
        *(quoted(c).alias(_IN + c) for c in source.columns), F.lit(True).alias(_HIT)
    )

    def updated(c: str) -> Column:
        old = (quoted(c) if c in names else F.lit(None)).cast(types[c])
        if c not in source.columns:
            return old.alias(c)
        return F.when(quoted(_HIT), quoted(_IN + c).cast(types[c])).otherwise(old).alias(c)

    def inserted(c: str) -> Column:
        value = quoted(c) if c in source.columns else F.lit(None)
        return value.cast(types[c]).alias(c)

    on = key_predicate(key_columns, [quoted(_IN + k) for k in keys])
    if colocated:
        held = target.withColumn(_OLD, F.lit(True)).join(incoming, on, "full_outer")
        return observe_merge(held, observed, quoted(_OLD).isNotNull(), quoted(_HIT).isNotNull()).select(
            *map(updated, columns)
        )
    kept = target.join(incoming, on, "left")
    kept = kept.select(*map(updated, columns), quoted(_HIT).alias(_OLD))
    # The repartitioning frees the join from keeping its rows by key, so that it may split them.
    matched = target.select(*key_columns).join(source.select(*key_columns), list(keys), "left_semi")
    matched = stage(matched.repartition(*key_columns).distinct(), "matched")
    # Rows with a NULL key match nothing, so they are among these.
    fresh = source.join(matched, list(keys), "left_anti")
    every = kept.unionByName(fresh.select(*map(inserted, columns), F.lit(False).alias(_OLD)))
    was_there = quoted(_OLD)
    return observe_merge(every, observed, was_there, was_there.isNotNull()).drop(_OLD)


def observe_merge(
    rows: DataFrame, observed: Observation | None, was_there: Column, is_source: Column | None = None
) -> DataFrame:
    """The rows of a merge, counted on their way: those from the source that were there or not."""
    if observed is None:
        return rows
    of_source = F.lit(True) if is_source is None else is_source
    return rows.observe(
        observed,
        F.count(F.when(of_source & ~was_there, 1)).alias("inserted"),
        F.count(F.when(of_source & was_there, 1)).alias("updated"),
    )


def merged_types(target: DataFrame, source: DataFrame) -> dict[str, T.DataType]:
    """The types of the target's columns after a merge."""
    new = {f.name.lower(): f.dataType for f in source.schema.fields}
    types, apart = {}, []
    for field in target.schema.fields:
        other = new.get(field.name.lower(), field.dataType)
        types[field.name] = wider(field.dataType, other)
        if types[field.name] is None:
            apart.append(f"{field.name} ({field.dataType.simpleString()}, {other.simpleString()})")
    if apart:
        raise ValueError(f"no type holds what target and source have in {', '.join(apart)}")
    return types


def check_merge(
    target: DataFrame | None, source: DataFrame, keys: Sequence[str], add_columns: bool
) -> None:
    """Raise where a merge cannot make sense, before any job runs."""
    if not keys:
        raise ValueError("a merge needs at least one key column")
    for side, df in (("source", source), ("target", target)):
        present = {c.lower() for c in df.columns} if df is not None else set()
        missing = [k for k in keys if df is not None and k.lower() not in present]
        if missing:
            raise ValueError(f"merge {side} lacks key columns {missing}")
    if target is not None and not add_columns:
        known = {c.lower() for c in target.columns}
        extra = [c for c in source.columns if c.lower() not in known]
        if extra:
            raise ValueError(f"merge source has columns the target lacks: {extra}")
    if target is not None:
        merged_types(target, source)
