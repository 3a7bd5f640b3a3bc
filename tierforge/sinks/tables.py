"""Table writers.

A Parquet folder cannot be updated in place, and overwriting a folder the plan still reads
loses the data. So a table that is replaced or upserted is a series of published snapshots
(see :mod:`tierforge.sinks.snapshots`), found by its path in any session. A failed or repeated
write leaves the old snapshot current; readers that started earlier keep theirs. An upsert of such
a table writes all of it anew, whatever the number of rows it brings; stored in buckets by its keys
it is not shuffled for that. What leaves unmatched data alone is :func:`upsert_partitions`, where the
partition columns are keys, and :func:`upsert_native`, where a format with its own MERGE is
installed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierforge.contract import Contract
from tierforge.functions.names import quoted
from tierforge.operators.merge import (
    check_merge,
    key_predicate,
    merge_options,
    merge_rows,
    merged_types,
    observe_merge,
    spelled_like,
    unique_rows,
)
from tierforge.scratch import stage, staging
from tierforge.sinks.layout import partitioned
from tierforge.sinks.snapshots import Snapshot, newest, publish, read_snapshot
from tierforge.sources.files import read_if_exists
from tierforge.storage import Folder

# Formats whose tables Spark can MERGE INTO.
MERGING_FORMATS = frozenset(("delta", "iceberg", "hudi"))


def overwrite(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Replace everything at ``path``; refuses a path that ``df`` itself reads.

    What was there is deleted before the new rows are written: a job that fails leaves no table.
    ``create_or_replace`` keeps the old rows until the new ones are complete.
    """
    _refuse_own_input(df, path)
    with staging(df.sparkSession):
        partitioned(df, fmt, partition_by).mode("overwrite").save(path)


def create_if_missing(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> None:
    """An empty table with the given schema, unless something is there already."""
    spark.createDataFrame([], schema).write.format(fmt).mode("ignore").save(path)


def create_or_replace(
    df: DataFrame,
    name: str,
    root: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    expected: DataFrame | None = None,
) -> Snapshot:
    """Make ``name`` show ``df``'s rows; returns the new snapshot.

    Old snapshots stay until :func:`drop_old` is called. ``expected``: see ``by_partition``.
    """
    before = newest(df.sparkSession, root, name)
    return publish(df, root, name, before, fmt=fmt, partition_by=partition_by, expected=expected)


def create_table(
    spark: SparkSession,
    name: str,
    root: str,
    schema: T.StructType,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> Snapshot:
    """A table without rows, unless there is one already; returns its snapshot."""
    before = newest(spark, root, name)
    if before is not None:
        return before
    empty = spark.createDataFrame([], schema)
    return publish(empty, root, name, None, fmt=fmt, partition_by=partition_by)


def upsert_table(
    source: DataFrame,
    name: str,
    root: str,
    keys: Sequence[str],
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    buckets: int = 0,
    figures: dict[str, int] | None = None,
    expected: DataFrame | None = None,
    **options,
) -> Snapshot:
    """Keyed upsert into ``name``, created on the first call; returns the new snapshot.

    Whether there is a table is settled by its path, not by the catalog. ``buckets`` is the number
    of Spark's buckets of a new table, by its keys (0: none); an existing one keeps its layout, and
    in buckets only the source is shuffled. ``options`` are those of ``merge_rows``. ``figures`` gets
    the numbers of rows ``inserted`` and ``updated``, counted by the job that writes them.
    ``expected`` tells how many rows of each partition ``source`` has at most (see ``by_partition``).
    """
    if figures is not None:
        figures |= {"inserted": 0, "updated": 0}
    observed = Observation() if figures is not None else None
    after = _upserted(
        source, name, root, keys, fmt, partition_by, buckets, observed, expected, options
    )
    if after.is_new and figures is not None:
        figures |= observed.get
    return after.snapshot


class _After(NamedTuple):
    snapshot: Snapshot
    is_new: bool


def _upserted(
    source: DataFrame,
    name: str,
    root: str,
    keys: Sequence[str],
    fmt: str,
    partition_by: Sequence[str],
    buckets: int,
    observed: Observation | None,
    expected: DataFrame | None,
    options: Mapping,
) -> _After:
    spark = source.sparkSession
    before = newest(spark, root, name)
    options = {**options, "observed": observed}
    with staging(spark):
        if before is None:
            rows = _merged(None, source, keys, **options)
            layout = {"fmt": fmt, "partition_by": partition_by, "keys": keys, "buckets": buckets}
            layout |= {"expected": expected}
            return _After(publish(rows, root, name, None, **layout), True)
        layout = {"fmt": before.fmt, "partition_by": before.partition_by}
        target = read_snapshot(spark, root, name, before)
        if not before.buckets:
            merged = _merged(target, source, keys, **options)
            return _After(publish(merged, root, name, before, **layout), True)
        if tuple(keys) != before.keys:
            raise ValueError(f"{name} is stored by {list(before.keys)}, not by {list(keys)}")
        add_columns = options.get("add_columns", False)
        check_merge(target, source, keys, add_columns)
        rows = stage(_unique(spelled_like(source, before.schema.names), keys, options), "merge")
        if rows.isEmpty():
            return _After(before, False)
        types = merged_types(target, rows)
        layout |= {"keys": keys, "buckets": before.buckets}
        if any(types[k] != before.schema[k].dataType for k in keys):
            # Keys of another type lie in other buckets.
            how = {"duplicates": "trust", "add_columns": add_columns, "observed": observed}
            return _After(publish(merge_rows(target, rows, keys, **how), root, name, before, **layout), True)
        typed = {k: quoted(k).cast(before.schema[k].dataType) for k in keys}
        placed = rows.withColumns(typed).repartition(before.buckets, *map(quoted, keys))
        merged = merge_rows(
            target, placed, keys, duplicates="trust", add_columns=add_columns, colocated=True,
            observed=observed,
        )
        return _After(publish(merged, root, name, before, colocated=True, **layout), True)


def upsert_path(
    source: DataFrame,
    target_path: str,
    out_path: str,
    keys: Sequence[str],
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    **options,
) -> None:
    """Keyed upsert of the table at ``target_path`` (which need not exist yet), written to
    ``out_path``; the caller does the switch."""
    types = {c: source.schema[c].dataType for c in partition_by}
    target = read_if_exists(source.sparkSession, target_path, fmt, types)
    overwrite(_merged(target, source, keys, **options), out_path, fmt, partition_by)


def upsert_partitions(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    *,
    fmt: str = "parquet",
    add_columns: bool = False,
    keys_present: bool = False,
    **options,
) -> None:
    """Keyed upsert in place that reads and rewrites only the partitions the source has rows of.

    The partition columns must be keys: then no row changes its partition, and the others
    hold no match. The new partitions are staged before they replace the old ones, so a
    failing job leaves the table as it was; what is not atomic is the final renaming.
    """
    if not partition_by or not set(partition_by) <= set(keys):
        raise ValueError(f"partition columns {list(partition_by)} must be among the keys")
    types = {c: source.schema[c].dataType for c in partition_by}
    target = read_if_exists(source.sparkSession, path, fmt, types)
    check_merge(target, source, keys, add_columns)
    if target is not None and any(merged_types(target, source)[f.name] != f.dataType for f in target.schema):
        raise ValueError("a wider type would have to be written into all partitions")
    rows = unique_rows(source, keys, keys_present=keys_present, **options)
    with staging(source.sparkSession):
        if target is not None:
            rows = stage(rows, "merge")
            # Joined on whole tuples: the scan is pruned to the partitions that are concerned.
            concerned = F.broadcast(rows.select(*map(quoted, partition_by)).distinct())
            merged = merge_rows(
                _semi_join(target, concerned, partition_by),
                rows,
                keys,
                duplicates="trust",
                keys_present=keys_present,
                add_columns=add_columns,
            )
            rows = stage(merged, "partitions")
        writer = partitioned(rows, fmt, partition_by).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").save(path)


def _semi_join(rows: DataFrame, wanted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose values of ``columns``, nulls included, are in ``wanted``."""
    renamed = wanted.select(*(quoted(c).alias(f"__wanted_{c}") for c in columns))
    on = reduce(and_, (quoted(c).eqNullSafe(quoted(f"__wanted_{c}")) for c in columns))
    return rows.join(renamed, on, "left_semi")


def _merged(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    *,
    add_columns: bool = False,
    duplicates: str = "first",
    keys_present: bool = False,
    spread: bool = False,
    observed: Observation | None = None,
    **ordering,
) -> DataFrame:
    """``merge_rows`` with the source made unique and staged first.

    A merge reads its source several times. Staged, the source is evaluated once, its true
    size decides whether it is broadcast, and the joins read plain shuffles, which is what
    Spark needs in order to split a hot key.
    """
    check_merge(target, source, keys, add_columns)
    how = {"duplicates": duplicates, "keys_present": keys_present, "spread": spread}
    source = _unique(source, keys, ordering | how)
    if target is None:
        return observe_merge(source, observed, F.lit(False))
    return merge_rows(
        target,
        stage(source, "merge"),
        keys,
        duplicates="trust",
        keys_present=keys_present,
        add_columns=add_columns,
        observed=observed,
    )


def _unique(source: DataFrame, keys: Sequence[str], options: Mapping) -> DataFrame:
    if options.get("duplicates") == "trust":
        return source
    others = ("add_columns", "observed")
    return unique_rows(source, keys, **{n: v for n, v in options.items() if n not in others})


def upsert_native(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    *,
    fmt: str = "delta",
    partition_by: Sequence[str] = (),
    **options,
) -> None:
    """Keyed upsert into a table whose format has a MERGE of its own, created on the first call.

    Such a format rewrites only the files that hold matching rows, and commits atomically.
    """
    check_merge(None, source, keys, False)
    rows = unique_rows(source, keys, **options)
    if source.sparkSession.catalog.tableExists(table):
        merge_into(stage(rows, "merge"), table, keys)
    else:
        writer = rows.writeTo(table).using(fmt)
        (writer.partitionedBy(*map(F.col, partition_by)) if partition_by else writer).create()


def merge_into(source: DataFrame, table: str, keys: Sequence[str]) -> None:
    """The MERGE statement: matched rows take every source column, the others are inserted.

    Columns only the target has keep their value, or stay NULL in inserted rows.
    """
    check_merge(None, source, keys, False)
    on = key_predicate(*([F.col(f"{side}.`{k}`") for k in keys] for side in (table, "source")))
    values = {c: F.col(f"source.`{c}`") for c in source.columns}
    merge = source.alias("source").mergeInto(table, on)
    merge.whenMatched().update(values).whenNotMatched().insert(values).merge()


def write_by_contract(
    df: DataFrame,
    contract: Contract,
    root: str,
    fmt: str = "parquet",
    *,
    keys_present: bool = False,
    keys_unique: bool = False,
    buckets: int | None = None,
    figures: dict[str, int] | None = None,
    expected: DataFrame | None = None,
    spread: bool = False,
) -> None:
    """Upsert or replace the contract's table, as its write mode says.

    A format with a MERGE of its own uses it; a new table of another is stored by its partitions or,
    if it has none, in ``buckets`` by its keys (as many as ``spark.sql.shuffle.partitions``, unless
    given). ``keys_unique`` says that no key of ``df`` repeats. ``figures`` gets the numbers of rows
    ``inserted`` and ``updated``; a format's own MERGE does not tell them. ``expected``: see
    ``by_partition``; ``spread``: see ``dedupe_on_keys``.
    """
    if contract.write_mode != "merge":
        observed = Observation() if figures is not None else None
        rows = observe_merge(df, observed, F.lit(False))
        create_or_replace(rows, contract.table, root, fmt, contract.partitions, expected)
        if figures is not None:
            figures |= observed.get
    elif fmt in MERGING_FORMATS:
        options = {n: v for n, v in merge_options(contract).items() if n != "add_columns"}
        upsert_native(
            df,
            contract.table,
            contract.keys,
            fmt=fmt,
            partition_by=contract.partitions,
            keys_present=keys_present,
            **options,
        )
    else:
        if buckets is None:
            shuffled = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            buckets = 0 if contract.partitions else shuffled
        upsert_table(
            df,
            contract.table,
            root,
            contract.keys,
            fmt=fmt,
            partition_by=contract.partitions,
            buckets=buckets,
            figures=figures,
            expected=expected,
            keys_present=keys_present,
            spread=spread,
            **merge_options(contract) | ({"duplicates": "trust"} if keys_unique else {}),
        )


def _refuse_own_input(df: DataFrame, path: str) -> None:
    """Raise if a relation of the plan reads below ``path``, or ``path`` lies below one."""
    spark = df.sparkSession
    own = Folder(spark, path).path.rstrip("/") + "/"
    for root in _relation_roots(df):
        other = Folder(spark, unquote(root)).path.rstrip("/") + "/"
        if other.startswith(own) or own.startswith(other):
            raise ValueError(f"refusing to overwrite {path}: the rows to write are read from it")


def _relation_roots(df: DataFrame) -> list[str]:
    """The paths that were given to the readers in a plan: a few, however many files they hold."""
    found = []
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            relation = leaf.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                paths = relation.location().rootPaths()
                found += [paths.apply(i).toString() for i in range(paths.size())]
    return found
