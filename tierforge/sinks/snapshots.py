"""Tables as published snapshots, found by their path.

A table is a folder. Its rows lie in data folders that Spark writes and that are never changed; the
newest of the small files in ``_published`` points to the one that is the table, and says how it
is stored. They are numbered, and a number can be taken only once: a writer that worked from an
older state than the newest finds its number taken, and fails instead of undoing the other's work.
That needs a file system that refuses to create or rename to a name that is taken (local, HDFS); on
object stores without such an operation only one writer at a time is safe. A write that breaks off
leaves a data folder nobody points to.

A table may be stored in Spark's buckets, by its keys and sorted by them: then a merge by these
keys joins it where it lies.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierforge.functions.names import quoted
from tierforge.scratch import staging
from tierforge.sinks.layout import by_partition
from tierforge.storage import Folder

# Files of a data folder are put in place by the tasks: nobody looks before it is pointed to.
_COMMIT = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
_PUBLISHED = "_published"


class ConcurrentWrite(RuntimeError):
    """Someone else published a snapshot since the one this write started from."""


@dataclass(frozen=True)
class Snapshot:
    """``buckets``: how many there are, by ``keys``; 0 if the rows lie in none."""

    version: int
    fmt: str
    schema: T.StructType
    partition_by: tuple[str, ...]
    keys: tuple[str, ...]
    buckets: int
    folder: str

    def text(self) -> str:
        return json.dumps(vars(self) | {"schema": self.schema.jsonValue()}, indent=1)

    @classmethod
    def parsed(cls, text: str) -> Snapshot:
        held = json.loads(text)
        return cls(**held | {
            "schema": T.StructType.fromJson(held["schema"]),
            "partition_by": tuple(held["partition_by"]),
            "keys": tuple(held["keys"]),
        })


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def published_names(spark: SparkSession, root: str, name: str) -> list[str]:
    """The names of the table's published files; none if it is not a table of ours."""
    folder = Folder(spark, f"{table_path(root, name)}/{_PUBLISHED}")
    return [n for n in folder.names() if n.endswith(".json")]


def newest(spark: SparkSession, root: str, name: str) -> Snapshot | None:
    """The table's current snapshot; None if there is no table.

    Raises if the folder holds rows that were never published here: they are somebody's table,
    and taking them for none would lose them.
    """
    table = Folder(spark, table_path(root, name))
    found = table.names()
    marks = published_names(spark, root, name) if _PUBLISHED in found else []
    if marks:
        return Snapshot.parsed(Folder(spark, f"{table.path}/{_PUBLISHED}").read(max(marks)))
    foreign = [n for n in found if not n.startswith(("_", ".", "data-"))]
    if foreign:
        raise ValueError(f"{table.path} holds {foreign[0]} and others, but no published snapshot")
    return None


def read_snapshot(spark: SparkSession, root: str, name: str, at: Snapshot) -> DataFrame:
    """The rows of a snapshot. Only the catalog can tell a scan of buckets, so one that is stored
    in buckets is made known to it."""
    if at.buckets:
        return spark.table(_known(spark, root, name, at)).select(*map(quoted, at.schema.names))
    place = f"{table_path(root, name)}/{at.folder}"
    return spark.read.schema(at.schema).format(at.fmt).load(place).select(*map(quoted, at.schema.names))


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table's rows as they are now."""
    at = newest(spark, root, name)
    if at is None:
        raise LookupError(f"no table {name} below {root}")
    return read_snapshot(spark, root, name, at)


def publish(
    df: DataFrame,
    root: str,
    name: str,
    before: Snapshot | None,
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    keys: Sequence[str] = (),
    buckets: int = 0,
    colocated: bool = False,
    expected: DataFrame | None = None,
) -> Snapshot:
    """Write ``df`` and make it the table's rows.

    ``before`` is the snapshot the rows were made from. ``colocated`` says that the rows already
    lie by their keys in as many partitions as there are buckets. ``expected``: see ``by_partition``.
    """
    spark, path = df.sparkSession, table_path(root, name)
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    folder = f"data-{stamp}-{uuid.uuid4().hex[:12]}"
    nullable = T.StructType([replace_nullable(f) for f in df.schema])
    now = Snapshot(
        (before.version if before else 0) + 1, fmt, nullable, tuple(partition_by),
        tuple(keys) if buckets else (), buckets, folder,
    )
    with staging(spark):
        if buckets:
            rows = df if colocated else df.repartition(buckets, *map(quoted, keys))
            writer = rows.write.format(fmt).bucketBy(buckets, *keys).sortBy(*keys)
        else:
            rows = by_partition(df, partition_by, expected) if partition_by else df
            writer = rows.write.format(fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer = writer.options(**_COMMIT)
        if buckets:
            place = Folder(spark, f"{path}/{folder}").path
            writer.option("path", place).saveAsTable(_identifier(_known_name(name, now)))
        else:
            writer.save(f"{path}/{folder}")
    if not Folder(spark, f"{path}/{_PUBLISHED}").create(f"{now.version:012d}.json", now.text()):
        raise ConcurrentWrite(f"{path}: version {now.version} was published meanwhile")
    show(spark, root, name, now)
    return now


def show(spark: SparkSession, root: str, name: str, at: Snapshot | None = None) -> None:
    """Make ``name`` a view over a snapshot, by default the newest, for use in SQL."""
    at = at or newest(spark, root, name)
    if at is None:
        raise LookupError(f"no table {name} below {root}")
    columns = ", ".join(quoted_name(c) for c in at.schema.names)
    known = _known(spark, root, name, at)
    spark.sql(f"CREATE OR REPLACE VIEW {_identifier(name)} AS SELECT {columns} FROM {known}")


def _known_name(name: str, at: Snapshot) -> str:
    return f"{name}__{at.folder.replace('-', '_')}"


def _known(spark: SparkSession, root: str, name: str, at: Snapshot) -> str:
    """The data folder's name in the catalog, which is told of it if need be.

    It is told the columns: a partition of strings stays one whatever its values look like, and a
    table without rows has columns.
    """
    known = _identifier(_known_name(name, at))
    if not spark.catalog.tableExists(known):
        declared = ", ".join(f"{quoted_name(f.name)} {f.dataType.simpleString()}" for f in at.schema)
        by = f"PARTITIONED BY ({_names(at.partition_by)})" if at.partition_by else ""
        if at.buckets:
            by += f" CLUSTERED BY ({_names(at.keys)}) SORTED BY ({_names(at.keys)}) INTO {at.buckets} BUCKETS"
        place = Folder(spark, f"{table_path(root, name)}/{at.folder}").path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {known} ({declared}) USING {at.fmt} {by} LOCATION '{place}'")
        if at.partition_by:
            spark.catalog.recoverPartitions(known)
    return known


def drop_old(spark: SparkSession, root: str, name: str, keep: int = 2) -> list[str]:
    """Delete the data folders that none of the newest ``keep`` snapshots refers to.

    Not for use while a write is under way: its folder is not referred to yet.
    """
    table = Folder(spark, table_path(root, name))
    published = Folder(spark, f"{table.path}/{_PUBLISHED}")
    marks = sorted(n for n in published.names() if n.endswith(".json"))
    kept = {Snapshot.parsed(published.read(n)).folder for n in marks[-max(1, keep) :]}
    gone = [n for n in table.names() if n.startswith("data-") and n not in kept] if marks else []
    for n in marks[: -max(1, keep)]:
        published.delete(n)
    for n in gone:
        table.delete(n)
    return gone


def replace_nullable(field: T.StructField) -> T.StructField:
    """Stored columns may be null; metadata of views stays behind."""
    return T.StructField(field.name, field.dataType, True)


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _identifier(name: str) -> str:
    """A table name of one or more parts, quoted."""
    return ".".join(quoted_name(part) for part in name.split("."))


def _names(columns: Sequence[str]) -> str:
    return ", ".join(map(quoted_name, columns))


__all__ = [
    "ConcurrentWrite", "Snapshot", "drop_old", "newest", "publish", "published_names",
    "read_snapshot", "read_table", "show",
]
