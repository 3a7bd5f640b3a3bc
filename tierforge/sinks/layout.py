"""How the rows of a partitioned table are dealt to the tasks that write it."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierforge.functions.names import quoted
from tierforge.scratch import stage

_ROWS, _KNOWN, _PIECES = "__rows", "__known_", "__pieces"


def by_partition(
    df: DataFrame, partition_by: Sequence[str], expected: DataFrame | None = None
) -> DataFrame:
    """The rows, those of a partition brought together.

    Left where they are, every task would add a file to every partition. What a partition costs to
    write is its rows, at the width the schema leads to expect, and a folder to open
    (``spark.sql.files.openCostInBytes``); the sum over ``advisoryPartitionSizeInBytes`` is the
    number of tasks, at least one a core. So folders of little content are written by all cores,
    and a partition that is larger than the advisory size is cut into as many pieces, by a hash of
    its rows, each of a task and file of its own. Where partitions are so large that every task has
    that much for each of them, rows stay where they are.

    Counting is one more pass over the rows; those that take a shuffle to make are staged for it, so
    that they are made once. ``expected`` (see ``rows_by``) spares both: the numbers of rows, or
    what they are at most or about, as they are known from what the rows are made from.
    """
    spark, columns = df.sparkSession, list(partition_by)
    shuffled = is_shuffled(df)
    if shuffled and expected is None:
        df, shuffled = stage(df, "rows"), False
    most, opening = (_bytes(spark, f"spark.sql.{name}") for name in (
        "adaptive.advisoryPartitionSizeInBytes", "files.openCostInBytes",
    ))
    sizes = stage(rows_by(df, columns) if expected is None else expected, "partitions")
    size = F.col(_ROWS) * df._jdf.schema().defaultSize()
    total, largest, held, partitions = sizes.agg(
        F.sum(size + opening), F.max(size), F.sum(size), F.count(F.lit(1))
    ).first()
    # In how many partitions rows lie that take a shuffle is known once that has run.
    large_ones = partitions and partitions * most <= held and not shuffled
    if large_ones and partitions * most * df.rdd.getNumPartitions() <= held:
        return df
    tasks = max(spark.sparkContext.defaultParallelism, -(-(total or 0) // most))
    hashed = [quoted(f.name) for f in df.schema if not _holds_map(f.dataType)]
    if (largest or 0) <= most or not hashed:
        return df.repartition(tasks, *map(quoted, columns))
    # No more rows than the table has pieces.
    large = sizes.where(size > most).select(
        *[quoted(c).alias(_KNOWN + c) for c in columns], F.ceil(size / most).alias(_PIECES)
    )
    same = [quoted(c).eqNullSafe(quoted(_KNOWN + c)) for c in columns]
    dealt = df.join(large, same, "left")
    piece = F.pmod(F.xxhash64(*hashed), F.coalesce(_PIECES, F.lit(1)))
    dealt = dealt.repartition(tasks, *map(quoted, columns), piece)
    return dealt.select(*map(quoted, df.columns))


def rows_by(
    df: DataFrame, partition_by: Sequence[str], number: Column | None = None
) -> DataFrame:
    """How many rows each partition has, or the aggregate ``number`` of it."""
    number = F.count(F.lit(1)) if number is None else number
    return df.groupBy(*map(quoted, partition_by)).agg(number.alias(_ROWS))


def partitioned(df: DataFrame, fmt: str, partition_by: Sequence[str]) -> DataFrameWriter:
    """A writer of the rows, by partition."""
    if not partition_by:
        return df.write.format(fmt)
    return by_partition(df, partition_by).write.format(fmt).partitionBy(*partition_by)


def is_shuffled(df: DataFrame) -> bool:
    """Does it take a shuffle to make the rows?"""
    return re.search(r"\bExchange\b", df._jdf.queryExecution().executedPlan().toString()) is not None


def _bytes(spark: SparkSession, setting: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(setting))


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _holds_map(kind.elementType)
