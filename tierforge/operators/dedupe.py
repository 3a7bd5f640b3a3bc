"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierforge.functions.names import quoted

_RANK = "__rank"

# Into how many groups the keys are hashed to see whether one of them is hot.
_GROUPS = 4096


def dedupe_on_keys(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] = (),
    ignore: Sequence[str] = (),
    *,
    spread: bool = False,
) -> DataFrame:
    """The first row of each key under ``order_by``, then under all other columns.

    The trailing columns make the order total, so a rerun, or a run with lost executors,
    picks the same row. Columns in ``ignore`` (say, a load time that is equal everywhere)
    take no part. NULL counts as one key value.

    ``row_number() = 1`` lets Spark put a group limit before the shuffle: each map task
    sends at most one row per key, so a key that holds a third of the table costs the
    reducer one row per map task. That sorts all rows before the shuffle and after it;
    ``spread`` says that no key is hot (see ``are_spread``), and they are sorted once, after it.
    """
    if not keys:
        raise ValueError("dedupe needs at least one key column")
    skip = {*keys, *ignore, *(o for o in order_by if isinstance(o, str))}
    order = [F.col(o) if isinstance(o, str) else o for o in order_by]
    order += [quoted(c) for c in df.columns if c not in skip]
    if spread:
        df = df.repartition(*map(quoted, keys))
    rank = F.row_number().over(
        Window.partitionBy(*map(quoted, keys)).orderBy(*(order or [F.lit(0)]))
    )
    return df.withColumn(_RANK, rank).where(quoted(_RANK) == 1).drop(_RANK)


def are_spread(df: DataFrame, keys: Sequence[str]) -> bool:
    """Does no key have more rows than a task of a shuffle gets on average?

    One pass over the keys, which counts them by a hash: the largest group is no smaller than the
    rows of the hottest key.
    """
    group = F.pmod(F.xxhash64(*map(quoted, keys)), F.lit(_GROUPS)).alias("group")
    counted = df.groupBy(group).agg(F.count(F.lit(1)).alias("rows"))
    total, largest = counted.agg(F.sum("rows"), F.max("rows")).first()
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return total is not None and largest * tasks <= total


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The input, failing the query at the first key that occurs twice.

    Two rows per key are enough to tell, so the group limit works here as well.
    """
    rank = F.row_number().over(Window.partitionBy(*map(quoted, keys)).orderBy(F.lit(0)))
    second = F.raise_error(F.lit(f"more than one row for a key in {', '.join(keys)}"))
    return (
        df.withColumn(_RANK, rank)
        .where(quoted(_RANK) <= 2)
        .where(F.when(quoted(_RANK) == 2, second.cast("boolean")).otherwise(F.lit(True)))
        .drop(_RANK)
    )
