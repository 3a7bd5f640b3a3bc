"""Grouped sums over a fact table joined with a lookup table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.functions.names import quoted

_COPIES = "__copies"
_MATCH = "__match"


@dataclass(frozen=True)
class Sum:
    name: str
    value: Column


def summarise_with_lookup(
    fact: DataFrame,
    lookup: DataFrame,
    key: str,
    group_by: Sequence[str],
    labels: Sequence[str],
    sums: Sequence[Sum],
) -> DataFrame:
    """``fact LEFT JOIN lookup USING (key) GROUP BY group_by, key, labels`` with sums.

    The facts are summed by ``(group_by, key)`` *before* the join. The join then moves one
    row per group instead of one per fact, and a key that holds a third of the facts is
    folded together on the map side; joining first would gather all its rows in one
    partition, because the later grouping can reuse the join's partitioning and so keeps
    the skewed one. Facts without a match keep NULL labels, and NULL is a group.

    A key that occurs n times in the lookup with equal labels counts n times, as the plain
    join would count it.
    """
    grain = [c for c in group_by if c != key] + [key]
    facts = fact.groupBy(*map(quoted, grain)).agg(*(F.sum(s.value).alias(s.name) for s in sums))
    names = lookup.groupBy(quoted(key), *map(quoted, labels)).agg(F.count(F.lit(1)).alias(_COPIES))

    def repeated(s: Sum) -> Column:
        total = quoted(s.name)
        many = (total * quoted(_COPIES)).cast(facts.schema[s.name].dataType)
        return F.when(quoted(_COPIES) > 1, many).otherwise(total).alias(s.name)

    return facts.join(names, key, "left").select(
        *map(quoted, grain), *map(quoted, labels), *map(repeated, sums)
    )


def flag_orphans(
    fact: DataFrame,
    lookup: DataFrame,
    key: str,
    flag: str = "is_orphan",
    *,
    lookup_key: str | None = None,
    lookup_unique: bool = False,
) -> DataFrame:
    """Add a boolean column: does the row's key have no counterpart in the lookup?

    The lookup is reduced to its distinct keys, so the join never multiplies facts; as a
    left join it is broadcast when those fit. Beyond that a hot key on the fact side is
    split at run time, provided the lookup comes as it is stored: say ``lookup_unique`` of
    one that holds each key once, and no aggregation stands between it and the join.
    """
    known = lookup.select(quoted(lookup_key or key).alias(key))
    if not lookup_unique:
        known = known.distinct()
    joined = fact.join(known.withColumn(_MATCH, F.lit(True)), key, "left")
    return joined.select(*map(quoted, fact.columns), quoted(_MATCH).isNull().alias(flag))
