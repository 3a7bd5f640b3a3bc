"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.scratch import stage


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``node, component``: every node of an edge, and the least node it is connected with.

    Alternates two rounds of grouping until nothing changes: each node ties its larger neighbours
    to its least neighbour, then its smaller ones. Every round keeps the components and shortens
    the paths, so that a path of ``n`` nodes takes about ``log n`` rounds. Hubs are not collected:
    the least neighbour comes from a partial minimum, and is joined back to the edges. Rounds are
    stored, so none is computed twice; one digest a round reaches the driver.
    """
    current = stage(
        edges.select(F.greatest(src, dst).alias("high"), F.least(src, dst).alias("low"))
        .filter("high <> low")
        .distinct(),
        "edges",
    )
    before = None
    while (now := _digest(current)) != before:
        before = now
        current = stage(_tie(_tie(current, larger=True), larger=False), "edges")
    leaves = current.select(F.col("high").alias("node"), F.col("low").alias("component"))
    hubs = current.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return leaves.union(hubs)


def _digest(edges: DataFrame) -> tuple:
    """The number of edges and 128 bits of their set: a round that changes nothing is the last."""
    key = F.xxhash64("high", "low")
    other = F.xxhash64("low", "high", F.lit(1))
    return tuple(edges.agg(F.count(key), F.bit_xor(key), F.bit_xor(other)).first())


def _tie(edges: DataFrame, larger: bool) -> DataFrame:
    """One round over edges ``high, low`` (``high > low``)."""
    down = edges.select(F.col("high").alias("node"), F.col("low").alias("near"))
    if larger:
        up = edges.select(F.col("low").alias("node"), F.col("high").alias("near"))
        sides = down.union(up)
        least = sides.groupBy("node").agg(F.min("near").alias("least"))
        least = least.select("node", F.least("node", "least").alias("least"))
        tied = up.join(least, "node")
        tied = tied.select(F.col("near").alias("high"), F.col("least").alias("low"))
        return tied.filter("high <> low").distinct()
    least = down.groupBy("node").agg(F.min("near").alias("least"))
    tied = down.join(least, "node")
    return (
        tied.select(F.col("near").alias("high"), F.col("least").alias("low"))
        .union(least.select(F.col("node").alias("high"), F.col("least").alias("low")))
        .filter("high <> low")
        .distinct()
    )
