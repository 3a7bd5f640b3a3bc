"""Mix sources to target weights by repeating and thinning documents.

Words are summed per source; a source's target over its words is the number of times each of
its documents is to appear. A document appears ``floor(rate)`` times, and once more if a hash
of its id falls below the fraction: the same on every run, and on every machine.

Defined cases: a null source is a source of its own and comes last; a null text has no words; a
source without words gets the target 0, its documents are not taken; rows that repeat an id are
taken or left alike; a text of any length is counted whole, within its row; an empty table gives an
empty mix. Columns beside ``doc_id``, ``text`` and ``source`` come back as they were, by any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierforge.llm.columns import own, spare
from tierforge.scratch import stage

WORD = r"[^\x20\x09-\x0D]+"

# What `copies` adds to each document.
COPY_COLUMNS = ("__size", "__source_size", "__target", "__copies")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources in code-point order weigh ``weights``, repeated. Targets share ``share`` times all
    words by weight; none exceeds ``cap`` times its source, and what it gives up goes to the
    others by weight. That is one water level ``x`` with targets ``min(cap * size, x * weight)``;
    the level rises over the sources still below their cap until no more of them reach it. Each
    round brings two sums to the driver, never the sources.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    table = stage(
        sizes.withColumn("weight", F.get(pattern, nth % len(weights))).withColumn(
            "most", cap * F.col("source_size")
        ),
        "sources",
    )
    wanted = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        at_cap = F.col("most") <= level * F.col("weight")
        given, open_weight, now_full = table.agg(
            F.sum(F.when(at_cap, F.col("most"))),
            F.sum(F.when(~at_cap, F.col("weight"))),
            F.count(F.when(at_cap, 1)),
        ).first()
        if not open_weight or now_full == full:
            break
        level, full = (wanted - (given or 0.0)) / open_weight, now_full
    target = F.least(F.col("most"), level * F.col("weight")).cast("double")
    return table.select("source", "source_size", target.alias("target"))


def copies(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 17,
    names: Sequence[str] = COPY_COLUMNS,
) -> DataFrame:
    """``docs`` with its words, its source's words and target, and its copies.

    ``names`` says what these columns are called; they replace columns of those names.
    """
    size, source_size, target, number = names
    own_columns = docs.drop(*names)
    sized = own_columns.withColumn(size, word_count(F.col("text")))
    sizes = sized.groupBy("source").agg(F.sum(size).alias("source_size"))
    known = spare(sized, "__source")
    targets = source_targets(sizes, weights, share, cap).select(
        F.col("source").alias(known),
        F.col("source_size").alias(source_size),
        F.col("target").alias(target),
    )
    rate = F.coalesce(
        F.when(F.col(source_size) > 0, F.col(target) / F.col(source_size)), F.lit(0.0)
    )
    # 53 bits of the hash as a fraction in [0, 1).
    chance = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) * F.lit(2.0**-53)
    extra = (chance < rate - F.floor(rate)).cast("long")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col(known))).drop(known)
    return joined.withColumn(number, F.floor(rate).cast("long") + extra)


def mix(docs: DataFrame, **options) -> DataFrame:
    """Each document as often as the mix takes it; the columns of ``docs``."""
    names = tuple(spare(docs, name) for name in COPY_COLUMNS)
    counted = copies(docs, names=names, **options)
    times = F.array_repeat(F.lit(1), F.col(names[-1]).cast("int"))
    return counted.withColumn(spare(counted, "__copy"), F.explode(times)).select(*own(docs))
