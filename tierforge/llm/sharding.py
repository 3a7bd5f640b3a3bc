"""Shards by fixed virtual slots.

A record hashes into one of a fixed number of slots, and a small versioned map says which shard
owns each slot. Records never move between slots; adding a shard or evening out bytes only edits
the map. The map has ``slots`` rows whatever the size of the data, so it may be broadcast.

Defined cases: a null key is one more key; a null text weighs as an empty one; equal keys share
a slot (and so a shard); a text of any length counts by its bytes and stays whole, so one that is
longer than a shard's part makes its shard the heaviest; an empty table gives an empty result, and
its slots weigh nothing. Columns beside the key and the text may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierforge.llm.columns import spare
from tierforge.scratch import scratch_dir

SLOTS = 4096


@dataclass(frozen=True)
class SlotMap:
    """Who owns each slot, and how many edits led there."""

    version: int
    owners: tuple[int, ...]

    @classmethod
    def first(cls, shards: int, slots: int = SLOTS) -> SlotMap:
        if not 0 < shards <= slots:
            raise ValueError("there must be a slot for each shard")
        return cls(1, tuple(s % shards for s in range(slots)))

    @property
    def shards(self) -> int:
        return max(self.owners) + 1

    def grown(self) -> SlotMap:
        """One more shard, which takes its even part of the slots; no other slot changes hands.

        The slots come from whichever shard has most left, lowest slot first, so the outcome
        depends on nothing but this map.
        """
        owners, new = list(self.owners), self.shards
        held = [[s for s, o in enumerate(owners) if o == shard] for shard in range(new)]
        for _ in range(len(owners) // (new + 1)):
            giver = max(held, key=len)
            owners[giver.pop(0)] = new
        return replace(self, version=self.version + 1, owners=tuple(owners))

    def rebalanced(self, weights: dict[int, int], tolerance: float = 0.01) -> SlotMap:
        """Slots moved from the heaviest to the lightest shard while that narrows their gap.

        ``weights``: bytes per slot. Ends once the heaviest and the lightest shard are no more
        than ``tolerance`` of the mean from the middle between them, or no single move helps.
        A shard that one slot makes too heavy to give is set aside, and the others go on.
        """
        owners, held = list(self.owners), [0] * self.shards
        for slot, owner in enumerate(owners):
            held[owner] += weights.get(slot, 0)
        givers = set(range(len(held)))
        for _ in range(len(owners)):
            heavy, light = max(givers, key=lambda s: (held[s], -s)), held.index(min(held))
            gap = held[heavy] - held[light]
            mean = sum(held[s] for s in givers) / len(givers)
            if gap <= 2 * tolerance * mean:
                break
            fits = [
                (weights.get(s, 0), s)
                for s, o in enumerate(owners)
                if o == heavy and 0 < weights.get(s, 0) < gap
            ]
            if not fits:
                givers.remove(heavy)
                if not givers:
                    break
                continue
            moved, slot = min(fits, key=lambda x: (abs(x[0] - gap / 2), -x[1]))
            owners[slot] = light
            held[heavy] -= moved
            held[light] += moved
        changed = tuple(owners) != self.owners
        return replace(self, version=self.version + changed, owners=tuple(owners))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(self.version, slot, owner) for slot, owner in enumerate(self.owners)]
        return spark.createDataFrame(rows, "version int, slot int, shard int")


def store_map(spark: SparkSession, path: str, *versions: SlotMap) -> None:
    """Add versions of the map to those below ``path``."""
    for version in versions:
        version.table(spark).coalesce(1).write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """A stored version, by default the newest."""
    stored = spark.read.schema("version int, slot int, shard int").parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    rows = stored.filter(F.col("version") == version).orderBy("slot").collect()
    if not rows:
        raise LookupError(f"no version {version} of the slot map in {path}")
    return SlotMap(version, tuple(r["shard"] for r in rows))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of a text and one for its end."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def slot_weights(docs: DataFrame, key: str, text: str, slots: int = SLOTS) -> DataFrame:
    """``slot, n_rows, n_bytes`` of the slots that have records (``slots`` rows at most)."""
    return docs.groupBy(slot_of(F.col(key), slots).alias("slot")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(byte_size(F.col(text))).alias("n_bytes")
    )


def even_map(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", slots: int = SLOTS
) -> SlotMap:
    """The map whose shards hold nearly equal bytes of ``docs``.

    Its first version deals the slots out in turn. The bytes of the slots, summed by Spark, then
    say which slots change hands; both versions are stored, and the newest is read back. The
    driver sees a row per slot, whatever the size of ``docs``.
    """
    path = scratch_dir(docs.sparkSession, "slot-map")
    first = SlotMap.first(shards, slots)
    store_map(docs.sparkSession, path, first)
    weights = {r["slot"]: r["n_bytes"] for r in slot_weights(docs, key, text, slots).collect()}
    evened = first.rebalanced(weights)
    if evened.version > first.version:
        store_map(docs.sparkSession, path, evened)
    return load_map(docs.sparkSession, path)


def assign(docs: DataFrame, owners: SlotMap, key: str = "doc_id") -> DataFrame:
    """``docs`` with ``shard`` (which replaces a column of that name)."""
    slot, shard = spare(docs, "__slot"), spare(docs, "__shard")
    table = owners.table(docs.sparkSession).select(
        F.col("slot").alias(slot), F.col("shard").alias(shard)
    )
    placed = docs.withColumn(slot, slot_of(F.col(key), len(owners.owners)))
    return placed.join(F.broadcast(table), slot).withColumn("shard", F.col(shard)).drop(slot, shard)


def placements(docs: DataFrame, now: SlotMap, later: SlotMap | None = None) -> DataFrame:
    """One row per record: ``doc_id, size, text_crc32, vslot, shard, slot`` and ``grown_shard``.

    ``slot`` numbers the records of a shard from 0 without gaps: records are counted within
    their virtual slot, behind the records of the shard's lower virtual slots, so no task ever
    orders more than one virtual slot. ``grown_shard`` is the shard under ``later``.
    """
    slots = len(now.owners)
    spark = docs.sparkSession
    body = F.coalesce(F.col("text"), F.lit(""))
    records = docs.select(
        "doc_id",
        byte_size(F.col("text")).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        slot_of(F.col("doc_id"), slots).alias("vslot"),
    )
    owners = now.table(spark).select(F.col("slot").alias("vslot"), "shard")
    if later is None:
        owners = owners.withColumn("grown_shard", F.lit(None).cast("int"))
    else:
        grown = later.table(spark).select(
            F.col("slot").alias("vslot"), F.col("shard").alias("grown_shard")
        )
        owners = owners.join(grown, "vslot")
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    counts = records.groupBy("vslot").agg(F.count(F.lit(1)).alias("n"))
    starts = owners.join(counts, "vslot").withColumn(
        "start", F.coalesce(F.sum("n").over(before), F.lit(0))
    )
    within = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    return (
        records.withColumn("nth", F.row_number().over(within))
        .join(F.broadcast(starts.drop("n")), "vslot")
        .withColumn("slot", (F.col("start") + F.col("nth") - 1).cast("long"))
        .drop("start", "nth")
    )


def write_shards(docs: DataFrame, owners: SlotMap, path: str, key: str = "doc_id") -> None:
    """The records as Parquet below ``path/shard=<n>``, several files to a large shard."""
    assign(docs, owners, key).repartition(F.col("shard"), slot_of(F.col(key), 64)).write.partitionBy(
        "shard"
    ).parquet(path)
