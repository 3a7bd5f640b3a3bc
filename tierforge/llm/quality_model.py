"""A quality classifier: a factorisation machine over words, structure and metadata.

Inputs of a score are the hashed words of the text, statistics of its structure, and metadata that
is about its form (the recorded length). Every pair of inputs interacts through low-rank factors,
which the identity ``sum_i<j <v_i, v_j> x_i x_j = (|sum_i v_i x_i|^2 - sum_i |v_i x_i|^2) / 2``
scores in time linear in the number of inputs.

The machine is fitted in one task on a bounded sample of labelled rows (``SAMPLE``, those with the
least hashes); every document is then scored where it is, with the fitted arrays (of fixed size)
sent along. Defined cases: a null text is an empty one, and has a score; a document without
recorded length gets the mean; labels that are null, or of no document, are not learned from, and
of several labels for one id the least counts; without labels every score is 0.5; rows that
repeat get one score; an empty table gives no rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.llm.words import each_text, gram_hashes, map_batches, word_hashes, word_spans

# At most so many labelled rows are learned from.
SAMPLE = 8192
BUCKETS, RANK = 1 << 16, 8
EPOCHS, BATCH, RATE, DECAY = 12, 128, 0.05, 1e-4
# Length of a text's vector of words; a statistic has half its standard score.
WORD_SCALE, STAT_SCALE = 0.3, 0.5

# Bytes that count together. Fixed values.
_GROUPS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digits": b"0123456789",
    "symbols": b"#*$%&<>@^~=+_\\{}[]",
    "bars": b"|",
    "shouts": b"!",
    "stops": b".?",
    "commas": b",;:",
    "lines": b"\n",
}
_STATS = (
    "words", "mean_length", *_GROUPS, "beyond_ascii", "repeated", "distinct", "top_word",
    "capital_words", "recorded_length",
)


def features(text: bytes, recorded: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, their values, and the structure statistics (NaN where there is none)."""
    data = np.frombuffer(text, np.uint8)
    starts, ends = word_spans(data)
    words = word_hashes(data, starts, ends)
    n, size = len(words), max(1, data.size)
    byte = np.bincount(data, minlength=256)
    stats = [np.log1p(n), float((ends - starts).mean()) if n else 0.0]
    stats += [byte[list(group)].sum() / size for group in _GROUPS.values()]
    stats.append(byte[128:].sum() / size)
    distinct, counts = np.unique(words, return_counts=True)
    grams = gram_hashes(words, 3)
    stats.append(1 - len(np.unique(grams)) / len(grams) if len(grams) else 0.0)
    # Distinct words grow with the root of a text's length, roughly.
    stats.append(len(distinct) / max(1.0, n**0.75))
    stats.append(counts.max() / n if n else 0.0)
    first = data[starts] if n else data[:0]
    stats.append(float(((first >= 65) & (first <= 90)).mean()) if n else 0.0)
    stats.append(np.nan if recorded is None else np.log1p(max(0.0, recorded)))
    bucket, place = np.unique((distinct >> np.uint64(48)).astype(np.int64), return_inverse=True)
    value = np.bincount(place, 1 + np.log(counts), minlength=len(bucket)) if n else np.empty(0)
    norm = np.sqrt((value**2).sum())
    return bucket, WORD_SCALE * value / norm if norm else value, np.array(stats)


@dataclass
class Machine:
    """``bias``, linear weights and factors; the statistics come behind the word buckets."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def inputs(self, bucket: np.ndarray, value: np.ndarray, stats: np.ndarray):
        z = np.clip((stats - self.mean) / self.scale, -4, 4)
        z = np.where(np.isnan(z), 0.0, z) * STAT_SCALE
        index = np.concatenate([bucket, BUCKETS + np.arange(len(z))])
        return index, np.concatenate([value, z])

    def margin(self, index: np.ndarray, x: np.ndarray) -> float:
        scaled = self.factors[index] * x[:, None]
        total = scaled.sum(axis=0)
        pairs = 0.5 * float((total**2).sum() - (scaled**2).sum())
        return self.bias + float(self.linear[index] @ x) + pairs

    def score(self, text: bytes, recorded: float | None) -> float:
        margin = self.margin(*self.inputs(*features(text, recorded)))
        return float(1 / (1 + np.exp(-np.clip(margin, -50, 50))))

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, bias=self.bias, linear=self.linear.astype(np.float32),
                 factors=self.factors.astype(np.float32), mean=self.mean, scale=self.scale)
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Machine:
        held = np.load(io.BytesIO(data))
        return cls(float(held["bias"]), *(held[n] for n in ("linear", "factors", "mean", "scale")))


def learn(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray) -> Machine:
    """Fit a machine by AdaGrad on the logistic loss."""
    rng = np.random.default_rng(7)
    stats = np.array([r[2] for r in rows])
    known = ~np.isnan(stats)
    count = np.maximum(1, known.sum(axis=0))
    mean = np.where(known, stats, 0).sum(axis=0) / count
    scale = np.sqrt(np.where(known, (stats - mean) ** 2, 0).sum(axis=0) / count) + 1e-6
    size = BUCKETS + len(_STATS)
    rate = np.clip(labels.mean(), 0.01, 0.99)
    model = Machine(
        float(np.log(rate / (1 - rate))), np.zeros(size), rng.normal(0, 0.05, (size, RANK)), mean, scale
    )
    inputs = [model.inputs(*r) for r in rows]
    seen_linear, seen_factors = np.full(size, 1e-6), np.full((size, RANK), 1e-6)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for first in range(0, len(rows), BATCH):
            part = order[first : first + BATCH]
            index = np.concatenate([inputs[k][0] for k in part])
            x = np.concatenate([inputs[k][1] for k in part])
            length = np.array([len(inputs[k][0]) for k in part])
            starts = np.concatenate([[0], np.cumsum(length)[:-1]])
            row = np.repeat(np.arange(len(part)), length)
            scaled = model.factors[index] * x[:, None]
            total = np.add.reduceat(scaled, starts, axis=0)
            squares = np.add.reduceat((scaled**2).sum(axis=1), starts)
            margin = model.bias + np.add.reduceat(model.linear[index] * x, starts)
            margin += 0.5 * ((total**2).sum(axis=1) - squares)
            error = 1 / (1 + np.exp(-np.clip(margin, -50, 50))) - labels[part]
            pull = (error[row] * x)[:, None]
            used, place = np.unique(index, return_inverse=True)
            g_linear = np.bincount(place, pull[:, 0]) + DECAY * model.linear[used]
            each = pull * (total[row] - scaled)
            g_factors = np.stack([np.bincount(place, each[:, f]) for f in range(RANK)], axis=1)
            g_factors += DECAY * model.factors[used]
            seen_linear[used] += g_linear**2
            seen_factors[used] += g_factors**2
            model.linear[used] -= RATE * g_linear / np.sqrt(seen_linear[used])
            model.factors[used] -= RATE * g_factors / np.sqrt(seen_factors[used])
            model.bias -= RATE * float(error.mean())
    return model


def _plain(docs: DataFrame) -> DataFrame:
    recorded = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        recorded.cast("double").alias("recorded"),
    )


def fit(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> Machine | None:
    """A machine from ``labelled`` (``doc_id, quality``), or None if it names no documents."""
    chosen = (
        labelled.filter("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"))
        .limit(sample)
    )
    arrow = pa.schema(
        [("doc_id", pa.int64()), ("label", pa.float64())]
        + [(n, pa.binary()) for n in ("bucket", "value", "stats")]
    )

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        recorded = batch.column("recorded").to_pylist()
        rows = [features(t, r) for t, r in zip(each_text(batch), recorded, strict=True)]
        yield {
            "doc_id": batch.column("doc_id"),
            "label": batch.column("label"),
            **{n: [r[k].tobytes() for r in rows] for k, n in enumerate(("bucket", "value", "stats"))},
        }

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [row for batch in batches for row in batch.to_pylist()]
        if held:
            # An order of their own, whatever order they come in.
            held.sort(key=lambda r: (r["doc_id"], r["value"]))
            kinds = (("bucket", np.int64), ("value", np.float64), ("stats", np.float64))
            rows = [tuple(np.frombuffer(r[n], kind) for n, kind in kinds) for r in held]
            model = learn(rows, np.array([r["label"] for r in held]))
            yield pa.RecordBatch.from_arrays([pa.array([model.packed()], pa.binary())], ["model"])

    drawn = _plain(docs).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    rows = map_batches(
        drawn, work, "doc_id long, label double, bucket binary, value binary, stats binary", arrow
    )
    found = rows.repartition(1).mapInArrow(train, "model binary").collect()
    return Machine.unpacked(bytes(found[0]["model"])) if found else None


def score(docs: DataFrame, model: Machine | None) -> DataFrame:
    """``doc_id, score`` of every row."""
    arrow = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    packed = model.packed() if model else None
    held: list[Machine] = []

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        if packed and not held:
            held.append(Machine.unpacked(packed))
        recorded = batch.column("recorded").to_pylist()
        scores = [
            held[0].score(t, r) if held else 0.5
            for t, r in zip(each_text(batch), recorded, strict=True)
        ]
        yield {"doc_id": batch.column("doc_id"), "score": scores}

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = map_batches(_plain(docs), work, "doc_id long, score double", arrow)
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def accepted(docs: DataFrame, model: Machine | None, least: float = 0.7) -> DataFrame:
    """``docs`` without those that score below ``least``; all their columns."""
    arrow_of = docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine.unpacked(packed) if packed else None
        for batch in batches:
            if machine is None:
                yield batch
                continue
            lengths = (
                batch.column("n_chars").to_pylist()
                if "n_chars" in batch.schema.names
                else [None] * batch.num_rows
            )
            mask = [
                machine.score(t, r) >= least for t, r in zip(each_text(batch), lengths, strict=True)
            ]
            yield batch.filter(pa.array(mask, pa.bool_()))

    packed = model.packed() if model else None
    return docs.mapInArrow(keep, arrow_of)
