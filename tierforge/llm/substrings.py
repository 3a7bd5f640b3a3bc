"""Remove passages that an earlier document has, word for word.

A window is ``WINDOW`` consecutive words of a document. A word goes if a window over it also
occurs in a document with a smaller id. Windows are judged on the input.

1. *Anchors.* Of the short grams of a window, the one with the least hash is its anchor, so equal
   windows have equal anchors, and neighbouring windows mostly share one. Anchors that two
   different texts have are noted in a bit set of fixed size, which lets the next pass skip the
   stretches that occur once. False alarms cost time only; past its capacity it lets all through.
2. *Shards.* The stretches around the remaining anchors, each distinct one once with the least id
   that has it, are dealt to shards by anchor: a window and all its copies meet in one shard. An
   anchor with a great many distinct stretches is cut into single windows, dealt by their hash.
3. *Index.* A shard's stretches, by ascending id, become an FM-index over their words, and every
   distinct window is searched for backwards through its wavelet matrix. The first suffix of the
   interval is the occurrence with the least id.
4. The verdicts go back to the documents that have the stretch, and those few documents to their
   texts. Copies of a whole text need none of this: all but the first lose all their words.

Defined cases: a null text has no words; texts shorter than a window lose none; rows that share an
id never cost each other words; a row without id loses none and takes none from others; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.llm.bits import bit_set, in_bit_set
from tierforge.llm.fm_index import FMIndex
from tierforge.llm.words import (
    covered,
    gram_hashes,
    hashed_words,
    map_batches,
    mix,
    texts,
    word_hashes,
    word_spans,
)
from tierforge.scratch import stage

WINDOW, GRAM = 13, 4
# Bits of the sets of shared anchors and of affected documents.
ANCHOR_BITS, DOC_BITS = 1 << 25, 1 << 20
# Stretches of a shard, about; and of one anchor before it is cut up.
SHARD, HOT = 1 << 14, 1 << 11
# Texts are handled in pieces of about so many bytes.
PIECE_BYTES = 2 << 20


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    size = pc.binary_length(batch.column("text").cast(pa.large_binary())).fill_null(0).to_numpy()
    edges = np.flatnonzero(np.diff(np.cumsum(size) // PIECE_BYTES, prepend=-1))
    for first, last in zip(edges, [*edges[1:], batch.num_rows], strict=True):
        yield batch.slice(first, last - first)


@dataclass
class Stretches:
    """Anchors of some texts: for each, the words that the windows it stands for cover."""

    data: bytes
    anchor: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    content: np.ndarray

    def text(self, k: int) -> bytes:
        return self.data[self.start[k] : self.end[k]]


def stretches(parts: list[bytes], window: int = WINDOW, gram: int = GRAM) -> Stretches:
    """``doc`` numbers the texts; ``first`` is the first word within its text; ``start, end`` are
    bytes of ``data``; ``content`` hashes the words of the stretch."""
    data = b"\n".join(parts)
    array = np.frombuffer(data, np.uint8)
    starts, ends = word_spans(array)
    words = word_hashes(array, starts, ends)
    bounds = np.cumsum([0] + [len(p) + 1 for p in parts])
    doc = np.searchsorted(bounds, starts, side="right") - 1
    begins = np.searchsorted(doc, np.arange(len(parts)))
    grams = gram_hashes(words, gram)
    per = window - gram + 1
    none = np.empty(0, np.int64)
    if len(words) < window:
        return Stretches(data, none.view(np.uint64), none, none, none, none, none.view(np.uint64))
    # The least gram of each window, found by halves: the least of 2, 4, 8 .. in a row.
    best, place, length = grams, np.arange(len(grams)), 1
    while length < per:
        step = min(length, per - length)
        a, b = best[: len(best) - step], best[step:]
        left = a <= b
        place = np.where(left, place[: len(place) - step], place[step:])
        best = np.where(left, a, b)
        length += step
    at = np.flatnonzero(doc[: len(place)] == doc[window - 1 :])
    if not len(at):
        return Stretches(data, none.view(np.uint64), none, none, none, none, none.view(np.uint64))
    place, best = place[at], best[at]
    # Windows in a row with one anchor, in one text, are a stretch.
    new = np.flatnonzero(
        np.concatenate([[True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)])
    )
    first, last = at[new], at[np.append(new[1:], len(at)) - 1] + window - 1
    run = np.zeros(len(words) + 1, np.uint64)
    # Position within the stretch is made part of each word's hash by a running polynomial.
    power = np.cumprod(np.full(len(words) + 1, 0x2545F4914F6CDD1D, np.uint64))
    inverse = np.cumprod(np.full(len(words) + 1, pow(0x2545F4914F6CDD1D, -1, 2**64), np.uint64))
    np.cumsum(words * power[:-1], out=run[1:])
    content = mix((run[last + 1] - run[first]) * inverse[first] + (last - first).astype(np.uint64))
    own = doc[first]
    return Stretches(
        data, best[new], own, first - begins[own], starts[first], ends[last], content
    )


def _print(text: bytes) -> tuple[int, int, int, bytes]:
    """Number of words, 128 bits of them in order, and the checksum of them all."""
    words = text.split()
    joined = b" ".join(words)
    digest = hashlib.sha256(joined).digest()
    low, high = (int.from_bytes(digest[k : k + 8], "little", signed=True) for k in (0, 8))
    return len(words), low, high, digest


def _prints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, low, high, whole`` of each row."""
    kinds = {"doc_id": pa.int64(), "n_words": pa.int64(), "low": pa.int64(), "high": pa.int64()}
    arrow = pa.schema([*kinds.items(), ("whole", pa.binary())])

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        found = [_print(t) for t in texts(batch)]
        names = ("n_words", "low", "high", "whole")
        yield {"doc_id": batch.column("doc_id")} | {
            n: [f[k] for f in found] for k, n in enumerate(names)
        }

    schema = "doc_id long, n_words long, low long, high long, whole binary"
    return map_batches(docs, work, schema, arrow)


def _shared_anchors(docs: DataFrame, window: int) -> DataFrame:
    """``anchor``: those that two different texts have."""
    arrow = pa.schema([(n, pa.int64()) for n in ("anchor", "least", "most")])

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in _pieces(batch):
            parts = texts(piece)
            found = stretches(parts, window)
            if not len(found.anchor):
                continue
            text = np.array([_print(p)[1] for p in parts], np.int64)[found.doc]
            order = np.lexsort((text, found.anchor))
            anchor, text = found.anchor[order], text[order]
            first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            last = np.append(first[1:], len(anchor)) - 1
            yield {"anchor": anchor[first].view(np.int64), "least": text[first], "most": text[last]}

    rows = map_batches(docs.select("text"), work, "anchor long, least long, most long", arrow)
    ends = rows.groupBy("anchor").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    return ends.filter("least <> most").select("anchor")


def _found(docs: DataFrame, shared: bytes, window: int, uses: bool) -> DataFrame:
    """Stretches around anchors of the bit set.

    As contents: ``anchor, content, doc_id, words``, each once a piece with its least id. As uses:
    ``anchor, content, doc_id, low, first``, the places where documents have them.
    """
    names = ("anchor", "content", "doc_id", *(("low", "first") if uses else ()))
    arrow = pa.schema([(n, pa.int64()) for n in names] + ([] if uses else [("words", pa.binary())]))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        held = np.frombuffer(shared, np.uint8)
        for piece in _pieces(batch.filter(batch.column("doc_id").is_valid())):
            parts = texts(piece)
            found = stretches(parts, window)
            anchor = found.anchor.view(np.int64)
            at = np.flatnonzero(in_bit_set(held, anchor))
            doc = piece.column("doc_id").to_numpy()[found.doc[at]]
            columns = {"anchor": anchor[at], "content": found.content.view(np.int64)[at], "doc_id": doc}
            if uses:
                which, place = np.unique(found.doc[at], return_inverse=True)
                low = np.array([_print(parts[k])[1] for k in which], np.int64)
                yield columns | {"low": low[place], "first": found.first[at]}
                continue
            order = np.lexsort((doc, columns["content"], columns["anchor"]))
            columns = {n: c[order] for n, c in columns.items()}
            key = np.stack([columns["anchor"], columns["content"]])
            new = np.ones(len(order), bool)
            new[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
            at = at[order][new]
            yield {n: c[new] for n, c in columns.items()} | {
                "words": [b" ".join(found.text(k).split()) for k in at]
            }

    schema = ", ".join(f"{n} long" for n in names) + ("" if uses else ", words binary")
    return map_batches(docs, work, schema, arrow)


def _shard_verdicts(rows: list[tuple], window: int) -> list[np.ndarray]:
    """For each stretch (by ascending id), the least id that has each of its windows."""
    words = [hashed_words(r[3]) for r in rows]
    size = np.array([len(w) for w in words])
    symbols, code = np.unique(np.concatenate(words), return_inverse=True)
    # Each stretch ends in the separator.
    text = np.zeros(int(size.sum()) + len(rows), np.int64)
    starts = np.cumsum(size + 1) - (size + 1)
    own = np.repeat(np.arange(len(rows)), size)
    text[np.arange(len(code)) + own] = code + 1
    index = FMIndex(text, len(symbols) + 1, window)
    count = size - window + 1
    stretch = np.repeat(np.arange(len(rows)), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = starts[stretch] + nth
    every = np.lib.stride_tricks.sliding_window_view(text, window)[at]
    # Equal windows are searched for once.
    distinct, place = np.unique(gram_hashes_of(every), return_inverse=True)
    sample = np.zeros(len(distinct), np.int64)
    sample[place[::-1]] = np.arange(len(at))[::-1]
    low, high = index.search(every[sample])
    doc_at = np.repeat(np.array([r[2] for r in rows], np.int64), size + 1)
    alone = high - low == 1
    least = np.where(alone, doc_at[at[sample]], doc_at[index.suffixes[low]])[place]
    return np.split(least, np.cumsum(count)[:-1])


def gram_hashes_of(windows: np.ndarray) -> np.ndarray:
    """A hash of each row of symbols."""
    out = np.full(len(windows), windows.shape[1], np.uint64)
    for k in range(windows.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + windows[:, k].astype(np.uint64))
    return out


def _verdicts(items: DataFrame, window: int) -> DataFrame:
    """``anchor, content, least``: the least id that has each window of a stretch."""
    total = items.count()
    shards = max(1, -(-total // SHARD))
    crowded = stage(
        items.groupBy("anchor").count().filter(F.col("count") > HOT).select("anchor"), "crowded"
    )
    shared_out = items.join(crowded, "anchor", "left_anti")
    kinds = "anchor long, content long, least array<long>"
    arrow = pa.schema(
        [("anchor", pa.int64()), ("content", pa.int64()), ("least", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("anchor", "content", "doc_id", "words")
        current, held = None, []

        def solved() -> pa.RecordBatch:
            least = _shard_verdicts(held, window)
            columns = [[r[0] for r in held], [r[1] for r in held], [x.tolist() for x in least]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)],
                schema=arrow,
            )

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in names]
            for shard, *row in zip(batch.column("shard").to_pylist(), *columns, strict=True):
                if shard != current:
                    if held:
                        yield solved()
                    current, held = shard, []
                held.append(tuple(row))
        if held:
            yield solved()

    dealt = (
        shared_out.withColumn("shard", F.pmod(F.col("anchor"), F.lit(shards)))
        .repartition(min(shards, 4096), "shard")
        .sortWithinPartitions("shard", "doc_id", "anchor", "content")
    )
    indexed = dealt.mapInArrow(run, kinds)
    if crowded.isEmpty():
        return indexed
    cut_kinds = "anchor long, content long, doc_id long, nth int, words binary"
    cut_arrow = pa.schema(
        [("anchor", pa.int64()), ("content", pa.int64()), ("doc_id", pa.int64()),
         ("nth", pa.int32()), ("words", pa.binary())]
    )

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        words = [w.split(b" ") for w in batch.column("words").to_pylist()]
        count = [len(w) - window + 1 for w in words]
        row = pa.array(np.repeat(np.arange(len(words)), count))
        names = ("anchor", "content", "doc_id")
        yield {n: batch.column(n).take(row) for n in names} | {
            "nth": [k for c in count for k in range(c)],
            "words": [b" ".join(w[k : k + window]) for w, c in zip(words, count) for k in range(c)],
        }

    single = map_batches(items.join(crowded, "anchor", "left_semi"), cut, cut_kinds, cut_arrow)
    single = stage(single, "windows")
    least = single.groupBy("words").agg(F.min("doc_id").alias("least"))
    met = single.join(least, "words").groupBy("anchor", "content")
    by_window = met.agg(F.array_sort(F.collect_list(F.struct("nth", "least"))).alias("w"))
    return indexed.union(
        by_window.select("anchor", "content", F.transform("w", lambda x: x["least"]).alias("least"))
    )


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, low, starts``: first words of the windows that a smaller id has.

    ``low`` tells apart the texts of a repeated id. Texts that are copies as a whole are judged as
    any other where another text shares the passage, but not against each other.
    """
    shared = bit_set(_shared_anchors(docs, window), "anchor", ANCHOR_BITS)
    items = stage(
        _found(docs, shared, window, uses=False)
        .groupBy("anchor", "content", "words")
        .agg(F.min("doc_id").alias("doc_id")),
        "stretches",
    )
    verdicts = _verdicts(items, window)
    met = _found(docs, shared, window, uses=True).join(verdicts, ["anchor", "content"])
    goes = F.filter(
        F.transform("least", lambda m, k: F.when(m < F.col("doc_id"), F.col("first") + k)),
        lambda k: k.isNotNull(),
    )
    return (
        met.select("doc_id", "low", goes.alias("goes"))
        .filter(F.size("goes") > 0)
        .groupBy("doc_id", "low")
        .agg(F.array_distinct(F.flatten(F.collect_list("goes"))).alias("starts"))
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of each row, and with ``with_text`` the ``kept``
    words, joined by spaces (null where nothing was removed)."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marks = stage(_prints(plain), "prints")
    same = ["low", "high", "n_words"]
    firsts = marks.groupBy(*same).agg(F.min("doc_id").alias("first_id"))
    copy = (F.col("doc_id") > F.col("first_id")) & (F.col("n_words") >= window)
    placed = stage(
        marks.join(firsts, same).select(
            "doc_id", "low", "n_words", "whole", F.coalesce(copy, F.lit(False)).alias("copy")
        ),
        "placed",
    )
    hits = repeated_windows(plain, window)
    ids = placed.filter("not copy and doc_id is not null").select("doc_id", "low").distinct()
    hits = stage(hits.join(ids, ["doc_id", "low"]), "hits")
    affected = bit_set(hits, "doc_id", DOC_BITS)
    arrow = pa.schema(
        [("doc_id", pa.int64()), ("low", pa.int64()), ("removed", pa.int64()),
         ("sha", pa.string()), ("kept", pa.string())]
    )

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(affected, np.uint8)
        for batch in batches:
            batch = batch.filter(batch.column("doc_id").is_valid())
            some = in_bit_set(held, batch.column("doc_id").to_numpy())
            yield batch.filter(pa.array(some, pa.bool_()))

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {n: [] for n in arrow.names}
        starts = batch.column("starts").to_pylist()
        rows = (batch.column("doc_id").to_pylist(), batch.column("low").to_pylist())
        for text, doc_id, low, first in zip(texts(batch), *rows, starts, strict=True):
            n, own, _, _ = _print(text)
            if own == low:
                gone = covered(np.array(first), window, n)
                kept = b" ".join(w for w, g in zip(text.split(), gone, strict=True) if not g)
                row = (doc_id, low, int(gone.sum()), hashlib.sha256(kept).hexdigest(),
                       kept.decode() if with_text else None)
                for name, value in zip(arrow.names, row, strict=True):
                    out[name].append(value)
        yield out

    met = plain.mapInArrow(likely, "doc_id long, text string").join(hits, "doc_id")
    schema = "doc_id long, low long, removed long, sha string, kept string"
    partly = map_batches(met, cut, schema, arrow).dropDuplicates(["doc_id", "low"])
    nothing = F.sha2(F.lit(""), 256)
    final = placed.join(partly, ["doc_id", "low"], "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words"))
        .otherwise(F.coalesce("removed", F.lit(0)))
        .cast("long")
        .alias("n_removed"),
        F.when(F.col("copy"), nothing)
        .otherwise(F.coalesce("sha", F.lower(F.hex("whole"))))
        .alias("kept_sha256"),
        F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )
    return final if with_text else final.drop("kept")
