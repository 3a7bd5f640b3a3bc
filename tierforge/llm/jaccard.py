"""Join documents whose sets of word shingles are similar, and the groups this makes.

Two sets link when ``100 * intersection >= percent * union``. The join loses no link and looks at
few other pairs:

1. Equal sets are one set, represented by their least ``doc_id``.
2. *Blocks of candidates.* Linked sets differ in a bounded number of shingles, at most ``D`` for
   sizes in two neighbouring size bands. The hash range is cut into more than ``D`` segments, so
   that two linked sets agree in all of at least one segment. By the pigeonring principle they
   also agree in one after which the next ``CHAIN`` segments differ in at most ``CHAIN`` shingles;
   a sketch of those, whose bits differ in no more places than they do, tells most sets apart that
   share a phrase by chance. Chance grows with the square of the corpus, so this keeps clusters
   from growing together. Sets that agree in a segment and have such sketches are tied, and
   connected ones form a cluster. Segments of nothing but the most common shingles are left out
   like empty ones, as far as that loses no link.
3. *Blocked product.* A cluster's incidence matrix of documents by shingles is cut into blocks of
   bounded size; pairs of blocks whose sizes can link are multiplied by their transposes, which
   counts the overlaps, and pairs below ``percent * (a + b) / (100 + percent)`` are discarded. A
   pair of blocks returns a spanning forest of its links and a count for each document, never all
   its pairs.

Equal segments with equal sketches are grouped per batch before they are shuffled, so a group of
copies that holds a third of all rows adds one per batch, not one per document, to any key.

Defined cases: a null text, or one without words, has an empty set and links with nothing, equal
ones included; texts shorter than a shingle are one shingle; equal rows link; a row without
``doc_id`` has no component and lends none; where an id repeats, each row is placed by its own
text, and a link of one text holds for the id; an empty table gives no rows.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.llm.columns import spare
from tierforge.llm.graph import components
from tierforge.llm.words import each_text, hashed_words, map_batches, mix, shingles
from tierforge.scratch import stage

# A block of the product holds about so many documents, and so many shingles.
BLOCK_DOCS, BLOCK_SHINGLES = 512, 1 << 18
# Share of all rows from which on a shingle is common.
COMMON = 0.0005
# Segments of a part of the range of hashes, about: so many shingles have no more of them.
PART_SEGMENTS = 1 << 20
# So many parts are worked on by one task, which does not repeat ties.
TOGETHER = 16
# As many sets as a task remembers the ties of.
KNOWN = 1 << 20
# Segments that the sketch of a segment covers, and bits in which those of linked sets may differ.
CHAIN = 4
# Sets that agree in a segment are compared all at once for up to so many sketches.
_FEW = 16
# Bits of the set of ids whose texts are looked at again, at least and at most.
DOC_BITS, MOST_DOC_BITS = 1 << 20, 1 << 27
# Keys over which a band of a cluster is spread where its members join what is known of it.
SPREAD = 16
# Rows of a batch that are worked on together.
_SLICE = 2048
# Shingles that at most so many documents of a block share are counted pair by pair.
_LIGHT = 24
_COLUMNS = 2048

_NONE = np.empty(0, np.uint64)
_SEED = np.uint64(0xA0761D6478BD642F)
_PLACES = np.int64(0xFFFF)


def fingerprint(sets: np.ndarray) -> tuple[int, int]:
    """128 bits of a set of hashes."""
    with np.errstate(over="ignore"):
        low = mix(mix(sets).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(sets)))
        high = mix(mix(sets ^ _SEED).sum(dtype=np.uint64, keepdims=True) ^ low)
    return int(high.view(np.int64)[0]), int(low.view(np.int64)[0])


# Bands and schemes that have been worked out, by their arguments.
_STARTS: dict[int, list[int]] = {}
_SCHEMES: dict[tuple[int, int], tuple[int, int]] = {}
# Hashes of the segments' numbers, by band and how many there are.
_LABELS: dict[tuple[int, int], np.ndarray] = {}


def band_starts(percent: int, upto: int) -> list[int]:
    """Least sizes of the size bands, to beyond ``upto``: linked sets are in one band or in
    neighbouring ones."""
    starts = _STARTS.setdefault(percent, [1])
    while starts[-1] <= upto:
        starts.append(starts[-1] * 100 // percent + 1)
    return starts


def band_of(size: int, percent: int) -> int:
    return bisect_right(band_starts(percent, size), size) - 1


def scheme(band: int, percent: int) -> tuple[int, int]:
    """Segments for the sets of ``band`` and the one above, and the empty ones allowed for.

    Linked sets differ in at most ``D`` shingles, hence in at most ``D`` segments. Segments that
    are empty in both agree without saying anything, so ``spare`` more are cut than needed; a set
    with more empty segments than that also shows some of them (see ``segments``).
    """
    if (band, percent) in _SCHEMES:
        return _SCHEMES[band, percent]
    starts = band_starts(percent, 1)
    while len(starts) < band + 3:
        starts = band_starts(percent, starts[-1])
    differ = 2 * (starts[band + 2] - 1) * (100 - percent) // (100 + percent)
    spare = 0
    for _ in range(8):
        segments = differ + 1 + spare
        mean = segments * math.exp(-starts[band] / segments)
        spare = min(math.ceil(mean + 4 * math.sqrt(mean)), 2 + (differ + 1) // 6)
    _SCHEMES[band, percent] = differ + 1 + spare, spare
    return _SCHEMES[band, percent]


def _labels(band: int, count: int) -> np.ndarray:
    if (band, count) not in _LABELS:
        _LABELS[band, count] = mix(np.arange(count, dtype=np.uint64) + np.uint64(band << 40))
    return _LABELS[band, count]


def segments(
    sets: np.ndarray, percent: int, common: np.ndarray = _NONE
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and sketches of the segments of a sorted set, for its band and the one below.

    Let linked sets differ in ``d[i]`` shingles of segment ``i``. The sum of ``1 - d[i]`` over all
    segments is above ``spare``, so (cycle lemma) more than ``spare`` segments are such that any
    run from there on, round the ring, of ``k`` segments has fewer than ``k`` differences: both
    sets agree in that segment, and the next ``CHAIN`` differ in at most ``CHAIN`` shingles. A
    sketch holds the parity of these next shingles in 32 places.

    Segments without shingles, or with ``common`` ones only (sorted), are bare and the last
    ``spare`` bare ones are not shown. Should all of the segments above be bare, then the first of
    them is shown by both sets, as more than ``spare`` are.
    """
    own, n = band_of(len(sets), percent), len(sets)
    hashed = mix(sets)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(hashed, out=total[1:])
    rare = np.arange(n + 1)
    if len(common):
        at = np.minimum(np.searchsorted(common, sets), len(common) - 1)
        np.cumsum(common[at] != sets, out=rare[1:])
    odd = np.zeros(n + 1, np.uint32)
    bit = np.uint32(1) << (hashed >> np.uint64(59)).astype(np.uint32)
    np.bitwise_xor.accumulate(bit, out=odd[1:])
    odd = np.concatenate([odd, odd[-1] ^ odd[1:]])
    keys, sketches = [], []
    for band in (own - 1, own) if own else (own,):
        count, spare = scheme(band, percent)
        place = (sets >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)
        at = np.zeros(count + 1, np.int64)
        np.cumsum(np.bincount(place.astype(np.int64), minlength=count), out=at[1:])
        label = _labels(band, count)
        bare = np.flatnonzero(rare[at[1:]] == rare[at[:-1]])
        shown = np.ones(count, bool)
        shown[bare[max(0, len(bare) - spare) :]] = False
        keys.append(mix((total[at[1:]] - total[at[:-1]]) + label)[shown])
        ring, chain = np.concatenate([at, at[1:] + n]), min(CHAIN, count - 1)
        after = odd[ring[chain + 1 : chain + 1 + count]] ^ odd[ring[1 : count + 1]]
        sketches.append(after[shown])
    return np.concatenate(keys), np.concatenate(sketches)


def segment_keys(sets: np.ndarray, percent: int, common: np.ndarray = _NONE) -> np.ndarray:
    """The hashes alone."""
    return segments(sets, percent, common)[0]


def tied(key: np.ndarray, sketch: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes that connect all those with equal keys whose sketches are ``CHAIN`` alike.

    Of equal sketches one is compared, and with many of them each only with those not yet reached.
    """
    both = key.astype(np.uint64) << np.uint64(32) | sketch
    order = np.lexsort((node, both))
    both, node = both[order], node[order]
    new = np.concatenate([[True], both[1:] != both[:-1]])
    a, b = [node[new][np.cumsum(new) - 1][~new]], [node[~new]]
    both, node = both[new], node[new]
    key, sketch = both >> np.uint64(32), both.astype(np.uint32)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    width = np.diff(np.append(starts, len(key)))
    few = np.repeat((width > 1) & (width <= _FEW), width)
    k, s, v = key[few], sketch[few], node[few]
    for step in range(1, _FEW):
        same = np.flatnonzero(k[step:] == k[:-step]) if step < len(k) else []
        if not len(same):
            break
        near = same[np.bitwise_count(s[same] ^ s[same + step]) <= CHAIN]
        a.append(v[near])
        b.append(v[near + step])
    for first in np.flatnonzero(width > _FEW):
        group = slice(starts[first], starts[first] + width[first])
        s, v = sketch[group], node[group]
        left, reached = np.arange(len(s)), []
        while len(left):
            if not reached:
                reached, left = [left[0]], left[1:]
            at = reached.pop()
            near = np.bitwise_count(s[left] ^ s[at]) <= CHAIN
            if near.any():
                a.append(np.full(np.count_nonzero(near), v[at]))
                b.append(v[left[near]])
                reached.extend(left[near].tolist())
                left = left[~near]
    return np.concatenate(a), np.concatenate(b)


class _Ties:
    """What a task has tied: of ties it is given, it returns those that connect anything new."""

    def __init__(self):
        self.node = self.label = np.empty(0, np.int64)

    def new(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        label, known = ends.copy(), np.zeros(len(ends), bool)
        if len(self.node):
            at = np.minimum(np.searchsorted(self.node, ends), len(self.node) - 1)
            known = self.node[at] == ends
            label[known] = self.label[at[known]]
        first, second = label[place].reshape(2, -1)
        apart = first != second
        sides = np.concatenate([first[apart], second[apart]])
        roots, place = np.unique(sides, return_inverse=True)
        kept = np.array(_spanning(len(roots), *place.reshape(2, -1)), np.int64).reshape(-1, 2)
        now = roots[_joined(len(roots), kept)]
        if len(roots):
            for labels in (self.label, label):
                at = np.minimum(np.searchsorted(roots, labels), len(roots) - 1)
                moved = roots[at] == labels
                labels[moved] = now[at[moved]]
        if len(self.node) + len(ends) > KNOWN:
            self.node, self.label = ends, label
        else:
            at = np.searchsorted(self.node, ends[~known])
            self.node = np.insert(self.node, at, ends[~known])
            self.label = np.insert(self.label, at, label[~known])
        return roots[kept[:, 0]], roots[kept[:, 1]]


def prints(docs: DataFrame, size: int, percent: int, key: Column | None = None) -> DataFrame:
    """``doc_id, n_shingles, band, high, low``: size band and fingerprint of each row's set.

    With a ``key`` (text), that as ``key`` besides.
    """
    names = ("doc_id", "n_shingles", "band", "high", "low")
    more = () if key is None else ("key",)
    arrow = pa.schema([*((n, pa.int64()) for n in names), *((n, pa.string()) for n in more)])

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        found = []
        for text in each_text(batch):
            own = shingles(hashed_words(text.lower()), size)
            band = band_of(len(own), percent) if len(own) else None
            found.append((len(own), band, *fingerprint(own)))
        yield {"doc_id": batch.column("doc_id")} | {
            n: [f[k] for f in found] for k, n in enumerate(names[1:])
        } | {n: batch.column(n) for n in more}

    return map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *(key.alias(n) for n in more)),
        work,
        ", ".join(f"{n} long" for n in names) + ", key string" * len(more),
        arrow,
    )


def common_shingles(docs: DataFrame, size: int, rows: int) -> np.ndarray:
    """Sorted shingles of at least ``COMMON`` of all ``rows``, as far as batches show them.

    A batch reports those that several of its sets have. There are at most as many as an average
    set has shingles, over ``COMMON``.
    """
    arrow = pa.schema([("shingle", pa.int64()), ("sets", pa.int64())])

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        seen: set[int] = set()
        sets = []
        for text in each_text(batch):
            if (mark := hash(text)) not in seen:
                seen.add(mark)
                sets.append(shingles(hashed_words(text.lower()), size))
        every = np.concatenate(sets) if sets else _NONE
        del sets
        # An eighth of the range of hashes at a time, for less memory.
        for k in range(8):
            part = every[every >> np.uint64(61) == k]
            found, count = np.unique(part, return_counts=True)
            some = count >= 4
            yield {"shingle": found[some].view(np.int64), "sets": count[some]}

    counted = map_batches(docs.select("text"), work, "shingle long, sets long", arrow)
    summed = counted.groupBy("shingle").agg(F.sum("sets").alias("sets"))
    found = summed.filter(F.col("sets") >= max(4, COMMON * rows)).select("shingle").toArrow()
    return np.sort(found.column("shingle").to_numpy().view(np.uint64))


def _candidate_edges(
    docs: DataFrame, size: int, percent: int, total: int, common: np.ndarray
) -> DataFrame:
    """``src, dst``: sets, by the low half of their fingerprints, that are tied.

    ``total`` is the number of shingles of all rows. Of equal segments with equal sketches a batch
    sends on just one, packed with others of the same part of the range of hashes: four bytes of the
    segment's hash (the part tells more), four of its sketch, and which of the batch's sets it is.
    A batch goes by a hash of its sets, whose names it sends once. So a segment takes ten bytes
    however many parts there are, and a part holds a bounded number of segments, so that false
    agreement is as rare in a larger corpus. A task works on several parts, and returns only ties
    that connect what it has not yet connected.
    """
    parts = max(1, -(-total // PART_SEGMENTS))
    names = ("keys", "sketches", "places", "ties", "sets")
    arrow = pa.schema([("part", pa.int64()), ("batch", pa.int64()), *((n, pa.binary()) for n in names)])

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for first in range(0, batch.num_rows, 2 * _SLICE):
            yield from pack(each_text(batch.slice(first, 2 * _SLICE)))

    def pack(bodies: Iterator[bytes]) -> Iterator[dict]:
        seen: set[tuple[int, int]] = set()
        keys, sketches, nodes = [], [], []
        for text in bodies:
            own = shingles(hashed_words(text.lower()), size)
            if len(own) and (mark := fingerprint(own)) not in seen:
                seen.add(mark)
                key, sketch = segments(own, percent, common)
                keys.append(key)
                sketches.append(sketch)
                nodes.append(mark[1])
        if not nodes:
            return
        own = np.repeat(np.arange(len(nodes), dtype=np.uint16), [len(k) for k in keys])
        node = np.array(nodes, np.int64)
        key, sketch = np.concatenate(keys), np.concatenate(sketches)
        del keys, sketches
        order = np.lexsort((sketch, key))
        key, sketch, own = key[order], sketch[order], own[order]
        del order
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (sketch[1:] != sketch[:-1])
        leader = own[new][np.cumsum(new) - 1][~new]
        ties = np.array(_spanning(len(node), leader, own[~new]), np.uint16).reshape(-1, 2)
        key, sketch, own = key[new], sketch[new], own[new]
        part = ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        key = key.astype(np.uint32)
        batch = mix(mix(node.view(np.uint64)) + np.arange(len(node), dtype=np.uint64))
        batch = batch.sum(dtype=np.uint64, keepdims=True).view(np.int64)[0] & ~_PLACES
        at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        bounds = list(zip(at, [*at[1:], len(key)], strict=True))
        more = len(bounds) - 1
        yield {
            "part": part[at],
            "batch": np.full(len(bounds), batch),
            "keys": [key[low:high].tobytes() for low, high in bounds],
            "sketches": [sketch[low:high].tobytes() for low, high in bounds],
            "places": [own[low:high].tobytes() for low, high in bounds],
            "ties": [ties.tobytes(), *[b""] * more],
            "sets": [node.tobytes(), *[b""] * more],
        }

    def agree(records: list[dict], ties: _Ties) -> Iterator[pa.RecordBatch]:
        def column(name, kind):
            return [np.frombuffer(r[name], kind) for r in records]

        def of_batches(found):
            return [r["batch"] | f.astype(np.int64) for r, f in zip(records, found, strict=True)]

        node = np.concatenate(of_batches(column("places", np.uint16)))
        key, sketch = (np.concatenate(column(n, np.uint32)) for n in ("keys", "sketches"))
        a, b = tied(key, sketch, node)
        own = np.concatenate(of_batches(column("ties", np.uint16))).reshape(-1, 2)
        src, dst = ties.new(np.concatenate([a, own[:, 0]]), np.concatenate([b, own[:, 1]]))
        named = column("sets", np.int64)
        low = np.concatenate(named)
        number = np.concatenate(of_batches([np.arange(len(n)) for n in named]))
        for columns in ((src, dst, None), (number, None, low)):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(columns[0]), pa.int64()) if c is None else pa.array(c) for c in columns],
                names=["src", "dst", "low"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, ties = None, [], _Ties()
        for batch in (b.slice(k, 64) for b in batches for k in range(0, b.num_rows, 64)):
            for record in batch.to_pylist():
                if record["part"] != current:
                    if held:
                        yield from agree(held, ties)
                    current, held = record["part"], []
                held.append(record)
        if held:
            yield from agree(held, ties)

    schema = "part long, batch long, " + ", ".join(f"{n} binary" for n in names)
    rows = map_batches(docs.select("text"), work, schema, arrow)
    tasks = min(-(-parts // TOGETHER), 1 << 14)
    dealt = rows.repartition(tasks, "part").sortWithinPartitions("part")
    found = stage(dealt.mapInArrow(run, "src long, dst long, low long"), "ties")
    name = found.filter("low is not null")
    return (
        found.filter("low is null").select("src", "dst").distinct()
        .join(name.select("src", F.col("low").alias("a")), "src")
        .join(name.select(F.col("src").alias("dst"), F.col("low").alias("b")), "dst")
        .select(F.col("a").alias("src"), F.col("b").alias("dst"))
    )


def _blocks(inner: DataFrame) -> DataFrame:
    """``inner`` (``cluster, low, n, band`` and more) with its block and the numbers of blocks.

    A cluster of one block (``whole``) is one cell. In a larger one, each band is cut into
    ``blocks`` by the hash of the member, which is in block ``x``; ``above`` and ``below`` are the
    numbers of blocks of the neighbouring bands. Members learn them in a join that spreads each
    band of a cluster over ``SPREAD`` keys.
    """

    def blocks(docs: Column, shingles: Column) -> Column:
        share = F.greatest(docs / BLOCK_DOCS, shingles / F.lit(float(BLOCK_SHINGLES)))
        return F.ceil(share).cast("int")

    counts = stage(
        inner.groupBy("cluster", "band").agg(
            F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles")
        ),
        "bands",
    )
    whole = counts.groupBy("cluster").agg(
        blocks(F.sum("docs"), F.sum("shingles")).alias("whole")
    )
    own = counts.select("cluster", "band", blocks(F.col("docs"), F.col("shingles")).alias("blocks"))
    up = own.select("cluster", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    down = own.select("cluster", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    plan = (
        own.join(up, ["cluster", "band"], "left")
        .join(down, ["cluster", "band"], "left")
        .join(whole, "cluster")
        .withColumn("spread", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    )
    hashed = F.xxhash64("low")
    return (
        inner.withColumn("spread", F.pmod(hashed, F.lit(SPREAD)).cast("int"))
        .join(plan, ["cluster", "band", "spread"])
        .withColumn("x", F.pmod(F.shiftrightunsigned(hashed, 16), F.col("blocks")).cast("int"))
        .drop("spread")
    )


def _cells(members: DataFrame) -> DataFrame:
    """Members (``rep, copies, sets`` and what ``_blocks`` adds) dealt to pairs of blocks.

    A block meets the blocks of its band and of the next. ``side`` is 0 where the block meets
    itself, else 1 and 2.
    """

    def cell(y, band, first, second, nxt, side):
        return F.struct(
            F.struct(
                "cluster",
                band.alias("b"),
                first.cast("long").alias("x"),
                second.cast("long").alias("y"),
                F.lit(nxt).alias("next"),
            ).alias("cell"),
            side.alias("side"),
        )

    def upto(n):
        n = F.coalesce(F.col(n), F.lit(0).cast("long"))
        return F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<long>"))

    x, band, none = F.col("x"), F.col("band"), F.lit(0).cast("long")
    only = F.array(cell(none, none, none, none, False, F.lit(0)))
    within = F.transform(
        upto("blocks"),
        lambda y: cell(y, band, F.least(x, y), F.greatest(x, y), False,
                       F.when(x == y, 0).when(x < y, 1).otherwise(2)),
    )
    above = F.transform(upto("above"), lambda y: cell(y, band, x, y, True, F.lit(1)))
    below = F.transform(upto("below"), lambda y: cell(y, band - 1, y, x, True, F.lit(2)))
    cells = F.when(F.col("whole") == 1, only).otherwise(F.concat(within, above, below))
    return members.select(F.explode(cells).alias("c"), "rep", "copies", "sets").select(
        "c.cell", "c.side", "rep", "copies", "sets"
    )


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets: incidence times its transpose."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    column = np.concatenate(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    starts = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
    count = np.diff(np.append(starts, len(column)))
    label = np.repeat(np.arange(len(starts)), count)
    width = count[label]
    light = (width > 1) & (width <= _LIGHT)
    rows, labels = row[light], label[light]
    pairs = np.zeros(n * n, np.int64) if len(rows) else None
    for step in range(1, _LIGHT):
        same = np.flatnonzero(labels[step:] == labels[:-step]) if step < len(labels) else []
        if not len(same):
            break
        pairs += np.bincount(rows[same] * n + rows[same + step], minlength=n * n)
    if pairs is not None:
        half = pairs.reshape(n, n)
        out += half + half.T
    heavy = width > _LIGHT
    rows = row[heavy]
    labels = np.unique(label[heavy], return_inverse=True)[1]
    for first in range(0, int(labels.max()) + 1 if len(labels) else 0, _COLUMNS):
        part = slice(*np.searchsorted(labels, [first, first + _COLUMNS]))
        dense = np.zeros((n, _COLUMNS), np.float32)
        dense[rows[part], labels[part] - first] = 1
        out += dense @ dense.T
    return out


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect whatever the links ``a, b`` connect."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        r, s = root(x), root(y)
        if r != s:
            parent[s] = r
            kept.append((x, y))
    return kept


def _spanning(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """``_forest`` of ties that repeat."""
    both = np.unique(a[a != b].astype(np.int64) * n + b[a != b])
    return _forest(n, both // max(n, 1), both % max(n, 1))


def _joined(n: int, edges: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes, one that all those the ``edges`` connect have in common."""
    parent = np.arange(n)
    while len(edges):
        ends = parent[edges]
        edges = edges[ends[:, 0] != ends[:, 1]]
        np.minimum.at(parent, ends.max(axis=1), ends.min(axis=1))
        while (parent[parent] != parent).any():
            parent = parent[parent]
    return parent


def _links(cells: DataFrame, percent: int) -> DataFrame:
    """``src, dst`` of a spanning forest of each cell's links, and rows ``src, links``.

    Sets are named by the low half of their fingerprints, as an id may have several.
    Rows come sorted by cell, so a task holds one cell at a time.
    """
    arrow = pa.schema([("src", pa.int64()), ("dst", pa.int64()), ("links", pa.int64())])

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        side = np.array([r[0] for r in rows])
        rep = np.array([r[1] for r in rows], np.int64)
        copies = np.array([r[2] for r in rows], np.int64)
        sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        sizes = np.array([len(s) for s in sets], np.int64)
        common = overlaps(sets).astype(np.int64)
        linked = (100 + percent) * common >= percent * (sizes[:, None] + sizes[None, :])
        crossing = side[:, None] != side[None, :] if side.any() else np.triu(
            np.ones((len(rows), len(rows)), bool), 1
        )
        a, b = np.nonzero(linked & crossing & (np.triu(np.ones_like(linked), 1)))
        tree = _forest(len(rows), a, b)
        links = np.bincount(a, copies[b], len(rows)) + np.bincount(b, copies[a], len(rows))
        some = np.flatnonzero(links)
        src = [rep[x] for x, _ in tree] + rep[some].tolist()
        dst = [rep[y] for _, y in tree] + [None] * len(some)
        number = [None] * len(tree) + links[some].astype(np.int64).tolist()
        if src:
            columns = [pa.array(c, pa.int64()) for c in (src, dst, number)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        slices = (b.slice(k, _SLICE) for b in batches for k in range(0, b.num_rows, _SLICE))
        for batch in slices:
            columns = [batch.column(c).to_pylist() for c in ("cell", "side", "rep", "copies", "sets")]
            for cell, *rest in zip(*columns, strict=True):
                if cell != current:
                    if len(held) > 1:
                        yield from solve(held)
                    current, held = cell, []
                # Rows that repeat id and text come one after the other, and count once.
                if not held or held[-1] != tuple(rest):
                    held.append(tuple(rest))
        if len(held) > 1:
            yield from solve(held)

    key = F.concat_ws(":", "cell.cluster", "cell.b", "cell.x", "cell.y", "cell.next")
    keyed = cells.select(key.alias("cell"), "side", "rep", "copies", "sets")
    dealt = keyed.repartition("cell").sortWithinPartitions("cell", "side", "rep")
    return dealt.mapInArrow(run, "src long, dst long, links long")


def similarity_groups(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every row.

    ``component_id`` is the least ``doc_id`` that links lead to, ``n_links`` the number of other
    rows a row links with.
    """
    return _groups(docs, size, percent).select("doc_id", "n_shingles", "component_id", "n_links")


def _groups(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The same with the set's fingerprint, ``high, low``, and ``stays``.

    That tells the rows of one id and set (or without words or id) that stand for their group.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and at most 100")
    marked = stage(prints(docs, size, percent), "prints")
    sets = stage(
        marked.filter("n_shingles > 0 and doc_id is not null")
        .groupBy("high", "low", "n_shingles", "band")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")),
        "sets",
    )
    rows, total = marked.agg(F.count("low"), F.sum("n_shingles")).first()
    common = common_shingles(docs, size, rows)
    clusters = components(_candidate_edges(docs, size, percent, total or 0, common))
    clusters = clusters.select(F.col("node").alias("low"), F.col("component").alias("cluster"))
    inner = stage(sets.withColumnRenamed("n_shingles", "n").join(clusters, "low"), "inner")
    members = _member_sets(docs, stage(_blocks(inner), "blocks"), size, rows)
    found = stage(_links(_cells(members), percent), "links")
    groups = components(found.filter("dst is not null").select("src", "dst"))
    links = found.filter("links is not null").groupBy("src").agg(F.sum("links").alias("links"))
    placed = stage(
        sets.join(groups.withColumnRenamed("node", "low"), "low", "left")
        .join(links.withColumnRenamed("src", "low"), "low", "left")
        .select(
            "high", "low", "n_shingles", "rep", "component",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "placed",
    )
    tied = placed.filter("component is not null")
    least = tied.groupBy("component").agg(F.min(F.struct("rep", "high", "low")).alias("least"))
    mark = F.struct("high", "low")
    one = tied.join(least, "component").select(
        "high", "low", "n_shingles", "n_links", F.col("least.rep").alias("component_id"),
        (mark == F.struct("least.high", "least.low")).alias("first"),
    )
    single = placed.filter("component is null").select(
        "high", "low", "n_shingles", "n_links", F.col("rep").alias("component_id"),
        F.lit(True).alias("first"),
    )
    names = ("doc_id", "n_shingles", "component_id", "n_links", "high", "low", "stays")
    alone = (
        marked.filter("n_shingles = 0 or doc_id is null")
        .withColumns({"component_id": F.col("doc_id"), "n_links": F.lit(0), "stays": F.lit(True)})
        .select(*names)
    )
    grouped = (
        marked.filter("n_shingles > 0 and doc_id is not null")
        .join(one.union(single), ["high", "low", "n_shingles"])
        .withColumn("stays", F.col("first") & (F.col("doc_id") == F.col("component_id")))
        .select(*names)
    )
    return grouped.union(alone)


def _member_sets(docs: DataFrame, inner: DataFrame, size: int, rows: int) -> DataFrame:
    """The sets of the representatives that are in a cluster, from their texts.

    In the result, ``rep`` is the low half of the fingerprint.
    A bit set of their ids, joined as 64-bit words, keeps most other texts from being shuffled; it
    has at least four bits for each of the ``rows``, up to ``MOST_DOC_BITS``. It is tested by Spark,
    so that no second Python worker is held by the tasks that make the sets.
    """
    bits = min(max(DOC_BITS, 1 << (4 * rows).bit_length()), MOST_DOC_BITS)
    place = F.col("rep").bitwiseAND(F.lit(bits - 1).cast("long"))
    word, bit = F.shiftright(place, 6), place.bitwiseAND(F.lit(63).cast("long")).cast("int")
    likely = (
        inner.select(word.alias("word"), bit.alias("bit"))
        .groupBy("word")
        .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    )
    names = ("cluster", "rep", "copies", "band", "whole", "blocks", "above", "below", "x")
    arrow = pa.schema([*((n, pa.int64()) for n in names), ("sets", pa.binary())])

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for first in range(0, batch.num_rows, _SLICE):
            yield cut(batch.slice(first, _SLICE))

    def cut(batch: pa.RecordBatch) -> dict:
        marks = zip(*(batch.column(c).to_pylist() for c in ("high", "low")), strict=True)
        own, sets = [], []
        for text, mark in zip(each_text(batch), marks, strict=True):
            found = shingles(hashed_words(text.lower()), size)
            # Where an id repeats, each of its texts is tried for the set in question.
            own.append(fingerprint(found) == mark)
            if own[-1]:
                sets.append(found.tobytes())
        keep = pa.array(own, pa.bool_())
        return {n: batch.column(n).filter(keep) for n in names} | {
            "rep": batch.column("low").filter(keep), "sets": sets
        }

    texts_of = (
        docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
        .where(F.col("rep").isNotNull())
        .join(F.broadcast(likely), word == F.col("word"))
        .where(F.getbit("bits", bit) == 1)
        .select("rep", "text")
    )
    return map_batches(
        texts_of.join(inner, "rep").select(
            *(F.col(n).cast("long").alias(n) for n in names), "high", "low", "text"
        ),
        work,
        ", ".join(f"{n} long" for n in names) + ", sets binary",
        arrow,
    )


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group, that of the least id.

    Rows without words or id all stay. Of an id that repeats, each text belongs to its own group,
    so that some may stay and others go; of texts of one id that are in one group, one stays.
    """
    id_, key_ = spare(docs, "__id"), spare(docs, "__key")
    groups = stage(_groups(docs.select("doc_id", "text"), size, percent), "groups")
    repeated = stage(
        groups.filter("doc_id is not null")
        .groupBy(F.col("doc_id").alias(id_))
        .count()
        .filter("count > 1")
        .select(id_),
        "repeated",
    )
    goes = groups.filter("not stays").select(F.col("doc_id").alias(id_)).distinct()
    if repeated.isEmpty():
        return docs.join(goes, docs["doc_id"] == F.col(id_), "left_anti")
    gone = goes.union(repeated).distinct()
    single = docs.join(gone, docs["doc_id"] == F.col(id_), "left_anti")
    # Rows of one id are told apart by their texts.
    key = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    several = docs.join(repeated, docs["doc_id"] == F.col(id_), "left_semi")
    marks = stage(
        prints(several.select("doc_id", "text").distinct(), size, percent, key), "marks"
    )
    chosen = groups.filter("stays and n_shingles > 0").select("doc_id", "high", "low").distinct()
    kept = (
        marks.filter("n_shingles > 0")
        .join(chosen, ["doc_id", "high", "low"])
        .groupBy("doc_id", "high", "low")
        .agg(F.min("key").alias(key_))
        .select(F.col("doc_id").alias(id_), key_)
    )
    empty = marks.filter("n_shingles = 0").select(
        F.col("doc_id").alias(id_), F.col("key").alias(key_)
    )

    def of(texts: DataFrame) -> DataFrame:
        same = (several["doc_id"] == F.col(id_)) & (key == F.col(key_))
        return several.join(texts, same, "left_semi")

    return single.union(of(kept).dropDuplicates(["doc_id", "text"])).union(of(empty))
