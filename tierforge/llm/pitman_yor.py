"""Language-model scores from a hierarchical Pitman-Yor process.

Each context is a restaurant: tokens are its customers, words the dishes, and a new table's dish
is drawn from the parent restaurant, so that every table is a customer there. A context is the
word before (for the first word, the end of a text). Its parent is the restaurant of its class, by
its last letter, and all classes share one parent, the restaurant of words without context. That
one's own base is spread so thinly over the words that could be that any new table there is a new
word, and a word has one table there: words never seen in training share that mass.

Seating is sampled by Gibbs sweeps. A pair of a context and a word is seated given the chance of
the word in the class and the tables of the context, both as the sweep before left them, so pairs
are independent within a sweep; a pair that occurs once has one table whatever is drawn, and takes
no part. A word's row holds its customers (the tables of its pairs) in every class, and is
reseated, class by class, given the tables that all other words have. Customers of one dish are
seated one after the other; beyond the first ``SINGLY``, in runs that grow by a quarter, within
which the chance of a new table is taken as constant. So a dish's cost grows with the logarithm of
its customers, and a word that makes up a third of the corpus is still one short row.

Tables of pairs and chances of words in classes are averaged over the sweeps after the first
``BURN`` ones. Words are dealt to ranges by their hash, and a pair to that of its word, as packed
records: a piece of documents sends one to each range, with its distinct pairs counted, so that
only its distinct words travel as hashes. What a range learns of its words and pairs is one record
as well. Of contexts, it asks the range that they belong to as words: one record there with its own
tables, one back with those of all ranges. A sweep moves these and the seats of pairs that occur
more than once, no others. A token's chance is a product of the chance of the word in the class, the
context's weight for its parent, and (if training has the pair) a gain. Documents are read a second
time to send their pairs to the ranges, with the rows they are in; a range knows all that its tokens
need and passes on one packed record a piece, which meets the others of its piece. All pairs of a
word are in one range; ranges grow in number with the input.

Defined cases: a null text is empty, and consists of its end; words that training lacks are
scored as one class; without training documents the one class of unknown words has all the mass,
and every score is 0; rows that repeat are learned from and scored as often as they occur; an
empty table gives no rows. ``documents`` is read twice and should be a stored table.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.llm.words import texts, word_hashes, word_spans
from tierforge.scratch import scratch_dir, stage
from tierforge.storage import Folder

# Classes of contexts, a power of two: the low bits of a word's hash are its class.
CONTEXTS = 8
SWEEPS, BURN = 3, 1
SINGLY, STEP = 48, 1.25
# Texts are handled in pieces of about so many bytes, and uses of words in pieces of so many.
PIECE_BYTES, PIECE_USES = 8 << 20, 1 << 18
# Input of a range, as Spark estimates it.
RANGE_BYTES = 4 << 20
# Rows of a piece are numbered below this.
_BATCH = 1 << 16
# The end of a text, as a word, of class 0; no word hashes are reserved, so it is one in 2**61.
_END = np.uint64(0xD1B54A32D192ED00)
_STRENGTH = 1.0

_CHANCES = [f"p{u}" for u in range(CONTEXTS)]
# What records hold, in the order in which a range reads them.
_ANSWER, _COUNTS, _STATE, _TOKENS, _ROWS, _ASK = range(6)
_RECORD = pa.schema(
    [
        ("range", pa.int32()), ("kind", pa.int32()), ("batch", pa.int64()),
        ("stats", pa.list_(pa.float64())), ("data", pa.binary()),
    ]
)
_RECORD_TYPE = "range int, kind int, batch long, stats array<double>, data binary"


def tokens(text: bytes) -> np.ndarray:
    """Hashes of a text's words and its end. The context of each is the one before, in a circle."""
    data = np.frombuffer(text.lower(), np.uint8)
    starts, ends = word_spans(data)
    last = data[ends - 1].astype(np.uint64) if len(ends) else np.empty(0, np.uint64)
    # 0 is the end of a text, the other classes fold the last byte.
    classes = np.uint64(1) + (last ^ (last >> np.uint64(3))) % np.uint64(CONTEXTS - 1)
    words = word_hashes(data, starts, ends) & ~np.uint64(CONTEXTS - 1) | classes
    return np.append(words, _END)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``PIECE_BYTES`` of text: the same wherever it is cut."""
    size = pc.fill_null(pc.binary_length(batch.column("text").cast(pa.large_binary())), 0).to_numpy()
    piece = np.cumsum(size) // PIECE_BYTES
    edges = np.flatnonzero(np.diff(piece, prepend=-1))
    for first, last in zip(edges, [*edges[1:], batch.num_rows], strict=True):
        for start in range(first, last, _BATCH):
            yield batch.slice(start, min(_BATCH, last - start))


@dataclass
class Restaurants:
    """What all words share: customers and tables of each context, discounts, strengths."""

    customers: np.ndarray
    tables: np.ndarray
    dishes: int
    discount: tuple[float, float]
    strength: tuple[float, float] = (1.0, 1.0)

    def root(self, served: np.ndarray) -> np.ndarray:
        """Chance of a word in the parent that has ``served`` customers there."""
        total = self.strength[0] + self.tables.sum()
        return np.maximum(served - self.discount[0], 0) / total

    def root_unknown(self) -> float:
        return (self.strength[0] + self.discount[0] * self.dishes) / (
            self.strength[0] + self.tables.sum()
        )

    def unknown(self) -> np.ndarray:
        """Chance of the class of unknown words in each context."""
        new = self.strength[1] + self.discount[1] * self.tables
        return new / (self.strength[1] + self.customers) * self.root_unknown()

    def predict(self, counts: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Chances of words (rows) in each context."""
        root = self.root(tables.sum(axis=1))
        new = (self.strength[1] + self.discount[1] * self.tables) * root[:, None]
        kept = np.maximum(counts - self.discount[1] * tables, 0)
        return (kept + new) / (self.strength[1] + self.customers)


def seat(
    customers: np.ndarray, base: np.ndarray, other_tables: np.ndarray, discount: float,
    strength: float, rng: np.random.Generator,
) -> np.ndarray:
    """Tables that ``customers`` of one dish open in a restaurant, for many dishes at once.

    ``base``: the parent's chance of the dish; ``other_tables``: those of the other dishes.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    seated = tables.copy()
    while True:
        active = np.flatnonzero(seated < customers)
        if not len(active):
            return tables
        done, now = seated[active], tables[active]
        run = np.where(
            done < SINGLY, 1, np.minimum(customers[active] - done, (done * (STEP - 1)).astype(int))
        )
        # The middle of the run stands for all of it, with the tables expected by then.
        chance, half = np.zeros(len(active)), (run - 1) / 2
        for _ in range(2):
            then = now + chance * half
            new = (strength + discount * (other_tables[active] + then)) * base[active]
            chance = new / (new + done + half - discount * then)
        opened = rng.binomial(run, chance)
        tables[active] = now + opened
        seated[active] = done + run


def reseat(
    counts: np.ndarray, tables: np.ndarray, all_: Restaurants, rng: np.random.Generator
) -> np.ndarray:
    """One sweep over words (rows): each context in turn, given the rest."""
    tables = tables.copy()
    for u in range(CONTEXTS):
        rest = tables.sum(axis=1) - tables[:, u]
        # A word that is nowhere else is new to the parent.
        fresh = all_.discount[0] / (all_.strength[0] + all_.tables.sum())
        base = np.where(rest > 0, all_.root(rest), fresh)
        others = np.maximum(all_.tables[u] - tables[:, u], 0)
        tables[:, u] = seat(counts[:, u], base, others, all_.discount[1], all_.strength[1], rng)
    return tables


def _seed(word: np.ndarray, sweep: int) -> np.random.Generator:
    """Random numbers that depend on the words of a batch alone."""
    return np.random.default_rng([sweep, int(np.bitwise_xor.reduce(word)) & (2**63 - 1), len(word)])


def _discount(ones: int, twos: int) -> float:
    """From the numbers of counts 1 and 2, as in absolute discounting."""
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5


# Records


def _pack(**arrays: np.ndarray) -> bytes:
    """Arrays by name, each compressed byte by byte of its numbers."""
    out = {}
    for name, values in arrays.items():
        values = np.ascontiguousarray(values)
        planes = values.reshape(-1).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
        data = pa.compress(planes, "zstd", asbytes=True) if planes else b""
        out[name] = (values.dtype.str, values.shape, data)
    return pickle.dumps(out)


def _unpack(record: bytes) -> dict[str, np.ndarray]:
    out = {}
    for name, (kind, shape, data) in pickle.loads(record).items():
        kind = np.dtype(kind)
        size = math.prod(shape) * kind.itemsize
        planes = pa.decompress(data, size, "zstd", asbytes=True) if size else b""
        values = np.frombuffer(planes, np.uint8).reshape(kind.itemsize, -1).T
        out[name] = np.ascontiguousarray(values).reshape(-1).view(kind).reshape(shape)
    return out


def _small(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the least type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _steps(values: np.ndarray) -> np.ndarray:
    """Sorted hashes as differences."""
    return np.diff(values, prepend=np.uint64(0))


def _run_steps(places: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Places that ascend within runs, as differences within these."""
    steps = np.diff(places, prepend=0)
    first = np.cumsum(runs) - runs
    steps[first] = places[first]
    return _small(steps)


def _run_places(steps: np.ndarray, runs: np.ndarray) -> np.ndarray:
    sums, runs = np.cumsum(steps, dtype=np.int64), runs.astype(np.int64)
    first = np.cumsum(runs) - runs
    return sums - np.repeat(sums[first] - steps[first], runs)


def _pack_pairs(words: np.ndarray, contexts: np.ndarray, runs: np.ndarray, places: np.ndarray, **more) -> bytes:
    """Pairs sorted by word and context: the words and contexts that occur, each in order, the pairs of
    each word and the places of their contexts."""
    return _pack(words=_steps(words), contexts=_steps(contexts), runs=_small(runs),
                 places=_run_steps(places, runs), **more)


def _unpack_pairs(record: bytes) -> dict[str, np.ndarray]:
    p = _unpack(record)
    steps, runs = p["places"], p["runs"]
    hashes = {k: np.cumsum(p[k], dtype=np.uint64) for k in ("words", "contexts")}
    return p | hashes | {"places": _run_places(steps, runs)}


def _record(range_: int, kind: int, batch: int, data: bytes, stats: list | None = None) -> tuple:
    return int(range_), kind, int(batch), stats, data


def _batches(records: Iterator[tuple], schema: pa.Schema = _RECORD) -> Iterator[pa.RecordBatch]:
    for record in records:
        columns = [pa.array([v], f.type) for v, f in zip(record, schema, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _range_of(word: np.ndarray, ranges: int) -> np.ndarray:
    """Ranges are in the order of the hashes."""
    return (((word >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _ranges(df: DataFrame) -> int:
    """Ranges for an input, by its size: each asks all others. Where Spark does not know the size,
    one a shuffle partition."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    # A frame whose size is not known says that it is enormous.
    if size >= 1 << 50:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-size // RANGE_BYTES))


def _by_range(
    records: DataFrame, work: Callable[[int, list[tuple]], Iterator[tuple]],
    schema: pa.Schema = _RECORD, kinds: str = _RECORD_TYPE,
) -> DataFrame:
    """What ``work`` makes of the records ``(kind, batch, data)`` of each range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("range", "kind", "batch", "data"))
            for at, *record in zip(*columns, strict=True):
                if at != current and held:
                    yield from _batches(work(current, held), schema)
                    held = []
                current = at
                held.append(tuple(record))
        if held:
            yield from _batches(work(current, held), schema)

    dealt = records.repartition("range").sortWithinPartitions("range", "kind", "batch")
    return dealt.mapInArrow(run, kinds)


def _sums(records: DataFrame, size: int) -> np.ndarray:
    """The sums of the records' figures."""
    places = records.filter("stats is not null").select(F.posexplode("stats"))
    rows = places.groupBy("pos").agg(F.sum("col").alias("sum")).collect()
    out = np.zeros(size)
    for row in rows:
        out[row["pos"]] = row["sum"]
    return out


def _stored(records: DataFrame) -> tuple[DataFrame, Folder]:
    """The records as they are stored, and the folder, to be deleted when they have been used."""
    spark = records.sparkSession
    path = scratch_dir(spark, "records")
    records.write.parquet(path)
    return spark.read.schema(records.schema).parquet(path), Folder(spark, path)


# Pairs of pieces


def _split(
    word: np.ndarray, context: np.ndarray, own: np.ndarray, ranges: int
) -> Iterator[tuple[int, slice, dict]]:
    """Pairs sorted by word, given as places in ``own``, distinct words in order: for each range,
    which of the pairs it gets, and the words, the pairs of each, the contexts and their places."""
    of = _range_of(own, ranges)
    edges = np.searchsorted(of, np.arange(ranges + 1))
    cuts = np.searchsorted(word, edges)
    for r in np.flatnonzero(np.diff(cuts)):
        part = slice(cuts[r], cuts[r + 1])
        first, last = edges[r], edges[r + 1]
        here = np.zeros(len(own), bool)
        here[context[part]] = True
        place = np.cumsum(here) - 1
        yield int(r), part, {
            "words": own[first:last],
            "runs": np.bincount(word[part] - first, minlength=last - first),
            "contexts": own[here],
            "places": place[context[part]],
        }


def _pairs_of(piece: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Distinct words of a piece, and of its tokens: row, place of the word and of the context."""
    found = [tokens(t) for t in texts(piece)]
    size = np.array([len(f) for f in found])
    own, at = np.unique(np.concatenate(found), return_inverse=True)
    del found
    at, ends = at.astype(np.int32), np.cumsum(size)
    before = np.empty_like(at)
    before[1:] = at[:-1]
    before[ends - size] = at[ends - 1]
    return own, np.repeat(np.arange(len(size), dtype=np.uint16), size), at, before


def _edges(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))


def _counted(docs: DataFrame, ranges: int) -> DataFrame:
    """Records of the pairs of pieces of ``text`` and their numbers, for the words' ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch):
                own, _, word, context = _pairs_of(piece)
                key = word * np.int64(len(own))
                key += context
                key.sort()
                first = _edges(key)
                n = np.diff(np.append(first, len(key)))
                word, context = np.divmod(key[first], len(own))
                yield from _batches(
                    _record(r, _COUNTS, 0, _pack_pairs(**of, n=_small(n[part])))
                    for r, part, of in _split(word, context, own, ranges)
                )

    return docs.select("text").mapInArrow(run, _RECORD_TYPE)


def _counted_rows(pairs: DataFrame, ranges: int) -> DataFrame:
    """The same from rows ``context, word, n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            word, context = (batch.column(c).to_numpy().view(np.uint64) for c in ("word", "context"))
            own, at = np.unique(np.concatenate([word, context]), return_inverse=True)
            word, context = at[: len(word)], at[len(word) :]
            order = np.lexsort((context, word))
            n = batch.column("n").to_numpy()[order]
            yield from _batches(
                _record(r, _COUNTS, 0, _pack_pairs(**of, n=_small(n[part])))
                for r, part, of in _split(word[order], context[order], own, ranges)
            )

    return pairs.select("context", "word", "n").mapInArrow(run, _RECORD_TYPE)


@dataclass
class _Pairs:
    """The pairs of a range, sorted: words, contexts, places of both in these, and numbers."""

    words: np.ndarray
    contexts: np.ndarray
    word: np.ndarray
    context: np.ndarray
    n: np.ndarray

    @classmethod
    def merged(cls, records: list[tuple]) -> _Pairs:
        parts = [_unpack_pairs(data) for _, _, data in records]
        words = np.unique(np.concatenate([p["words"] for p in parts]))
        contexts = np.unique(np.concatenate([p["contexts"] for p in parts]))
        key, n = [], []
        for p in parts:
            word = np.repeat(np.searchsorted(words, p["words"]), p["runs"])
            key.append(word * len(contexts) + np.searchsorted(contexts, p["contexts"])[p["places"]])
            n.append(p["n"].astype(np.int64))
        key, n = np.concatenate(key), np.concatenate(n)
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = _edges(key)
        return cls(words, contexts, *np.divmod(key[first], len(contexts)), np.add.reduceat(n[order], first))

    @classmethod
    def of(cls, data: bytes) -> _Pairs:
        p = _unpack_pairs(data)
        word = np.repeat(np.arange(len(p["words"])), p["runs"])
        return cls(p["words"], p["contexts"], word, p["places"], p["n"].astype(np.int64))

    def packed(self) -> bytes:
        runs = np.bincount(self.word, minlength=len(self.words))
        return _pack_pairs(self.words, self.contexts, runs, self.context, n=_small(self.n))

    def classes(self) -> np.ndarray:
        """The class of each context."""
        return (self.contexts & np.uint64(CONTEXTS - 1)).astype(np.int64)


def pair_counts(docs: DataFrame, training: Column) -> DataFrame:
    """``context, word, n``: customers of each word in each context in the training documents."""
    arrow = pa.schema([(n, pa.list_(pa.int64())) for n in ("context", "word", "n")])

    def rows(range_: int, records: list[tuple]) -> Iterator[tuple]:
        p = _Pairs.merged(records)
        yield p.contexts[p.context].view(np.int64), p.words[p.word].view(np.int64), p.n

    lists = "context array<long>, word array<long>, n array<long>"
    learned = docs.filter(training).select("text")
    packed = _by_range(_counted(learned, _ranges(learned)), rows, arrow, lists)
    return packed.select(F.inline(F.arrays_zip("context", "word", "n")))


# Questions between ranges


def _asks(range_: int, contexts: np.ndarray, values: np.ndarray, ranges: int) -> Iterator[tuple]:
    """Records that tell the ranges of ``contexts`` the values here, to hear those of all ranges."""
    of = _range_of(contexts, ranges)
    for r in np.unique(of):
        here = of == r
        yield _record(r, _ASK, range_, _pack(contexts=_steps(contexts[here]), values=values[here]))


def _answers(asks: DataFrame) -> DataFrame:
    """The sums over all ranges, in the order of each question; those of all words of a range go to
    it too, in their order, as the record of batch -1."""

    def work(range_: int, records: list[tuple]) -> Iterator[tuple]:
        parts = [_unpack(data) for _, _, data in records]
        asked = [np.cumsum(p["contexts"], dtype=np.uint64) for p in parts]
        own, at = np.unique(np.concatenate(asked), return_inverse=True)
        sums = np.bincount(at, np.concatenate([p["values"] for p in parts]), len(own))
        yield _record(range_, _ANSWER, -1, _pack(values=sums))
        cuts = np.cumsum([len(a) for a in asked])[:-1]
        for (_, batch, _), places in zip(records, np.split(at, cuts), strict=True):
            if batch < 0:
                continue
            yield _record(batch, _ANSWER, range_, _pack(values=sums[places]))

    return _by_range(asks, work)


def _heard(records: list[tuple], contexts: np.ndarray, ranges: int) -> np.ndarray:
    """The answers to the question about ``contexts``."""
    of = _range_of(contexts, ranges)
    out = np.zeros(len(contexts))
    for kind, batch, data in records:
        if kind == _ANSWER and batch >= 0:
            out[of == batch] = _unpack(data)["values"]
    return out


def _one(records: list[tuple], kind: int, batch: int | None = None) -> bytes | None:
    return next((d for k, b, d in records if k == kind and batch in (None, b)), None)


# Training


@dataclass
class Model:
    """``records``: what each range knows of its words and pairs; the chances of unknown words by
    class, the numbers of training tokens and words, of ranges, and the discount of contexts."""

    records: DataFrame
    unknown: np.ndarray
    seen: int
    words: int
    ranges: int
    kept: list[Restaurants]
    leaf: float

    @property
    def chances(self) -> DataFrame:
        """``word, total, p0 .. pk`` (log10 chances in each class), ``back`` (log10 of the weight
        that the word as a context gives its class)."""
        kept, leaf, ranges = self.kept, self.leaf, self.ranges

        def rows(_: int, records: list[tuple]) -> Iterator[tuple]:
            known = _Known.of(records, kept, leaf, ranges)
            yield known.words.view(np.int64), known.total, *known.chance.T, known.back

        names = {"word": "long", "total": "long"} | dict.fromkeys([*_CHANCES, "back"], "double")
        return self._rows(rows, names)

    @property
    def gains(self) -> DataFrame:
        """``pair, gain`` (log10) of the pairs that training has."""
        kept, leaf, ranges = self.kept, self.leaf, self.ranges

        def rows(_: int, records: list[tuple]) -> Iterator[tuple]:
            known = _Known.of(records, kept, leaf, ranges)
            word, context = np.divmod(known.pairs, max(1, len(known.contexts)))
            yield (known.contexts[context].view(np.int64), known.words[word].view(np.int64), known.gain)

        found = self._rows(rows, {"context": "long", "word": "long", "gain": "double"})
        return found.select(F.xxhash64("context", "word").alias("pair"), "gain")

    def _rows(self, rows: Callable, names: dict[str, str]) -> DataFrame:
        types = {"long": pa.int64(), "double": pa.float64()}
        arrow = pa.schema([(n, pa.list_(types[kind])) for n, kind in names.items()])
        lists = ", ".join(f"{n} array<{kind}>" for n, kind in names.items())
        return _by_range(self.records, rows, arrow, lists).select(F.inline(F.arrays_zip(*names)))


def _figures(counts: np.ndarray, tables: np.ndarray) -> list[float]:
    return [*counts.sum(axis=0).astype(float), *tables.sum(axis=0).astype(float)]


def train(pairs: DataFrame) -> Model:
    """Seat the pairs of ``pairs``, a stored table of ``context, word, n``."""
    ranges = _ranges(pairs)
    return _trained(_counted_rows(pairs, ranges), ranges)


def _trained(counted: DataFrame, ranges: int) -> Model:
    """The model of the pairs in ``counted``. A sweep reads what the one before has stored."""

    def begin(range_: int, records: list[tuple]) -> Iterator[tuple]:
        p = _Pairs.merged(records)
        place = p.word * CONTEXTS + p.classes()[p.context]
        shape = (len(p.words), CONTEXTS)
        counts = np.bincount(place, minlength=math.prod(shape)).reshape(shape)
        once = p.n == 1
        single = np.bincount(place[once], minlength=math.prod(shape)).reshape(shape)
        tables = np.minimum(counts, 1)
        classes = tables.sum(axis=1)
        stats = [
            *_figures(counts, tables), len(p.words), p.n.sum(), once.sum(), (p.n == 2).sum(),
            *[(counts == k).sum() for k in (1, 2)], *[(classes == k).sum() for k in (1, 2)],
        ]
        yield _record(range_, _COUNTS, -1, p.packed())
        many = ~once
        used = np.unique(p.context[many])
        state = {
            "words": p.words, "contexts": p.contexts[used], "word": _small(p.word[many]),
            "context": _small(np.searchsorted(used, p.context[many])), "n": _small(p.n[many]),
            "t": np.ones(many.sum(), np.uint8), "sum": np.zeros(many.sum(), np.uint8),
            "single": _small(single), "counts": _small(counts), "tables": _small(tables),
        }
        yield _record(range_, _STATE, -1, _pack(**state), [float(x) for x in stats])
        singles = np.bincount(p.context[once], minlength=len(p.contexts))
        yield from _asks(range_, p.contexts[used], _small(singles[used]), ranges)
        # Contexts that have no pair with more customers here still have single ones.
        rest = np.setdiff1d(np.arange(len(p.contexts)), used)
        of = _range_of(p.contexts[rest], ranges)
        for r in np.unique(of):
            told = rest[of == r]
            yield _record(r, _ASK, -1, _pack(contexts=_steps(p.contexts[told]), values=_small(singles[told])))

    made, made_at = _stored(_by_range(counted, begin))
    sums = _sums(made, 2 * CONTEXTS + 8)
    dishes, seen, ones, twos, *classes = (int(x) for x in sums[2 * CONTEXTS :])
    leaf = _discount(ones, twos)
    discount = (_discount(classes[2], classes[3]), _discount(classes[0], classes[1]))

    def shared(sums: np.ndarray) -> Restaurants:
        customers, tables = sums[:CONTEXTS], sums[CONTEXTS : 2 * CONTEXTS]
        return Restaurants(customers, tables, dishes, discount, (_STRENGTH, _STRENGTH))

    counts = made.filter(F.col("kind") == _COUNTS)
    state, state_at, kept = made, None, []
    now = shared(sums)
    for sweep in range(-1, SWEEPS):
        if sweep >= BURN:
            kept.append(now)
        asks, about = (state.filter(F.col("kind") == k) for k in (_ASK, _STATE))
        told = about.unionByName(_answers(asks))
        last, before = sweep == SWEEPS - 1, state_at
        if last:
            told = told.unionByName(counts)
        seated = _by_range(told, _sweep(sweep, now, leaf, ranges))
        state, state_at = (stage(seated, "seats"), None) if last else _stored(seated)
        if before:
            before.delete_all()
        now = shared(_sums(state, 2 * CONTEXTS))
    made_at.delete_all()
    learned = state.filter(F.col("kind") != _ASK)
    records = learned.unionByName(_answers(state.filter(F.col("kind") == _ASK)))
    mean = np.mean([k.unknown() for k in kept], axis=0) if dishes else np.ones(CONTEXTS)
    return Model(records, mean, seen, dishes, ranges, kept, leaf)


def _sweep(
    sweep: int, shared: Restaurants, leaf: float, ranges: int
) -> Callable[[int, list[tuple]], Iterator[tuple]]:
    """Seats the pairs of a range, then its words; before the first sweep (-1) the words only."""

    def work(range_: int, records: list[tuple]) -> Iterator[tuple]:
        data = _one(records, _STATE)
        if data is None:
            return
        s = _unpack(data)
        heard = _heard(records, s["contexts"], ranges)
        word, context, n = (s[k].astype(np.int64) for k in ("word", "context", "n"))
        t, total, counts, tables = (s[k].astype(np.int64) for k in ("t", "sum", "counts", "tables"))
        kind = (s["contexts"] & np.uint64(CONTEXTS - 1)).astype(np.int64)[context]
        rng = _seed(s["words"], sweep + 1)
        if sweep < 0:
            s["singles"] = _small(heard)
        else:
            others = (s["singles"] + heard)[context] - t
            base = shared.predict(counts, tables)[word, kind]
            t = seat(n, base, np.maximum(others, 0), leaf, _STRENGTH, rng)
            if sweep >= BURN:
                total = total + t
                s |= {f"counts{sweep}": s["counts"], f"tables{sweep}": s["tables"]}
            found = np.bincount(word * CONTEXTS + kind, t, counts.size).astype(np.int64)
            counts = s["single"] + found.reshape(counts.shape)
        s |= {"t": _small(t), "sum": _small(total), "counts": _small(counts)}
        if sweep == SWEEPS - 1:
            yield from _learned(range_, records, s, total, ranges)
            return
        # As many as before, as far as the customers allow.
        tables = np.maximum(np.minimum(tables, counts), np.minimum(counts, 1))
        tables = reseat(counts, tables, shared, rng)
        s["tables"] = _small(tables)
        yield _record(range_, _STATE, -1, _pack(**s), _figures(counts, tables))
        values = np.bincount(context, t, len(s["contexts"])).astype(np.int64)
        yield from _asks(range_, s["contexts"], _small(values), ranges)

    return work


def _learned(range_: int, records: list[tuple], s: dict, total: np.ndarray, ranges: int) -> Iterator[tuple]:
    """The counts and the averaged seats of a range, and questions about tables of all contexts."""
    data = _one(records, _COUNTS)
    p = _Pairs.of(data)
    tables = np.ones(len(p.n))
    tables[p.n > 1] = total / (SWEEPS - BURN)
    yield _record(range_, _COUNTS, -1, data)
    names = [f"{n}{k}" for n in ("counts", "tables") for k in range(BURN, SWEEPS)]
    yield _record(range_, _STATE, -1, _pack(sum=s["sum"], **{n: s[n] for n in names}))
    values = np.bincount(p.context, tables, len(p.contexts))
    yield from _asks(range_, p.contexts, values, ranges)


@dataclass
class _Known:
    """What a range knows: its words, their customers, log10 of their chances by class and of their
    weights as contexts, and its pairs (word * contexts + context) with log10 of their gains."""

    words: np.ndarray
    total: np.ndarray
    chance: np.ndarray
    back: np.ndarray
    contexts: np.ndarray
    pairs: np.ndarray
    gain: np.ndarray

    @classmethod
    def of(cls, records: list[tuple], kept: list[Restaurants], leaf: float, ranges: int) -> _Known:
        data = _one(records, _COUNTS)
        if data is None:
            none = np.empty(0, np.uint64)
            return cls(none, np.empty(0, np.int64), np.empty((0, CONTEXTS)), np.empty(0), none,
                       np.empty(0, np.int64), np.empty(0))
        p, s = _Pairs.of(data), _unpack(_one(records, _STATE))
        total = np.bincount(p.word, p.n, len(p.words)).astype(np.int64)
        chance = np.mean(
            [k.predict(s[f"counts{i}"].astype(np.int64), s[f"tables{i}"].astype(np.int64))
             for i, k in enumerate(kept, BURN)],
            axis=0,
        )
        # Every word is a context as often: the text goes round in a circle.
        tables = _unpack(_one(records, _ANSWER, -1))["values"]
        back = (_STRENGTH + leaf * tables) / (_STRENGTH + total)
        t = np.ones(len(p.n))
        t[p.n > 1] = s["sum"] / (SWEEPS - BURN)
        # Relative to what the context leaves to its class, its total cancels out.
        own = (p.n - leaf * t) / (_STRENGTH + leaf * _heard(records, p.contexts, ranges))[p.context]
        gain = np.log10(1 + own / chance[p.word, p.classes()[p.context]])
        pairs = p.word * len(p.contexts) + p.context
        return cls(p.words, total, np.log10(chance), np.log10(back), p.contexts, pairs, gain)


# Scores


def _tokens(docs: DataFrame, ranges: int) -> DataFrame:
    """Records of the pairs of pieces of documents with the rows that have them, for the words'
    ranges, and one of the rows themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            for piece in _pieces(batch):
                own, row, word, context = _pairs_of(piece)
                key = word * np.int64(len(own))
                key += context
                del word, context
                # Rows stay in order.
                order = np.argsort(key, kind="stable")
                row, key = row[order], key[order]
                del order
                first = _edges(key)
                n = np.diff(np.append(first, len(key)))
                word, context = np.divmod(key[first], len(own))
                ends = np.append(first, len(key))
                about = {
                    "ids": piece.column("doc_id").to_pylist(),
                    "held": piece.column("held_out").to_pylist(),
                    "tokens": np.bincount(row, minlength=piece.num_rows).tolist(),
                }
                yield from _batches(
                    iter([_record(number % ranges, _ROWS, number, pickle.dumps(about))])
                )
                yield from _batches(
                    _record(r, _TOKENS, number, _pack_pairs(
                        **of, n=_small(n[part]),
                        rows=row[ends[part.start] : ends[part.stop]],
                    ))
                    for r, part, of in _split(word, context, own, ranges)
                )
                number += 1

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, _RECORD_TYPE)


def _found(sorted_: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the wanted values are (somewhere, if absent), and which are there."""
    if not len(sorted_):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
    return at, sorted_[at] == wanted


# What a task knows of a row of a batch: tokens, known ones, and the two sums of logarithms.
_PART = np.dtype(
    [("row", np.uint16), ("n", np.uint32), ("known", np.uint32), ("base", float), ("score", float)]
)


def _collected(every: DataFrame) -> DataFrame:
    """Rows with the sums of all their parts. A task holds one batch's at a time."""
    kinds = {
        "doc_id": "long", "held_out": "boolean", "n_tokens": "long", "n_known": "long",
        "base_score": "double", "score": "double",
    }
    types = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    arrow = pa.schema([(n, types[kind]) for n, kind in kinds.items()])

    def whole(batch: int, about: dict | None, found: list[bytes]) -> pa.RecordBatch:
        size = len(about["ids"]) if about else 0
        part = np.frombuffer(b"".join(found), _PART)
        row = part["row"].astype(np.int64)
        sums = {n: np.bincount(row, part[n], size) for n in _PART.names[1:]}
        if about is None or not np.array_equal(sums["n"], np.array(about["tokens"])):
            raise RuntimeError(f"batch {batch}: its parts do not make up its tokens")
        columns = {
            "doc_id": about["ids"], "held_out": about["held"], "n_tokens": about["tokens"],
            "n_known": np.rint(sums["known"]).astype(np.int64),
            "base_score": sums["base"], "score": sums["score"],
        }
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, about, found = None, None, []
        for incoming in batches:
            for record in incoming.to_pylist():
                if record["batch"] != current:
                    if current is not None:
                        yield whole(current, about, found)
                    current, about, found = record["batch"], None, []
                if record["part"] is None:
                    about = record
                else:
                    found.append(record["part"])
        if current is not None:
            yield whole(current, about, found)

    dealt = every.repartition("batch").sortWithinPartitions("batch")
    return dealt.mapInArrow(run, ", ".join(f"{n} {kind}" for n, kind in kinds.items()))


def _scored(tokens_: DataFrame, model: Model) -> DataFrame:
    """``batch, part, ids, held, tokens``: sums over the uses in the rows of a batch, in parts
    (packed), and the rows."""
    arrow = pa.schema(
        [
            ("batch", pa.int64()), ("part", pa.binary()), ("ids", pa.list_(pa.int64())),
            ("held", pa.list_(pa.bool_())), ("tokens", pa.list_(pa.int64())),
        ]
    )
    log_unknown = np.log10(model.unknown)
    below = math.log10(model.seen + 0.5 * (model.words + 1))
    kept, leaf, ranges = model.kept, model.leaf, model.ranges

    def part(known: _Known, p: dict[str, np.ndarray]) -> bytes:
        word, there = _found(known.words, p["words"])
        total = np.where(there, known.total[word] if there.any() else 0, 0)
        chance = np.tile(log_unknown, (len(word), 1))
        chance[there] = known.chance[word[there]]
        # A word is the context of what follows, too; one that training lacks leaves all to its class.
        back = np.zeros(len(word))
        back[there] = known.back[word[there]]
        of = np.repeat(np.arange(len(word)), p["runs"])
        context, seen = _found(known.contexts, p["contexts"])
        pair = word[of] * len(known.contexts) + context[p["places"]]
        at, paired = _found(known.pairs, pair)
        paired &= there[of] & seen[p["places"]]
        kind = (p["contexts"] & np.uint64(CONTEXTS - 1)).astype(np.int64)[p["places"]]
        score = chance[of, kind] + back[of]
        score[paired] += known.gain[at[paired]]
        base = np.log10(total + 0.5) - below
        sums = np.zeros((4, int(p["rows"].max()) + 1))
        uses = np.repeat(np.arange(len(of)), p["n"])
        for start in range(0, len(uses), PIECE_USES):
            some = slice(start, start + PIECE_USES)
            row, use = p["rows"][some].astype(np.int64), uses[some]
            for k, values in enumerate((None, (total > 0)[of[use]], base[of[use]], score[use])):
                sums[k] += np.bincount(row, values, sums.shape[1])
        rows = np.flatnonzero(sums[0])
        out = np.empty(len(rows), _PART)
        out["row"], out["n"], out["known"] = rows, np.rint(sums[0][rows]), np.rint(sums[1][rows])
        out["base"], out["score"] = sums[2][rows], sums[3][rows]
        return out.tobytes()

    def run(texts_: pa.Table, learned: pa.Table) -> pa.Table:
        def listed(table: pa.Table) -> list[tuple]:
            return list(zip(*(table.column(n).to_pylist() for n in ("kind", "batch", "data")), strict=True))

        known = None
        out = []
        for kind, batch, data in listed(texts_):
            if kind == _ROWS:
                about = pickle.loads(data)
                out.append({"batch": batch, "part": None, **about})
            else:
                known = known or _Known.of(listed(learned), kept, leaf, ranges)
                out.append({"batch": batch, "part": part(known, _unpack_pairs(data))})
        return pa.Table.from_pylist(out, arrow)

    return (
        tokens_.groupBy("range")
        .cogroup(model.records.groupBy("range"))
        .applyInArrow(
            run, "batch long, part binary, ids array<long>, held array<boolean>, tokens array<long>"
        )
    )


def scores(docs: DataFrame, training: Column) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``training`` says which rows are learned from. ``score`` is the model's log10 probability of
    the text, ``base_score`` that of word counts with half a count added.
    """
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (~training).alias("held_out"), "text"
    )
    ranges = _ranges(docs)
    model = _trained(_counted(docs.filter(training), ranges), ranges)
    return _collected(_scored(_tokens(plain, ranges), model)).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.seen).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def perplexity(scored: DataFrame) -> DataFrame:
    """``held_out, perplexity, base_perplexity`` per token."""

    def of(name: str) -> Column:
        return F.pow(F.lit(10.0), -F.sum(name) / F.sum("n_tokens"))

    return scored.groupBy("held_out").agg(
        of("score").alias("perplexity"), of("base_score").alias("base_perplexity")
    )
