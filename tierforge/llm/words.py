"""Words and hashes of whole texts, as numpy arrays inside tasks.

A text is handled as UTF-8 bytes: white space here is the six ASCII characters, no byte of which
occurs inside a longer UTF-8 sequence, and ``bytes.lower`` changes A-Z only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# White space between words. Fixed values.
_SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(_SPACES)] = True

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**64 - 1, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 2**64)
_EMPTY = np.empty(0, np.int64)


class _Powers:
    """Powers of an odd number modulo 2**64, extended as longer texts come."""

    def __init__(self, base: int):
        self._base, self._known = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self._known) < n:
            step = np.uint64(pow(self._base, len(self._known), 2**64))
            self._known = np.concatenate([self._known, self._known * step])
        return self._known[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_UNBASE)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets at which words start and end."""
    if not data.size:
        return _EMPTY, _EMPTY
    inside = np.zeros(data.size + 2, bool)
    np.logical_not(IS_SPACE[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: differences of a running polynomial over the whole text."""
    if not starts.size:
        return np.empty(0, np.uint64)
    run = np.zeros(data.size + 1, np.uint64)
    np.cumsum(_BYTE[data] * _UP.upto(data.size), out=run[1:])
    own = (run[ends] - run[starts]) * _DOWN.upto(data.size)[starts]
    return mix(own + (ends - starts).astype(np.uint64))


def hashed_words(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    return word_hashes(data, *word_spans(data))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words, in order; none if there are fewer words."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.full(count, size, np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(_BASE) + words[k : k + count])
    return out


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct ``size``-word shingles; a shorter, non-empty text is one shingle."""
    return np.unique(gram_hashes(words, min(size, len(words)))) if len(words) else words


def covered(starts: np.ndarray, lengths: np.ndarray | int, size: int) -> np.ndarray:
    """Which of ``size`` places the runs beginning at ``starts`` cover."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as bytes; null is an empty text."""
    return [t or b"" for t in batch.column(name).cast(pa.large_binary()).to_pylist()]


def each_text(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The same one by one, without holding them all as Python objects."""
    for value in batch.column(name).cast(pa.large_binary()):
        yield value.as_py() or b""


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[dict]], schema: str, arrow: pa.Schema
) -> DataFrame:
    """``mapInArrow`` of a function from a batch to dicts of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in work(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow
                )
            # A worker lives on, for other stages too.
            del batch
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
