"""Tell the encoding of text files that do not say it and are not UTF-8.

The files' bytes are counted on the executors, by file: each byte above ASCII, how often two of
them follow each other, and, for encodings of several bytes, what characters the text is made of
when it is read that way. Counts add up, so a file of any size is counted by many tasks and no part
of it is a sample. Each encoding is then judged by the sums:

================  ============================================================================
UTF-16LE, -BE     there are zero bytes; the text decodes, without control characters, and its
                  first lines have delimiters or line ends in this byte order only
Shift_JIS,        it decodes; at least a tenth of its Japanese characters are kana, and hardly
EUC-JP            any others lie beyond ASCII
windows-1251      bytes above ASCII come in runs, are Cyrillic letters, small ones with the usual
                  share of vowels, and no capital follows a small one
windows-1252      bytes above ASCII mostly stand alone, and are signs and the letters of one
                  western language
================  ============================================================================

A file for which none, or more than one, holds is unclear, and is not read as any.
"""

from __future__ import annotations

import codecs
import sys
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.sources.spreadsheets import escaped

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What the encodings judged are called by Spark, and by Python. Fixed values.
CODECS = {
    "UTF-16LE": "utf-16-le",
    "UTF-16BE": "utf-16-be",
    "Shift_JIS": "cp932",
    "EUC-JP": "euc_jp",
    "windows-1251": "cp1251",
    "windows-1252": "cp1252",
}
_WIDE, _DOUBLE = ("UTF-16LE", "UTF-16BE"), ("Shift_JIS", "EUC-JP")
# Letters beyond ASCII by language, and signs that go with any of them. Fixed values.
_LETTERS = {
    "Danish, Norwegian": "æøåéÆØÅÉ",
    "Dutch": "ëïéèöüËÏÉ",
    "French": "àâæçèéêëîïôœùûüÿÀÂÇÈÉÊËÎÏÔŒÙÛÜ",
    "German": "äöüßÄÖÜéà",
    "Icelandic": "áéíóúýþæöðÁÉÍÓÚÝÞÆÖÐ",
    "Italian": "àèéìòùÀÈÉÌÒÙ",
    "Portuguese": "àáâãçéêíóôõúÀÁÂÃÇÉÊÍÓÔÕÚ",
    "Spanish": "áéíñóúüÁÉÍÑÓÚÜ",
    "Swedish, Finnish": "åäöéÅÄÖÉ",
}
_SIGNS = "€‚„…‘’“”•–—™ £§©«®°±²´µ·º»¼½¾¿ª¡×"
_VOWELS = "аеио"
_MARKS = np.array([ord(c) for c in ",;\t|\n"], np.uint32)


def _codes(chunk: bytes, codec: str) -> np.ndarray | None:
    """Code points; None if the bytes are no text of that encoding."""
    try:
        return np.frombuffer(chunk.decode(codec).encode("utf-32-le"), np.uint32)
    except UnicodeError:
        return None


def _between(values: np.ndarray, first: int, last: int) -> np.ndarray:
    return (values >= first) & (values <= last)


def byte_counts(chunk: bytes, at_start: bool) -> Counter[str]:
    """What there is in some lines of a file, without the last line's end; ``at_start``: its first."""
    data = np.frombuffer(chunk, np.uint8)
    if (data == 0).any():
        return _wide_counts(chunk, at_start)
    high, capital = data >= 0x80, _between(data, 0xC0, 0xDF)
    found = np.bincount(data[high], minlength=256)
    out = Counter({f"byte {b}": int(found[b]) for b in np.flatnonzero(found)})
    out["pairs"] = int((high[:-1] & high[1:]).sum())
    out["small, capital"] = int(((data >= 0xE0)[:-1] & capital[1:]).sum())
    for name in _DOUBLE:
        codes = _codes(chunk, CODECS[name])
        if codes is None:
            out[f"bad {name}"] = 1
            continue
        beyond = codes[codes >= 0x80]
        kana = _between(beyond, 0x3041, 0x30FF)
        wide = _between(beyond, 0x4E00, 0x9FFF)
        signs = _between(beyond, 0x3000, 0x3040) | _between(beyond, 0xFF01, 0xFF5E)
        out[f"kana {name}"], out[f"kanji {name}"] = int(kana.sum()), int(wide.sum())
        out[f"other {name}"] = len(beyond) - int((kana | wide | signs).sum())
    return out


def _wide_counts(chunk: bytes, at_start: bool) -> Counter[str]:
    out = Counter({"zeros": 1})
    for name in _WIDE:
        # A line is cut at the byte of a line end. The other byte of that character comes first in
        # what follows, or, in the other order, last in what came before.
        if name == "UTF-16LE":
            rest = chunk if at_start else chunk[1:]
        else:
            rest = chunk + b"\n" * (len(chunk) % 2)
        codes = _codes(rest, CODECS[name])
        if codes is None:
            out[f"bad {name}"] = 1
        else:
            # Behind a line end, either order may be read as the other, shifted by a byte.
            out[f"marks {name}"] = int(np.isin(codes, _MARKS).sum()) * at_start
            out[f"odd {name}"] = int(((codes < 0x20) & ~np.isin(codes, (9, 10, 13))).sum())
    return out


def judged(counts: Mapping[str, int]) -> str | None:
    """The one encoding that the counts of a whole file hold for; None if it is unclear.

    Text of windows-1252 without what sets it apart from ISO-8859-1 is given out as that, which
    Spark's own readers know.
    """
    n = Counter(counts)
    if n["zeros"]:
        fit = [w for w in _WIDE if not n[f"bad {w}"] and not n[f"odd {w}"] and n[f"marks {w}"]]
        return fit[0] if len(fit) == 1 else None
    by_byte = np.array([n[f"byte {b}"] for b in range(256)])
    high = int(by_byte.sum())
    fit = []
    for name in _DOUBLE:
        text = n[f"kana {name}"] + n[f"kanji {name}"]
        if not n[f"bad {name}"] and 0 < text <= 10 * n[f"kana {name}"] and 50 * n[f"other {name}"] <= text:
            fit.append(name)
    if _is_cyrillic(by_byte, n):
        fit.append("windows-1251")
    if high and 4 * n["pairs"] <= high and any(_is_of(by_byte, s) for s in _LETTERS.values()):
        fit.append("windows-1252" if by_byte[0x80:0xA0].any() else "ISO-8859-1")
    return fit[0] if len(fit) == 1 else None


def _is_of(by_byte: np.ndarray, letters: str) -> bool:
    known = list(set((letters + _SIGNS).encode("cp1252")))
    return 100 * by_byte[known].sum() >= 97 * by_byte.sum()


def _is_cyrillic(by_byte: np.ndarray, n: Counter[str]) -> bool:
    letters = by_byte[0xC0:].sum() + by_byte[0xA8] + by_byte[0xB8]
    small, high = by_byte[0xE0:].sum(), by_byte.sum()
    vowels = [by_byte[b] for b in _VOWELS.encode("cp1251")]
    return bool(
        small
        and 100 * letters >= 95 * high
        and 2 * n["pairs"] >= high
        and 50 * n["small, capital"] <= small
        and all(30 * v >= small for v in vowels)
    )


def encodings(spark: SparkSession, paths: Sequence[str], file_path: Column) -> DataFrame:
    """``path, encoding`` of the files, null where it is unclear."""
    lines = (
        spark.read.option("lineSep", "\n")
        .text([escaped(p) for p in paths])
        .select(
            file_path.alias("path"),
            F.col("_metadata.file_block_start").alias("split"),
            F.col("value").cast("binary").alias("line"),
        )
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, Counter[str]] = {}
        for batch in batches:
            files, splits, values = (batch.column(c).to_pylist() for c in ("path", "split", "line"))
            first = 0
            for k in range(1, len(files) + 1):
                if k == len(files) or (files[k], splits[k]) != (files[first], splits[first]):
                    # A task meets a file's first split from its start.
                    at_start = splits[first] == 0 and files[first] not in sums
                    found = byte_counts(b"\n".join(values[first:k]), at_start)
                    sums.setdefault(files[first], Counter()).update(found)
                    first = k
        rows = [(path, what, n) for path, found in sums.items() for what, n in found.items()]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        kinds = (pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["path", "what", "n"]
        )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [judged(dict(found)) for found in batch.column("found").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(names, pa.string())], ["path", "encoding"]
            )

    counted = lines.mapInArrow(count, "path string, what string, n long")
    sums = counted.groupBy("path", "what").agg(F.sum("n").alias("n"))
    # Some hundreds of counts a file at most.
    found = sums.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("what", "n"))).alias("found"))
    return found.mapInArrow(judge, "path string, encoding string")


def codec_of(encoding: str) -> str:
    return codecs.lookup(CODECS.get(encoding, encoding)).name
