"""Quality rules judged by host.

Each document is measured once. Failures of the rules are added up by host (here: ``source``),
each host's failure rates, of each rule and of any rule, are shrunk towards the mean of all hosts
by a beta prior that is fitted to the hosts themselves. A host is condemned, and its documents go
with it, if its posterior rate of failing any rule is surely high (also some deviations below its
mean) and stands out from the prior of all hosts. A host with few documents can hardly be condemned
by them alone.

Defined cases: a null text has no words; a null host is a host of its own; rows that repeat are
counted as often as they occur; a text of any length is measured whole, within its row; with one
host, or none that deviate, every rate shrinks to the mean and none stands out; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.llm.words import (
    IS_SPACE,
    covered,
    gram_hashes,
    map_batches,
    texts,
    word_hashes,
    word_spans,
)
from tierforge.scratch import stage

# Characters that count as symbols. Fixed value.
_SYMBOLS = b"#*$%&|<>"

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(_SYMBOLS)] = True

_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class HostRules:
    """Bounds of the rules and of the verdict on hosts."""

    min_words: int = 50
    # Of the words, in percent.
    max_repeat_pct: int = 50
    # Of the characters in words, in percent.
    max_symbol_pct: int = 20
    # Of the lines with words, in percent.
    max_dup_line_pct: int = 30
    # A host is condemned if its rate of failing any rule, less so many standard deviations of its
    # posterior, is above this rate ...
    max_host_rate: float = 0.3
    sure_deviations: float = 2.0
    # ... and is more than so many standard deviations of the prior above the prior's mean.
    prior_deviations: float = 1.0


RULES = ("too_short", "repetitive", "symbols", "dup_lines")
RATES = (*RULES, "any_rule")


def measure(text: bytes) -> tuple[int, ...]:
    """The figures of one text, in the order of ``_FIELDS``."""
    data = np.frombuffer(text, np.uint8)
    starts, ends = word_spans(data)
    n = len(starts)
    if not n:
        return 0, 0, 0, 0, 0, 0
    # Code points begin at bytes that do not continue one.
    chars = int(np.count_nonzero(((data & 0xC0) != 0x80) & ~IS_SPACE[data]))
    repeats = 0
    if n > 3:
        grams = gram_hashes(word_hashes(data, starts, ends), 3)
        _, group, count = np.unique(grams, return_inverse=True, return_counts=True)
        again = np.flatnonzero(count[group] > 1)
        repeats = int(np.count_nonzero(covered(again, 3, n)))
    lines = [line for line in text.split(b"\n") if line.strip(b"\x20\x09\x0a\x0b\x0c\x0d")]
    symbols = int(np.count_nonzero(_IS_SYMBOL[data]))
    return n, chars, symbols, len(lines) - len(set(lines)), repeats, len(lines)


def measures(docs: DataFrame, host: str) -> DataFrame:
    """``doc_id, host`` and the figures of each row's whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow = pa.schema(
        [("doc_id", pa.int64()), ("host", pa.string()), *((f, pa.int64()) for f in _FIELDS)]
    )

    def work(batch: pa.RecordBatch):
        figures = np.array([measure(t) for t in texts(batch)], np.int64).reshape(-1, len(_FIELDS))
        columns = {f: figures[:, k] for k, f in enumerate(_FIELDS)}
        yield columns | {"doc_id": batch.column("doc_id"), "host": batch.column("host")}

    schema = "doc_id long, host string, " + ", ".join(f"{f} long" for f in _FIELDS)
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(host).alias("host"), "text"
    )
    out = map_batches(plain, work, schema, arrow)
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def failures(rules: HostRules) -> dict[str, Column]:
    """What each rule says of a measured document."""
    return {
        "too_short": F.col("n_words") < rules.min_words,
        "repetitive": 100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > rules.max_symbol_pct * F.col("word_chars"),
        "dup_lines": 100 * F.col("n_dup_lines") > rules.max_dup_line_pct * F.col("n_lines"),
    }


def failures_and_any(rules: HostRules) -> dict[str, Column]:
    failed = failures(rules)
    return failed | {"any_rule": reduce(or_, failed.values())}


def host_verdicts(measured: DataFrame, rules: HostRules) -> DataFrame:
    """``host``, its documents, a shrunk rate for each of ``RATES``, and ``condemned``.

    The prior of a rule has the hosts' mean rate ``m`` and the variance that is left of theirs
    once that of drawing ``n`` documents is taken off, weighted by documents (method of moments).
    Three sums over the hosts give it; the hosts themselves never leave the executors.
    """
    failed = failures_and_any(rules)
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("docs"),
        *[F.sum(c.cast("long")).alias(rule) for rule, c in failed.items()],
    )
    n = F.col("docs")
    sums = hosts.agg(
        F.count(n).alias("hosts"),
        F.sum(n).alias("n"),
        F.sum(n * n).alias("nn"),
        *[F.sum(r).alias(f"{r}_f") for r in RATES],
        *[F.sum(F.col(r) * F.col(r) / n).alias(f"{r}_ff") for r in RATES],
    ).first()
    shrunk = {}
    for rule in RATES:
        mean, strength = _prior(
            sums["hosts"], sums["n"] or 0, sums["nn"] or 0,
            sums[f"{rule}_f"] or 0, sums[f"{rule}_ff"] or 0.0,
        )
        shrunk[rule] = (F.col(rule) + F.lit(mean * strength)) / (n + F.lit(strength))
    # The last is that of any rule, by which hosts are judged.
    deviation = math.sqrt(mean * (1 - mean) / (strength + 1))
    rate = shrunk["any_rule"]
    unsure = F.sqrt(rate * (1 - rate) / (n + F.lit(strength + 1)))
    condemned = (rate - rules.sure_deviations * unsure > rules.max_host_rate) & (
        rate > mean + rules.prior_deviations * deviation
    )
    return hosts.select(
        "host", "docs", *[c.alias(f"{r}_rate") for r, c in shrunk.items()],
        condemned.alias("condemned"),
    )


def _prior(hosts: int, n: int, nn: int, f: int, ff: float) -> tuple[float, float]:
    """Mean and strength (alpha + beta) of the beta prior of a rate."""
    if hosts < 2 or not 0 < f < n:
        return (f / n if n else 0.0), float(max(n, 1))
    mean = f / n
    between = ff - n * mean * mean
    spread = (between - (hosts - 1) * mean * (1 - mean)) / (n - nn / n)
    # No spread beyond chance: the prior outweighs any host.
    strength = mean * (1 - mean) / spread - 1 if spread > 0 else float(n)
    return mean, min(max(strength, 1.0), float(n))


def judge(docs: DataFrame, host: str = "source", rules: HostRules | None = None) -> DataFrame:
    """Every document's figures, ``base_failed`` by its own length and repetition, and ``kept``."""
    rules = rules or HostRules()
    # Read by the hosts' sums, the prior and the documents: measured once, a few numbers a row.
    measured = stage(measures(docs, host), "measures")
    failed = failures(rules)
    verdicts = host_verdicts(measured, rules).select(
        F.col("host").alias("known_host"), "condemned"
    )
    return (
        measured.withColumn("base_failed", failed["too_short"] | failed["repetitive"])
        .join(verdicts, F.col("host").eqNullSafe(F.col("known_host")))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("condemned"))
        .drop("known_host")
    )
