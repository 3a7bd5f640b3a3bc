"""Find and remove passages of benchmark items in training documents, with SQL functions only.

The windows of all items (ten words; a shorter item is one window) form a small table that is
broadcast if their counted number allows, and joined by shuffle otherwise. Documents are scanned
window by window. A bit set over the first and last words of the item windows, of bounded size
and passed as a literal, lets most positions go unread further; what passes is joined on the
words themselves, so colliding bits cost time and nothing else.

Defined cases: a null or wordless document has no words and no hits; a null or wordless item has
no window; items that repeat a window are all reported; rows that repeat a ``doc_id`` are judged
one by one; an empty benchmark leaves every document clean; empty documents give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.llm.columns import own, spare
from tierforge.scratch import stage

WINDOW = 10
# Up to so many item windows are broadcast and prefiltered; beyond it they are shuffled.
BROADCAST_WINDOWS = 200_000
# The literal bit set has 32 bits for each window, between these bounds.
LEAST_BITS, MOST_BITS = 1 << 12, 1 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A run of word characters or a run of others, before letters are lowered.
_PIECE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def normal_words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and characters beyond ASCII."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(lower, _BREAK), lambda w: w != "")


def _window(words: Column, start: Column, n: Column | int) -> Column:
    return F.array_join(F.slice(words, start + 1, n), " ")


def _starts(words: Column, n: Column | int) -> Column:
    """First words of the windows of ``n`` words."""
    some = F.size(words) >= n
    return F.when(some, F.sequence(F.lit(0), F.size(words) - n)).otherwise(
        F.array().cast("array<int>")
    )


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``window, n, first, last, items``: each distinct window and the items that have it."""
    words = benchmark.select("item_id", normal_words(F.col("text")).alias("w")).filter(
        F.size("w") > 0
    )
    counted = words.withColumn("n", F.least(F.size("w"), F.lit(size)))
    each = F.transform(
        _starts(F.col("w"), F.col("n")),
        lambda i: F.struct(
            _window(F.col("w"), i, F.col("n")).alias("window"),
            F.get("w", i).alias("first"),
            F.get("w", i + F.col("n") - 1).alias("last"),
        ),
    )
    return (
        counted.select("item_id", "n", F.inline(each))
        .groupBy("window", "n", "first", "last")
        .agg(F.collect_set("item_id").alias("items"))
    )


def _bit(first: Column, last: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(first, last), F.lit(bits)).cast("int")


def _bit_set(windows: DataFrame, bits: int) -> Column:
    """The bits of the windows' ends, 64 to a number, as a literal array."""
    bit = _bit(F.col("first"), F.col("last"), bits)
    rows = (
        windows.select(bit.alias("b"))
        .groupBy(F.shiftright("b", 6).alias("k"))
        .agg(F.expr("bit_or(shiftleft(1L, b & 63))").alias("v"))
        .collect()
    )
    numbers = {r["k"]: r["v"] for r in rows}
    # The least long has no literal of its own.
    return F.expr(
        "array(" + ",".join(f"{numbers.get(k, 0)}L" if numbers.get(k, 0) != -(2**63) else
                            "shiftleft(1L, 63)" for k in range(bits // 64)) + ")"
    )


def hits(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """One row per document: the columns ``keep`` and ``n_words, spans, items``.

    ``spans``: ``start, n`` in words of the windows found, sorted; ``items``: the ids of their
    items, each once.
    """
    windows = stage(item_windows(benchmark, size), "windows")
    counts = {r["n"]: r["count"] for r in windows.groupBy("n").count().collect()}
    total = sum(counts.values())
    small = total <= BROADCAST_WINDOWS
    # The row's number tells apart rows that repeat an id; it is used within this one plan only.
    words = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("keep"),
        normal_words(F.col("text")).alias("w"),
        F.monotonically_increasing_id().alias("row"),
    )
    bits = min(max(LEAST_BITS, 1 << (32 * total).bit_length()), MOST_BITS)
    bit_set = _bit_set(windows, bits) if small and total else None

    def found(n: int) -> Column:
        w = F.col("w")

        def may(i: Column) -> Column:
            bit = _bit(F.get(w, i), F.get(w, i + (n - 1)), bits)
            number = F.get(bit_set, F.shiftright(bit, 6))
            return F.getbit(number, bit.bitwiseAND(F.lit(63))) == 1

        starts = _starts(w, n)
        if bit_set is not None:
            starts = F.filter(starts, may)
        return F.transform(
            starts,
            lambda i: F.struct(
                i.alias("start"), F.lit(n).alias("n"), _window(w, i, n).alias("window")
            ),
        )

    none = F.array().cast("array<struct<start:int,n:int,window:string>>")
    candidates = reduce(F.concat, [found(n) for n in sorted(counts)], none)
    read = words.select("row", "keep", F.size("w").alias("n_words"), candidates.alias("found"))
    rows = read.select("row", "keep", "n_words", F.explode_outer("found").alias("c")).select(
        "row", "keep", "n_words", "c.start", "c.n", "c.window"
    )
    known = windows.select(F.col("window").alias("known"), "items")
    if small:
        known = F.broadcast(known)
    hit = F.when(F.col("known").isNotNull(), F.struct("start", "n"))
    return (
        rows.join(known, F.col("window") == F.col("known"), "left")
        .groupBy("row", "keep", "n_words")
        .agg(
            F.array_sort(F.collect_list(hit)).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
        .select("keep.*", "n_words", "spans", "items")
    )


def covered_words(spans: Column) -> Column:
    """How many words sorted, possibly overlapping spans cover."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))

    def add(state: Column, s: Column) -> Column:
        end = s["start"] + s["n"]
        new = F.greatest(F.lit(0), end - F.greatest(state["end"], s["start"]))
        return F.struct(
            F.greatest(state["end"], end).alias("end"), (state["total"] + new).alias("total")
        )

    return F.aggregate(spans, zero, add, lambda state: state["total"])


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of the spans and the separators that follow them."""
    pieces = F.regexp_extract_all(text, F.lit(f"({_PIECE})"), F.lit(0))
    leading = F.translate(F.get(pieces, F.lit(0)), _UPPER, _LOWER).rlike(_BREAK)
    first = F.when(leading, 1).otherwise(0)

    def kept(piece: Column, j: Column) -> Column:
        # Word k and the separator behind it are pieces 2k and 2k + 1, after a leading separator.
        k = F.floor((j - first) / 2)
        cut = F.exists(spans, lambda s: (k >= s["start"]) & (k < s["start"] + s["n"]))
        return F.when((j >= first) & cut, "").otherwise(piece)

    return F.array_join(F.transform(pieces, kept), "")


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) without the passages.

    Verdicts meet the documents by id and text hash, so whole texts are not dragged through the
    scan; rows that repeat both share their verdict.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove: {remove}")
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.struct(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.xxhash64(text).alias("hash"),
        F.octet_length(text).alias("size"),
    )
    known, spans = spare(docs, "__key"), spare(docs, "__spans")
    found = (
        hits(docs.select(key.alias("key"), "text"), benchmark, keep=("key",))
        .filter(F.size("spans") > 0)
        .dropDuplicates(["key"])
        .select(F.col("key").alias(known), F.col("spans").alias(spans))
    )
    if remove == "documents":
        return docs.join(found, key == F.col(known), "left_anti")
    cut = F.when(F.col(known).isNotNull(), without_spans(F.col("text"), F.col(spans)))
    joined = docs.join(found, key == F.col(known), "left")
    whole = F.coalesce(cut, F.col("text")).alias("text")
    return joined.select(
        *[whole if c == "text" else x for c, x in zip(docs.columns, own(docs), strict=True)]
    )
