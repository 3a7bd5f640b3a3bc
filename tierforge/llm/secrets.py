"""Find secrets in texts, with SQL functions only: by shape, and by entropy.

By shape: an assignment to a telling name, an access key, a run of hex digits. By entropy: runs of
the characters of a class (hex digits, base64) are candidates; a window slides over each, its
Shannon entropy kept up to date by changing the counts of the character that leaves and the one
that enters, and windows above the threshold of the class are joined to spans. What the allow list
names (placeholders, alphabets, words) is cut out of a candidate, and what is left on either side
is scanned; an identifier is passed over whole, as are spans that lie within one found by shape.

Everything happens within the row: no shuffle, and no row sees another. Defined cases: a null
text is empty and has no spans; repeated rows are scanned one by one; an empty table gives no
rows; the time for a text is in proportion to its length, for a candidate of any length, too.
Positions count code points; ends are exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Shapes of secrets: kind, pattern, least length of the whole match. Fixed values.
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
)
ASSIGN_VALUE = (
    r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16

# What is no secret within a candidate by entropy, and as a whole candidate. Fixed values.
ALLOWED = (
    r"(?i)example|sample|dummy|placeholder|changeme|redacted|your[_-]?(?:key|token|secret)"
    r"|xxxx|0123456789|abcdefghij|qwertyuiop"
)
IDENTIFIER = r"(?i)^[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}$"

# Windows, or matches, that one fold goes through: it copies what it has found at each step.
STEP = 512

BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class CharacterClass:
    """Candidates of one alphabet and the entropy, in bits a character, that betrays them."""

    kind: str
    alphabet: str
    # The alphabet as a regular expression class.
    members: str
    window: int
    threshold: float
    # What a candidate must have besides its length.
    needs: tuple[str, ...] = ()


CLASSES = (
    CharacterClass("entropy_hex", "0123456789abcdef", "[0-9A-Fa-f]", 20, 2.95, ("[0-9]",)),
    CharacterClass(
        "entropy_base64",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-",
        "[A-Za-z0-9+/_-]",
        24,
        3.95,
        ("[0-9]", "[A-Z]", "[a-z]"),
    ),
)


def _pieces(text: Column, pattern: str) -> Column:
    """The text up to the last match, cut after each match (leftmost, none overlapping).

    ``\\G`` ties each piece to the end of the one before, so that the text behind the last match
    is read once and not again from each of its characters.
    """
    return F.regexp_extract_all(text, F.lit(rf"(?s)\G.*?(?:{pattern})"), F.lit(0))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _upto(n: Column) -> Column:
    """The numbers below ``n``."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _sums(numbers: Column) -> Column:
    """Running sums: within blocks of ``STEP``, to which the sums of the blocks before are added."""

    def running(values: Column) -> Column:
        return F.aggregate(
            values,
            F.array().cast("array<int>"),
            lambda sums, v: F.concat(
                sums, F.array(F.coalesce(F.get(sums, F.size(sums) - 1), F.lit(0)) + v)
            ),
        )

    def of(values: Column) -> Column:
        count = F.ceil(F.size(values) / STEP).cast("int")
        blocks = F.transform(
            _upto(count),
            lambda k: running(
                F.transform(
                    _upto(F.least(F.lit(STEP), F.size(values) - k * STEP)),
                    lambda j: F.get(values, k * STEP + j),
                )
            ),
        )
        return _let(blocks, lambda b: _let(running(F.transform(b, F.array_max)), lambda t: add(b, t)))

    def add(blocks: Column, totals: Column) -> Column:
        return F.flatten(
            F.transform(
                blocks,
                lambda block, k: _let(
                    F.coalesce(F.get(totals, k - 1), F.lit(0)),
                    lambda before: F.transform(block, lambda x: x + before),
                ),
            )
        )

    return _let(numbers, of)


def _ends(pieces: Column) -> Column:
    """Where each piece ends."""
    return _sums(F.transform(pieces, F.length))


def _matches(text: Column, pattern: str) -> Column:
    """``found, start, end`` of the leftmost matches, none overlapping."""

    def place(x: Column) -> Column:
        return _let(
            F.regexp_substr(x["piece"], F.lit(pattern)),
            lambda found: F.struct(
                found.alias("found"),
                (x["end"] - F.length(found)).alias("start"),
                x["end"].alias("end"),
            ),
        )

    return _let(
        _pieces(text, pattern),
        lambda pieces: F.transform(
            F.arrays_zip(pieces.alias("piece"), _ends(pieces).alias("end")), place
        ),
    )


def _spans(matches: Column, rank: int, kind: str) -> Column:
    return F.transform(
        matches,
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(kind).alias("kind"),
            m["end"].alias("end"),
        ),
    )


def shaped_spans(text: Column) -> Column:
    """Spans of the three shapes, by start and kind."""
    # A run of hex digits is found at the same place whether or not the pattern has its length.
    hex_runs = _matches(text, f"[0-9a-f]{{{LEAST_HEX},}}")
    access = F.filter(_matches(text, ACCESS), lambda m: m["end"] - m["start"] >= LEAST_ACCESS)
    # A match whose value is too short still hides what it covers, so it is dropped afterwards.
    assign = F.filter(
        _matches(text, ASSIGN),
        lambda m: F.length(F.regexp_extract(m["found"], ASSIGN_VALUE, 1)) >= LEAST_VALUE,
    )
    return F.array_sort(
        F.concat(
            _spans(assign, 0, "assign"), _spans(access, 1, "access"), _spans(hex_runs, 2, "hex")
        )
    )


def hot_windows(candidate: Column, cls: CharacterClass) -> Column:
    """``start, end`` of the joined windows whose entropy reaches the threshold of the class."""
    w, size = cls.window, len(cls.alphabet)
    # c * log2(c): the entropy of a window is log2(w) less the sum of these over w.
    terms = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(w + 1)])
    limit = F.lit((math.log2(w) - cls.threshold) * w)
    folded = F.lower(candidate) if cls.alphabet.lower() == cls.alphabet else candidate
    # Characters of an alphabet are ASCII.
    codes = F.transform(F.split(folded, ""), lambda c: F.instr(F.lit(cls.alphabet), c) - 1)

    def joined(spans: Column, start: Column) -> Column:
        last = F.get(spans, F.size(spans) - 1)
        new = F.struct(start.alias("start"), (start + w).alias("end"))
        grown = F.struct(last["start"].alias("start"), (start + w).alias("end"))
        return F.when(
            (F.size(spans) > 0) & (start <= last["end"]),
            F.concat(F.slice(spans, F.lit(1), F.size(spans) - 1), F.array(grown)),
        ).otherwise(F.concat(spans, F.array(new)))

    def state(counts: Column, total: Column, spans: Column) -> Column:
        return F.struct(counts.alias("counts"), total.alias("total"), spans.alias("spans"))

    def block(codes: Column, first: Column) -> Column:
        """The spans of the windows that start at ``first`` and the ``STEP - 1`` places behind."""

        def slide(s: Column, i: Column) -> Column:
            out, new = F.get(codes, i - 1), F.get(codes, i + (w - 1))
            c_out, c_new = F.get(s["counts"], out), F.get(s["counts"], new)
            change = (
                F.get(terms, c_new + 1)
                - F.get(terms, c_new)
                + F.get(terms, c_out - 1)
                - F.get(terms, c_out)
            )
            total = s["total"] + F.when(out == new, 0.0).otherwise(change)
            counts = F.when(out == new, s["counts"]).otherwise(
                F.transform(
                    s["counts"],
                    lambda c, k: c + F.when(k == new, 1).when(k == out, -1).otherwise(0),
                )
            )
            spans = F.when(total <= limit, joined(s["spans"], i)).otherwise(s["spans"])
            return state(counts, total, spans)

        def run(counts: Column) -> Column:
            total = F.aggregate(counts, F.lit(0.0), lambda acc, c: acc + F.get(terms, c))
            none = F.array().cast("array<struct<start:int,end:int>>")
            found = F.when(total <= limit, joined(none, first)).otherwise(none)
            more = F.least(F.lit(STEP), F.size(codes) - (w - 1) - first) - 1
            return F.aggregate(
                F.transform(_upto(more), lambda j: first + 1 + j),
                state(counts, total, found),
                slide,
                lambda s: s["spans"],
            )

        window = F.transform(_upto(F.lit(w)), lambda j: F.get(codes, first + j))
        counts = _let(
            window,
            lambda inside: F.transform(
                _upto(F.lit(size)), lambda k: F.size(F.filter(inside, lambda x: x == k))
            ),
        )
        return _let(counts, run)

    def islands(spans: Column) -> Column:
        """Spans of neighbouring blocks that meet, as one."""
        starts = F.filter(
            spans, lambda s, i: (i == 0) | (s["start"] > F.get(spans, i - 1)["end"])
        )
        ends = F.filter(
            spans,
            lambda s, i: (i == F.size(spans) - 1) | (F.get(spans, i + 1)["start"] > s["end"]),
        )
        return F.transform(
            F.arrays_zip(starts.alias("a"), ends.alias("b")),
            lambda x: F.struct(x["a"]["start"].alias("start"), x["b"]["end"].alias("end")),
        )

    def spans_of(codes: Column) -> Column:
        count = F.ceil((F.size(codes) - (w - 1)) / STEP).cast("int")
        blocks = F.transform(_upto(count), lambda k: _let(k * STEP, lambda at: block(codes, at)))
        return _let(F.flatten(blocks), islands)

    return _let(codes, spans_of)


def _rest(match: Column) -> Column:
    """``found, start`` of what the allow list leaves of a candidate."""

    def place(pieces: Column) -> Column:
        cuts = F.regexp_extract_all(match["found"], F.lit(ALLOWED), F.lit(0))
        # Pieces and what was cut out behind each; nothing is behind the last.
        widths = F.zip_with(
            pieces, cuts, lambda p, c: F.length(p) + F.coalesce(F.length(c), F.lit(0))
        )
        return F.zip_with(
            pieces,
            F.transform(F.arrays_zip(_sums(widths).alias("e"), widths.alias("n")), lambda x: x["e"] - x["n"]),
            lambda p, at: F.struct(p.alias("found"), (match["start"] + at).alias("start")),
        )

    return _let(F.split(match["found"], ALLOWED, -1), place)


def entropy_spans(text: Column, cls: CharacterClass, rank: int) -> Column:
    """Spans found in the candidates of one class."""
    runs = F.filter(
        _matches(text, f"{cls.members}{{{cls.window},}}"),
        lambda m: ~m["found"].rlike(IDENTIFIER),
    )
    candidates = F.filter(
        F.flatten(F.transform(runs, _rest)),
        lambda m: reduce(
            lambda a, b: a & b,
            [m["found"].rlike(need) for need in cls.needs],
            F.length(m["found"]) >= cls.window,
        ),
    )
    return F.flatten(
        F.transform(
            candidates,
            lambda m: F.transform(
                hot_windows(m["found"], cls),
                lambda s: F.struct(
                    (m["start"] + s["start"]).alias("start"),
                    F.lit(rank).alias("rank"),
                    F.lit(cls.kind).alias("kind"),
                    (m["start"] + s["end"]).alias("end"),
                ),
            ),
        )
    )


def secret_spans(docs: DataFrame, classes: tuple[CharacterClass, ...] = CLASSES) -> DataFrame:
    """``doc_id, base, more``: spans by shape, and those that entropy adds; each sorted.

    A span has ``start, rank, kind, end``; the rank orders kinds that start at one place.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    by_entropy = F.concat(
        *[entropy_spans(F.col("text"), c, len(BASE_KINDS) + k) for k, c in enumerate(classes)]
    )
    new = F.filter(
        F.col("more"),
        lambda m: ~F.exists(
            F.col("base"), lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"])
        ),
    )
    return (
        docs.select("doc_id", text.alias("text"))
        .select("doc_id", shaped_spans(F.col("text")).alias("base"), by_entropy.alias("more"))
        .select("doc_id", "base", F.array_sort(new).alias("more"))
    )


def span_list(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
