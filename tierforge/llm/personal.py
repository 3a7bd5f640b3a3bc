"""Find personal data: an automaton finds anchors, local parsers expand them to spans.

One pass of an Aho-Corasick automaton over the text finds at-signs, plus signs, digits, schemes and
cues of identifiers. At each anchor a parser of that kind reads to the left and to the right as far
as the kind's characters go, and accepts or drops what it has read:

=======  ========================  ==============================================================
kind     anchor                    read and checked
=======  ========================  ==============================================================
email    ``@``                     local part to the left; dotted labels, two at least, to the right
ip       a digit                   chain of numbers joined by dots, cut in fours; none above 255
card     a digit                   digits, single blanks or hyphens between; 16 to 19, Luhn's check
phone    ``+``                     digits, blanks, dots, hyphens, brackets; 8 to 15 digits
link     ``://``                   letters to the left that are a scheme; to the right a host with a
                                   dot, a user before it, a port, a path; less closing punctuation
iban     ``iban``                  a joint, then groups of four; the check modulo 97
account  another cue               a joint, then up to three letters and 6 to 34 digits
=======  ========================  ==============================================================

All kinds are the leftmost matches of a pattern, none overlapping within the kind, and a match that
fails its check still covers its place. The first four are the base. A cue is any spelling that is
all small, all capitals or capitalised, with no letter or digit before it. No parser reads again
what it has read before, so a text costs time in proportion to its length, whatever it holds.

Everything happens within the row: no shuffle. Defined cases: a null or empty text has no spans;
very long texts are read whole; repeated rows are read one by one; an empty table gives no rows;
columns other than ``doc_id`` and ``text`` are not read. Positions count code points; ends are
exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Span = tuple[int, int]

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "link", "iban", "account")

# Schemes of links and cues of identifiers. Fixed values.
SCHEMES = ("http", "https", "ftp", "sftp", "ssh")
CUES = ("account", "acct", "passport", "ssn", "tax id", "customer id", "konto", "compte", "cuenta")

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"
_LETTERS = frozenset(_CAPITALS + _SMALL)
_LOCAL = _LETTERS | frozenset(DIGITS + "._%+-")
_ALNUM = _LETTERS | frozenset(DIGITS)

DOMAIN = r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
LINK = (
    r"://(?:[A-Za-z0-9._~%+-]+(?::[A-Za-z0-9._~%+!$&*,;=-]*)?@)?"
    rf"{DOMAIN}(?::[0-9]+)?(?:/[A-Za-z0-9._~%+!$&*,;=:@/?#-]*)?"
)
OPEN_END = ".,;:!?"
JOINT = r"(?:\x20?(?:[Nn]umber|[Nn][or]\.?|N[OR]\.?))?\x20?[\x20:=#]\x20?"
IBAN = r"[A-Z][A-Z][0-9][0-9](?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
ACCOUNT = r"(?:[A-Z]{1,3}[\x20-]?)?[0-9](?:[\x20-]?[0-9])*"

_DOMAIN, _LINK = re.compile(DOMAIN), re.compile(LINK)
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_GROUPED = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
_DIALLED = re.compile(r"\+[0-9][\x20().0-9-]+")
_IBAN, _ACCOUNT = re.compile(f"{JOINT}({IBAN})"), re.compile(f"{JOINT}({ACCOUNT})")


def spellings(cue: str) -> list[str]:
    return sorted({cue, cue.upper(), cue.capitalize()})


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    found.add_word("+", ("phone", 1))
    found.add_word("://", ("link", 3))
    for digit in DIGITS:
        found.add_word(digit, ("digit", 1))
    for kind, cues in (("iban", ("iban",)), ("account", CUES)):
        for cue in cues:
            for spelt in spellings(cue):
                found.add_word(spelt, (kind, len(spelt)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def small_number(digits: str) -> bool:
    """At most 255; leading zeros do not count."""
    value = digits.lstrip("0")
    return len(value) < 3 or (len(value) == 3 and value <= "255")


def valid_iban(identifier: str) -> bool:
    rest = 0
    for sign in identifier[4:] + identifier[:4]:
        value = int(sign, 36)
        rest = (rest * (100 if value > 9 else 10) + value) % 97
    return rest == 1


class Reader:
    """The parsers over one text; each remembers how far it has read."""

    def __init__(self, text: str):
        self.text = text
        self.spans: dict[str, list[Span]] = {kind: [] for kind in KINDS}
        self.read = dict.fromkeys(KINDS, 0)

    def email(self, at: int) -> None:
        start = self._back(at, _LOCAL, self.read["email"])
        domain = _DOMAIN.match(self.text, at + 1)
        # What lies before the sign can belong to no later address.
        self.read["email"] = at + 1
        if domain and start < at:
            self.read["email"] = domain.end()
            self.spans["email"].append((start, domain.end()))

    def digit(self, at: int) -> int:
        """At a digit that one parser at least has not read; returns up to where both have."""
        if at >= self.read["ip"]:
            self.address(at)
        if at >= self.read["card"]:
            self.card(at)
        return min(self.read["ip"], self.read["card"])

    def address(self, at: int) -> None:
        """At the first digit of a chain, as all digits before it are read."""
        chain = _NUMBERS.match(self.text, at)
        self.read["ip"] = chain.end()
        numbers = chain[0].split(".")
        for first in range(0, len(numbers) - 3, 4):
            four = numbers[first : first + 4]
            end = at + sum(map(len, four)) + 3
            if all(map(small_number, four)):
                self.spans["ip"].append((at, end))
            at = end + 1

    def card(self, at: int) -> None:
        chain = _GROUPED.match(self.text, at)
        self.read["card"] = chain.end()
        digits = chain[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            self.spans["card"].append(chain.span())

    def phone(self, at: int) -> None:
        if dialled := _DIALLED.match(self.text, at):
            # Back to the last digit; one character at least lies between it and the first.
            number = dialled[0].rstrip(" ().-")
            if len(number) > 3 and 8 <= sum(map(number.count, DIGITS)) <= 15:
                self.spans["phone"].append((at, at + len(number)))

    def link(self, at: int) -> None:
        if at < self.read["link"]:
            return
        start = self._back(at, _LETTERS, self.read["link"])
        self.read["link"] = at + 3
        if (rest := _LINK.match(self.text, at)) and start < at:
            self.read["link"] = rest.end()
            if self.text[start:at].lower() in SCHEMES:
                self.spans["link"].append((start, at + len(rest[0].rstrip(OPEN_END))))

    def identifier(self, kind: str, start: int, end: int) -> None:
        if start < self.read[kind] or (start and self.text[start - 1] in _ALNUM):
            return
        if found := (_IBAN if kind == "iban" else _ACCOUNT).match(self.text, end):
            self.read[kind] = found.end()
            if kind == "iban":
                holds = valid_iban(found[1].replace(" ", ""))
            else:
                holds = 6 <= sum(map(found[1].count, DIGITS)) <= 34
            if holds:
                self.spans[kind].append(found.span(1))

    def _back(self, at: int, members: frozenset[str], least: int) -> int:
        while at > least and self.text[at - 1] in members:
            at -= 1
        return at


def text_spans(text: str, automaton: ahocorasick.Automaton) -> dict[str, list[Span]]:
    """Spans of each kind, by start."""
    reader = Reader(text)
    digits = 0
    for last, (kind, length) in automaton.iter(text):
        if kind == "digit":
            if last >= digits:
                digits = reader.digit(last)
        elif kind == "email":
            reader.email(last)
        elif kind == "phone":
            reader.phone(last)
        elif kind == "link":
            reader.link(last - 2)
        else:
            reader.identifier(kind, last + 1 - length, last + 1)
    return reader.spans


def personal_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: ``kind, start, end`` by kind as listed, then start."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        codes = {kind: code for code, kind in enumerate(KINDS)}
        for batch in batches:
            ends, kinds, starts, stops = [0], [], [], []
            for value in batch.column("text"):
                if text := value.as_py():
                    for kind, spans in text_spans(text, automaton).items():
                        kinds += [codes[kind]] * len(spans)
                        starts += [s for s, _ in spans]
                        stops += [e for _, e in spans]
                ends.append(len(kinds))
            names = pa.DictionaryArray.from_arrays(pa.array(kinds, pa.int32()), pa.array(KINDS))
            found = pa.StructArray.from_arrays(
                [names.cast(pa.string()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32())],
                ["kind", "start", "end"],
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)],
                ["doc_id", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, spans array<struct<kind:string,start:int,end:int>>"
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def span_list(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
