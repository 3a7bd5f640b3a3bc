"""The main text of web pages.

Parser events of the standard library become blocks: runs of text between block-level tags. Each
block has a ratio of text to tags, which counts as that of a paragraph from ``FULL`` on; the ratios
are smoothed along the page by a Gaussian and cut in two clusters by a threshold. The upper cluster
tells where the content is: in the outermost ``article`` elements (else ``main``) if they hold half
of its text or more, else in the smallest element around all of it. Of that every block is kept but
those within menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments, as elements and plain names tell. Names that content has, too, such as ``related``, count
only where the element is mostly links or, outside of ``article`` and ``main``, mostly in the lower
cluster; a heading goes by no name. So a short paragraph of the article stays, and dense text
elsewhere does not; without ``article`` or ``main``, a short line in an element outside of all the
dense text is left out.

Each page is one row's work; time and memory are in proportion to the page, however deep its
elements lie. Defined cases: a null or empty page, or one without text, gives an empty text; broken
markup is read as far as it can be; repeated rows are extracted one by one; an empty table gives no
rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.llm.words import map_batches

# How HTML elements behave.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav"
    " ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
# An opening tag of the key ends an open element of the value.
_ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
# Elements that are never content.
_NEVER = frozenset(
    "script style noscript template head title nav header footer aside form button select textarea"
    " input iframe object embed svg canvas audio video menu dialog map".split()
)
# Words in class, id or role that mark an element as no content ...
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo"
    " promoted cookie cookies consent gdpr notice notices notification newsletter"
    " subscribe subscription signup paywall popup modal overlay sidebar sidebars sidenav menu menus"
    " nav navbar navigation breadcrumb breadcrumbs pagination pager masthead footer comment"
    " comments commentlist disqus respond replies reply toolbar contentinfo complementary searchbox"
    " dialog".split()
)
# ... and those that do so only if links or ratios agree.
_HINTS = frozenset(
    "alert header promotion recommendations recommended related search share sharing skip social"
    " widget widgets".split()
)
# A header by name alone, or with one of these before it, is that of the page.
_PAGE = frozenset(("site", "page", "global", "top"))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_COMMENTS = frozenset("comment comments commentlist disqus respond replies reply".split())
# Elements that are marked for what they contain besides content.
_FRAMES = frozenset(("html", "body", "main", "article"))

_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
# Characters a tag from which a block is as good as any: a lead, too, beside far longer blocks.
FULL = 50.0
_SIGMA = 1.0
_KERNEL = np.exp(-0.5 * (np.arange(-3, 4) / _SIGMA) ** 2)
_KERNEL /= _KERNEL.sum()


@dataclass
class _Block:
    text: str
    tags: int
    linked: int
    # The innermost open element.
    within: int


def _marks(tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool]:
    """Whether an element's attributes say that it is no content, and whether they hint at it."""
    hinted = False
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return tag not in _FRAMES, False
        if name not in ("class", "id", "role") or not value or tag in _HEADINGS:
            continue
        for word in value.split():
            tokens = [t.lower() for t in _TOKEN.findall(word)]
            if not tokens or tokens[0] in ("has", "no", "with", "without"):
                continue
            if tag in _FRAMES:
                if tag == "article" and _COMMENTS.intersection(tokens):
                    return True, False
                continue
            of_page = "header" in tokens and (len(tokens) == 1 or tokens[0] in _PAGE)
            if of_page or _MARKS.intersection(tokens):
                return True, False
            hinted = hinted or bool(_HINTS.intersection(tokens))
    return False, hinted


class _Blocks(HTMLParser):
    """Collects the blocks outside of what is never content."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[_Block] = []
        # By the number of an element, in page order; 0 is the page.
        self.parents: list[int] = [0]
        self.kinds: dict[int, str] = {}
        self.hinted: set[int] = set()
        self._open: list[tuple[str, int, bool]] = []
        self._count: Counter[str] = Counter()
        self._skipped = self._links = self._tags = self._linked = 0
        self._text: list[str] = []

    def _flush(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            self.blocks.append(_Block(text, self._tags, self._linked, self._inner()))
        self._text, self._tags, self._linked = [], 0, 0

    def _inner(self) -> int:
        return self._open[-1][1] if self._open else 0

    def _pop(self) -> None:
        tag, _, skipped = self._open.pop()
        self._count[tag] -= 1
        self._skipped -= skipped
        self._links -= tag == "a"

    def _close(self, tags: tuple[str, ...], until: frozenset[str]) -> None:
        """End the innermost open element of ``tags`` unless one of ``until`` lies in between."""
        if not any(self._count[tag] for tag in tags):
            return
        for k in range(len(self._open) - 1, -1, -1):
            tag = self._open[k][0]
            if tag in tags:
                while len(self._open) > k:
                    self._pop()
                return
            if tag in until:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _BLOCK:
            self._flush()
            self._close(("p",), _BLOCK - {"p"})
            if tag in _ENDS:
                self._close(_ENDS[tag], frozenset(("ul", "ol", "dl", "table", "select", "menu")))
        self._tags += 1
        if tag == "br":
            self._text.append(" ")
        if tag in _VOID:
            return
        serial = len(self.parents)
        self.parents.append(self._inner())
        if tag in _BLOCK:
            self.kinds[serial] = "main" if ("role", "main") in attrs else tag
        marked, hinted = _marks(tag, attrs)
        if hinted:
            self.hinted.add(serial)
        skipped = tag in _NEVER or marked
        self._open.append((tag, serial, skipped))
        self._count[tag] += 1
        self._skipped += skipped
        self._links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # In HTML the slash means nothing; foreign elements that use it have no text.
        if tag in _VOID or tag in _BLOCK:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        if tag in _BLOCK:
            self._flush()
        self._close((tag,), frozenset())

    def handle_data(self, data: str) -> None:
        if self._skipped:
            return
        self._text.append(data)
        if self._links:
            self._linked += len(data)

    def finish(self) -> list[_Block]:
        self.close()
        self._flush()
        return self.blocks


def content_lines(ratios: np.ndarray) -> np.ndarray:
    """Which lines lie in the upper of two clusters of the smoothed ratios."""
    padded = np.pad(ratios, len(_KERNEL) // 2, mode="edge")
    smooth = np.convolve(padded, _KERNEL, mode="valid")
    cut = smooth.mean()
    for _ in range(50):
        upper = smooth >= cut
        if upper.all():
            break
        new = (smooth[upper].mean() + smooth[~upper].mean()) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return smooth >= cut


def _links_only(block: _Block) -> bool:
    return block.linked >= 0.8 * len(block.text)


def _outermost(parser: _Blocks, chosen: Callable[[int], bool]) -> list[int]:
    """For each element the outermost chosen one that it lies in or is, else 0."""
    out = [0] * len(parser.parents)
    for s in range(1, len(out)):
        out[s] = out[parser.parents[s]] or (s if chosen(s) else 0)
    return out


def _sums(parser: _Blocks, blocks: list[_Block], size: Callable[[_Block], int]) -> list[int]:
    """For each element what the blocks within it add up to."""
    out = [0] * len(parser.parents)
    for b in blocks:
        out[b.within] += size(b)
    for s in range(len(out) - 1, 0, -1):
        out[parser.parents[s]] += out[s]
    return out


def _hints_hold(parser: _Blocks, blocks: list[_Block], hits: list[_Block]) -> Callable[[int], bool]:
    """Which elements that a name hints at are no content, by their links and their cluster."""
    if not parser.hinted:
        return lambda s: False
    text = _sums(parser, blocks, lambda b: len(b.text))
    linked = _sums(parser, blocks, lambda b: b.linked)
    dense = _sums(parser, hits, lambda b: len(b.text))
    framed = _outermost(parser, lambda s: parser.kinds.get(s) in ("article", "main"))
    return lambda s: s in parser.hinted and (
        2 * linked[s] >= text[s] or (not framed[s] and 2 * dense[s] < text[s])
    )


def _roots(parser: _Blocks, hits: list[_Block]) -> set[int]:
    """The elements that hold the content; none for the whole page."""
    hits = [b for b in hits if not _links_only(b)] or hits
    dense = sum(len(b.text) for b in hits)
    for wanted in ("article", "main"):
        frame = _outermost(parser, lambda s: parser.kinds.get(s) == wanted)
        held = [b for b in hits if frame[b.within]]
        if 2 * sum(len(b.text) for b in held) >= dense:
            return {top for top in frame if top}
        # What has little of the dense text is something else beside the content.
        hits = [b for b in hits if not frame[b.within]]
    around = _sums(parser, hits, lambda b: 1)
    kinds = ("body", "div", "section", "td")
    common = [s for s, n in enumerate(around) if n == len(hits) and parser.kinds.get(s) in kinds]
    return set(common[-1:])


def main_text(html: str) -> str:
    """The content of a page, its blocks joined by empty lines."""
    parser = _Blocks()
    parser.feed(html)
    blocks = parser.finish()
    if not blocks:
        return ""
    ratios = np.array([len(b.text) / max(1, b.tags) for b in blocks], float)
    dense = content_lines(np.minimum(ratios, FULL))
    hits = [b for b, hit in zip(blocks, dense, strict=True) if hit]
    out = _outermost(parser, _hints_hold(parser, blocks, hits))
    blocks = [b for b in blocks if not out[b.within]]
    hits = [b for b in hits if not out[b.within]] or blocks
    if not blocks:
        return ""
    roots = _roots(parser, hits)
    inside = _outermost(parser, roots.__contains__)
    kept = [b for b in blocks if not roots or inside[b.within]]
    if not any(parser.kinds[r] in ("article", "main") for r in roots):
        # Nothing tells menus from text here but that they are links through and through.
        kept = [b for b in kept if not _links_only(b)]
    return "\n\n".join(b.text for b in kept)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of each page."""
    arrow = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]
    )

    def work(batch: pa.RecordBatch):
        found = [main_text(h) if h else "" for h in batch.column("html").to_pylist()]
        yield {
            "page_id": batch.column("page_id"),
            "url": batch.column("url"),
            "text": found,
            "n_chars": [len(t) for t in found],
        }

    kind = pages.schema["page_id"].dataType.simpleString()
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    out = map_batches(plain, work, "page_id long, url string, text string, n_chars long", arrow)
    return out.withColumn("page_id", F.col("page_id").cast(kind))
