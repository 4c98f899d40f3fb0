"""Operator 3: main text of HTML pages from parser events and text-to-tag ratios.

Events of the standard library's parser are taken in as they come. Text between
two block-level tags is a line; each line has its text-to-tag ratio. Ratios are
smoothed with a Gaussian over neighbouring lines, so that a short paragraph
among long ones is carried by them and a long one among links is not, and lines
over a threshold found by clustering are content. The content region is the
article and main elements if most content is in them, all of them, and else the
innermost container with all content lines. All lines of the region are the
text, but for those in elements that say they are something else (menus,
headers, footers, sidebars, notices, adverts, forms, comments): by tag or role,
by a whole class name or id of a container, or by two parts of a hyphenated
name. One part of a name, or the name of a single block, is weak evidence and
needs the content's too: most of its text in links, or for a block's whole name
no content line. What lies around the article, or holds most content, stays.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Element names by their meaning in HTML.
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NO_TEXT = frozenset(
    "annotation annotation-xml applet audio button canvas datalist embed head iframe noframes noscript object option script "
    "select style svg template textarea title video".split()
)
_OTHER = frozenset("aside dialog footer form menu nav search".split())
_OTHER_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
_OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination "
    "popup promo promotion related recommended recommendations replies respond share sharing sidebar signup skip social "
    "sponsor sponsored subscribe toolbar widget widgets".split()
)
_HEADER_NAMES = frozenset(("header", "topbar", "banner"))
_CONTAINERS = frozenset("article body div html main section".split())
# Elements that are one block of text; their names say less than a container's.
_SINGLE = frozenset("address blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())
# Words that take a name's meaning back.
_NOT = frozenset("has no not non with without".split())
# What readers write, and the words that make it a part of the page.
_REPLIES = frozenset("comment comments replies reply respond responses disqus".split())
_PARTS = frozenset(
    "area author block body box container content form header holder item items list meta section text thread title wrap wrapper".split()
)
_DECLARED = re.compile(r"<!\[[^>]*>")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

SIGMA = 1.0
REACH = 3
MOST = 0.5
_NAME_PARTS = re.compile(r"[-_]+")


def name_evidence(names: set[str]) -> int:
    """2 if the words of a class name or id say that an element is not main text, 1 if one word hints at it, else 0."""
    most = 0
    for name in names:
        words = _NAME_PARTS.split(name.strip("-_"))
        if len(words) < 2 or _NOT & {*words}:
            continue
        hints = [w for w in words if w in _OTHER_NAMES or w in _REPLIES]
        if len(hints) > 1 or (hints and hints[0] in _REPLIES and all(w in _PARTS or w in _REPLIES for w in words)):
            return 2
        most = max(most, len(hints))
    return most


class Lines(HTMLParser):
    """Lines of a page, each its tags and its parts (innermost element, text); and elements with their parents."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.unseen, self.other, self.mains = [""], [0], [False], [False], [False]
        # What a name hints at: 0 nothing, 1 if most of the text is links, 2 also if no line is content.
        self.hints = [0]
        self.open = [0]
        self.open_tags: Counter[str] = Counter()
        self.lines: list[tuple[int, list[tuple[int, str]]]] = []
        self._parts: list[tuple[int, str]] = []
        self._tag_count = 0

    def _end_line(self) -> None:
        if self._parts:
            self.lines.append((self._tag_count, self._parts))
        self._parts, self._tag_count = [], 0

    def _is_unseen(self, tag: str, attrs: dict[str, str | None]) -> bool:
        hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true"
        return tag in _NO_TEXT or hidden or bool(_HIDDEN.search(attrs.get("style") or ""))

    def _is_other(self, tag: str, attrs: dict[str, str | None]) -> tuple[bool, int]:
        """Whether an element is certainly something else, and otherwise the hint."""
        if tag in _OTHER or (attrs.get("role") or "").lower() in _OTHER_ROLES:
            return True, 0
        if tag in ("article", "main", "body", "html"):
            return False, 0
        names = {*f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split()}
        if not self.open_tags["article"] and not self.open_tags["main"] and (tag == "header" or names & _HEADER_NAMES):
            return True, 0
        if names & _OTHER_NAMES:
            return (False, 2) if tag in _SINGLE else (True, 0)
        evidence = name_evidence(names)
        return (True, 0) if evidence == 2 and tag not in _SINGLE else (False, evidence)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._tag_count += 1
        if tag in _BLOCKS:
            self._end_line()
            if self.open_tags["p"]:
                self._close("p")
        elif tag == "br":
            self._parts.append((0, " "))
        if tag in _VOID:
            return
        named = dict(attrs)
        parent = self.open[-1]
        self.tags.append(tag)
        self.parents.append(parent)
        self.unseen.append(self.unseen[parent] or self._is_unseen(tag, named))
        other, hint = self._is_other(tag, named)
        self.other.append(other)
        self.hints.append(hint)
        self.mains.append(tag in ("article", "main") or (named.get("role") or "").lower() in ("main", "article"))
        self.open.append(len(self.tags) - 1)
        self.open_tags[tag] += 1

    def _close(self, tag: str) -> None:
        while True:
            closed = self.tags[self.open.pop()]
            self.open_tags[closed] -= 1
            if closed == tag:
                return

    def handle_endtag(self, tag: str) -> None:
        self._tag_count += 1
        if tag in _BLOCKS:
            self._end_line()
        elif tag == "br":
            self._parts.append((0, " "))
        if self.open_tags[tag]:
            self._close(tag)

    def handle_data(self, data: str) -> None:
        if not self.unseen[self.open[-1]]:
            self._parts.append((self.open[-1], data))

    def finish(self) -> None:
        self.close()
        self._end_line()

    def below(self, marked: np.ndarray) -> np.ndarray:
        """Elements that are marked or in a marked one."""
        out = marked.copy()
        for i in range(1, len(out)):  # children come after their parents
            out[i] |= out[self.parents[i]]
        return out

    def text_held(self, marked: np.ndarray) -> np.ndarray:
        """Characters of text in each element, of marked innermost elements only."""
        held = np.zeros(len(self.tags))
        for _, parts in self.lines:
            for element, data in parts:
                if marked[element]:
                    held[element] += len(data.strip())
        for i in range(len(held) - 1, 0, -1):
            held[self.parents[i]] += held[i]
        return held

    def without(self, dropped: np.ndarray) -> tuple[list[str], list[int], np.ndarray]:
        """Texts and innermost elements of the lines outside dropped elements, and the content that each element holds."""
        texts, owners, counts = [], [], []
        for count, parts in self.lines:
            left = [(element, data) for element, data in parts if not dropped[element]]
            text = " ".join("".join([data for _, data in left]).split())
            if text:
                texts.append(text)
                counts.append(count)
                owners.append(next(element for element, data in left if data.strip()))
        held = np.zeros(len(self.tags))
        if texts:
            sizes = np.array([len(t) for t in texts], float)
            ratios = sizes / np.maximum(1, np.array(counts))
            # Ratios of a page differ by orders of magnitude; clusters are sought on a log scale.
            smooth = np.log1p(smoothed(ratios))
            content = smooth >= threshold(smooth) if smooth.max() > smooth.min() else np.ones(smooth.size, bool)
            np.add.at(held, np.array(owners), sizes * content)
            for i in range(len(held) - 1, 0, -1):
                held[self.parents[i]] += held[i]
        return texts, owners, held


def smoothed(ratios: np.ndarray, sigma: float = SIGMA, reach: int = REACH) -> np.ndarray:
    """Gaussian over neighbours; weights of lines past the ends go to the others."""
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    ones = np.ones_like(ratios)
    pad = lambda x: np.pad(x, reach)
    return np.convolve(pad(ratios), kernel, "valid") / np.convolve(pad(ones), kernel, "valid")


def threshold(values: np.ndarray, rounds: int = 20) -> float:
    """Border between the two clusters of ``values`` (2-means on a line)."""
    low, high = float(values.min()), float(values.max())
    for _ in range(rounds):
        border = (low + high) / 2
        under, over = values[values <= border], values[values > border]
        if not under.size or not over.size:
            return border
        moved = float(under.mean()), float(over.mean())
        if moved == (low, high):
            break
        low, high = moved
    return (low + high) / 2


def _hinted(lines: Lines) -> np.ndarray:
    """Elements that a hint and their text together say are something else."""
    hints = np.array(lines.hints)
    if not hints.any():
        return hints.astype(bool)
    everything = np.ones(hints.size, bool)
    links = lines.below(np.array([tag == "a" for tag in lines.tags]))
    linked = lines.text_held(links) > MOST * lines.text_held(everything)
    held = lines.without(~everything)[2]
    return (hints > 0) & linked | (hints == 2) & (held == 0)


def _others(lines: Lines) -> np.ndarray:
    """Elements that say they are something else and what is in them.

    If no article or main element has content outside them, those around one
    with most of the page's content, or that hold most of it themselves, are kept.
    """
    other, mains = np.array(lines.other) | _hinted(lines), np.array(lines.mains)
    if not other.any():
        return other
    dropped = lines.below(other)
    if (mains & ~dropped & (lines.without(dropped)[2] > 0)).any():
        return dropped
    held = lines.without(np.zeros(other.size, bool))[2]
    most = (held > MOST * held[0]) & (other | mains)
    for i in range(other.size - 1, 0, -1):
        most[lines.parents[i]] |= most[i]
    return lines.below(other & ~most)


def _closed(html: str) -> str:
    """``html`` without a comment that is open at its end."""
    at = html.rfind("<!--")
    if at > html.rfind("-->") and "</script" not in html[at:].lower() and "</style" not in html[at:].lower():
        return html[:at]
    return html


def _region(lines: Lines, held: np.ndarray) -> np.ndarray:
    """Marks the elements whose lines are the text."""
    mark = np.zeros(held.size, bool)
    mains = np.array(lines.mains) & (held > 0)
    outer = mains.copy()
    above = np.zeros(held.size, bool)
    for i in range(1, held.size):
        above[i] = above[lines.parents[i]] or mains[lines.parents[i]]
    outer &= ~above
    if held[outer].sum() >= MOST * held[0] and outer.any():
        return outer
    region = 0
    for i in range(1, held.size):
        # Sums of whole numbers: equality is exact.
        if lines.tags[i] in _CONTAINERS and held[i] == held[0]:
            region = i
    mark[region] = True
    return mark


def main_text(html: str | None) -> str:
    """The main text of a page, blocks joined by a line end; empty if there is none."""
    if not html:
        return ""
    lines = Lines()
    html = _closed(html)
    lines.feed(_DECLARED.sub("", html) if "<![" in html else html)
    lines.finish()
    texts, owners, held = lines.without(_others(lines))
    if not texts:
        return ""
    inside = lines.below(_region(lines, held))
    return "\n".join(t for t, owner in zip(texts, owners, strict=True) if inside[owner])


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars (code points).

    A null or empty html, or one without content, gives an empty text. Rows are
    read one by one: repeated rows and nulls in other columns come back as they
    are; further columns are ignored; an empty table gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py()) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
