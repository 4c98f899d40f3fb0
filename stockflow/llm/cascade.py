"""Operator 8: quality rules as a short-circuit cascade.

Each rule rejects a text or lets it pass, and the verdict is that no rule
rejects. A task estimates each rule's cost (seconds a text) and selectivity
(share of texts rejected) on the first texts of its partition, on which it runs
every rule, and orders the rules by rejection per cost. From then on a text
meets the rules in that order and leaves at the first rejection. The order
changes the work, never the verdict. Estimates stay inside the task: they need
no pass of their own and no driver, and a retried task makes its own.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.textarrays import IS_SPACE, SAME, as_bytes, span_hashes, window_hashes, word_bounds

# The symbols that are counted and the limits of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SAMPLE = 64

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_SHOUT = np.zeros(256, bool)
_IS_SHOUT[list(b"!?")] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(65, 91), *range(97, 123)]] = True
# Bytes that begin a code point.
_BEGINS = (np.arange(256) & 0xC0) != 0x80
_NEWLINE = 10


class Text:
    """One text and its base counts; words `[^\\x20\\x09-\\x0D]+`."""

    def __init__(self, text: str | None) -> None:
        self.raw = as_bytes(text)
        self.starts, self.ends = word_bounds(self.raw)
        self.n_words = self.starts.size
        self.word_chars = int((_BEGINS & ~IS_SPACE)[self.raw].sum())
        self.n_symbols = int(_IS_SYMBOL[self.raw].sum())
        self.n_lines, self.n_dup_lines = self._lines()
        self.n_repeat_words = self._repeats()

    def _lines(self) -> tuple[int, int]:
        """Lines with a word, and those of them that equal an earlier line."""
        ends = np.append(np.flatnonzero(self.raw == _NEWLINE), self.raw.size)
        starts = np.append(0, ends[:-1] + 1)
        before = np.append(0, np.cumsum(~IS_SPACE[self.raw]))
        worded = before[ends] > before[starts]
        hashes = span_hashes(SAME[self.raw], starts[worded], ends[worded])
        return hashes.size, hashes.size - np.unique(hashes).size

    def _repeats(self) -> int:
        """Words in a 3-word window that is found twice or more."""
        windows = window_hashes(span_hashes(self.raw, self.starts, self.ends), 3)
        _, which, count = np.unique(windows, return_inverse=True, return_counts=True)
        again = np.flatnonzero(count[which] > 1)
        covered = np.zeros(self.n_words, bool)
        for i in range(3):
            covered[again + i] = True
        return int(covered.sum())

    @property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


def _symbols(t: Text) -> bool:
    """More than 8 symbols per 100 code points of words."""
    return 100 * t.n_symbols > 8 * t.word_chars


def _dup_lines(t: Text) -> bool:
    """More than half of the lines repeat an earlier one."""
    return 2 * t.n_dup_lines > t.n_lines


def _shouting(t: Text) -> bool:
    """More than 5 exclamation or question marks per 100 code points of words."""
    return 100 * int(_IS_SHOUT[t.raw].sum()) > 5 * t.word_chars


def _capitals(t: Text) -> bool:
    """More than half of the ASCII letters are capitals, of 100 letters at least."""
    letters, upper = int(_IS_LETTER[t.raw].sum()), int(_IS_UPPER[t.raw].sum())
    return letters >= 100 and 2 * upper > letters


def _word_length(t: Text) -> bool:
    """Mean word length under 2 or over 25 code points."""
    return t.word_chars < 2 * t.n_words or t.word_chars > 25 * t.n_words


RULES = (
    Rule("symbols", _symbols),
    Rule("dup_lines", _dup_lines),
    Rule("shouting", _shouting),
    Rule("capitals", _capitals),
    Rule("word_length", _word_length),
)


class Cascade:
    """Rules in the order in which they are best asked."""

    def __init__(self, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> None:
        self.order = list(rules)
        self.sample = sample
        self.seen = 0
        self.seconds = dict.fromkeys((r.name for r in rules), 0.0)
        self.rejected = dict.fromkeys((r.name for r in rules), 0)

    def _estimate(self, text: Text) -> bool:
        any_ = False
        for rule in self.order:
            began = time.perf_counter()
            verdict = rule.rejects(text)
            self.seconds[rule.name] += time.perf_counter() - began
            self.rejected[rule.name] += verdict
            any_ |= verdict
        self.seen += 1
        if self.seen == self.sample:
            self.order.sort(key=lambda r: -self.rejected[r.name] / max(self.seconds[r.name], 1e-9))
        return any_

    def rejects(self, text: Text) -> bool:
        if self.seen < self.sample:
            return self._estimate(text)
        return any(rule.rejects(text) for rule in self.order)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), "base_failed boolean", "kept boolean"])


def quality(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Per row of ``docs``: doc_id, the base counts, base_failed, kept, and ``carry``.

    A null text has no words and fails the base rules, like any text of under 50
    words. Rows are judged one by one: repeated rows and null ids are returned
    as they come, columns named in ``carry`` come along, others are ignored, an
    empty table gives no row.
    """
    given = docs.select("doc_id", F.col("text").alias("judged"), *carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cascade = Cascade(rules, sample)
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = Text(value.as_py())
                failed = text.base_failed
                rows.append((*(getattr(text, c) for c in COUNTS), failed, not failed and not cascade.rejects(text)))
            columns = list(zip(*rows, strict=True)) or [()] * (len(COUNTS) + 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(c, pa.int64()) for c in columns[: len(COUNTS)]),
                    *(pa.array(c, pa.bool_()) for c in columns[len(COUNTS) :]),
                    *batch.columns[2:],
                ],
                ["doc_id", *COUNTS, "base_failed", "kept", *carry],
            )

    columns = [f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields[2:]]
    return given.mapInArrow(run, ", ".join([SCHEMA, *columns]))
