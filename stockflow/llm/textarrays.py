"""Words and word hashes of one text as numpy arrays.

Everything works on the UTF-8 bytes of one text at a time, so a task holds one
text and its arrays (about 30 bytes per byte of text) whatever the batch size.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=_U) + _U(seed << 32)) * _GOLDEN)


_BYTE = stream(1, 256)
_POWER = np.ones(64, _U)

# The word rule [^\x20\x09-\x0D]+ : these bytes never occur inside a longer UTF-8 sequence.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Letters and digits of ASCII and every byte of a longer UTF-8 sequence.
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32


def _powers(n: int) -> np.ndarray:
    """Odd multipliers by position in a word."""
    global _POWER
    if _POWER.size < n:
        _POWER = stream(2, max(n, 2 * _POWER.size)) | _U(1)
    return _POWER


_powers(256)


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def word_bounds(raw: np.ndarray, outside: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of bytes that are not ``outside``."""
    inside = np.zeros(raw.size + 2, np.int8)
    inside[1:-1] = ~outside[raw]
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each span; spans are in order, disjoint and not empty."""
    if not starts.size:
        return np.empty(0, _U)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    spelled = raw[place + np.repeat(starts, lengths)]
    with np.errstate(over="ignore"):
        total = np.add.reduceat(_BYTE[spelled] * _powers(int(lengths.max()))[place], first)
        return mix(total + lengths.astype(_U) * _GOLDEN)


def word_hashes(text: str | None, lower: bool = True) -> np.ndarray:
    raw = as_bytes(text)
    starts, ends = word_bounds(raw)
    return span_hashes((LOWER if lower else SAME)[raw], starts, ends)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` neighbours; none if there are fewer."""
    n = hashes.size - width + 1
    if n < 1:
        return np.empty(0, _U)
    by_place = stream(3, width) | _U(1)
    with np.errstate(over="ignore"):
        total = np.zeros(n, _U)
        for i in range(width):
            total += hashes[i : i + n] * by_place[i]
        return mix(total)


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of ``width``-word shingles.

    A text of fewer words has its whole sequence as its only shingle; a text
    without words has none.
    """
    words = word_hashes(text)
    if 0 < words.size < width:
        return window_hashes(words, words.size) ^ stream(4, width)[words.size - 1 : words.size]
    return np.unique(window_hashes(words, width))
