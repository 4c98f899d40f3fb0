"""Operator 6: best-fit packing with a swap-based local search.

Documents become token ids, long ones are cut, and the pieces are packed into
sequences of at most ``capacity`` tokens. A bin is a sequence; a piece is its
length. Pieces are dealt at random to groups of bounded size, each of which is
packed in one task: best fit in order of decreasing length, then a local search
over the bins that are not full. A step moves a piece, or exchanges one for one
or one for two between two bins, if the sum of squared fills rises; pieces so
gather in the fuller bins until light bins are empty and go.

Only lengths travel to the packing step, never texts or ids.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from unicodedata import category, combining, is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.storage import stored

CAPACITY = 2048
END = 0
GROUP = 32_768
WORDS_KEPT = 1_000_000
# Texts whose new words are encoded together.
TEXTS = 64
# Words of letters that are encoded as one text.
AT_ONCE = 512
_LETTERS_THEN_MARKS = re.compile(r"([^\W\d_]+)([^\w\s]+)")
PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def _parts_stay(word: str, parts: re.Match) -> bool:
    """Whether the tokenizer sees the same letters and marks as the match."""
    if word.isascii():
        return True
    letters, marks = parts.groups()
    return (
        letters.isalpha()
        and not combining(marks[0])
        and word == word.lower()
        and is_normalized("NFC", word)
        and all(category(c)[0] in "PS" for c in marks)
    )


class Encoder:
    """Ids of a text, word by word.

    The vocabulary never joins bytes across white space, so a text's ids are its
    words' ids in order, and never letters with the marks behind them, if
    lower-casing and normalisation leave both as they are. Those of recent words
    are remembered, up to ``WORDS_KEPT`` of them.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        strings = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(1 + max(strings.values()), bool)
        self.ends_word[[i for string, i in strings.items() if string.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def _encode(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        # Words of letters alone end where a token does that ends a word, so many are one text.
        letters = [w for w in new if w.isalpha() and (w.isascii() and w.islower() or w == w.lower() and is_normalized("NFC", w))]
        for at in range(0, len(letters), AT_ONCE):
            some = letters[at : at + AT_ONCE]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            packed, start = ids.tobytes(), 0
            for word, end in zip(some, ends.tolist(), strict=True):
                self.known[word] = packed[4 * start : 4 * end]
                start = end
        rest = [w for w in new if w not in self.known]
        for word, found in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.known[word] = np.array(found.ids, "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Remember the ids of words that are not known yet."""
        parts = {w: m.groups() for w in words if (m := _LETTERS_THEN_MARKS.fullmatch(w)) and _parts_stay(w, m)}
        self._encode({p for pair in parts.values() for p in pair} | (words - parts.keys()))
        known = self.known
        for word, (letters, marks) in parts.items():
            known[word] = known[letters] + known[marks]

    @staticmethod
    def words(text: str | None) -> list[str]:
        text = text or ""
        # The vocabulary has lower case only; where lowering first is the same, fewer words differ.
        if text.isascii():
            text = text.lower()
        elif "\u03a3" not in text and is_normalized("NFC", text):
            lowered = text.lower()
            if is_normalized("NFC", lowered):
                text = lowered
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")

    def ids_of(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text and the end id; new words of all texts are encoded together."""
        words = [self.words(text) for text in texts]
        new = set().union(*words).difference(self.known)
        if len(self.known) + len(new) > WORDS_KEPT:
            self.known.clear()
            new = set().union(*words)
        if new:
            self.learn(new)
        find = self.known.__getitem__
        end = np.uint32(END).tobytes()
        return [np.frombuffer(b"".join(map(find, of_text)) + end, "<u4") for of_text in words]

    def ids(self, text: str | None) -> np.ndarray:
        return self.ids_of([text])[0]


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The encoder of this Python worker, which goes on from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int) -> DataFrame:
    """One row for each piece of each row of ``docs``; ``row`` tells repeated rows apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        for batch in (b.slice(i, TEXTS) for b in batches for i in range(0, b.num_rows, TEXTS)):
            out = []
            doc_ids, rows, texts = (c.to_pylist() for c in batch.columns)
            for doc_id, row, ids in zip(doc_ids, rows, encoder.ids_of(texts), strict=True):
                for i, start in enumerate(range(0, ids.size, capacity)):
                    part = ids[start : start + capacity]
                    out.append((doc_id, row, i, start, part.size, zlib.crc32(part.tobytes())))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "row", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(run, PIECES)


class Bins:
    """Bins of one group: members by bin, and bins by fill."""

    def __init__(self, lengths: np.ndarray, capacity: int) -> None:
        self.lengths = lengths.tolist()
        self.capacity = capacity
        self.members: list[list[int]] = []
        self.fill: list[int] = []
        self._best_fit()

    def _best_fit(self) -> None:
        """Largest piece first, each into the fullest bin that has room."""
        room: list[int] = []  # rooms in use, ascending
        by_room: dict[int, list[int]] = {}
        for item in sorted(range(len(self.lengths)), key=lambda i: -self.lengths[i]):
            need = self.lengths[item]
            at = bisect_left(room, need)
            if at == len(room):
                bin_, left = len(self.fill), self.capacity
                self.members.append([])
                self.fill.append(0)
            else:
                left = room[at]
                bin_ = by_room[left].pop()
                if not by_room[left]:
                    del by_room[left]
                    room.pop(at)
            self.members[bin_].append(item)
            self.fill[bin_] += need
            left -= need
            if left:
                if left not in by_room:
                    by_room[left] = []
                    insort(room, left)
                by_room[left].append(bin_)

    def _put(self, light: int, heavy: int, gives: list[int], takes: list[int]) -> None:
        """``light`` gives pieces to ``heavy`` and takes others."""
        for item in gives:
            self.members[light].remove(item)
        for item in takes:
            self.members[heavy].remove(item)
        self.members[heavy] += gives
        self.members[light] += takes
        gain = sum(self.lengths[i] for i in gives) - sum(self.lengths[i] for i in takes)
        self.fill[light] -= gain
        self.fill[heavy] += gain

    def _best(self, light: int, items: np.ndarray, bins: np.ndarray) -> tuple[int, list[int], list[int]] | None:
        """Partner, pieces given and pieces taken of the step from ``light`` that raises squared fill most, if any does.

        ``items`` are the pieces of all open bins, ``bins`` those bins. One
        piece or two go to a partner for nothing or for one of its pieces.
        """
        size, fill = self.sizes, self.fills
        mine = self.members[light]
        singles = {self.lengths[i]: [i] for i in mine}
        ways = dict(singles)
        seen = {n: [i for i in mine if self.lengths[i] == n][:2] for n in singles}
        names = sorted(seen)
        for k, n in enumerate(names):
            for m in names[k:]:
                if n != m or len(seen[n]) > 1:
                    ways.setdefault(n + m, [seen[n][0], seen[m][0] if n != m else seen[n][1]])
        given = np.array(list(ways))
        # What is taken: a piece of an open bin, or (a bin by itself) nothing.
        owner = np.concatenate((self.home[items], bins))
        taken = np.concatenate((size[items], np.zeros(bins.size, np.int64)))
        other = owner != light
        owner, taken, items = owner[other], taken[other], np.concatenate((items, np.full(bins.size, -1)))[other]
        if not owner.size:
            return None
        full = fill[owner]
        ahead = full - fill[light]
        most, way = 0, None
        chunk = max(1, 1_000_000 // owner.size)
        for at in range(0, given.size, chunk):
            some = given[at : at + chunk, None]
            net = some - taken
            # Half of what the sum of squares rises by.
            rise = np.where((net > 0) & (net <= self.capacity - full), net * (net + ahead), 0)
            top = int(rise.argmax())
            if rise.flat[top] > most:
                most = int(rise.flat[top])
                k, entry = divmod(top, owner.size)
                way = (int(owner[entry]), list(ways[int(given[at + k])]), [int(items[entry])] if items[entry] >= 0 else [])
        return way

    def search(self) -> None:
        """Empty the lightest bins into others that are not full.

        Each round takes the open bins in order of fill; each makes its best step
        with any other open bin until it has none. Steps raise the sum of squared
        fills, and rounds end when a whole one changes nothing.
        """
        self.sizes, self.fills = np.array(self.lengths, np.int64), np.array(self.fill, np.int64)
        self.home = np.zeros(len(self.lengths), np.int64)
        for bin_, members in enumerate(self.members):
            self.home[members] = bin_
        changed = True
        while changed:
            changed = False
            open_ = np.flatnonzero((self.fills > 0) & (self.fills < self.capacity))
            for light in open_[np.argsort(self.fills[open_], kind="stable")].tolist():
                while 0 < self.fills[light] < self.capacity:
                    is_open = (self.fills > 0) & (self.fills < self.capacity)
                    way = self._best(light, np.flatnonzero(is_open[self.home]), np.flatnonzero(is_open))
                    if way is None:
                        break
                    heavy, gives, takes = way
                    self._put(light, heavy, gives, takes)
                    self.home[gives], self.home[takes] = heavy, light
                    self.fills[light], self.fills[heavy] = self.fill[light], self.fill[heavy]
                    changed = True

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of each piece; bins are numbered without gaps."""
        bin_of, offset = np.zeros(len(self.lengths), np.int64), np.zeros(len(self.lengths), np.int64)
        used = 0
        for members in self.members:
            at = 0
            for item in members:
                bin_of[item], offset[item] = used, at
                at += self.lengths[item]
            used += bool(members)
        return bin_of, offset


def pack(pieces_: DataFrame, groups: int, capacity: int) -> DataFrame:
    """Adds sequence_id and offset; each of ``groups`` groups of pieces is packed by itself."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("row", "ascending"), ("piece", "ascending")])
        bins = Bins(table.column("length").to_numpy(), capacity)
        bins.search()
        bin_of, offset = bins.places()
        sequence = (np.int64(key[0].as_py()) << 32) + bin_of
        return table.select(names).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    group = F.pmod(F.xxhash64("doc_id", "row", "piece"), F.lit(groups))
    return pieces_.withColumn("group", group).groupBy("group").applyInArrow(
        lambda key, table: run(key, table.drop_columns(["group"])), schema
    )


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Each row of ``docs`` gives its ids and one end id; a null or empty text gives
    the end id alone. Pieces of ``capacity`` tokens are sequences by themselves.
    Rows with a null or a repeated doc_id are packed like any other. Other
    columns are ignored; an empty table gives no row. ``group`` bounds the
    pieces in one packing task, on average.
    """
    cut = stored(pieces(docs, tokenizer, capacity), "pieces")
    return pack(cut, max(1, -(-cut.count() // group)), capacity)
