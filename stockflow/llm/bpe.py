"""Operator 12: byte-pair encoding and decoding.

A word starts as a doubly linked list of its letters. Every pair of neighbours
that the vocabulary merges waits in a priority queue, lowest rank first and the
leftmost of equals; a merge takes its right symbol out of the list and queues
the two new pairs. Entries whose symbols have changed since are stale and are
skipped when they come up. Decoding joins the vocabulary's strings.

The tokenizer's file says what happens before and after: normalisation, the
rule that splits a text, the mark of a word's end and the added tokens.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS_KEPT = 500_000
WINDOW = 1 << 20
BATCH_BYTES = 8 << 20
CODED = "doc_id long, ids array<int>, decoded string"

# White space at which no token, no normalisation and no word goes on.
_CUT = re.compile("[ \n\r\t]")
_TO_SPACE = str.maketrans("\n\r\t", "   ")
# Marks that a later Unicode version orders differently among others.
_REORDERED = {"\u1df6", "\U0001e4ec", "\U0001e4ed"}


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is printable, else the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def windows(text: str, size: int = WINDOW) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, cut before white space of ASCII."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Merger:
    """Merges the symbols of one word by rank."""

    def __init__(self, vocab: dict[str, int], merges: list[list[str]], end: str) -> None:
        self.vocab, self.end = vocab, end
        self.rank = {
            (vocab[left], vocab[right]): (rank, vocab[left + right]) for rank, (left, right) in enumerate(merges)
        }

    def ids(self, letters: str) -> list[int]:
        """Ids of a word that is not empty."""
        symbols = [self.vocab[c] for c in letters[:-1]]
        symbols.append(self.vocab[letters[-1] + self.end])
        n = len(symbols)
        rank = self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            found = rank.get((symbols[i], symbols[i + 1]))
            if found:
                queue.append((found[0], i, found[1]))
        heapq.heapify(queue)
        while queue:
            order, i, merged = heapq.heappop(queue)
            j = after[i]
            # Stale: the left symbol is gone or at the end, or the pair is another one by now.
            if symbols[i] < 0 or j == n or rank.get((symbols[i], symbols[j])) != (order, merged):
                continue
            symbols[i], symbols[j] = merged, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = rank.get((merged, symbols[k]))
                if found:
                    heapq.heappush(queue, (found[0], i, found[1]))
            h = before[i]
            if h >= 0:
                found = rank.get((symbols[h], merged))
                if found:
                    heapq.heappush(queue, (found[0], h, found[1]))
        return [s for s in symbols if s >= 0]


class Coder:
    """Encodes and decodes texts by a tokenizer's file.

    White space of ASCII ends words and normalisation alike, so a text's ids are
    those of its space-separated parts in order. The ids of up to ``WORDS_KEPT``
    recent parts are remembered.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        model = rules["model"]
        steps = [s["type"] for s in rules["normalizer"]["normalizers"]]
        splits = rules["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in splits] != ["Split", "ByteLevel"]:
            raise ValueError(f"{path}: this coder normalises by NFC and lower case and splits by one rule into bytes")
        added = {t["content"]: t["id"] for t in rules["added_tokens"]}
        self.rule = regex.compile(splits[0]["pattern"]["Regex"])
        self.letters = byte_letters()
        self.merger = Merger(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        self.strings = [""] * (1 + max([*model["vocab"].values(), *added.values()]))
        for string, id_ in (model["vocab"] | added).items():
            self.strings[id_] = string
        longest_first = sorted(added, key=len, reverse=True)
        self.added, self.added_rule = added, re.compile(f"({'|'.join(map(re.escape, longest_first))})") if added else None
        self.path, self.tables = path, None
        self.parts: dict[str, bytes] = {"": b""}
        self.words: dict[str, list[int]] = {}

    def _word(self, word: str) -> list[int]:
        ids = self.words.get(word)
        if ids is None:
            ids = self.merger.ids("".join([self.letters[b] for b in word.encode("utf-8", "replace")]))
            if len(word) < 64:
                if len(self.words) >= WORDS_KEPT:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def _plain(self, part: str) -> list[int]:
        if not part.isascii() and any(c in _REORDERED or unicodedata.category(c) == "Cn" for c in set(part)):
            words = self._newer(part)
        else:
            # One letter at a time: a sigma is lowered alike wherever it stands.
            words = self.rule.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return [id_ for word in words for id_ in self._word(word)]

    def _newer(self, part: str) -> list[str]:
        """Words of a part with characters that only the tokenizer's own Unicode tables know."""
        from tokenizers import Regex, Tokenizer
        from tokenizers.pre_tokenizers import Split

        if self.tables is None:
            split = Split(Regex(self.rule.pattern), "removed", invert=True)
            self.tables = (Tokenizer.from_file(self.path).normalizer, split)
        normalizer, split = self.tables
        return [word for word, _ in split.pre_tokenize_str(normalizer.normalize_str(part))]

    def _part(self, part: str) -> bytes:
        if self.added_rule is None or "<" not in part:
            ids = self._plain(part)
        else:
            # Every other piece is an added token.
            ids = []
            for k, piece in enumerate(self.added_rule.split(part)):
                ids += [self.added[piece]] if k % 2 else self._plain(piece)
        packed = np.array(ids, "<i4").tobytes()
        if len(part) < 64:
            if len(self.parts) >= WORDS_KEPT:
                self.parts.clear()
                self.parts[""] = b""
            self.parts[part] = packed
        return packed

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; none of a null or empty one."""
        known = self.parts.get
        out = []
        for window in windows(text or ""):
            for part in window.translate(_TO_SPACE).split(" ") if not window.isascii() else _ascii_parts(window):
                packed = known(part)
                out.append(self._part(part) if packed is None else packed)
        return np.frombuffer(b"".join(out), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """The strings of the ids, one space between two: this vocabulary's file names no other joint."""
        return " ".join(map(self.strings.__getitem__, ids.tolist()))


def _ascii_parts(window: str) -> list[str]:
    return window.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ")


_coders: dict[str, Coder] = {}


def coder_of(path: str) -> Coder:
    """The coder of this Python worker, which goes on from task to task."""
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def coded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids, decoded`` for each row: its text's ids and the text they decode to.

    A null or empty text has no ids and decodes to the empty string; texts are
    taken whole, in windows cut at white space, so memory beyond the row itself
    follows the window and the longest word (about 300 bytes a letter). Rows are
    coded one by one: repeated rows and null ids come out as they came in.
    Columns other than doc_id and text are ignored; an empty table gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(tokenizer)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            ids, decoded, first, held = [], [], 0, 0
            for i in range(batch.num_rows):
                found = coder.encode(texts[i].as_py())
                ids.append(found)
                decoded.append(coder.decode(found))
                held += found.nbytes + len(decoded[-1])
                if held > BATCH_BYTES or i + 1 == batch.num_rows:
                    yield _rows(doc_ids.slice(first, len(ids)), ids, decoded)
                    ids, decoded, first, held = [], [], i + 1, 0

    return docs.select("doc_id", "text").mapInArrow(run, CODED)


def _rows(doc_ids: pa.Array, ids: list[np.ndarray], decoded: list[str]) -> pa.RecordBatch:
    ends = np.cumsum([0, *(x.size for x in ids)], dtype=np.int64)
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
    return pa.RecordBatch.from_arrays([doc_ids, lists, pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])


def code_report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of ``coded``."""
    return coded(docs, tokenizer).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
