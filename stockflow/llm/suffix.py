"""Operator 2: removal of repeated passages by common-prefix intervals of a suffix array.

A byte goes if it lies in a ``length``-byte string that also starts earlier
(smaller doc_id, or same document and earlier start). Such a string lies in a
maximal repeat, so it is enough to find the maximal repeats with all their
occurrences and to remove every occurrence but the earliest.

Distribution. The content-chosen anchor of a ``length``-byte string is the
``GRAM``-byte piece in it with the smallest hash. Equal strings have equal
anchors, so it is enough to compare pieces of text around equal anchors, and
only around those that occur twice or more; the counts are combined before they
are shuffled. Each piece holds exactly the strings that its anchor was chosen by.

Work on one group of pieces. A suffix array over the starts in the group is
enhanced with common-prefix lengths and scanned with a stack, which yields the
tree of common-prefix intervals from the leaves up. A start takes part only if
the class of its first ``length`` bytes has different bytes (or a piece's
start) to the left, and an interval counts only if this holds for its own
occurrences: otherwise the same repeat is found one byte further left. In each
interval all occurrences meet, not only neighbours; the earliest goes on to the
interval above and the others are removed for the interval's length.

Groups of more than ``limit`` pieces (a passage in a third of all documents)
are not brought together at once. Their pieces are dealt to parts; each part
finds its own repeats by the same tree, gives its removals, and passes on only
the starts that it did not remove: of equal strings its earliest. What is left
of a group is divided by the next smallest piece of its strings, which equal
strings share, and meets in the next round, until no group is too large.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.storage import stored
from stockflow.llm.textarrays import as_bytes, mix, stream

LENGTH = 100
GRAM = 32
LIMIT = 20_000
# What a task holds beside one text: runs looked at together, and bytes of results before they are handed on.
RUNS_AT_ONCE = 4_096
HANDED_ON = 4 << 20
_U = np.uint64
_BYTE = stream(21, 256)
_STEP = stream(23, 16) | _U(1)
_BYTE_SMALL = stream(25, 256).astype(np.uint32)
_STEP_SMALL = (stream(26, 8) | _U(1)).astype(np.uint32)
_WORD = stream(27, GRAM // 8) | _U(1)


def rolling(raw: np.ndarray, width: int, table: np.ndarray = _BYTE, step: np.ndarray = _STEP) -> np.ndarray:
    """A hash of each ``width``-byte string, put together from powers of two."""
    n = raw.size - width + 1
    if n < 1:
        return np.empty(0, _U)
    with np.errstate(over="ignore"):
        part, size, level = table[raw], 1, 0
        total, taken = np.zeros(n, _U), 0
        while True:
            if width & size:
                total = total * step[level] + part[taken : taken + n]
                taken += size
            if 2 * size > width:
                return mix(total)
            part = part[:-size] * step[level] + part[size:]
            size, level = 2 * size, level + 1


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, put together from powers of two."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: values.size - rest], values[rest:]) if rest else values


def _small_grams(raw: np.ndarray) -> np.ndarray:
    """A 32-bit hash of each ``GRAM``-byte string, for choosing only."""
    with np.errstate(over="ignore"):
        part, size, level = _BYTE_SMALL[raw], 1, 0
        while size < GRAM:
            part = part[:-size] * _STEP_SMALL[level] + part[size:]
            size, level = 2 * size, level + 1
        part ^= part >> np.uint32(16)
        part *= np.uint32(0x85EBCA6B)
        part ^= part >> np.uint32(13)
        part *= np.uint32(0xC2B2AE35)
        part ^= part >> np.uint32(16)
        return part


def runs(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring starts of ``length``-byte strings with one anchor.

    Returns each run's first and last start, its anchor's hash, and how often the
    anchor occurs in the run. A run has as many starts as a string can hold
    anchors at most.
    """
    if raw.size < length:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, _U), none
    width = length - GRAM + 1
    grams = _small_grams(raw)
    least = sliding_min(grams, width)
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    last = np.append(first[1:], least.size) - 1
    if (last - first).max() >= width:
        # Equal anchors in a row, as in a run of one character.
        parts = (last - first) // width + 1
        nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        first, end = np.repeat(first, parts) + width * nth, np.repeat(last, parts)
        last = np.minimum(first + width - 1, end)
    hashes, often = np.empty(first.size, _U), np.empty(first.size, np.int64)
    for at in range(0, first.size, RUNS_AT_ONCE):
        some = slice(at, at + RUNS_AT_ONCE)
        place = first[some, None] + np.arange(2 * width - 1)
        equal = grams[np.minimum(place, grams.size - 1)] == least[first[some]][:, None]
        anchor = first[some] + equal.argmax(axis=1)
        often[some] = (equal & (place < (last[some] + width)[:, None])).sum(axis=1)
        words = raw[anchor[:, None] + np.arange(GRAM)].view("<u8")
        with np.errstate(over="ignore"):
            hashes[some] = mix((words * _WORD).sum(axis=1, dtype=_U))
    return first, last, hashes, often


def intervals(lcp: np.ndarray, floor: int) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (depth, first, last) with depth >= floor, inner before outer.

    ``lcp[i]`` is the common prefix of entries i - 1 and i of the suffix array.
    """
    stack: list[tuple[int, int]] = []
    values = lcp.tolist()
    for i in range(1, len(values) + 1):
        depth = values[i] if i < len(values) else -1
        first = i - 1
        while stack and stack[-1][0] > depth:
            found, first = stack.pop()
            yield found, first, i - 1
        if depth >= floor and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def suffix_array(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings text[start:end] and the common prefix of neighbours; none exceeds ``depth`` bytes.

    Eight bytes at a time: strings that are equal so far are one class, and only
    classes of two or more are looked at further, so memory follows the number
    of strings and not their bytes.
    """
    n = starts.size
    sizes = ends - starts
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    order, head = np.arange(n), np.zeros(n, np.int64)
    lcp = np.zeros(n, np.int64)
    # Entries at[i] of the order are still equal to others of their class, which begins at head.
    at = order.copy()
    done = 0
    masks = np.array([(1 << 64) - (1 << (64 - 8 * k)) if k else 0 for k in range(9)], _U)
    while at.size and done < depth + 8:
        which = order[at]
        left = np.clip(sizes[which] - done, 0, 8)
        place = np.minimum(starts[which] + done, text.size)
        key = np.zeros(at.size, _U)
        for k in range(8):
            key = (key << _U(8)) | padded[place + k]
        key &= masks[left]
        # Of equal bytes the shorter string is first.
        move = np.lexsort((left, key, head[at]))
        order[at], key, left, group = which[move], key[move], left[move], head[at]
        same = np.append(False, group[1:] == group[:-1])
        differ = np.append(_U(0), key[1:] ^ key[:-1])
        common = np.minimum(_leading_equal(differ), np.minimum(left, np.append(0, left[:-1])))
        split = same & ((common < 8) | (left < 8) | (np.append(0, left[:-1]) < 8))
        lcp[at[split]] = done + common[split]
        first = ~same | split
        head[at] = at[np.maximum.accumulate(np.where(first, np.arange(at.size), 0))]
        alone = first & np.append(first[1:], True)
        at = at[~alone]
        done += 8
    return order, lcp


def _leading_equal(differ: np.ndarray) -> np.ndarray:
    """How many bytes from the highest on are zero, in each of the 64-bit numbers."""
    out = np.zeros(differ.size, np.int64)
    alive = np.ones(differ.size, bool)
    for k in range(8):
        alive &= (differ >> _U(56 - 8 * k)) & _U(255) == 0
        out += alive
    return out


def repeats(
    pieces: list[bytes], docs: np.ndarray, places: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, Iterator[tuple[int, int, int]]]:
    """Starts in pieces that take part, in suffix-array order, and the maximal repeats among them.

    Returns the documents and places of the starts and, inner before outer, each
    repeat's length with its first and last entry; all entries between are its
    occurrences.
    """
    text = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    begins = np.cumsum(sizes) - sizes
    counts = np.maximum(sizes - length + 1, 0)
    piece = np.repeat(np.arange(sizes.size), counts)
    inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = begins[piece] + inside
    _, which, count = np.unique(rolling(text, length)[starts], return_inverse=True, return_counts=True)
    left = np.where(inside > 0, text[starts - 1].astype(np.int64), -1)
    least, most = np.full(count.size, 256), np.full(count.size, -1)
    np.minimum.at(least, which, left)
    np.maximum.at(most, which, left)
    takes = ((count > 1) & ((least < 0) | (least < most)))[which]
    starts, piece, left, which = starts[takes], piece[takes], left[takes], which[takes]
    if not starts.size:
        return docs[:0], places[:0], iter(())
    order, lcp = suffix_array(text, starts, (begins + sizes)[piece], int(sizes.max()))
    left = left[order]
    change = np.cumsum(np.append(False, (left[1:] != left[:-1]) | (left[1:] < 0) | (left[:-1] < 0)))
    where = (places[piece] + starts - begins[piece])[order]
    found = (x for x in intervals(lcp, length) if change[x[2]] > change[x[1]])
    return docs[piece][order], where, found


def removals(pieces: list[bytes], docs: np.ndarray, places: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """(document, start, end) to remove: of each repeat all occurrences but the earliest."""
    doc, start, found = repeats(pieces, docs, places, length)
    doc, start = doc.tolist(), start.tolist()
    earliest, last = list(range(len(doc))), list(range(len(doc)))
    for depth, first, end in found:
        best, i = earliest[first], last[first] + 1
        while i <= end:
            other = earliest[i]
            order = (doc[other], start[other]), (doc[best], start[best])
            if order[0] < order[1]:
                best, other = other, best
            if order[0] != order[1]:
                yield doc[other], start[other], start[other] + depth
            i = last[i] + 1
        earliest[first], last[first] = best, end


def _merged(spans: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal runs of the union of [start, end) rows, inside a text of ``size`` bytes."""
    mark = np.zeros(size + 1, np.int64)
    np.add.at(mark, np.minimum(spans[:, 0], size), 1)
    np.add.at(mark, np.minimum(spans[:, 1], size), -1)
    inside = np.concatenate(([0], (np.cumsum(mark[:-1]) > 0).astype(np.int8), [0]))
    change = np.diff(inside)
    return list(zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist(), strict=True))


def _anchors_of(docs: DataFrame, length: int) -> DataFrame:
    names = ["anchor", "doc_id", "start", "often"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for doc_id, text in zip(*batch.columns, strict=True):
                first, _, hashes, often = runs(as_bytes(text.as_py()), length)
                ids = np.full(first.size, doc_id.as_py(), np.int64)
                parts.append((hashes.view(np.int64), ids, first.astype(np.int32), often.astype(np.int32)))
                held += 24 * first.size
                if held > HANDED_ON:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names)
                    parts, held = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names)

    return docs.select("doc_id", "text").mapInArrow(run, "anchor long, doc_id long, start int, often int")


def _pieces_of(texts: DataFrame, length: int) -> DataFrame:
    """Rows (doc_id, text, starts of runs) to one row a run: the piece of text that its strings make up."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def rows(anchors: list, ids: list, starts: list, pieces: list) -> pa.RecordBatch:
        columns = [np.concatenate(anchors), np.concatenate(ids), np.concatenate(starts), pieces]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["anchor", "doc_id", "start", "piece"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, ids, starts, pieces, held = [], [], [], [], 0
        for batch in batches:
            for doc_id, text, wanted in zip(*batch.columns, strict=True):
                raw = as_bytes(text.as_py())
                first, last, hashes, _ = runs(raw, length)
                mine = np.flatnonzero(np.isin(first, wanted.values.to_numpy(zero_copy_only=False)))
                whole = raw.tobytes()
                for at in range(0, mine.size, RUNS_AT_ONCE):
                    some = mine[at : at + RUNS_AT_ONCE]
                    anchors.append(hashes[some].view(np.int64))
                    ids.append(np.full(some.size, doc_id.as_py(), np.int64))
                    starts.append(first[some].astype(np.int64))
                    pieces += [whole[a : b + length] for a, b in zip(first[some].tolist(), last[some].tolist(), strict=True)]
                    held += int((last[some] - first[some]).sum()) + (length + 64) * some.size
                    if held > HANDED_ON:
                        yield rows(anchors, ids, starts, pieces)
                        anchors, ids, starts, pieces, held = [], [], [], [], 0
        if anchors:
            yield rows(anchors, ids, starts, pieces)

    return texts.select("doc_id", "text", "starts").mapInArrow(run, "anchor long, doc_id long, start long, piece binary")


_SPANS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _joined(spans: Iterable[tuple[int, int, int]]) -> list[list[int]]:
    """(document, start, end) put together where they meet."""
    out: list[list[int]] = []
    for doc, start, end in sorted(spans):
        if out and out[-1][0] == doc and start <= out[-1][2]:
            out[-1][2] = max(out[-1][2], end)
        else:
            out.append([doc, start, end])
    return out


def _grouped_removals(pieces: DataFrame, length: int, batch_rows: int = 4_000) -> DataFrame:
    """Removals from pieces that are partitioned and sorted by anchor; whole groups at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def settle(rows: pa.Table) -> pa.RecordBatch:
            found = removals(rows.column(3).to_pylist(), rows.column(1).to_numpy(), rows.column(2).to_numpy(), length)
            spans = np.array(_joined(found), np.int64).reshape(-1, 3)
            return pa.RecordBatch.from_arrays([pa.array(spans[:, i]) for i in range(3)], schema=_SPANS)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < batch_rows:
                continue
            rows = pa.Table.from_batches(held)
            anchors = rows.column(0).to_numpy()
            # The last group may go on in the next batch.
            whole = int(np.flatnonzero(anchors == anchors[-1])[0])
            if whole:
                yield settle(rows.slice(0, whole))
            held = rows.slice(whole).to_batches()
        if held:
            yield settle(pa.Table.from_batches(held))

    return pieces.mapInArrow(run, "doc_id long, start long, end long")


_LEFT = "key long, doc_id long, start long, end long, piece binary"


def left_starts(pieces: list[bytes], docs: np.ndarray, places: np.ndarray, spans: list[tuple[int, int, int]], length: int) -> list[np.ndarray]:
    """For each piece the starts, counted in it, of ``length``-byte strings that no span holds."""
    sizes = np.array([len(p) - length + 1 for p in pieces])
    order = np.lexsort((places, docs))
    keys = list(zip(docs[order].tolist(), places[order].tolist(), strict=True))
    offsets = np.cumsum(sizes) - sizes
    mark = np.zeros(int(sizes.sum()) + 1, np.int64)
    for doc, start, end in spans:
        piece = order[bisect_right(keys, (doc, start)) - 1]
        at = offsets[piece] - places[piece]
        mark[at + start] += 1
        mark[at + end - length + 1] -= 1
    free = np.cumsum(mark[:-1]) == 0
    return [np.flatnonzero(free[o : o + n]) for o, n in zip(offsets.tolist(), sizes.tolist(), strict=True)]


def nth_grams(piece: bytes, starts: np.ndarray, length: int, nth: int) -> np.ndarray:
    """Hash of the ``nth`` smallest different gram of each string, the largest if it has fewer."""
    grams = _small_grams(np.frombuffer(piece, np.uint8))
    held = np.sort(np.lib.stride_tricks.sliding_window_view(grams, length - GRAM + 1)[starts], axis=1)
    rank = np.cumsum(np.append(np.zeros((len(held), 1), bool), held[:, 1:] != held[:, :-1], axis=1), axis=1)
    return held[np.arange(len(held)), np.minimum((rank < nth - 1).sum(axis=1), held.shape[1] - 1)]


def _reduced(pieces: DataFrame, length: int, level: int, at_once: int) -> DataFrame:
    """Removals among each ``at_once`` neighbouring pieces (null piece), and what is left of the pieces under new keys."""
    names = ["key", "doc_id", "start", "end", "piece"]

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        texts = rows.column("piece").to_pylist()
        docs, places, keys = (rows.column(n).to_numpy() for n in ("doc_id", "start", "key"))
        spans = list(removals(texts, docs, places, length))
        out = [(None, doc, start, end, None) for doc, start, end in _joined(spans)]
        for i, starts in enumerate(left_starts(texts, docs, places, spans, length)):
            if not starts.size:
                continue
            found = nth_grams(texts[i], starts, length, level)
            first = np.flatnonzero(np.append(True, (np.diff(starts) != 1) | (found[1:] != found[:-1])))
            last = np.append(first[1:], starts.size) - 1
            with np.errstate(over="ignore"):
                key = mix(mix(found[first].astype(_U)) ^ keys[i : i + 1].view(_U)).view(np.int64).tolist()
            for k, a, b in zip(key, starts[first].tolist(), starts[last].tolist(), strict=True):
                out.append((k, int(docs[i]), int(places[i]) + a, 0, texts[i][a : b + length]))
        for at in range(0, len(out), 20_000):
            columns = zip(*out[at : at + 20_000], strict=True)
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, at_once):
                held.append(batch.slice(at, at_once))
                rows += held[-1].num_rows
                if rows >= at_once:
                    yield from settle(pa.Table.from_batches(held))
                    held, rows = [], 0
        if rows:
            yield from settle(pa.Table.from_batches(held))

    return pieces.mapInArrow(run, _LEFT)


def _crowded_removals(pieces: DataFrame, length: int, limit: int) -> DataFrame:
    """Removals from groups that are too large to meet at once, in rounds."""
    now = pieces.select(F.col("anchor").alias("key"), "doc_id", "start", "piece")
    parts, level = [], 1
    while True:
        # Parts of a group: any will do, and those of equal places in their documents are most alike.
        deal = F.pmod(F.xxhash64("doc_id"), F.lit(64))
        dealt = now.withColumn("deal", deal).repartition("key", "deal").sortWithinPartitions("key", "deal").drop("deal")
        level += 1
        round_ = stored(_reduced(dealt, length, level, max(2, limit // 4)), "reduced")
        parts.append(round_.filter("piece is null").select("doc_id", "start", "end"))
        left = round_.filter("piece is not null")
        # A key that no other piece has is done.
        counts = stored(left.groupBy("key").count().filter("count > 1"), "left")
        large = counts.filter(F.col("count") > limit).select("key")
        small = counts.filter(F.col("count") <= limit).select("key")
        meet = left.join(small.hint("shuffle_hash"), "key", "left_semi").select(F.col("key").alias("anchor"), "doc_id", "start", "piece")
        parts.append(_grouped_removals(meet.repartition("anchor").sortWithinPartitions("anchor"), length))
        n_large = large.count()
        if not n_large:
            return reduce(DataFrame.union, parts)
        # So many keys of over ``limit`` pieces each; beyond that the join is a shuffle.
        large = F.broadcast(large) if n_large <= 100_000 else large
        now = left.join(large, "key", "left_semi").select("key", "doc_id", "start", "piece")


def repeated_spans(docs: DataFrame, length: int = LENGTH, limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    """``docs`` with an id and a text, keyed by doc_id, and ``doc_id, spans`` to remove from them.

    A copy of a whole text of ``length`` bytes or more is removed as a whole and
    takes no further part; spans then hold that text's full length.
    """
    texts = docs.filter("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    named = texts.filter(F.octet_length("text") >= length).select(
        "doc_id", F.octet_length("text").cast("long").alias("size"), F.unhex(F.sha2("text", 256)).alias("name")
    )
    first = named.groupBy("name").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    copies = stored(
        named.join(first.hint("merge"), "name").filter("doc_id != first").groupBy("doc_id").agg(F.max("size").alias("size")), "copies"
    )
    anchors = _anchors_of(texts, length)
    shared = stored(anchors.groupBy("anchor").agg(F.sum("often").alias("count")).filter("count > 1"), "anchors")

    def pieces(counted: DataFrame) -> DataFrame:
        places = anchors.select("anchor", "doc_id", "start").join(counted.select("anchor").hint("shuffle_hash"), "anchor", "left_semi")
        by_doc = places.groupBy("doc_id").agg(F.collect_list("start").alias("starts"))
        wanted = by_doc.join(copies.select("doc_id").hint("merge"), "doc_id", "left_anti")
        return _pieces_of(texts.join(wanted.hint("merge"), "doc_id"), length)

    small = pieces(shared.filter(F.col("count") <= limit)).repartition("anchor").sortWithinPartitions("anchor")
    spans = _grouped_removals(small, length)
    large = shared.filter(F.col("count") > limit)
    if not large.isEmpty():
        spans = spans.union(_crowded_removals(pieces(large), length, limit))
    spans = spans.union(copies.select("doc_id", F.lit(0).cast("long"), "size"))
    spans = spans.select("doc_id", F.col("start").cast("int"), F.col("end").cast("int"))
    return texts, spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def dedup_report(docs: DataFrame, length: int = LENGTH, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text is empty. A row without doc_id has no place in the order: nothing
    is removed from it or because of it. Rows that repeat a doc_id are versions
    of one document: each is returned, with the spans of all versions cut to its
    own length; equal places of versions do not remove each other. Other columns
    are ignored; an empty table gives no row.
    """
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            rows = []
            for _, text, spans in zip(*batch.columns, strict=True):
                raw = as_bytes(text.as_py())
                runs, kept = cut(raw, spans.as_py())
                rows.append((raw.size, raw.size - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return with_spans(docs, length, limit).select("doc_id", "text", "spans").mapInArrow(run, schema)


def with_spans(docs: DataFrame, length: int, limit: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, spans to remove (or null) and the columns ``carry`` of every row."""
    _, spans = repeated_spans(docs, length, limit)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *carry)
    none = F.lit(None).cast("array<struct<start:int,end:int>>")
    placed = rows.filter("doc_id is not null").join(spans.hint("merge"), "doc_id", "left")
    without = rows.filter("doc_id is null").withColumn("spans", none)
    return placed.select("doc_id", "text", "spans", *carry).union(without.select("doc_id", "text", "spans", *carry))


def cut(raw: np.ndarray, spans: list[dict] | None) -> tuple[list[tuple[int, int]], bytes]:
    """Removed runs and the remaining bytes."""
    if not spans:
        return [], raw.tobytes()
    runs = _merged(np.array([(s["start"], s["end"]) for s in spans], np.int64), raw.size)
    keep = np.ones(raw.size, bool)
    for start, end in runs:
        keep[start:end] = False
    return runs, raw[keep].tobytes()


def dedup_texts(
    docs: DataFrame, length: int = LENGTH, limit: int = LIMIT, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Per row of ``docs``: doc_id, text without repeated passages, and the columns ``carry``.

    Spans shrink to whole code points, so that the rest is a text again.
    """
    given = with_spans(docs, length, limit, carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            rest = []
            for _, text, spans in zip(*batch.columns[:3], strict=True):
                raw = as_bytes(text.as_py())
                runs, kept = cut(raw, spans.as_py())
                if runs:
                    parts, at = [], 0
                    for start, end in runs:
                        while start < end and raw[start] & 0xC0 == 0x80:
                            start += 1
                        while start < end < raw.size and raw[end] & 0xC0 == 0x80:
                            end -= 1
                        parts.append(raw[at:start].tobytes())
                        at = end
                    kept = b"".join([*parts, raw[at:].tobytes()])
                rest.append(kept.decode("utf-8"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rest, pa.string()), *batch.columns[3:]], ["doc_id", "text", *carry])

    columns = [f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields[3:]]
    return given.mapInArrow(run, ", ".join(["doc_id long, text string", *columns]))
