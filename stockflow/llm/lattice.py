"""Operator 9: encoding and decoding with sampled segmentations, by perturbed A-star search.

A text's lattice has every way to spell it with the vocabulary's pieces. A
segmentation's probability falls with the merge ranks of its pieces. Gumbel
top-k without replacement gives every segmentation its log probability plus
Gumbel noise and takes the k largest sums, without naming them all: the noise of
a set of segmentations is drawn for the set as a whole (the largest sum in it is
Gumbel with the set's log probability), and sets are split only when they come
to the head of the queue. The largest sum of a set is an upper bound for every
part, so the search is A-star with perturbed bounds and emits segmentations in
order of their sums, all distinct.

The lattice holds all pieces. A text is cut between two bytes that no piece has
beside each other, so it is a chain of unit lattices and a segmentation is one
choice for each unit. When a set is opened, its best member is drawn arc by arc
from the units that are still free; what is left splits by the first unit that
differs. What is left of a unit is added up along the excluded segmentations,
arc by arc, never subtracted, so a set is empty if, and only if, its sum is zero.

Texts go in blocks. Each different unit of a block has one lattice; arcs, sums
and draws of all units of a block are numpy arrays.

A segmentation's inclusion score is the probability that its sum exceeds the
(k+1)-th largest one.
"""

from __future__ import annotations

import heapq
import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stockflow.llm.textarrays import mix, span_hashes, stream

SPACE = "▁"
# Bytes of text that are worked on together, and bytes that are hashed at a time.
BLOCK, SLICE = 1 << 20, 1 << 18
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Model:
    """Pieces with their log scores, as a trie of bytes, and the pairs of bytes they join."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        self.byte_ids = np.zeros(256, np.int32)
        self.spelling: list[bytes] = []
        self.logs = np.zeros(processor.get_piece_size())
        children: dict[tuple[int, int], int] = {}
        ends = {}
        joined = np.zeros((256, 256), bool)
        self.longest, self.byte_log = 1, 0.0
        for i in range(self.logs.size):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.spelling.append(bytes([int(piece[3:5], 16)]))
                continue
            if processor.is_control(i) or processor.is_unknown(i):
                self.spelling.append(b"")
                continue
            spelled = piece.replace(SPACE, " ").encode()
            self.spelling.append(spelled)
            self.logs[i] = -math.log(2.0 - processor.get_score(i))
            self.byte_log = min(self.byte_log, self.logs[i])
            self.longest = max(self.longest, len(spelled))
            node = 0
            for one, two in zip(spelled, spelled[1:], strict=False):
                joined[one, two] = True
            for b in spelled:
                node = children.setdefault((node, b), len(children) + 1)
            ends[node] = i
        whole = (np.arange(256) & 0xC0) != 0x80
        self.cuts = (whole & ~joined).ravel()
        # Nodes that go on come first, so that the table of steps has a row for them alone, and one for all others.
        inner = sorted({node for node, _ in children} | {0})
        self.inner = len(inner)
        number = dict(zip([*inner, *sorted(set(children.values()) - set(inner))], range(len(children) + 1), strict=True))
        self.steps = np.full((self.inner + 1) * 256, -1, np.int32)
        for (node, b), to in children.items():
            self.steps[number[node] * 256 + b] = number[to]
        self.ends = np.full(len(children) + 1, -1, np.int32)
        for node, i in ends.items():
            self.ends[number[node]] = i

    def decode(self, ids: list[int]) -> str:
        """The text of a row of ids; the space that encoding puts in front is taken off."""
        return b"".join(map(self.spelling.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")

    def starts(self, raw: np.ndarray) -> np.ndarray:
        """Where units begin in texts, given one behind the other: nowhere inside a character or a piece."""
        cut = [np.zeros(min(1, raw.size), np.int64)]
        for i in range(0, raw.size - 1, SLICE):
            pair = raw[i : i + 1 + SLICE].astype(np.uint16)
            cut.append(np.flatnonzero(self.cuts[(pair[:-1] << np.uint16(8)) | pair[1:]]) + i + 1)
        return np.concatenate(cut)


class Lattices:
    """Lattices of different units, given one behind the other in ``raw``.

    Places are the beginnings of characters, numbered by their distance from the
    end of their unit, so that sums over what follows a place come from arcs of
    earlier numbers. The arcs of place q are ``first[q]`` to ``first[q + 1]``.
    """

    def __init__(self, model: Model, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        self.raw, self.byte_ids = raw, model.byte_ids
        unit_end = np.repeat(ends, ends - starts)
        begins = (raw & 0xC0) != 0x80
        # A unit always begins with a place, also in bytes that are no text.
        begins[starts] = True
        at = np.flatnonzero(begins)
        left = unit_end[at] - at
        order = np.argsort(left, kind="stable")
        at, self.left = at[order], left[order]
        n = at.size
        number = np.full(raw.size + 1, n, np.int64)
        number[at] = np.arange(n)
        self.left = self.left.astype(np.int32)
        self.begin = number[starts].astype(np.int32)
        # Arcs: place, bytes covered, piece (or byte position, below zero).
        froms, sizes, pieces = [], [], []
        alive, node = np.arange(n), np.zeros(n, np.int32)
        for depth in range(model.longest):
            inside = self.left[alive] > depth
            alive, node = alive[inside], node[inside]
            node = model.steps[np.minimum(node, model.inner) * 256 + raw[at[alive] + depth]]
            known = node >= 0
            alive, node = alive[known], node[known]
            if not alive.size:
                break
            piece = model.ends[node]
            is_piece = piece >= 0
            froms.append(alive[is_piece])
            sizes.append(np.full(froms[-1].size, depth + 1))
            pieces.append(piece[is_piece].astype(np.int64))
        # A character without a piece of its own is spelled in bytes, its place's first arc.
        lead = raw[at]
        width = np.minimum(np.where(lead < 0xC0, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4))), self.left)
        has_own = np.zeros(n, bool)
        for some, covered in zip(froms, sizes, strict=True):
            has_own[some[covered == width[some]]] = True
        plain = np.flatnonzero(~has_own)
        froms, sizes, pieces = [plain, *froms], [width[plain], *sizes], [-1 - at[plain], *pieces]
        counts = np.zeros(n, np.int64)
        for some in froms:
            counts[some] += 1
        self.first = np.concatenate(([0], np.cumsum(counts)))
        place = np.repeat(np.arange(n), counts)
        size, self.piece = np.empty(place.size, np.int64), np.empty(place.size, np.int64)
        free = self.first[:-1].copy()
        for some, covered, found in zip(froms, sizes, pieces, strict=True):
            slot = free[some]
            size[slot], self.piece[slot] = covered, found
            free[some] += 1
        self.size = size
        log = np.where(self.piece >= 0, model.logs[np.maximum(self.piece, 0)], model.byte_log * size)
        over = self.left[place] == size
        self.to = np.where(over, n, number[at[place] + size]).astype(np.int32)
        # Sums over all that follows a place, in logs; distances in turn.
        after = np.zeros(n + 1)
        distances = np.append(np.flatnonzero(np.diff(self.left, prepend=-1)), n)
        for low, high in zip(distances[:-1].tolist(), distances[1:].tolist(), strict=True):
            a, b = self.first[low], self.first[high]
            values = log[a:b] + after[self.to[a:b]]
            heads = self.first[low:high] - a
            top = np.maximum.reduceat(values, heads)
            after[low:high] = top + np.log(np.add.reduceat(np.exp(values - np.repeat(top, np.diff(self.first[low : high + 1]))), heads))
        self.log = log + after[self.to] - after[place]
        # A place with one arc has exactly share 1.
        self.log[self.first[:-1][counts == 1]] = 0.0
        share = np.exp(self.log)
        # The shares of a place's other arcs: added up for the arc that has most, the difference to 1 for the others.
        most = share >= 0.5
        small = np.add.reduceat(np.where(most, 0.0, share), self.first[:-1])
        self.others = np.where(most, small[place], 1.0 - share)
        running = np.cumsum(share)
        heads = self.first[:-1]
        self.until = running + np.repeat(np.arange(n) - (running[heads] - share[heads]), counts)
        self.last = (self.first[1:] - 1).astype(np.int32)
        self.longer = self.others[self.last]

    def draw(self, units: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> Drawn:
        """A segmentation of each unit; ``ends`` are the units' ends in their texts, which place the random numbers."""
        # Occurrences of a unit beside each other: their arcs are read together.
        order = np.argsort(units, kind="stable")
        ends, keys = ends[order], keys[order]
        q = self.begin[units[order]]
        arc = self._pick(q, keys, ends)
        log, left = self.log[arc], self.others[arc]
        counts = np.ones(units.size, np.int64)
        steps = [arc]
        everyone = [slice(None)]
        who = np.flatnonzero(self.to[arc] < self.left.size)
        q = self.to[arc[who]]
        while who.size:
            arc = self._pick(q, keys[who], ends[who])
            everyone.append(who)
            steps.append(arc)
            so_far = log[who]
            left[who] += np.exp(so_far) * self.others[arc]
            log[who] = so_far + self.log[arc]
            counts[who] += 1
            q = self.to[arc]
            on = q < self.left.size
            who, q = who[on], q[on]
        # Back in the order of the texts.
        placed = np.empty((2, order.size))
        placed[0, order], placed[1, order] = log, np.minimum(left, 1.0)
        many = np.empty(order.size, np.int64)
        many[order] = counts
        first = np.concatenate(([0], np.cumsum(many)))
        begin = first[order]
        arcs = np.empty(int(first[-1]), np.int64)
        for i, (some, arc) in enumerate(zip(everyone, steps, strict=True)):
            arcs[begin[some] + i] = arc
        with np.errstate(divide="ignore"):
            return Drawn(arcs, first, placed[0], np.log(placed[1]))

    def _pick(self, q: np.ndarray, keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """An arc of each place."""
        u = uniform(keys, ends - self.left[q])
        arc = self.last[q]
        # Most draws fall on the longest piece.
        search = np.flatnonzero(u < self.longer[q])
        arc[search] = np.minimum(np.searchsorted(self.until, q[search] + u[search], side="right"), arc[search])
        return arc

    def ids(self, arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids along arcs, bytes for characters without a piece, and where each arc's begin."""
        pieces = self.piece[arcs]
        counts = np.where(pieces < 0, self.size[arcs], 1)
        first = np.concatenate(([0], np.cumsum(counts)))
        out = np.repeat(pieces, counts)
        place = np.flatnonzero(out < 0)
        out[place] = self.byte_ids[self.raw[-1 - out[place] + place - np.repeat(first[:-1], counts)[place]]]
        return out, first

    def without(self, unit: int, excluded: list[tuple[int, ...]]) -> Remainder:
        """What is left of a unit without some segmentations: sums along their trie."""
        places, children = [int(self.begin[unit])], [{}]
        for path in excluded:
            node = 0
            for arc in path:
                to = int(self.to[arc])
                if to == self.left.size:
                    children[node][arc] = -1
                elif arc in children[node]:
                    node = children[node][arc]
                else:
                    children[node][arc] = len(places)
                    node = len(places)
                    places.append(to)
                    children.append({})
        sums = [0.0] * len(places)
        weights: list[list[float]] = [[]] * len(places)
        for node in range(len(places) - 1, -1, -1):
            low, high = int(self.first[places[node]]), int(self.first[places[node] + 1])
            logs = self.log[low:high].tolist()
            for arc, child in children[node].items():
                logs[arc - low] = -math.inf if child < 0 else logs[arc - low] + sums[child]
            weights[node] = logs
            top = max(logs)
            sums[node] = -math.inf if top == -math.inf else top + math.log(sum([math.exp(x - top) for x in logs]))
        return Remainder(places, children, weights, sums[0])

    def draw_without(self, unit: int, rest: Remainder, end: int, key: np.uint64) -> tuple[tuple[int, ...], float]:
        """A segmentation that is not excluded, and its log probability in the whole unit."""
        q, node, log, path = int(self.begin[unit]), 0, 0.0, []
        noise = uniform(key, np.arange(end - int(self.left[q]), end))
        begin = end - int(self.left[q])
        while q < self.left.size:
            low = int(self.first[q])
            weights = rest.weights[node] if node >= 0 else self.log[low : int(self.first[q + 1])].tolist()
            top = max(weights)
            shares = list(accumulate([math.exp(x - top) for x in weights]))
            u = float(noise[end - int(self.left[q]) - begin]) * shares[-1]
            i = bisect_right(shares, u)
            if i == len(shares):
                i = max(j for j, x in enumerate(weights) if x > -math.inf)
            arc = low + i
            path.append(arc)
            log += float(self.log[arc])
            node = rest.children[node].get(arc, -1) if node >= 0 else -1
            q = int(self.to[arc])
        return tuple(path), log


class Drawn(NamedTuple):
    """Segmentations of units: arcs, the first of each unit, log probabilities, logs of all other probability."""

    arcs: np.ndarray
    first: np.ndarray
    log: np.ndarray
    left: np.ndarray


class Remainder(NamedTuple):
    """A trie of excluded segmentations: places, children by arc, log weights of arcs, log of the whole."""

    places: list[int]
    children: list[dict[int, int]]
    weights: list[list[float]]
    log: float


class Sample(NamedTuple):
    """A segmentation of a text: arcs, the first of each unit, log probability of each unit."""

    arcs: np.ndarray
    first: np.ndarray
    log: np.ndarray


_models: dict[str, Model] = {}


def model_of(path: str) -> Model:
    """The model of this Python worker, which goes on from task to task."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def uniform(keys: np.ndarray | np.uint64, places: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) by key and place."""
    with np.errstate(over="ignore"):
        x = (mix(keys + (places.astype(np.uint64) + np.uint64(1)) * _STEP) >> np.uint64(12)).astype(np.float64)
    x += 0.5
    x *= 2.0**-52
    return x


def keys_of(seeds: np.ndarray, turn: int) -> np.ndarray:
    """The keys of rows' random numbers for their ``turn``-th draw."""
    return mix(mix(stream(31, 1) ^ seeds) ^ stream(32, turn + 1)[-1:])


def _below(log: np.ndarray, top: float, noise: np.ndarray) -> np.ndarray:
    """Gumbel values of sets with log probability ``log``, given that they are under ``top``."""
    return -np.logaddexp(np.log(-np.log(noise)) - log, -top)


def spaced(text: str | None) -> bytes:
    """The text's bytes with a space in front; marks of space are spaces."""
    return (" " + text.replace(SPACE, " ")).encode("utf-8", "surrogatepass") if text else b""


class Block:
    """The units of some texts: which lattice each has, and where it ends in its text."""

    def __init__(self, model: Model, texts: list[bytes]) -> None:
        raw = np.frombuffer(b"".join(texts), np.uint8)
        heads = np.cumsum([0, *map(len, texts)])
        first = np.zeros(raw.size, bool)
        first[model.starts(raw)] = True
        first[heads[:-1][np.diff(heads) > 0]] = True
        begin = np.flatnonzero(first)
        self.bounds = np.searchsorted(begin, heads).tolist()
        stops = np.append(begin[1:], raw.size)[: begin.size]
        self.ends = stops - np.repeat(heads[:-1], np.diff(self.bounds))
        # Hashes of some units at a time: a hash takes many times the bytes.
        hashes = [np.empty(0, np.uint64)]
        groups = np.flatnonzero(np.diff(begin // SLICE, prepend=-1)).tolist() + [begin.size]
        for low, high in zip(groups[:-1], groups[1:], strict=True):
            a, b = int(begin[low]), int(stops[high - 1])
            hashes.append(span_hashes(raw[a:b], begin[low:high] - a, stops[low:high] - a))
        _, one, self.units = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        begin, length = begin[one], (stops - begin)[one]
        stops = np.cumsum(length)
        if length.size:
            raw = raw[np.arange(int(stops[-1])) + np.repeat(begin - (stops - length), length)]
        self.lattices = Lattices(model, raw, stops - length, stops) if length.size else None


def sample_texts(model: Model, texts: list[bytes], seeds: list[int], k: int) -> list[list[tuple[np.ndarray, float, float]]]:
    """Per text at most ``k`` distinct segmentations: ids, log probability, inclusion; largest perturbed sum first."""
    block = Block(model, texts)
    lattices, units, ends = block.lattices, block.units, block.ends
    low, high = block.bounds[:-1], block.bounds[1:]
    samples: list[list[Sample]] = [[] for _ in texts]
    # A set: its value, a number, the sample it was split from, the unit at which it differs, what is excluded there.
    queues: list[list[tuple[float, int, int, int, list[tuple[int, ...]]]]] = [[] for _ in texts]
    opened = [(d, None) for d in range(len(texts)) if low[d] < high[d]]
    for turn in range(k):
        if turn:
            opened = [(d, heapq.heappop(queues[d])) for d in range(len(texts)) if queues[d]]
        if not opened:
            break
        # All units behind the one that differs, of all texts.
        fresh = [low[d] if of is None else low[d] + of[3] + 1 for d, of in opened]
        counts = [high[d] - f for (d, _), f in zip(opened, fresh, strict=True)]
        total = np.concatenate(([0], np.cumsum(counts)))
        where = np.concatenate([np.arange(f, f + n) for f, n in zip(fresh, counts, strict=True)])
        rows = np.array([seeds[d] & (2**64 - 1) for d, _ in opened], np.uint64)
        keys, noises = keys_of(rows, 2 * turn), keys_of(rows, 2 * turn + 1)
        drawn = lattices.draw(units[where], ends[where], np.repeat(keys, counts))
        noise = uniform(np.repeat(noises, counts), ends[where])
        own = uniform(noises, np.zeros(len(opened)))
        for m, (d, of) in enumerate(opened):
            a, b = int(total[m]), int(total[m + 1])
            arcs, first = drawn.arcs[drawn.first[a] : drawn.first[b]], drawn.first[a : b + 1] - drawn.first[a]
            log, left = drawn.log[a:b], drawn.left[a:b]
            sets: list[tuple[float, int, list[tuple[int, ...]] | None]] = []
            if of is None:
                start, base = 0, 0.0
                top = -math.log(-math.log(own[m]))
            else:
                value, _, parent, at, excluded = of
                top, old, unit = -value, samples[d][parent], int(units[low[d] + at])
                rest = lattices.without(unit, excluded)
                path, here = lattices.draw_without(unit, rest, int(ends[low[d] + at]), keys[m])
                before = float(old.log[:at].sum())
                start, base = at + 1, before + here
                excluded = [*excluded, path]
                remains = lattices.without(unit, excluded).log
                if remains > -math.inf:
                    sets.append((float(_below(before + remains, top, own[m])), at, excluded))
                head = old.arcs[: old.first[at]]
                first = np.concatenate((old.first[: at + 1], head.size + len(path) + first))
                arcs = np.concatenate((head, np.array(path, np.int64), arcs))
                log = np.concatenate((old.log[:at], [here], log))
            samples[d].append(Sample(arcs, first, log))
            # The rest of the set, by the first unit that differs; more than k + 1 sets are never opened.
            wanted = k - turn
            tail = log[start:]
            values = _below(base + np.cumsum(tail) - tail + left, top, noise[a:b])
            best = np.argpartition(-values, wanted - 1)[:wanted] if values.size > wanted else np.arange(values.size)
            sets += [(float(values[j]), start + int(j), None) for j in best if left[j] > -math.inf]
            for value, at, excluded in sets:
                if excluded is None:
                    excluded = [tuple(arcs[first[at] : first[at + 1]].tolist())]
                heapq.heappush(queues[d], (-value, turn * (k + 2) + len(queues[d]), turn, at, excluded))
    out = []
    flat = [sample.arcs for of_text in samples for sample in of_text]
    ids, begin = lattices.ids(np.concatenate(flat)) if flat else (np.empty(0, np.int64), np.zeros(1, np.int64))
    at = 0
    for found, queue in zip(samples, queues, strict=True):
        limit = -queue[0][0] if queue else -math.inf
        rows = []
        for sample in found:
            log = float(sample.log.sum())
            inclusion = -math.expm1(-math.exp(min(50.0, log - limit))) if queue else 1.0
            rows.append((ids[begin[at] : begin[at + sample.arcs.size]], log, inclusion))
            at += sample.arcs.size
        out.append(rows or [(np.empty(0, np.int64), 0.0, 1.0)][:k])
    return out


def top_k(model: Model, text: str | None, k: int, seed: int) -> list[tuple[list[int], float, float]]:
    """At most ``k`` distinct segmentations: ids, log probability, inclusion score; largest perturbed sum first."""
    return [(ids.tolist(), log, inclusion) for ids, log, inclusion in sample_texts(model, [spaced(text)], [seed], k)[0]]


def _blocks(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts of a batch, about ``BLOCK`` characters at a time, and the row of the first."""
    first, texts, size = 0, [], 0
    for i in range(len(column)):
        texts.append(column[i].as_py() or "")
        size += len(texts[-1])
        if size >= BLOCK:
            yield first, texts
            first, texts, size = i + 1, [], 0
    if texts:
        yield first, texts


def sampled(docs: DataFrame, model_path: str, k: int = 2, seed: int = 0) -> DataFrame:
    """Per row of ``docs`` and sample: doc_id, sample, n_pieces, ids_crc32, log_probability, inclusion, decoded.

    Samples of a text are distinct and come in order of their perturbed sums;
    there are fewer than ``k`` if the text has fewer segmentations, and one, of
    no piece, for a null or empty text. The random numbers of a row depend on
    ``seed`` and its doc_id (null: 0) alone, so repeated rows have the same
    samples. ``decoded`` says that the ids give the text back; marks of space in
    a text come back as spaces. Other columns are ignored; an empty table gives
    no row. A very long text is a block of its own, and a very long word a
    lattice of its own.
    """
    names = ["doc_id", "sample", "n_pieces", "ids_crc32", "log_probability", "inclusion", "decoded"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(model_path)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, texts in _blocks(batch.column(1)):
                some = doc_ids[first : first + len(texts)]
                rows = []
                found = sample_texts(model, [spaced(t) for t in texts], [seed ^ (i or 0) for i in some], k)
                for doc_id, text, samples in zip(some, texts, found, strict=True):
                    plain = text.replace(SPACE, " ")
                    for i, (ids, log, inclusion) in enumerate(samples):
                        crc = zlib.crc32(ids.astype("<u4").tobytes())
                        rows.append((doc_id, i, len(ids), crc, log, inclusion, model.decode(ids.tolist()) == plain))
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)

    schema = "doc_id long, sample int, n_pieces long, ids_crc32 long, log_probability double, inclusion double, decoded boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
