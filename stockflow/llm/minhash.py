"""Operator 4: near-duplicate documents by one-permutation MinHash.

Each document's shingle set is hashed once; the hash range is cut into bins and
the smallest hash of each bin is kept (one permutation). An empty bin borrows
from the first filled bin in its own fixed random order of all bins (optimal
densification), so that signatures agree bin by bin with probability equal to
the Jaccard similarity also for short texts. Bands of the signature are the
buckets. In a bucket only edges from one member, the hub, to the others are
made (a star), so a bucket of n members gives n - 1 pairs.

A star can miss a link between two of its leaves. Where the members of a bucket
are not all in one component after the first stars, every member outside the
bucket's largest component is a hub once more and is compared with the members
of other components. These stars are not made as rows: blocks of hubs meet
blocks of members in a task, which returns only the pairs that are similar
enough. All pairs that share a bucket are so either in one component or
compared.

Candidates are confirmed on full shingle sets. With 48 bands of 6 bins a pair
of similarity 0.8 shares no bucket with probability 5e-7.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.components import connected
from stockflow.llm.storage import stored
from stockflow.llm.textarrays import mix, shingles, stream

BANDS = 48
ROWS = 6
BLOCK = 500
# Share of bins that must agree for a pair to be confirmed on full sets.
LIKELY = 0.62
_U = np.uint64


def probe_order(bins: int) -> np.ndarray:
    """For each bin, the rank of every bin in its own random order."""
    return stream(7, bins * bins).reshape(bins, bins).argsort(axis=1).argsort(axis=1).astype(np.uint16)


def signature(hashes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Smallest hash of each bin, empty bins filled from others; ``hashes`` sorted, not empty."""
    bins = len(order)
    where = ((hashes >> _U(32)) * _U(bins) >> _U(32)).astype(np.intp)
    first = np.flatnonzero(np.diff(where, prepend=-1))
    filled = where[first]
    source = np.full(bins, -1)
    source[filled] = first
    empty = np.flatnonzero(source < 0)
    if empty.size:
        source[empty] = first[order[np.ix_(empty, filled)].argmin(axis=1)]
    return hashes[source]


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    by_band = values.reshape(-1, rows)
    with np.errstate(over="ignore"):
        total = (by_band * (stream(8, rows) | _U(1))).sum(axis=1, dtype=_U)
        return mix(total + stream(9, len(by_band)))


def sketches(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """Per row: doc_id, set size, a 128-bit name of the set, its band keys, a byte of each bin."""
    schema = "doc_id long, n_shingles long, set_id binary, bands array<long>, bins binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = probe_order(bands * rows)
        for batch in batches:
            sizes, names, keys, bins = [], [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), width)
                sizes.append(found.size)
                names.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if found.size else None)
                values = signature(found, order) if found.size else None
                keys.append(band_keys(values, rows).view(np.int64) if found.size else None)
                bins.append(mix(values).astype(np.uint8).tobytes() if found.size else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(names, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(bins, pa.binary()),
                ],
                ["doc_id", "n_shingles", "set_id", "bands", "bins"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def full_sets(docs: DataFrame, width: int, kind: type = np.uint64) -> DataFrame:
    """doc_id and its sorted shingle hashes as bytes, or the low part of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text.as_py(), width).astype(kind).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["doc_id", "members"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, members binary")


def _compared(pairs: DataFrame, table: DataFrame, value: str, alike: Callable[[bytes, bytes], bool]) -> DataFrame:
    """Pairs (a, b) whose values in ``table`` (doc_id and ``value``) are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [alike(x.as_py(), y.as_py()) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = table.select(F.col("doc_id").alias("a"), F.col(value).alias("left_value"))
    right = table.select(F.col("doc_id").alias("b"), F.col(value).alias("right_value"))
    joined = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    return joined.select("a", "b", "left_value", "right_value").mapInArrow(run, "a long, b long")


def likely(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """Pairs of which enough bins agree."""
    least = LIKELY

    def alike(x: bytes, y: bytes) -> bool:
        return bool(np.mean(np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)) >= least)

    return _compared(pairs, table, "bins", alike)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""

    def alike(x: bytes, y: bytes) -> bool:
        one, two = np.frombuffer(x, _U), np.frombuffer(y, _U)
        both = np.intersect1d(one, two, assume_unique=True).size
        return 100 * both >= percent * (one.size + two.size - both)

    return _compared(pairs, sets, "members", alike)


def shared_buckets(heads: DataFrame) -> DataFrame:
    """Rows (band, node) of buckets with two members or more, with the bucket's smallest member."""
    hubs = heads.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("size"))
    return heads.join(hubs.filter("size > 1").drop("size").hint("merge"), "band")


def first_stars(buckets: DataFrame) -> DataFrame:
    """Edges from the smallest member of each bucket to the others."""
    return buckets.filter("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()


def open_buckets(buckets: DataFrame, components: DataFrame) -> DataFrame:
    """Members of buckets that lie in several components; a hub is outside the largest of them."""
    placed = buckets.join(components.hint("merge"), "node", "left").select(
        "band", "node", F.coalesce("component", "node").alias("component")
    )
    parts = placed.groupBy("band", "component").count()
    main = (
        parts.groupBy("band")
        .agg(F.max(F.struct("count", "component")).alias("main"), F.count("*").alias("parts"), F.sum("count").alias("size"))
        .filter("parts > 1")
        .select("band", "size", F.col("main.component").alias("main"), (F.col("size") - F.col("main.count")).alias("hubs"))
    )
    by_role = Window.partitionBy("band").orderBy(F.col("component") == F.col("main"), "node")
    return placed.join(main.hint("merge"), "band").withColumn("place", F.row_number().over(by_role) - 1)


def block_pairs(open_: DataFrame, table: DataFrame, value: str, compare: Callable, members: bool) -> DataFrame:
    """Compare hubs with members of other components of their bucket, block by block.

    Hubs have the first places of their bucket. Each pair of a block of hubs
    and a block of members is one unit of work of bounded size. ``compare`` gets
    the values of a unit and returns a function that says which rows are like a
    given one. The result has the similar pairs (a, b), or, if only ``members``
    are asked for, the ends of such pairs as a with their bucket as b.
    """
    known = open_.join(table.select(F.col("doc_id").alias("node"), F.col(value).alias("value")).hint("merge"), "node")
    columns = ["node", "component", "place", "value"]
    blocks = [F.sequence(F.lit(0), ((F.col(n) - 1) / BLOCK).cast("int")) for n in ("size", "hubs")]
    own = (F.col("place") / BLOCK).cast("int")
    hubs = known.filter("place < hubs").select(
        "band", F.explode(blocks[0]).alias("block"), own.alias("hub_block"), F.lit(0).alias("role"), *columns
    )
    others = known.select(
        "band", own.alias("block"), F.explode(blocks[1]).alias("hub_block"), F.lit(1).alias("role"), *columns
    )
    unit = ["band", "block", "hub_block"]
    work = hubs.union(others).repartition(*unit).sortWithinPartitions(*unit, "role")

    def settle(band: int, rows: list[tuple]) -> set[tuple[int, int]]:
        role, node, component, place = (np.array([r[i] for r in rows]) for i in range(4))
        alike = compare([r[4] for r in rows])
        out: set[tuple[int, int]] = set()
        for i in np.flatnonzero(role == 0):
            other = (role == 1) & (component != component[i]) & (place > place[i])
            for j in np.flatnonzero(alike(i) & other) if other.any() else ():
                one, two = int(node[i]), int(node[j])
                out |= {(one, band), (two, band)} if members else {(min(one, two), max(one, two))}
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def batch_of(out: set[tuple[int, int]]) -> pa.RecordBatch:
            found = np.array(sorted(out), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

        for batch in batches:
            out: set[tuple[int, int]] = set()
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if row[:3] != now:
                    out |= settle(now[0], rows) if rows else set()
                    now, rows = row[:3], []
                rows.append(row[3:])
            yield batch_of(out)
        yield batch_of(settle(now[0], rows) if rows else set())

    return work.mapInArrow(run, "a long, b long").distinct()


def _same_bins(values: list[bytes]) -> Callable[[int], np.ndarray]:
    table, least = np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1), LIKELY
    return lambda i: (table == table[i]).mean(axis=1) >= least


def _similar_halves(percent: int) -> Callable[[list[bytes]], Callable[[int], np.ndarray]]:
    """For sets of which two bytes a member are given: no similar pair is missed, few others pass."""

    def compare(values: list[bytes]) -> Callable[[int], np.ndarray]:
        sizes = np.array([len(v) // 2 for v in values])
        members = np.frombuffer(b"".join(values), np.uint16)
        starts = np.cumsum(sizes) - sizes
        mine = np.zeros(1 << 16, bool)

        def alike(i: int) -> np.ndarray:
            own = members[starts[i] : starts[i] + sizes[i]]
            mine[own] = True
            both = np.add.reduceat(mine[members], starts, dtype=np.int64)
            mine[own] = False
            return (100 + percent) * both >= percent * (sizes + sizes[i])

        return alike

    return compare


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= percent * union of their
    shingle sets. A null text or one without words has an empty set and no link.
    ``component_id`` is the smallest doc_id reachable, ``kept`` marks that
    document. Equal sets are one class, named by its smallest doc_id and
    compared once. Rows that repeat a doc_id are all returned, each with the
    class of its own text; classes of the same name count as one. A row without
    doc_id is linked with nothing, has no component and is kept. Other columns
    are ignored.
    """
    sketch = stored(sketches(docs, width, bands, rows), "sketches")
    classes = sketch.filter("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("node"))
    heads = (
        sketch.select("doc_id", "set_id", "bands")
        .join(classes.filter("node is not null").hint("merge"), "set_id")
        .filter("doc_id = node")
        .select("node", F.explode("bands").alias("band"))
    )
    buckets = stored(shared_buckets(heads), "buckets")
    nodes = buckets.select(F.col("node").alias("doc_id")).distinct()

    def of_nodes(table: DataFrame, *columns: str) -> DataFrame:
        """Rows of documents that share a bucket, one for each."""
        held = table.select("doc_id", *columns).join(nodes.hint("merge"), "doc_id", "left_semi")
        return held.groupBy("doc_id").agg(*(F.first(c).alias(c) for c in columns))

    bins = stored(of_nodes(sketch.filter("bins is not null"), "bins"), "bins")
    texts = stored(docs.select("doc_id", "text").join(nodes.hint("merge"), "doc_id", "left_semi"), "texts")

    def sets_of(frame: DataFrame, *columns: str, kind: type = np.uint64) -> DataFrame:
        ids = frame.select(F.explode(F.array(*columns)).alias("doc_id")).distinct()
        return full_sets(texts.join(ids.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"]), width, kind)

    pairs = stored(likely(first_stars(buckets), bins), "pairs")
    links = stored(confirm(pairs, sets_of(pairs, "a", "b"), percent), "confirmed")
    components = connected(links)
    open_ = stored(open_buckets(buckets, components), "open")
    near = stored(block_pairs(open_, bins, "bins", _same_bins, members=True), "near")
    if not near.isEmpty():
        # Members that are like no hub have no further part; hubs keep their places.
        left = near.select(F.col("a").alias("node"), F.col("b").alias("band"))
        left = open_.join(left.hint("merge"), ["band", "node"])
        halves = stored(sets_of(left, "node", kind=np.uint16), "halves")
        pairs = stored(block_pairs(left, halves, "members", _similar_halves(percent), members=False), "pairs")
        if not pairs.isEmpty():
            more = stored(confirm(pairs, sets_of(pairs, "a", "b"), percent), "confirmed")
            components = connected(links.union(more))

    of_class = classes.join(components.hint("merge"), "node", "left").select("set_id", F.coalesce("component", "node").alias("class"))
    reached = F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id"))
    return (
        sketch.select("doc_id", "n_shingles", "set_id")
        .join(of_class.hint("merge"), "set_id", "left")
        .select("doc_id", "n_shingles", reached.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
