"""Operator 11: vector codes, their codebooks trained by Lloyd rounds over cover trees.

Every vector is cut into parts, and each part position has a codebook. A task
builds, for each block of its vectors and each position, a cover tree: a node
has a centre and a radius that holds all points below it, its children lie
further than half of that from each other (by ``BASE``), and its points are a
run of the tree's order, so cumulative sums give the sum of any subtree.

A round walks the trees with the current codebooks. An entry further from a
node's centre than the nearest entry by over twice the radius is the nearest of
no point below (triangle inequality); where one entry is left the whole subtree
goes to it at once. Only nodes that stay ambiguous are opened, and only points
of ambiguous leaves are compared one by one. All sums and distances that decide
are integers.

Trees are stored once and read by every round; a round returns one row for each
task, entry and component at most, and the driver holds the codebooks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.storage import stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
BLOCK = 2048
LEAF = 12
BASE = 1.6
LARGEST = 1 << 27
TREES = (
    "ids array<long>, labels array<int>, points array<int>, sizes array<int>, positions array<int>, centres array<int>, "
    "starts array<int>, ends array<int>, firsts array<int>, counts array<int>, radii array<double>"
)
_NODE = ("centres", "starts", "ends", "firsts", "counts")


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all entries, as integers."""
    gap = points[:, None, :] - entries[None, :, :]
    return np.einsum("ijk,ijk->ij", gap, gap)


class Tree:
    """A cover tree of the rows of ``points``, nodes in breadth-first order.

    Node i has the points ``order[start[i]:end[i]]``, all within ``radius[i]``
    of the point ``centre[i]``, and the children ``first[i]`` to ``first[i] +
    count[i] - 1``; a leaf has none.
    """

    def __init__(self, order: np.ndarray, nodes: dict[str, np.ndarray], radius: np.ndarray) -> None:
        self.order, self.radius = order, radius
        self.centre, self.start, self.end, self.first, self.count = (nodes[n] for n in _NODE)

    @classmethod
    def built(cls, points: np.ndarray, leaf: int = LEAF, base: float = BASE) -> Tree:
        n = len(points)
        order = np.zeros(n, np.int32)
        gap = points - points[:1]
        away = np.einsum("ij,ij->i", gap, gap)
        nodes, radius = [[0, 0, n, 0, 0]], [_over(away.max())]
        waiting = [(np.arange(n), away)]
        for at, (members, away) in enumerate(waiting):
            centre, start, end = nodes[at][:3]
            if end - start <= leaf or not radius[at]:
                order[start:end] = members
                continue
            limit = base ** (np.ceil(np.log(radius[at]) / np.log(base)) - 1)
            limit = limit * limit
            nodes[at][3] = len(nodes)
            inside = away <= limit
            while True:
                mine, dist = members[inside], away[inside]
                nodes.append([centre, start, start + mine.size, 0, 0])
                radius.append(_over(dist.max()))
                waiting.append((mine, dist))
                start += mine.size
                members = members[~inside]
                if not members.size:
                    break
                centre = int(members[0])
                gap = points[members] - points[centre]
                away = np.einsum("ij,ij->i", gap, gap)
                inside = away <= limit
            nodes[at][4] = len(nodes) - nodes[at][3]
            waiting[at] = None
        table = np.array(nodes, np.int32).T
        return cls(order, dict(zip(_NODE, table, strict=True)), np.array(radius))

    def nearest(self, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Nearest entry of each point, each entry's sum and number of points, and how many distances were taken.

        Ties go to the lower index.
        """
        near = np.zeros(len(points), np.int8)
        ordered = points[self.order]
        upto = np.zeros((len(points) + 1, points.shape[1]), np.int64)
        np.cumsum(ordered, axis=0, out=upto[1:])
        total, number = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
        taken = 0
        nodes, open_ = np.zeros(1, np.int64), np.ones((1, len(entries)), bool)
        while nodes.size:
            far = np.where(open_, squares(points[self.centre[nodes]], entries), np.iinfo(np.int64).max)
            taken += int(open_.sum())
            least = far.argmin(1)
            root = np.sqrt(far.astype(np.float64))
            reach = root[np.arange(nodes.size), least] + 2 * self.radius[nodes]
            open_ &= root <= (reach * (1 + 1e-9))[:, None]
            # All points of a node without radius are its centre.
            sole = (open_.sum(1) == 1) | (self.radius[nodes] == 0)
            for entry in np.unique(least[sole]):
                some = nodes[sole & (least == entry)]
                start, end = self.start[some], self.end[some]
                total[entry] += (upto[end] - upto[start]).sum(0)
                number[entry] += int((end - start).sum())
                near[self.order[_runs(start, end - start)]] = entry
            leaf = ~sole & (self.count[nodes] == 0)
            if leaf.any():
                some, size = nodes[leaf], self.end[nodes[leaf]] - self.start[nodes[leaf]]
                at = _runs(self.start[some], size)
                mask = np.repeat(open_[leaf], size, axis=0)
                found = np.where(mask, squares(ordered[at], entries), np.iinfo(np.int64).max).argmin(1)
                taken += int(mask.sum())
                near[self.order[at]] = found
                np.add.at(total, found, ordered[at])
                number += np.bincount(found, minlength=len(entries))
            down = ~sole & ~leaf
            count = self.count[nodes[down]]
            open_ = np.repeat(open_[down], count, axis=0)
            nodes = _runs(self.first[nodes[down]], count)
        return near, total, number, taken


def _over(square: int) -> float:
    """A distance not below the root of ``square``."""
    return float(np.sqrt(float(square))) * (1 + 1e-9)


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1 ... for each pair, one after the other."""
    size = size.astype(np.int64)
    before = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - before, size)


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, x``: rows whose vector is neither null nor holds null or non-finite components, as integers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return vectors.filter(F.col("embedding").isNotNull() & finite).select("vec_id", F.col("label").cast("int").alias("label"), scaled.alias("x"))


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *(r.size for r in rows)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows), kind))


def trees(whole: DataFrame, parts: int, block: int = BLOCK) -> DataFrame:
    """One row for each block of up to ``block`` vectors of a task: its vectors and their trees, position by position."""

    def row(ids: pa.Array, labels: pa.Array, points: np.ndarray) -> pa.RecordBatch:
        cut = points.reshape(len(points), parts, -1)
        built = [Tree.built(np.ascontiguousarray(cut[:, p])) for p in range(parts)]
        one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
        node = [_lists([np.concatenate([getattr(t, n.removesuffix("s")) for t in built])], pa.int32()) for n in _NODE]
        return pa.RecordBatch.from_arrays(
            [
                one(ids),
                one(labels),
                _lists([points.ravel()], pa.int32()),
                _lists([np.array([t.centre.size for t in built])], pa.int32()),
                _lists([np.concatenate([t.order for t in built])], pa.int32()),
                *node,
                _lists([np.concatenate([t.radius for t in built])], pa.float64()),
            ],
            ["ids", "labels", "points", "sizes", "positions", *_NODE, "radii"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            lists = table.column("x").combine_chunks()
            sizes = np.diff(lists.offsets.to_numpy())
            if (sizes != sizes[0]).any() or sizes[0] % parts:
                raise ValueError(f"vectors must have one length, a multiple of {parts}")
            points = lists.flatten().to_numpy().reshape(table.num_rows, -1)
            if points.size and (points.max() >= LARGEST or points.min() <= -LARGEST):
                raise ValueError(f"components must be below {LARGEST // SCALE} in size: distances are 64-bit integers")
            return row(table.column("vec_id").combine_chunks(), table.column("label").combine_chunks(), points)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                some = batch.slice(at, block - rows)
                held.append(some)
                at, rows = at + some.num_rows, rows + some.num_rows
                if rows == block:
                    yield flush()
                    held, rows = [], 0
        if rows:
            yield flush()

    return whole.select("vec_id", "label", "x").mapInArrow(run, TREES)


def _read(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.Array, pa.Array, list[tuple[np.ndarray, Tree]]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            cell = {n: batch.column(n)[i].values for n in batch.schema.names}
            points = cell["points"].to_numpy().astype(np.int64).reshape(len(cell["ids"]), -1)
            n, at, out = len(points), 0, []
            cut = points.reshape(n, parts, -1)
            nodes = {k: cell[k].to_numpy() for k in _NODE}
            for p, size in enumerate(cell["sizes"].to_pylist()):
                mine = slice(at, at + size)
                order = cell["positions"].to_numpy()[p * n : (p + 1) * n]
                tree = Tree(order, {k: v[mine] for k, v in nodes.items()}, cell["radii"].to_numpy()[mine])
                out.append((np.ascontiguousarray(cut[:, p]), tree))
                at += size
            yield cell["ids"], cell["labels"], out


def lloyd_round(stored_trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round; ``books`` is positions by entries by components."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for _, _, cut in _read(batches, parts):
            for p, (points, tree) in enumerate(cut):
                _, sums, counts, _ = tree.nearest(points, books[p])
                total[p] += sums
                number[p] += counts
        part, entry = np.nonzero(number)
        if part.size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(part * entries + entry, pa.int32()), pa.array(number[part, entry]), _lists(list(total[part, entry]), pa.int64())],
                ["place", "n", "total"],
            )

    sums = stored_trees.mapInArrow(run, "place int, n long, total array<long>")
    # A component's sum may pass 64 bits over all tasks.
    each = [F.sum(F.col("total")[i].cast("decimal(38,0)")) for i in range(width)]
    rows = sums.groupBy("place").agg(F.sum("n"), *each).collect()
    after = books.copy()
    for place, n, *total in rows:
        after[place // entries, place % entries] = [int(t) // n for t in total]
    return after


def assigned(stored_trees: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error``: nearest entries as hexadecimal digits, and the squared distances to them."""
    parts = books.shape[0]
    digits = np.array([f"{i:02x}" for i in range(books.shape[1])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, cut in _read(batches, parts):
            error, near = np.zeros(len(ids), np.int64), []
            for p, (points, tree) in enumerate(cut):
                near.append(tree.nearest(points, books[p])[0])
                gap = points - books[p][near[-1]]
                error += np.einsum("ij,ij->i", gap, gap)
            code = ["".join(c) for c in digits[np.array(near).T].tolist()]
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(code, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    return stored_trees.mapInArrow(run, "vec_id long, label int, code string, error long")


def with_label_error(rows: DataFrame) -> DataFrame:
    """Adds ``label_error``, the sum of ``error`` over rows with an equal label (null is one).

    Labels with over a thousandth of the rows, of which there are fewer than a
    thousand, are joined by broadcast, the others by a shuffle of their rows.
    """
    n = rows.count()
    totals = stored(rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "label-errors")
    common = totals.filter(F.col("n") * 1000 > n).select(F.col("label").alias("of"), "label_error")
    rare = totals.filter(F.col("n") * 1000 <= n).select(F.col("label").alias("of"), "label_error")
    same = F.col("label").eqNullSafe(F.col("of"))
    rest = rows.join(F.broadcast(common), same, "left_anti")
    return rows.join(F.broadcast(common), same).drop("of").union(rest.join(rare, same).drop("of"))


def coded(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error, codebooks_sha256.

    Vectors that are null or hold a null, NaN or infinite component are dropped;
    the others must have one length, a multiple of ``parts``, and components below
    32,768 in size (ValueError in the task otherwise). Codebooks start from the
    ``entries`` smallest vec_ids, null ids last and equal ids by vector; fewer
    vectors make fewer entries. Repeated rows count and are coded each, rows
    without a vec_id too. Columns other than vec_id, embedding and label are
    ignored; a table without kept vectors gives no row.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors)
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    if len({len(r.x) for r in first}) > 1 or len(first[0].x) % parts:
        raise ValueError(f"vectors must have one length, a multiple of {parts}")
    books = np.array([r.x for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    kept = stored(trees(whole, parts, block), "trees")
    for _ in range(rounds):
        after = lloyd_round(kept, books)
        if (after == books).all():
            break
        books = after
    rows = stored(assigned(kept, books), "codes")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return with_label_error(rows).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
