"""Operator 7: shards of equal row counts by balanced label propagation.

Documents of equal text are linked. Every document starts in the shard of its
slice of the id order, so that counts are at most one apart. In each round the
shards of a group are ranked by how much of it they hold, and members in lower
ones ask for the first (for a group larger than a shard: for one of the first few
that it fills). Requests are granted so that every count stays as it is: linked
rows that leave a shard balance those that come, and documents without links
pay for the remainder. Quotas come from the largest circulation in a table of
requests by pair of shards (256 numbers, whatever the input) and are handed out
by rank. Where none of these requests is granted, all higher ranked shards are
looked at, and cycles of moves, or moves that unlinked documents pay for, are
sought among them. Rounds end when there are none.

Moves go up the ranking of the round only (shards that hold equally much are
ranked by a hash of the group, the shard and the round), so that each round raises the sum
of squared parts of groups and no state comes twice.

The law that holds is ``rows``: counts of shards are at most one apart. Only
ids, sizes, checksums and text digests travel, never texts.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.storage import stored

SHARDS = 16
# Rows numbered in one task.
SLICE = 50_000


def numbered(rows: DataFrame, keys: list[str], spread: Column, order: list[Column], slices: int, name: str) -> DataFrame:
    """Adds ``name``: gapless numbers from 0 within ``keys``.

    Rows of a key are dealt to ``slices`` slices by ``spread``, numbered there, and
    shifted by the sizes of the slices before, so that no key meets in one task.
    """
    dealt = rows.withColumn("slice", F.pmod(spread, F.lit(slices)))
    by = Window.partitionBy(*keys, "slice").orderBy(*order)
    before = Window.partitionBy(*keys or [F.lit(0)]).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = dealt.groupBy(*keys, "slice").count().select(
        *keys, "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift")
    )
    placed = dealt.withColumn(name, F.row_number().over(by) - 1).join(shift, [*keys, "slice"])
    return placed.withColumn(name, F.col(name) + F.col("shift")).drop("shift", "slice")


def granted(requests: np.ndarray, spare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Moves [from, to] that are granted, and the moves of unlinked documents that pay for them.

    As many requests as possible under which each shard takes in at most what
    its linked documents leave and the ``spare`` unlinked ones. That is a
    circulation through the shards and a pool (unlinked documents leave a shard
    for the pool and come back to any): all requests are granted first, and the
    surplus of a shard then goes to one that lacks rows by the way that takes
    back fewest.
    """
    n = len(spare)
    moves, pool = requests.copy(), np.zeros(n, np.int64)  # pool: net unlinked documents given to it
    over = np.append(moves.sum(axis=0) - moves.sum(axis=1), 0)
    endless = np.iinfo(np.int64).max // 4
    while over.max() > 0:
        space, cost = np.zeros((n + 1, n + 1), np.int64), np.zeros((n + 1, n + 1), np.int64)
        again = requests - moves
        space[:n, :n], cost[:n, :n] = np.where(again > 0, again, moves.T), np.where(again > 0, -1, 1)
        space[:n, n], space[n, :n] = spare - pool, endless
        cost = np.where(space > 0, cost, endless)
        start = int(over.argmax())
        far, before = np.full(n + 1, endless), np.full(n + 1, -1)
        far[start] = 0
        for _ in range(n):
            ways = np.minimum(far[:, None] + cost, endless)
            ways[far >= endless] = endless
            least, via = ways.min(axis=0), ways.argmin(axis=0)
            better = least < far
            if not better.any():
                break
            far, before = np.where(better, least, far), np.where(better, via, before)
        end = int(np.where(over < 0, far, endless).argmin())
        path = [end]
        while path[-1] != start:
            path.append(int(before[path[-1]]))
        steps = list(zip(path[:0:-1], path[-2::-1], strict=True))
        size = min(int(over[start]), int(-over[end]), *(int(space[step]) for step in steps))
        for one, two in steps:
            if two == n:
                pool[one] += size
            elif one == n:
                pool[two] -= size
            elif again[one, two] > 0:
                moves[one, two] += size
            else:
                moves[two, one] -= size
        over[start] -= size
        over[end] += size
    return moves, _paid(moves)


def _paid(moves: np.ndarray) -> np.ndarray:
    """Moves of unlinked documents that make up for ``moves``."""
    owed = moves.sum(axis=0) - moves.sum(axis=1)
    back = np.zeros_like(moves)
    for giver in np.flatnonzero(owed > 0):
        for taker in np.flatnonzero(owed < 0):
            n = min(owed[giver], -owed[taker])
            back[giver, taker] = n
            owed[giver] -= n
            owed[taker] += n
    return back


def exchanged(options: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """Balanced moves among ``options`` [from, to], at most one target for each shard; none if there is no balanced move.

    A row may be an option for several targets, so its shard gives to one only.
    A move is balanced by unlinked documents of its target, or by a cycle.
    """
    moves, spare, left = np.zeros_like(options), spare.copy(), set(range(len(spare)))
    for source in range(len(spare)):
        most = np.minimum(options[source], spare)
        if most.max() > 0:
            to = int(most.argmax())
            moves[source, to] = most[to]
            spare[to] -= most[to]
            left.discard(source)
    while True:
        # What no other shard asks for or what asks for none is on no cycle.
        core = set(left)
        while True:
            stay = {i for i in core if any(options[i, j] for j in core) and any(options[j, i] for j in core)}
            if stay == core:
                break
            core = stay
        if not core:
            return moves
        path = [min(core)]
        while path[-1] not in path[:-1]:
            path.append(max(core, key=lambda j: (options[path[-1], j], -j)))
        cycle = path[path.index(path[-1]) :]
        steps = list(zip(cycle, cycle[1:], strict=False))
        for step in steps:
            moves[step] = min(options[s] for s in steps)
        left -= set(cycle)


def _ranked(placed: DataFrame, quota: int, turn: int) -> DataFrame:
    """The shards of each linked group by rank: group, shard, held, rank, homes (as many shards as the group fills).

    A group has at most as many rows here as there are shards.
    """
    held = placed.filter("linked").groupBy("group", "shard").agg(F.count("*").alias("held"))
    tie = F.xxhash64("group", "shard", F.lit(turn))
    return held.select(
        "group", "shard", "held",
        F.row_number().over(Window.partitionBy("group").orderBy(F.desc("held"), tie, "shard")).alias("rank"),
        F.ceil(F.sum("held").over(Window.partitionBy("group")) / quota).cast("int").alias("homes"),
    )


def _requests(placed: DataFrame, ranked: DataFrame, turn: int) -> DataFrame:
    """Linked rows outside the homes of their group, each asking for one of them: row, shard, target, gain."""
    homes = ranked.filter("rank <= homes").groupBy("group").agg(
        F.array_sort(F.collect_list(F.struct("rank", "shard", "held"))).alias("open")
    )
    away = ranked.filter("rank > homes").join(homes, "group").select("group", "shard", "open")
    pick = F.pmod(F.xxhash64("row", F.lit(turn)), F.size("open")).cast("int")
    target = F.col("open")[pick]
    return placed.filter("linked").join(away, ["group", "shard"]).select(
        "row", "shard", target["shard"].alias("target"), target["held"].alias("gain")
    )


def _options(ranked: DataFrame) -> DataFrame:
    """All ways up: group, shard, target, held (rows that have it), gain."""
    above = ranked.select("group", F.col("shard").alias("target"), F.col("held").alias("gain"), F.col("rank").alias("over"))
    return ranked.join(above, "group").filter("over < rank").select("group", "shard", "target", "held", "gain")


def _ranges(moves: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(from, to, first rank, end rank) of the rows of a shard that go to another."""
    out = []
    for source in range(len(moves)):
        at = 0
        for to in np.flatnonzero(moves[source]):
            out.append((source, int(to), at, at + int(moves[source, to])))
            at += int(moves[source, to])
    return out


def shards(docs: DataFrame, count: int = SHARDS, slice_rows: int = SLICE) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the bytes of the text and 1; a null text has none and is linked
    with empty ones. Every row is placed for itself, also if doc_id is null or
    repeated. Other columns are ignored; an empty table gives no row.
    """
    text = F.coalesce("text", F.lit(""))
    base = stored(
        docs.select(
            "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("group"),
        ),
        "sizes",
    )
    total = base.count()
    slices = max(1, -(-total // slice_rows))
    spark = docs.sparkSession
    # Neighbouring ids stay together: slices are blocks of ids in turn.
    block = F.coalesce(F.shiftright("doc_id", 10), F.xxhash64("group"))
    order = [F.col("doc_id"), F.col("group")]
    rows = numbered(base, [], block, order, slices, "row")
    groups = base.groupBy("group").count().filter("count > 1").select("group", F.lit(True).alias("linked"))
    placed = stored(
        rows.join(groups, "group", "left").select(
            "row", "doc_id", "size", "text_crc32", "group", F.coalesce("linked", F.lit(False)).alias("linked"),
            F.floor(F.col("row") * count / max(1, total)).cast("int").alias("shard"),
        ),
        "placed",
    )

    def matrix(frame: DataFrame, *keys: str, rows: Column = F.lit(1)) -> np.ndarray:
        """Sums of ``rows`` by shard, or by pair of shards: at most count * count numbers."""
        out = np.zeros([count] * len(keys), np.int64)
        for row in frame.groupBy(*keys).agg(F.sum(rows)).collect():
            out[tuple(row[:-1])] = row[-1]
        return out

    for turn in itertools.count():
        room = matrix(placed.filter("not linked"), "shard")
        order_ = stored(_ranked(placed, max(1, total // count), turn), "ranked")
        requests = stored(_requests(placed, order_, turn), "requests")
        moves, back = granted(matrix(requests, "shard", "target"), room)
        if not moves.any():
            options = _options(order_)
            moves = exchanged(matrix(options, "shard", "target", rows=F.col("held")), room)
            back = _paid(moves)
            if not moves.any():
                break
            targets = spark.createDataFrame([(int(i), int(j)) for i, j in zip(*np.nonzero(moves), strict=True)], "shard int, target int")
            ways = options.join(F.broadcast(targets), ["shard", "target"]).drop("held")
            requests = placed.filter("linked").join(ways, ["group", "shard"]).select("row", "shard", "target", "gain")
        asking = numbered(requests, ["shard", "target"], F.xxhash64("row"), [F.desc("gain"), F.col("row")], slices, "rank")
        allowed = spark.createDataFrame(
            [(int(i), int(j), int(moves[i, j])) for i, j in zip(*np.nonzero(moves), strict=True)], "shard int, target int, quota long"
        )
        going = asking.join(F.broadcast(allowed), ["shard", "target"]).filter("rank < quota").select("row", "target")
        if back.any():
            ranges = spark.createDataFrame(_ranges(back), "shard int, target int, first long, end long")
            free = placed.filter("not linked").select("row", "shard")
            free = numbered(free, ["shard"], F.xxhash64("row"), [F.col("row")], slices, "rank")
            paid = free.join(F.broadcast(ranges), "shard").filter("rank >= first and rank < end")
            going = going.union(paid.select("row", "target"))
        placed = stored(
            placed.join(going, "row", "left").withColumn("shard", F.coalesce("target", "shard")).drop("target"), "placed"
        )
    slotted = numbered(placed, ["shard"], F.xxhash64("row"), [F.col("row")], slices, "slot")
    return slotted.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
