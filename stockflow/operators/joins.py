"""Join helpers: lookups with null keys, fan-out, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Left outer ``spread_join``: every left row stays, with its matches or nulls."""
    return spread_join(left, right, on, "left", spread_by)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Equi-join of two frames without common column names that stays even under skew.

    Both sides get a bucket as one more join key, 0 for rows with a key. Left
    rows whose key is null match nothing but would all hash to one partition;
    with ``spread_by``, a column that differs between them, they get a bucket
    of their own. Name a column the query needs anyway, so pruning is not lost.

    A hot key that is not null is split by the skew join of adaptive execution.
    That rule needs a shuffle directly below both sides. The bucket sees to it:
    a side that already has the partitioning of an earlier join or window on
    the same key is exchanged again, and so can be split.
    """
    left_keys, right_keys = [l for l, _ in on], [r for _, r in on]
    bucket = _zero(left_keys)
    if spread_by:
        no_key = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in left_keys))
        # Any number but the 0 of rows with a key.
        spread = F.xxhash64(*spread_by).bitwiseOR(F.lit(1))
        bucket = F.when(no_key, spread).otherwise(bucket)
    left = left.withColumn("__bucket", bucket)
    right = right.withColumn("__right_bucket", _zero(right_keys))
    match = [F.col(l) == F.col(r) for l, r in on]
    match.append(F.col("__bucket") == F.col("__right_bucket"))
    return left.join(right, match, how).drop("__bucket", "__right_bucket")


def repeated(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """``lookup`` without the columns of ``right``: each left row as often as it brings it.

    Only keys that ``right`` has more than once meet the left rows. There are few
    in a table of its key, so that adaptive execution has nothing to shuffle for.
    """
    times = right.groupBy(*(F.col(r) for _, r in on)).agg(F.count(F.lit(1)).alias("__times"))
    rows = lookup(left, times.where(F.col("__times") > 1), on, spread_by)
    again = F.when(F.col("__times").isNull(), F.array(F.lit(1))).otherwise(F.array_repeat(F.lit(1), F.col("__times").cast("int")))
    return rows.select(*left.columns, F.explode(again).alias("__again")).drop("__again")


def placed_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str,
    by: tuple[str, str],
    in_place: tuple[bool, bool] = (False, False),
) -> DataFrame:
    """Equi-join whose sides are dealt out by one pair of the keys alone, which has to be the first.

    A side that is ``in_place``, as the result of such a join is on its left column,
    is neither shuffled nor sorted again, if the session has ``PLACED_JOINS``. In return adaptive execution does not split
    a hot value of that column: it is for keys like an order's id, whose rows are few.
    """
    if on[0] != by:
        raise ValueError(f"{by} has to be the first of the keys {on}")
    left, right = (
        side if there else side.repartition(F.col(key))
        for side, there, key in zip((left, right), in_place, by, strict=True)
    )
    return left.join(right, [F.col(l) == F.col(r) for l, r in on], how)


def _zero(keys: Sequence[str]) -> Column:
    """Always 0, but not a literal: the optimizer would turn an equality with a literal into
    a filter, and the bucket would no longer be a join key."""
    return F.pmod(F.xxhash64(*keys), F.lit(1)).cast("bigint")


class JoinSide(NamedTuple):
    """One left join to measure: name, both frames and the key pairs."""

    name: str
    left: DataFrame
    right: DataFrame
    on: Sequence[tuple[str, str]]


def fanout_metrics(sides: Sequence[JoinSide]) -> DataFrame:
    """Rows before and after each left join, without running the join on rows.

    Both sides are counted per key first, so what is joined is one row per key.
    """
    return reduce(DataFrame.unionByName, (_fanout(s) for s in sides))


def _fanout(side: JoinSide) -> DataFrame:
    left = side.left.groupBy(*(F.col(l).alias(f"l{i}") for i, (l, _) in enumerate(side.on))).agg(
        F.count(F.lit(1)).alias("n_left")
    )
    right = side.right.groupBy(*(F.col(r).alias(f"r{i}") for i, (_, r) in enumerate(side.on))).agg(
        F.count(F.lit(1)).alias("n_right")
    )
    pairs = left.join(
        right, [F.col(f"l{i}") == F.col(f"r{i}") for i in range(len(side.on))], "left"
    )
    matched = F.col("n_right").isNotNull()
    return pairs.agg(
        F.coalesce(F.sum("n_left"), F.lit(0)).alias("rows_before"),
        F.coalesce(
            F.sum(F.col("n_left") * F.coalesce("n_right", F.lit(1))), F.lit(0)
        ).alias("rows_after"),
        F.coalesce(F.sum(F.when(~matched, F.col("n_left"))), F.lit(0)).alias("rows_unmatched"),
        F.coalesce(F.max("n_right"), F.lit(0)).alias("max_matches"),
    ).select(F.lit(side.name).alias("join_name"), "*")


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Compare two frames by key: keys and rows on both sides, on one side only, or with
    different row counts. Null keys equal each other.

    One shuffle of per-key counts instead of a full outer join of rows.
    """
    tagged = a.select(*keys, F.lit(1).alias("__a"), F.lit(0).alias("__b")).unionByName(
        b.select(*keys, F.lit(0).alias("__a"), F.lit(1).alias("__b"))
    )
    counts = tagged.groupBy(*keys).agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
    status = (
        F.when(F.col("__b") == 0, "ONLY_A")
        .when(F.col("__a") == 0, "ONLY_B")
        .when(F.col("__a") != F.col("__b"), "COUNT_DIFFERS")
        .otherwise("SAME")
    )
    return counts.groupBy(status.alias("status")).agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.sum("__a").alias("rows_a"),
        F.sum("__b").alias("rows_b"),
    )


# Bits of a key's hash that one level of the checksum tree tells apart.
TREE_LEVELS = (12, 12)


def _checksums(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """``df`` with the hash of its key and two hashes of its row, nulls told from absent values."""

    def hashed(columns: Sequence[str], seed: int) -> Column:
        return F.xxhash64(F.lit(seed), *(x for c in columns for x in (F.col(c), F.col(c).isNull())))

    rest = sorted(c for c in df.columns)
    return df.select(
        hashed(keys, 1).alias("__key"),
        hashed(rest, 2).cast("decimal(38,0)").alias("__one"),
        hashed(rest, 3).cast("decimal(38,0)").alias("__two"),
        F.lit(side).alias("__side"),
    )


def differing_ranges(a: DataFrame, b: DataFrame, keys: Sequence[str], levels: Sequence[int] = TREE_LEVELS) -> DataFrame:
    """``range``: leading bits of key hashes, all levels' together, below which the two frames differ.

    Each level is one aggregate of order-independent checksums: counts and sums
    of two row hashes. The next level looks only at rows in ranges that differ,
    so equal frames shuffle one level's checksums and nothing else.
    """
    both = _checksums(a, keys, "a").union(_checksums(b, keys, "b"))
    bits, found = 0, None
    for level in levels:
        if found is not None:
            wide = F.shiftrightunsigned("__key", 64 - bits).alias("range")
            ranges = F.broadcast(found) if bits <= 16 else found
            both = both.withColumn("range", wide).join(ranges, "range", "left_semi").drop("range")
        bits += level
        parts = both.groupBy(F.shiftrightunsigned("__key", 64 - bits).alias("range"), "__side").agg(
            F.count(F.lit(1)).alias("n"), F.sum("__one").alias("one"), F.sum("__two").alias("two")
        )
        sums = F.struct("n", "one", "two")
        sides = [F.max(F.when(F.col("__side") == s, sums)).alias(s) for s in "ab"]
        found = parts.groupBy("range").agg(*sides).where(~F.col("a").eqNullSafe(F.col("b"))).select("range")
    return found


def reconcile_changes(a: DataFrame, b: DataFrame, keys: Sequence[str], levels: Sequence[int] = TREE_LEVELS) -> DataFrame:
    """What differs between two frames of the same columns, by key and column.

    Per difference: the keys, ``status``, ``column_name``, ``value_a``, ``value_b``
    and ``n_rows``. A key with one row on each side that differ is CHANGED, a line
    for each column that does, values as text. Otherwise rows that one side has
    more often are ONLY_A or ONLY_B, one line for each distinct row, with how
    many more there are. Null keys equal each other, null values too.

    Only rows in ranges that ``differing_ranges`` finds are compared.
    """
    columns = a.columns
    if sorted(columns) != sorted(b.columns):
        raise ValueError(f"columns differ: {sorted(set(columns) ^ set(b.columns))}")
    found = differing_ranges(a, b, keys, levels)
    wide = F.shiftrightunsigned(
        F.xxhash64(F.lit(1), *(x for c in keys for x in (F.col(c), F.col(c).isNull()))), 64 - sum(levels)
    ).alias("range")
    one = F.lit(1).cast("long")
    tagged = a.select(*columns, one.alias("__n")).union(b.select(*columns, (-one).alias("__n")))
    suspects = tagged.withColumn("range", wide).join(found, "range", "left_semi").drop("range")
    more = suspects.groupBy(*columns).agg(F.sum("__n").alias("__n")).where("__n != 0")
    rest = [c for c in columns if c not in keys]
    row = F.struct(*(F.col(c) for c in rest), F.lit(0).alias("__any"))
    side = {s: F.max(F.when(F.col("__n") * way > 0, row)).alias(f"__{s}") for s, way in (("a", 1), ("b", -1))}
    counts = [F.count_if(F.col("__n") * way > 0).alias(f"__n{s}") for s, way in (("a", 1), ("b", -1))]
    total = F.max(F.abs("__n")).alias("__most")
    # Rows of a key that has several differing rows are reported as they are, not paired.
    per_key = more.groupBy(*keys).agg(*side.values(), *counts, total)
    paired = (F.col("__na") == 1) & (F.col("__nb") == 1) & (F.col("__most") == 1)
    pairs = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"__a.{c}").cast("string").alias("value_a"), F.col(f"__b.{c}").cast("string").alias("value_b"),
            (~F.col(f"__a.{c}").eqNullSafe(F.col(f"__b.{c}"))).alias("differs"),
        )
        for c in rest
    ]
    changed = per_key.where(paired)
    if rest:
        lines = changed.select(*keys, F.inline(F.array(*pairs))).where("differs").drop("differs")
    else:
        lines = changed.where(F.lit(False)).select(*keys, *(F.lit(None).cast("string").alias(n) for n in ("column_name", "value_a", "value_b")))
    lines = lines.withColumn("status", F.lit("CHANGED")).withColumn("n_rows", one)
    alone = per_key.where(~paired).select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)))
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    only = more.join(alone, same, "left_semi").select(
        *keys,
        *(F.lit(None).cast("string").alias(n) for n in ("column_name", "value_a", "value_b")),
        F.when(F.col("__n") > 0, "ONLY_A").otherwise("ONLY_B").alias("status"),
        F.abs("__n").alias("n_rows"),
    )
    return lines.unionByName(only).select(*keys, "status", "column_name", "value_a", "value_b", "n_rows")
