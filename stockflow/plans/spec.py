"""A view as data: which columns of which tables, joined how.

One declaration has two readings. ``frame`` builds the DataFrame, with joins that
stay even under skew; ``view_sql`` writes the same rows as a SELECT that a catalog
can store, so that other sessions and tools read the view by its name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence, Set
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.operators.joins import lookup, placed_join, repeated, spread_join
from stockflow.operators.keyed import latest_by
from stockflow.operators.packing import Packed, pack, unpack
from stockflow.session import joins_in_place


@dataclass(frozen=True)
class Newest:
    """One row per ``keys``: the one with the greatest ``by``, then ``ties``; nulls are smallest."""

    keys: tuple[str, ...]
    by: str
    ties: tuple[str, ...] = ()


@dataclass(frozen=True)
class Pick:
    """Columns of a table, given as SQL expressions over the table's own columns."""

    role: str
    columns: Mapping[str, str]
    where: str | None = None
    newest: Newest | None = None


@dataclass(frozen=True)
class Join:
    """``left`` with the matching rows of ``right``; ``spread_by`` are left columns that tell
    rows without a key apart, so that they do not gather in one task. ``shuffled`` keeps a
    wide ``right`` from being broadcast by the size of its files, which says little of it.
    ``placed`` deals both sides out by the first pair of ``on`` alone, so that a join above
    on the same column of this one finds its rows in place, in a session with
    ``PLACED_JOINS``. ``key`` names the key of a full
    join, from whichever side has it."""

    left: Pick | Join
    right: Pick | Join
    on: tuple[tuple[str, str], ...]
    how: str = "left"
    spread_by: tuple[str, ...] = ()
    shuffled: bool = False
    placed: bool = False
    key: str | None = None


@dataclass(frozen=True)
class View:
    """The columns of a joined relation, some computed from others by SQL expressions."""

    name: str
    rows: Pick | Join
    columns: tuple[str, ...]
    computed: Mapping[str, str] = field(default_factory=dict)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> str:
    """A column as an expression, whatever characters its name has."""
    return _quoted(name)


def names(node: Pick | Join) -> list[str]:
    if isinstance(node, Pick):
        return list(node.columns)
    return [*names(node.left), *names(node.right), *([node.key] if node.key else [])]


def frame(
    node: Pick | Join, tables: Mapping[str, DataFrame], needed: Set[str] | None = None
) -> DataFrame:
    """The rows of a relation over tables by role, with the columns ``needed`` at least."""
    if isinstance(node, Pick):
        df = tables[node.role]
        if node.newest:
            df = latest_by(df, node.newest.keys, node.newest.by, node.newest.ties)
        if node.where:
            df = df.where(node.where)
        return df.select(*(F.expr(expr).alias(name) for name, expr in node.columns.items()))
    if needed is None:
        return _joined(node, frame(node.left, tables), frame(node.right, tables))
    left = frame(node.left, tables, {*needed, *node.spread_by, *(l for l, _ in node.on)})
    if node.how == "left" and isinstance(node.right, Pick) and not needed & set(names(node.right)):
        return repeated(left, frame(node.right, tables), node.on, node.spread_by)
    return _joined(node, left, frame(node.right, tables, {*needed, *(r for _, r in node.on)}))


def _joined(node: Join, left: DataFrame, right: DataFrame) -> DataFrame:
    if node.shuffled:
        right = right.hint("merge")
    if node.placed and joins_in_place(left.sparkSession):
        (by, *_), there = node.on, tuple(_placed_by(s, k) for s, k in zip((node.left, node.right), node.on[0], strict=True))
        return placed_join(left, right, node.on, node.how, by, there)
    if node.how == "full":
        match = [F.col(l) == F.col(r) for l, r in node.on]
        return left.join(right, match, "full").withColumn(node.key, F.coalesce(*node.on[0]))
    if node.how == "left":
        return lookup(left, right, node.on, node.spread_by)
    return spread_join(left, right, node.on, node.how, node.spread_by)


def _placed_by(node: Pick | Join, name: str) -> bool:
    return isinstance(node, Join) and node.placed and node.on[0][0] == name


def view_frame(view: View, tables: Mapping[str, DataFrame], columns: Sequence[str] = ()) -> DataFrame:
    """The view, or these ``columns`` of all its rows. A lookup that brings none of them is then
    reduced to how often it repeats a row."""
    if not columns:
        return _view_columns(view, frame(view.rows, tables))
    return _view_columns(view, frame(view.rows, tables, _needed(view, columns)), columns)


def _view_columns(view: View, rows: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    columns = columns or view.columns
    return rows.withColumns({c: F.expr(view.computed[c]) for c in columns if c in view.computed}).select(*map(column, columns))


def _needed(view: View, columns: Sequence[str]) -> set[str]:
    """Columns below a view that the named ones are made of."""
    computed = [view.computed[c] for c in columns if c in view.computed]
    return {n for n in names(view.rows) if n in columns or any(_quoted(n) in expr for expr in computed)}


def packed_frame(view: View, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``view_frame`` for readers of whole rows: what the left side of a join only brings along
    travels as one value.

    Shuffles and sorts then hold a fraction of the bytes. A filter or a choice of
    columns on the result does not reach the tables; ``view_frame`` is for those.
    """
    packs: list[Packed] = []
    rows = _packed(view.rows, tables, _needed(view, view.columns), set(), packs)
    return _view_columns(view, unpack(rows, packs))


def _packed(
    node: Pick | Join, tables: Mapping[str, DataFrame], wanted: Set[str], above: Set[str], packs: list[Packed]
) -> DataFrame:
    """Rows of a relation with what is ``wanted`` and what joins ``above`` look at."""
    if isinstance(node, Pick):
        return frame(node, tables)
    looked_at = {*above, *node.spread_by, *(n for pair in node.on for n in pair)}
    left = _packed(node.left, tables, wanted, looked_at, packs)
    left, packed = pack(left, [c for c in left.columns if c not in looked_at], f"__packed{len(packs)}")
    packs.append(packed)
    rows = _joined(node, left, _packed(node.right, tables, wanted, looked_at, packs))
    kept = {*above, *wanted, *(p.into for p in packs)}
    return rows.select(*(column(c) for c in rows.columns if c in kept))


def _pick_sql(pick: Pick, tables: Mapping[str, str]) -> str:
    source, where = tables[pick.role], [f"({pick.where})"] if pick.where else []
    if pick.newest:
        keys = ", ".join(map(_quoted, pick.newest.keys))
        order = ", ".join(f"{_quoted(c)} DESC NULLS LAST" for c in (pick.newest.by, *pick.newest.ties))
        rank = f"row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS `__rank`"
        source = f"(SELECT *, {rank} FROM {source})"
        where = ["`__rank` = 1", *where]
    columns = ", ".join(f"{expr} AS {_quoted(name)}" for name, expr in pick.columns.items())
    return f"SELECT {columns} FROM {source}" + (f" WHERE {' AND '.join(where)}" if where else "")


def _rows_sql(node: Pick | Join, tables: Mapping[str, str], parts: list[str]) -> str:
    """Adds what ``node`` needs to ``parts`` as common table expressions and returns its name."""
    if isinstance(node, Pick):
        text = _pick_sql(node, tables)
    else:
        left, right = _rows_sql(node.left, tables, parts), _rows_sql(node.right, tables, parts)
        columns = [f"l.{_quoted(n)}" for n in names(node.left)] + [f"r.{_quoted(n)}" for n in names(node.right)]
        if node.key:
            columns.append(f"coalesce({', '.join(f'{s}.{_quoted(n)}' for s, n in zip('lr', node.on[0], strict=True))}) AS {_quoted(node.key)}")
        match = " AND ".join(f"l.{_quoted(a)} = r.{_quoted(b)}" for a, b in node.on)
        kind = {"left": "LEFT JOIN", "inner": "JOIN", "full": "FULL JOIN"}[node.how]
        text = f"SELECT {', '.join(columns)} FROM {left} l {kind} {right} r ON {match}"
    name = f"part_{len(parts) + 1}"
    parts.append(f"{name} AS ({text})")
    return name


def view_sql(view: View, tables: Mapping[str, str]) -> str:
    """The SELECT of a view over table names by role."""
    parts: list[str] = []
    last = _rows_sql(view.rows, tables, parts)
    columns = [f"{view.computed[c]} AS {_quoted(c)}" if c in view.computed else _quoted(c) for c in view.columns]
    return f"WITH {', '.join(parts)} SELECT {', '.join(columns)} FROM {last}"
