"""Columns that only travel, as one compact value.

A row in a shuffle or a sort has eight bytes for every column and strings padded
to eight more. Columns that no join looks at take a fraction of that as one
variant, which keeps each value with its type.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types a variant gives back exactly as they were.
_EXACT = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType, T.VariantType,
)


class Packed(NamedTuple):
    """A column of packed values and the names and types in it, by position."""

    into: str
    columns: tuple[tuple[str, str], ...]


def pack(df: DataFrame, names: Sequence[str], into: str) -> tuple[DataFrame, Packed]:
    """``df`` with the columns ``names`` as one column, packed values among them too; those of
    types that would not come back the same stay as they are."""
    kinds = {f.name: f.dataType for f in df.schema if f.name in names and _exact(f.dataType)}
    if len(kinds) < 2:
        return df, Packed(into, ())
    values = F.array(*(F.col(_quoted(n)).cast("variant") for n in kinds))
    rest = [F.col(_quoted(c)) for c in df.columns if c not in kinds]
    packed = Packed(into, tuple((n, k.simpleString()) for n, k in kinds.items()))
    return df.select(*rest, F.to_variant_object(values).alias(into)), packed


def unpack(df: DataFrame, packs: Sequence[Packed]) -> DataFrame:
    """The columns of ``packs``, given in the order they were made, inner before outer. A value
    that is missing, as after a left join, gives nulls."""
    for into, columns in reversed(packs):
        if columns:
            values = {n: F.variant_get(F.col(into), f"$[{i}]", kind) for i, (n, kind) in enumerate(columns)}
            df = df.withColumns(values).drop(into)
    return df


def _exact(kind: T.DataType) -> bool:
    # A string with a collation of its own would lose it.
    return isinstance(kind, _EXACT) or kind == T.StringType()


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
