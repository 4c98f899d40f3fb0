"""Text expressions. All are built-in column expressions, so they stay in codegen."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# A run of characters an identifier may not hold becomes one underscore.
_NOT_IDENTIFIER = "[^a-z0-9]+"


def strip_ws(col: Column) -> Column:
    """Remove every kind of surrounding white space; Spark's ``trim`` removes only U+0020."""
    return F.btrim(col, F.lit(WHITESPACE))


def sanitize_name(name: str) -> str:
    """Turn a header cell into an identifier."""
    return re.sub(_NOT_IDENTIFIER, "_", name.strip().lower()).strip("_")


def sanitize_col(col: Column) -> Column:
    """``sanitize_name`` for values of a column."""
    return F.btrim(F.regexp_replace(F.lower(strip_ws(col)), _NOT_IDENTIFIER, "_"), F.lit("_"))


def unique_names(headers: Sequence[str | None]) -> list[str]:
    """Sanitised column names, each used once: blanks become ``unnamed_<position>``
    and repeats get ``_1``, ``_2`` in column order."""
    plain = [sanitize_name(h or "") or f"unnamed_{i}" for i, h in enumerate(headers)]
    taken: set[str] = set(plain)
    seen: set[str] = set()
    names = []
    for name in plain:
        if name in seen:
            n = 1
            while f"{name}_{n}" in taken:
                n += 1
            name = f"{name}_{n}"
            taken.add(name)
        seen.add(name)
        names.append(name)
    return names


def nullify(col: Column, tokens: Iterable[str]) -> Column:
    """Null where the text is one of the tokens."""
    return F.when(~col.isin(*tokens), col)


# Three concatenation rules with three null rules. A wrong choice changes match
# rates without any error, so each has its own name.


def sql_concat(*cols: Column) -> Column:
    """Null counts as the empty string."""
    return F.concat(*(F.coalesce(c, F.lit("")) for c in cols))


def text_combine(separator: str, *cols: Column) -> Column:
    """Nulls are skipped together with their separator."""
    return F.concat_ws(separator, *cols)


def amp_concat(*cols: Column) -> Column:
    """Any null makes the result null."""
    return F.concat(*cols)


def middle_segment(col: Column) -> Column:
    """Text between the first and the second hyphen; null with fewer than two hyphens."""
    parts = F.split(col, "-")
    return F.when(F.size(parts) >= 3, F.get(parts, 1))


def normalized_key(col: Column) -> Column:
    """Key with blanks, letter case and leading zeros taken out."""
    return F.ltrim(F.upper(strip_ws(col)), F.lit("0"))
