"""Names: snake case for identifiers, quoting, prefixes."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The upper letter that starts a word: it follows a lower letter or digit, or has anything
# before it and a lower letter after it. Looking at the upper letter first keeps long texts fast.
WORD_START = r"[A-Z](?:(?<=[a-z0-9][A-Z])|(?<=[^\n][A-Z])(?=[a-z]))"


def snake_case(name: str) -> str:
    """Snake-case form of one identifier (driver side, for column names)."""
    return re.sub(WORD_START, r"_\g<0>", name.replace(" ", "_")).lower()


def normalize_text(col: Column | str) -> Column:
    """The same rule as :func:`snake_case` for values of a column."""
    underscored = F.replace(F.col(col) if isinstance(col, str) else col, F.lit(" "), F.lit("_"))
    return F.lower(F.regexp_replace(underscored, F.lit(WORD_START), F.lit("_$0")))


def database_name(name: str) -> str:
    """A database name usable without quoting: dashes become underscores."""
    return name.replace("-", "_")


def quote(identifier: str, mark: str = "`") -> str:
    """Quote an identifier; a mark inside the name is doubled."""
    return mark + identifier.replace(mark, mark * 2) + mark


def join_parts(parts: Iterable[str], sep: str = "_") -> str:
    """Column name of a nested path: every part in snake case, joined."""
    return sep.join(snake_case(p) for p in parts)


def settle_collisions(names: list[str], on_collision: str = "error") -> list[int]:
    """Positions to keep, one per distinct name in order of first appearance.

    ``"error"`` refuses two sources for one name; ``"last"`` keeps the last source.
    Names are compared without case, as Spark and most databases do.
    """
    keep: dict[str, int] = {}
    clashes = set()
    for position, name in enumerate(names):
        if name.lower() in keep:
            clashes.add(name)
        keep[name.lower()] = position
    if clashes and on_collision == "error":
        raise ValueError(f"several fields share the name(s) {sorted(clashes)}; pass on_collision='last' to keep the last")
    if on_collision not in ("error", "last"):
        raise ValueError(f"unknown on_collision {on_collision!r}")
    return list(keep.values())


def normalize_columns(df: DataFrame, on_collision: str = "error") -> DataFrame:
    """Rename all columns to snake case."""
    names = [snake_case(c) for c in df.columns]
    by_position = df.toDF(*(f"_{i}" for i in range(len(names))))
    return by_position.select(*(F.col(f"_{i}").alias(names[i]) for i in settle_collisions(names, on_collision)))


def prefix_columns(df: DataFrame, prefix: str = "") -> DataFrame:
    """Put ``prefix_`` before every column name; no prefix leaves the names alone."""
    return df.toDF(*(f"{prefix}_{c}" for c in df.columns)) if prefix else df
