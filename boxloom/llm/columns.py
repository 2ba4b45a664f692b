"""Passed columns, packed into one struct so that no name of theirs can clash with an operator's own.

Spark compares names without case, and so do these functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_name(one: str, other: str | None) -> bool:
    return other is not None and one.lower() == other.lower()


def other_columns(df: DataFrame, names: list[str]) -> list[str]:
    """The columns of ``df`` but for those that an operator's results replace."""
    replaced = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in replaced]


def packed(df: DataFrame, names: list[str], apart: str | None = None) -> tuple[list[str], Column]:
    """The names of the passed columns, and one column that holds them, but for ``apart``, which goes beside it."""
    passed = other_columns(df, names)
    inside = [F.col(f"`{c}`") for c in passed if not same_name(c, apart)]
    return passed, F.struct(*inside) if inside else F.lit(0)


def unpacked(passed: list[str], row: str, apart: str | None = None, value: Column | None = None) -> list[Column]:
    """The passed columns again, in their order; ``value`` for the one that went beside them."""
    return [value.alias(c) if same_name(c, apart) else F.col(row).getField(c).alias(c) for c in passed]
