"""Bounded samples of texts by hash, at any number of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHOLE = 1 << 32


def share(size: int, total: int) -> int:
    """The share of rows, of 2**32, among which ``size`` are surely found: four times as many as needed."""
    return _WHOLE if 4 * size >= total else -(-4 * size * _WHOLE // total)


def drawn(text: str, limit: Column) -> Column:
    """Whether a text's hash is in the share, so that tasks send only a few texts to the one that orders them."""
    return F.pmod(F.xxhash64(text), F.lit(_WHOLE)) < limit
