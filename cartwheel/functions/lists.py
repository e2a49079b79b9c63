"""Array expressions used by the recommenders."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def take_first(items, n: int) -> Column:
    return F.slice(_col(items), 1, n)


def backfill(own, pool, n: int) -> Column:
    """``own`` first, then pool entries not in ``own``, cut to ``n``."""
    return take_first(F.concat(_col(own), F.array_except(_col(pool), _col(own))), n)


def joined(items, sep: str = ", ") -> Column:
    return F.concat_ws(sep, F.transform(_col(items), lambda x: x.cast("string")))
