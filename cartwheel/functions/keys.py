"""Repeatable pseudo-random values from key columns.

md5 is used because any SQL engine can recompute it, so a draw can be checked outside Spark
and does not depend on partitioning or on retries.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def hash_order(keys, seed: int) -> Column:
    """32 hex digits that order rows pseudo-randomly."""
    return F.md5(F.concat_ws("|", *[F.coalesce(_text(k), F.lit("")) for k in keys],
                             F.lit(str(seed))))


def hash_lead(keys) -> Column:
    """What ``hash_after`` takes for the leading ``keys``, so that they are spelt once for many rows."""
    return F.concat(*[F.concat(F.coalesce(_text(k), F.lit("")), F.lit("|")) for k in keys])


def hash_after(lead, last, seed: int) -> Column:
    """``hash_order`` of the keys in ``lead`` (a column of ``hash_lead``) and a ``last`` one."""
    return F.md5(F.concat(lead, F.coalesce(_text(last), F.lit("")), F.lit(f"|{seed}")))


def hash_bucket(hashed: Column, digits: int = 4) -> Column:
    """Leading hex digits: at most 16**digits groups of near-equal size."""
    return F.substring(hashed, 1, digits)


def hash_long(*parts) -> Column:
    """A 60-bit non-negative integer from the parts."""
    digest = F.md5(F.concat_ws("|", *[_text(p) for p in parts]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
