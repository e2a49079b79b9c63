"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    return F.when(~F.isnan(_col(c)), _col(c))


def round_half_even(c, digits: int = 1) -> Column:
    """Round on the scaled binary value, ties to even; ``+ 0.0`` turns -0.0 into 0.0."""
    scale = F.lit(float(10 ** digits))
    return F.rint(_col(c) * scale) / scale + F.lit(0.0)


def degradation_pct(best, current) -> Column:
    """Relative loss of a metric in percent of the current value; null when current is 0."""
    return F.try_divide(F.lit(100.0) * (_col(best) - _col(current)), _col(current))
