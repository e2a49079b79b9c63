"""Whole-table helpers: enrichment, deduplication, ingest, null filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from cartwheel.session import spread


def enrich(tx: DataFrame, cust: DataFrame, prod: DataFrame, null_safe: bool = False) -> DataFrame:
    """Left-join both dimensions. A key that is repeated in a dimension repeats the row.

    No broadcast hint: Spark broadcasts a dimension when its size allows it, otherwise the
    adaptive skew join splits a hot customer or product. ``null_safe`` also matches null keys.
    """
    def left(a, b, key):
        if not null_safe:
            return a.join(b, key, "left")
        other = b.withColumnRenamed(key, "_key")
        return a.join(other, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    return left(left(tx, cust, "customer_id"), prod, "product_id")


def dedupe(tx: DataFrame, rows: int | None = None) -> DataFrame:
    """Distinct full rows; nulls are equal. Copies collapse before the shuffle, unless there are so
    many rows (about ``rows``, if known) that they are dealt out first."""
    return spread(tx, rows, *tx.columns).distinct()


def union_by_name(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def ingest(new: DataFrame, history: DataFrame) -> DataFrame:
    """New and historic rows together, each distinct row once."""
    return union_by_name(new, history).distinct()


def fill_nulls(df: DataFrame, num: float = 0, text: str = "0",
               overrides: dict | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Fill numbers with ``num`` and strings with ``text``; dates stay null.

    ``overrides`` maps a column to its own fill value; columns in ``keep`` stay as they are.
    """
    overrides = overrides or {}
    fills = {}
    for f in df.schema:
        if f.name in keep:
            continue
        if f.name in overrides:
            fills[f.name] = overrides[f.name]
        elif isinstance(f.dataType, T.NumericType):
            fills[f.name] = num
        elif isinstance(f.dataType, T.StringType):
            fills[f.name] = text
    return df.fillna(fills) if fills else df


def latest_week_split(df: DataFrame, week: str = "week") -> tuple[DataFrame, DataFrame]:
    """(rows of all other weeks, rows of the newest week). The newest week is a scalar subquery,
    so it reaches the scan as a filter."""
    newest = df.agg(F.max(week).alias("w")).scalar()
    return df.filter(F.col(week) != newest), df.filter(F.col(week) == newest)
