"""Checks and size decisions used by several operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A side of a join is broadcast only below both limits.
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Rows whose columns are all non-null, as plain ``IS NOT NULL`` tests.

    Unlike ``dropna`` these reach the scan and count as known constraints, so that
    two branches of a plan stay equal and share one shuffle.
    """
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df


def require(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """The same rows; the query fails while running if a row breaks ``condition``."""
    return df.where(F.coalesce(condition, F.lit(False)) | F.raise_error(F.lit(message)).cast("boolean"))


# Types whose values have a fixed small width.
_FIXED_WIDTH = ("integer", "long", "double", "float", "date", "boolean", "short", "byte", "timestamp", "timestamp_ntz")


def broadcastable(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Measure a dimension against the broadcast limits: its rows first, its bytes only if these are few.

    Both are distributed aggregates of one row; the count of a plain table reads no columns.
    """
    if df.count() > max_rows:
        return False
    width = F.lit(8 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        if field.dataType.typeName() not in _FIXED_WIDTH:
            value = F.col(f"`{field.name}`")
            text = value if field.dataType.typeName() == "string" else F.to_json(F.struct(value))
            width = width + F.coalesce(F.octet_length(text), F.lit(0))
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0] <= max_bytes


def maybe_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast where the measured size allows it; otherwise the plain DataFrame.

    Without the hint the join is shuffled, and adaptive execution splits the
    partitions of a hot key.
    """
    return F.broadcast(df) if broadcastable(df, max_rows, max_bytes) else df
