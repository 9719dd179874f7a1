"""Broadcast with a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows a broadcast side may have.  At some hundred bytes each this stays far below executor memory.
MAX_BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting at most ``max_rows + 1`` rows; else leave the join to
    adaptive execution, which sorts, merges and splits skewed partitions."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
