"""Joins of a large frame with a lookup table whose size is checked first."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def lookup_join(big: DataFrame, table: DataFrame, on, how: str = "left", max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcasts a table that was counted to be small; otherwise a shuffled join, where adaptive
    execution splits the partitions of hot keys."""
    return big.join(F.broadcast(table) if is_small(table, max_rows) else table, on, how)
