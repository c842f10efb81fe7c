"""Join sides whose row count is known beforehand."""

from pyspark.sql import DataFrame

# An axis of the grid is some 100 bytes per row in a hash table, so this is about 400 MB per executor.
BROADCAST_ROWS = 4_000_000


def size_checked(side: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a side of that many rows for broadcast if it is small enough, else for a sort-merge join."""
    return side.hint("broadcast" if rows <= limit else "merge")
