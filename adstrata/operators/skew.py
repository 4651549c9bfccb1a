"""Helpers for keys that hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstrata.session import stage

# A group up to this size is sorted by one task; larger ones are split.
HOT_ROWS = 5_000_000

# A relation is broadcast only when it was counted and stays within both bounds.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 200 * 1024 * 1024


def fits_broadcast(keys: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the (string) key columns are small enough to broadcast, by an exact count."""
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in keys.columns), F.lit(0))
    size = keys.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("bytes")).first()
    return size.n <= max_rows and (size.bytes or 0) <= max_bytes


def broadcast_if_small(keys: DataFrame) -> DataFrame:
    """The keys, marked for broadcast when they fit one."""
    return F.broadcast(keys) if fits_broadcast(keys) else keys


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The key values with more than `hot_rows` rows, or None when there are none.

    At most rows / hot_rows values can qualify. They come ready for a broadcast join if they fit one.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hot = counts.filter(F.col("n") > hot_rows).select(*keys).dropna()
    if hot.isEmpty():
        return None
    return broadcast_if_small(stage(hot, "hot-keys"))
