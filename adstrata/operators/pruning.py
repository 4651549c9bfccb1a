"""Reading back no more of the raw table than a batch can match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstrata.operators.skew import BROADCAST_ROWS, fits_broadcast
from adstrata.schemas import CREATIVE_KEY, PARTITION_COLUMN

# Up to this many creatives are named one by one as well, so that the reader can ask the Bloom filters of row groups.
NAMED_CREATIVES = 100
# Up to this many partition days are named one by one; beyond it the range is used.
NAMED_DAYS = 400


def relevant_history(raw: DataFrame, staged: DataFrame, max_broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """The raw-table rows that could equal a row of a staged batch.

    Equal texts hold the same first-shown day, so only the batch's partitions are read, and in them
    only row groups with its advertisers, and with its creatives if they are few. When the batch's creatives fit a broadcast,
    all other rows are dropped before any shuffle.

    This holds for a raw table of one market, written by these jobs.
    """
    span = staged.agg(
        F.min(PARTITION_COLUMN).alias("first_day"),
        F.max(PARTITION_COLUMN).alias("last_day"),
        F.min("advertiser_id").alias("first_id"),
        F.max("advertiser_id").alias("last_id"),
    ).first()
    if span.first_day is None:
        return raw.limit(0)
    # Distinct calendar days: their number is bounded by the years covered, not by the rows.
    days = [r[0] for r in staged.select(PARTITION_COLUMN).dropna().distinct().collect()]
    partition = F.col(PARTITION_COLUMN)
    pruned = raw.filter(partition.isin(days) if len(days) <= NAMED_DAYS else partition.between(span.first_day, span.last_day))
    pruned = pruned.filter(F.col("advertiser_id").between(F.lit(span.first_id), F.lit(span.last_id)))
    creatives = staged.select(*CREATIVE_KEY).dropna().distinct()
    few = [r[0] for r in creatives.select("creative_id").distinct().limit(NAMED_CREATIVES + 1).collect()]
    if len(few) <= NAMED_CREATIVES:
        pruned = pruned.filter(F.col("creative_id").isin(few))
    if fits_broadcast(creatives, max_broadcast):
        pruned = pruned.join(F.broadcast(creatives), list(CREATIVE_KEY), "left_semi")
    return pruned.select(raw.columns)
