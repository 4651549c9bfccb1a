"""Versions of creatives: what is new, what is newest, and in which order they came."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adstrata.schemas import CREATIVE_KEY, VERSION_KEY


def new_versions(incoming: DataFrame, existing: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """The incoming rows whose advertiser, creative and text are not in the existing rows.

    Equal incoming rows are all kept (see `drop_repeats`), and so are rows with a NULL key. `also`
    names further columns that equal texts are known to share, such as the partition column.

    Texts of a creative meet by 128 bits of their SHA-256, so none of the existing ones is shuffled, and
    copies of a version are dropped before the shuffle. That aggregation has a key more than the join, which so keeps a shuffle of its
    own right below it: without one the skew join could not split incoming copies of one version.
    """
    keys = [*CREATIVE_KEY, *also, "_digest"]
    digest = F.unhex(F.substring(F.sha2("raw_data", 256), 1, 32))
    known = existing.withColumn("_digest", digest).select(*keys, F.substring("_digest", 1, 1).alias("_lead"))
    known = known.distinct().select(keys)
    return incoming.withColumn("_digest", digest).join(known, keys, "left_anti").select(incoming.columns)


def drop_repeats(incoming: DataFrame) -> DataFrame:
    """One row per version within a batch."""
    return incoming.dropDuplicates(list(VERSION_KEY))


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of each key. Each map task keeps one row per key, so hot keys do not pile up."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def latest_version(raw: DataFrame) -> DataFrame:
    """The newest row per creative; of equally new ones, the smallest text."""
    return newest_per_key(raw, CREATIVE_KEY, [F.desc("metadata_time"), F.asc("raw_data"), F.asc("data_modified")])


def version_history(raw: DataFrame) -> DataFrame:
    """The versions of each creative, numbered in load order.

    One row per load time and text (by its SHA-256), with the number of stored copies and whether the
    text differs from the version before. Only digests are shuffled, and creatives are numbered in pieces.
    """
    versions = (
        raw.select(*CREATIVE_KEY, "metadata_time", "data_modified", F.sha2("raw_data", 256).alias("digest"))
        .groupBy(*CREATIVE_KEY, "metadata_time", "digest", "data_modified")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    return _numbered_in_pieces(versions)


def _numbered_in_pieces(versions: DataFrame) -> DataFrame:
    """Versions numbered by pieces of one load time and one leading byte of the digest.

    Digests spread evenly, so a piece holds about 1/256 of a load. The pieces of a creative number
    256 per load time at most; their totals give each piece its offset.
    """
    piece = [*CREATIVE_KEY, "metadata_time", "_lead"]
    pieces = versions.withColumn("_lead", F.substring("digest", 1, 2))
    inside = Window.partitionBy(*piece).orderBy("digest", "data_modified")
    earlier = Window.partitionBy(*CREATIVE_KEY).orderBy("metadata_time", "_lead")
    totals = pieces.groupBy(*piece).agg(F.count(F.lit(1)).alias("_n"), F.max("digest").alias("_last"))
    offsets = totals.select(
        *piece,
        F.coalesce(
            F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_offset"),
        F.lag("_last").over(earlier).alias("_carried"),
    )
    return (
        pieces.withColumn("_row", F.row_number().over(inside))
        .withColumn("_inside", F.lag("digest").over(inside))
        .join(offsets, piece)
        .withColumn("version_no", F.col("_offset") + F.col("_row"))
        .withColumn(
            "changed", F.coalesce(F.col("digest") != F.coalesce("_inside", "_carried"), F.lit(False))
        )
        .drop("_lead", "_row", "_inside", "_offset", "_carried")
    )
