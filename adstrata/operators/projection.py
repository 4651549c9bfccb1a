"""From nested source rows to raw-table rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstrata.functions.dates import parse_day, utc_midnight
from adstrata.functions.records import json_text, record_struct
from adstrata.functions.regions import market_entries, single
from adstrata.functions.values import once
from adstrata.operators.selection import in_market


def market_records(source: DataFrame, market: str, strict: bool = True) -> DataFrame:
    """The market's records with its regions cut out once, and the days it was first and last shown.

    Strict: a bad day text, or two entries for the market, fails the job. Otherwise the days are NULL.
    """
    entries = market_entries(F.col("region_stats"), market)
    entry = F.col("_entry")
    return (
        in_market(source, market)
        .withColumn("region_stats", entries)
        .withColumn("_entry", once(single(F.col("region_stats"), strict)))
        .select(
            *source.columns,
            parse_day(entry["first_shown"], strict).alias("first_shown_date"),
            parse_day(entry["last_shown"], strict).alias("last_shown_date"),
        )
    )


LOADS = ("window", "refresh")


def unusable_records(source: DataFrame, market: str, load: str = "window") -> DataFrame:
    """The market's records that a lenient load of a kind never stores, and why.

    A strict load fails on them, but for one case: a window load merely passes over a record without a day last
    shown. A refresh does not look at that day, and stores such records.
    """
    if load not in LOADS:
        raise ValueError(f"load must be one of {LOADS}")
    records = market_records(source, market, strict=False)
    reason = (
        F.when(F.size("region_stats") > 1, "more than one entry")
        .when(F.col("first_shown_date").isNull(), "first_shown")
        .when(F.col("last_shown_date").isNull() & F.lit(load == "window"), "last_shown")
    )
    return records.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def raw_rows(records: DataFrame, ingest_time: datetime | None = None) -> DataFrame:
    """The raw-table rows of market records."""
    loaded = F.current_timestamp() if ingest_time is None else F.lit(ingest_time).cast("timestamp")
    return records.select(
        utc_midnight(F.col("first_shown_date")).alias("data_modified"),
        loaded.alias("metadata_time"),
        "advertiser_id",
        "creative_id",
        json_text(record_struct(F.col("region_stats"))).alias("raw_data"),
    )


def lower_case_columns(df: DataFrame) -> DataFrame:
    """Column names in lower case. Of names that then collide, the last column is kept."""
    names = [c.lower() for c in df.columns]
    position = {name: i for i, name in enumerate(names)}
    numbered = df.toDF(*[f"c{i}" for i in range(len(names))])
    return numbered.select(*[F.col(f"c{position[name]}").alias(name) for name in dict.fromkeys(names)])
