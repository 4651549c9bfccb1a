"""The serialised form of a creative, which is also its version key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adstrata.schemas import RECORD_FIELDS

# The text must not change between runs: NULL fields stay in it, instants are written in UTC.
JSON_OPTIONS = {"ignoreNullFields": "false", "timeZone": "UTC"}


def record_struct(region_stats: Column) -> Column:
    """The record with its regions replaced, fields in their fixed order."""
    return F.struct(
        *[region_stats.alias(name) if name == "region_stats" else F.col(name) for name in RECORD_FIELDS]
    )


def json_text(record: Column) -> Column:
    return F.to_json(record, JSON_OPTIONS)
