"""Column contracts of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of a creative record, in the order they are serialised.
RECORD_FIELDS = (
    "advertiser_id",
    "creative_id",
    "creative_page_url",
    "ad_format_type",
    "advertiser_disclosed_name",
    "advertiser_legal_name",
    "advertiser_location",
    "advertiser_verification_status",
    "topic",
    "is_funded_by_google_ad_grants",
    "region_stats",
    "audience_selection_approach_info",
)

# The raw table's columns. All of them are required.
RAW_COLUMNS = ("data_modified", "metadata_time", "advertiser_id", "creative_id", "raw_data")

VERSION_KEY = ("advertiser_id", "creative_id", "raw_data")
CREATIVE_KEY = ("advertiser_id", "creative_id")

# Derived from data_modified on write; the raw table is partitioned by it.
PARTITION_COLUMN = "data_date"

RAW_SCHEMA = T.StructType(
    [
        T.StructField("data_modified", T.TimestampType(), False),
        T.StructField("metadata_time", T.TimestampType(), False),
        T.StructField("advertiser_id", T.StringType(), False),
        T.StructField("creative_id", T.StringType(), False),
        T.StructField("raw_data", T.StringType(), False),
        T.StructField(PARTITION_COLUMN, T.DateType(), False),
    ]
)

PAGE_COLUMNS = ("advertiser_id", "creative_id", "creative_page_url")

LINK_SCHEMA = T.StructType(
    [
        T.StructField("advertiser_id", T.StringType(), False),
        T.StructField("creative_id", T.StringType(), False),
        T.StructField("creative_page_url", T.StringType(), False),
        T.StructField("youtube_video_url", T.StringType(), True),
        T.StructField("youtube_watch_url", T.StringType(), True),
    ]
)

# Tables that a load fills together are partitioned by the load that wrote them.
LOAD_COLUMN = "load_id"
COMMITTED_AT = "committed_at"

LOADED_LINK_SCHEMA = T.StructType([*LINK_SCHEMA.fields, T.StructField(LOAD_COLUMN, T.StringType(), False)])

# One row commits a media load to both of its tables. The counters are those of the load.
COMMIT_SCHEMA = T.StructType(
    [
        T.StructField(LOAD_COLUMN, T.StringType(), False),
        T.StructField("total_rows", T.LongType(), False),
        T.StructField("total_urls_processed", T.LongType(), False),
        T.StructField("successful_scrapes", T.LongType(), False),
        T.StructField("timeouts_inserted", T.LongType(), False),
        T.StructField(COMMITTED_AT, T.TimestampType(), False),
    ]
)

_CREATIVE_FIELDS = [T.StructField("advertiser_id", T.StringType(), False), T.StructField("creative_id", T.StringType(), False)]
_LOAD_FIELD = T.StructField(LOAD_COLUMN, T.StringType(), False)

# The numbered versions; each load adds those it brought.
HISTORY_SCHEMA = T.StructType(
    [
        *_CREATIVE_FIELDS,
        T.StructField("metadata_time", T.TimestampType(), False),
        T.StructField("data_modified", T.TimestampType(), False),
        T.StructField("digest", T.StringType(), False),
        T.StructField("copies", T.LongType(), False),
        T.StructField("version_no", T.LongType(), False),
        T.StructField("changed", T.BooleanType(), False),
        _LOAD_FIELD,
    ]
)

# Where each creative's history stands after a load, and the creative's own number.
STATE_SCHEMA = T.StructType(
    [
        *_CREATIVE_FIELDS,
        T.StructField("last_no", T.LongType(), False),
        T.StructField("last_digest", T.StringType(), False),
        T.StructField("number", T.LongType(), False),
        _LOAD_FIELD,
    ]
)

# What a load adds to the mart: sums in rows without a bucket, and its creatives' numbers as bitmaps in rows with one.
MART_PART_SCHEMA = T.StructType(
    [
        T.StructField("advertiser_id", T.StringType(), True),
        T.StructField("ad_format_type", T.StringType(), True),
        T.StructField("bucket", T.LongType(), True),
        T.StructField("bits", T.BinaryType(), True),
        T.StructField("versions", T.LongType(), True),
        T.StructField("first_shown_date", T.DateType(), True),
        T.StructField("last_shown_date", T.DateType(), True),
        _LOAD_FIELD,
    ]
)

MODEL_COMMIT_SCHEMA = T.StructType(
    [
        _LOAD_FIELD,
        T.StructField("newest_time", T.TimestampType(), False),
        T.StructField("last_number", T.LongType(), False),
        T.StructField(COMMITTED_AT, T.TimestampType(), False),
    ]
)

CODE_SCHEMA = T.StructType(
    [
        T.StructField("email", T.StringType(), False),
        T.StructField("verification_code", T.StringType(), False),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)

RUN_SCHEMA = T.StructType(
    [
        T.StructField("job", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("rows_added", T.LongType(), False),
        T.StructField("started_at", T.TimestampType(), False),
    ]
)
