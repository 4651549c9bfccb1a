"""Hand-made source rows."""

from __future__ import annotations

SOURCE_SCHEMA = (
    "advertiser_id string, creative_id string, creative_page_url string, ad_format_type string, "
    "advertiser_disclosed_name string, advertiser_legal_name string, advertiser_location string, "
    "advertiser_verification_status string, topic string, is_funded_by_google_ad_grants boolean, "
    "region_stats array<struct<region_code:string,first_shown:string,last_shown:string>>, "
    "audience_selection_approach_info struct<approach:string>"
)

MARKET = "SE"


def creative(
    advertiser="AR1",
    number="CR1",
    regions=((MARKET, "2024-01-05", "2024-01-09"),),
    location=MARKET,
    topic="cars",
    legal="Legal",
):
    return (
        advertiser,
        number,
        f"https://ads.example.com/advertiser/{advertiser}/creative/{number}",
        "TEXT",
        "Shown Name",
        legal,
        location,
        "VERIFIED",
        topic,
        False,
        None if regions is None else [None if r is None else tuple(r) for r in regions],
        ("all",),
    )


def source(spark, *rows):
    return spark.createDataFrame(list(rows), SOURCE_SCHEMA)


def raw(spark, *rows):
    """Raw-table rows from (advertiser, creative, text[, day[, load time]])."""
    from datetime import datetime, timezone

    from pyspark.sql import functions as F

    from adstrata.schemas import RAW_COLUMNS

    full = []
    for row in rows:
        advertiser, number, text, day, loaded = (*row, None, None)[:5]
        full.append(
            (
                datetime.fromisoformat(day or "2024-01-05").replace(tzinfo=timezone.utc),
                datetime.fromisoformat(loaded or "2024-02-01").replace(tzinfo=timezone.utc),
                advertiser,
                number,
                text,
            )
        )
    schema = "data_modified timestamp, metadata_time timestamp, advertiser_id string, creative_id string, raw_data string"
    return spark.createDataFrame(full, schema).select(*[F.col(c) for c in RAW_COLUMNS])
