"""Outcome of looking for an embedded video in stored creative pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstrata.functions.links import VIDEO_HOST, video_frame, watch_url
from adstrata.functions.values import once
from adstrata.schemas import LINK_SCHEMA, PAGE_COLUMNS


def pages_to_read(pages: DataFrame, advertiser_id: str | None = None) -> DataFrame:
    """Pages with both ids and an address, of one advertiser or of all."""
    if advertiser_id is not None:
        pages = pages.filter(F.col("advertiser_id") == advertiser_id)
    return pages.dropna(subset=list(PAGE_COLUMNS))


def page_outcomes(pages: DataFrame, host: str = VIDEO_HOST) -> DataFrame:
    """Each page's video URL, watch URL and outcome; the HTML is left behind.

    skipped: empty address. timeout: the page was not fetched (NULL HTML). no_video: no frame from the
    host. convert_failed: a frame without a video id. video: the rest.
    """
    address = F.length("creative_page_url") > 0
    frame = video_frame(F.col("creative_page_url"), F.col("html"), host)
    fetched = pages.withColumn(
        "youtube_video_url", once(F.when(address & F.col("html").isNotNull(), frame))
    ).withColumn("youtube_watch_url", watch_url(F.col("youtube_video_url")))
    outcome = (
        F.when(~address, "skipped")
        .when(F.col("html").isNull(), "timeout")
        .when(F.col("youtube_video_url").isNull(), "no_video")
        .when(F.col("youtube_watch_url").isNull(), "convert_failed")
        .otherwise("video")
    )
    return fetched.select(*LINK_SCHEMA.names, outcome.alias("outcome"))


def links(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("outcome") == "video").select(*LINK_SCHEMA.names)


def timeouts(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("outcome") == "timeout").select(*LINK_SCHEMA.names)


def counters(outcomes: DataFrame, *by: str) -> DataFrame:
    """Rows, rows processed, videos found (converted or not) and timeouts."""
    outcome = F.col("outcome")
    return outcomes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(F.lit(1)).alias("total_urls_processed"),
        F.count_if(outcome.isin("video", "convert_failed")).alias("successful_scrapes"),
        F.count_if(outcome == "timeout").alias("timeouts_inserted"),
    )
