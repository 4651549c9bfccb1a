"""Loads without a day window: all tracked advertisers, or chosen creatives."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from adstrata.operators.projection import market_records, raw_rows
from adstrata.operators.selection import Ids, listed, targeted
from adstrata.plans.ingest import RunResult, Target, finish, load_new
from adstrata.plans.status import IngestStatus, RefreshMode


def _result(spark: SparkSession, target: Target, job: str, added: int) -> RunResult:
    status = IngestStatus.DATA_INSERTED if added else IngestStatus.NO_NEW_UPDATES
    return finish(spark, target, RunResult(job, status, added))


def refresh_all(
    spark: SparkSession,
    source: DataFrame,
    tracking: DataFrame,
    target: Target,
    ingest_time: datetime | None = None,
) -> RunResult:
    """New versions of every creative of the tracked advertisers. The raw table must exist."""
    tracked = tracking.select("advertiser_id")
    records = market_records(listed(source, tracked), target.market, target.strict)
    added = load_new(raw_rows(records, ingest_time), target, prune=False, advertisers=tracked)
    return _result(spark, target, "refresh_all", added)


def refresh_targeted(
    spark: SparkSession,
    source: DataFrame,
    target: Target,
    advertiser_ids: Ids = None,
    creative_ids: Ids = None,
    ingest_time: datetime | None = None,
) -> RunResult:
    """New versions of the listed advertisers' and the listed creatives, tracked or not."""
    records = market_records(targeted(source, advertiser_ids, creative_ids), target.market, target.strict)
    added = load_new(raw_rows(records, ingest_time), target)
    return _result(spark, target, "refresh_targeted", added)


def refresh(
    spark: SparkSession,
    mode: RefreshMode | str,
    source: DataFrame,
    tracking: DataFrame,
    target: Target,
    advertiser_ids: Ids = None,
    creative_ids: Ids = None,
    ingest_time: datetime | None = None,
) -> RunResult:
    """Refresh by mode: `all`, or `specific` with at least one list of ids."""
    if RefreshMode(mode) is RefreshMode.ALL:
        return refresh_all(spark, source, tracking, target, ingest_time)
    return refresh_targeted(spark, source, target, advertiser_ids, creative_ids, ingest_time)
