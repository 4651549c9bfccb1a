"""Loads by day window: daily, back-fill, and the last three months."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adstrata.functions.dates import as_day, look_back, yesterday
from adstrata.operators.projection import market_records, raw_rows
from adstrata.operators.pruning import relevant_history
from adstrata.operators.selection import Ids, between_days, id_list, listed
from adstrata.operators.versions import drop_repeats, new_versions
from adstrata.plans.status import IngestStatus
from adstrata.schemas import PARTITION_COLUMN, RUN_SCHEMA
from adstrata.session import stage
from adstrata.sources.tables import TableRef, append, append_raw, check_granularity, ensure_raw_table, with_partition
from adstrata.sources.version_index import VersionIndex

log = logging.getLogger(__name__)

GATES = ("first_shown", "same_as_insert")


@dataclass(frozen=True)
class Target:
    """Where a load goes and how it treats its rows.

    One raw table holds one market. `granularity` is day, month or year; a load with another one than the table's is refused.
    `strict` fails the job on bad days or a repeated market entry; otherwise such rows are left out.
    `drop_repeats` also removes equal rows within a batch. With an `index` of the raw table, loads join that instead of the
    stored rows.
    """

    raw: TableRef
    market: str
    granularity: str = "day"
    strict: bool = True
    drop_repeats: bool = False
    runs: TableRef | None = None
    index: VersionIndex | None = None


@dataclass(frozen=True)
class RunResult:
    job: str
    status: IngestStatus
    rows_added: int


def finish(spark: SparkSession, target: Target, result: RunResult) -> RunResult:
    """Log a run, and record it when there is a table of runs."""
    log.info("%s: %s (%d rows)", result.job, result.status.value, result.rows_added)
    if target.runs is not None:
        now = datetime.now(timezone.utc)
        row = [(result.job, result.status.name, result.rows_added, now)]
        append(spark.createDataFrame(row, RUN_SCHEMA), target.runs, RUN_SCHEMA)
    return result


def load_new(
    candidates: DataFrame,
    target: Target,
    prune: bool = True,
    advertisers: Ids = None,
    gate: Gate | None = None,
) -> int | None:
    """Append the candidate rows whose version is not stored yet; returns how many were added.

    With `prune` the candidates are written out first: they then tell which partitions and creatives
    of the raw table to read back. Without it, for loads that touch nearly all of the table, the
    candidates go straight into the join. `advertisers` names all that the candidates can have; stored rows
    of others are then not compared. A `gate` is asked once the candidates are written; None means it was closed, and
    nothing was compared or added.

    Running it again after a failure adds only what is missing. One writer per table at a time.
    """
    if gate is not None and not prune:
        raise ValueError("a gate needs the candidates to be written first")
    spark = candidates.sparkSession
    if target.drop_repeats:
        candidates = drop_repeats(candidates)
    if not target.strict:
        candidates = candidates.dropna(subset=["data_modified"])
    candidates = with_partition(candidates, target.granularity)
    if prune:
        candidates = stage(candidates, "candidates")
        if gate is not None and not gate.is_open():
            return None
    check_granularity(spark, target.raw, target.granularity)
    if target.index is not None:
        return _load_indexed(candidates if prune else stage(candidates, "candidates"), target)
    stored = target.raw.read_anew(spark)
    if prune:
        stored = relevant_history(stored, candidates)
    elif advertisers is not None:
        stored = listed(stored, advertisers)
    return append_raw(new_versions(candidates, stored, also=[PARTITION_COLUMN]), target.raw)


def _load_indexed(candidates: DataFrame, target: Target) -> int:
    """The same by the table's index. What it appends is written out first, since it goes to both tables."""
    spark, index = candidates.sparkSession, target.index
    index.ensure(spark)
    new = stage(index.new_versions(candidates), "new")
    added = append_raw(new, target.raw)
    if added:
        index.add(new)
        index.note(spark)
    return added


class Gate:
    """Whether a window has any record, found out by the pass that loads it.

    Records are counted on their way to the load, by the day first shown or by the day the load filters on, so the
    source is read once. `is_open` waits for that pass.
    """

    def __init__(self, start: date, end: date, column: str = "first_shown") -> None:
        if column not in GATES:
            raise ValueError(f"gate must be one of {GATES}")
        self._column = "first_shown_date" if column == "first_shown" else "last_shown_date"
        self._days = (start, end)
        self._seen = Observation()

    def watch(self, records: DataFrame) -> DataFrame:
        """The same records; from here on filters stay above, so none of them is lost to the gate."""
        inside = F.col(self._column).between(*map(F.lit, self._days))
        return records.observe(self._seen, F.count_if(inside).alias("inside"))

    def is_open(self) -> bool:
        return self._seen.get.get("inside", 0) > 0


def ingest_window(
    spark: SparkSession,
    source: DataFrame,
    target: Target,
    ids: Ids,
    start: date | str,
    end: date | str,
    *,
    job: str = "window",
    gate: str = "first_shown",
    ingest_time: datetime | None = None,
) -> RunResult:
    """Load the listed advertisers' creatives last shown in the window.

    The gate decides whether there is anything to do. By default it looks at the day first shown, so a
    window with only re-shown creatives counts as empty; `same_as_insert` looks at the day last shown. It is decided by the
    pass that writes the candidates, so the source is read once.
    """
    start, end = as_day(start), as_day(end)
    watched = Gate(start, end, gate)
    if ensure_raw_table(spark, target.raw) is IngestStatus.TABLE_CREATION_FAILED:
        return finish(spark, target, RunResult(job, IngestStatus.TABLE_CREATION_FAILED, 0))
    records = watched.watch(market_records(listed(source, ids), target.market, target.strict))
    window = between_days(records, "last_shown_date", start, end)
    added = load_new(raw_rows(window, ingest_time), target, gate=watched)
    if added is None:
        return finish(spark, target, RunResult(job, IngestStatus.NO_DATA_AVAILABLE, 0))
    status = IngestStatus.DATA_INSERTED if added else IngestStatus.INCOMPLETE_INSERTION
    return finish(spark, target, RunResult(job, status, added))


def daily_ingest(
    spark: SparkSession, source: DataFrame, tracking: DataFrame, target: Target, as_of: date | None = None, **options
) -> RunResult:
    """Yesterday's window for all tracked advertisers."""
    start, end = yesterday(as_of)
    return ingest_window(spark, source, target, tracking.select("advertiser_id"), start, end, job="daily", **options)


def backfill(
    spark: SparkSession, source: DataFrame, target: Target, ids: Ids, start: date | str, end: date | str, **options
) -> RunResult:
    """A window for the given advertisers; ids and both days are required."""
    if not isinstance(ids, DataFrame) and not id_list(ids):
        raise ValueError("advertiser ids are required")
    if not start or not end:
        raise ValueError("both start and end are required")
    return ingest_window(spark, source, target, ids, start, end, **{"job": "backfill", **options})


def three_month_backfill(
    spark: SparkSession, source: DataFrame, target: Target, ids: Ids, as_of: date | None = None, **options
) -> RunResult:
    """The window of the 90 days up to yesterday for the given advertisers."""
    start, end = look_back(as_of)
    return backfill(spark, source, target, ids, start, end, **{"job": "three_months", **options})
