import json
import os
from collections import Counter
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

import pytest
from builders import MARKET, creative, raw, source
from pyspark.sql import functions as F

from adstrata.operators.codes import check_codes
from adstrata.operators.media import page_outcomes
from adstrata.operators.projection import market_records, raw_rows, unusable_records
from adstrata.operators.pruning import relevant_history
from adstrata.plans import codes as code_plans
from adstrata.plans import ingest, marts, refresh
from adstrata.plans.media import MediaResult, MediaTables, advertiser_ids_of_links, media_links_job
from adstrata.plans.status import IngestStatus, RefreshMode
from adstrata.schemas import CODE_SCHEMA, LOAD_COLUMN, LOADED_LINK_SCHEMA, PARTITION_COLUMN, RAW_COLUMNS, RAW_SCHEMA
from adstrata.sources import commits, rewrite
from adstrata.sources.config import Environment, load_environment
from adstrata.sources.tables import RAW_OPTIONS, TableRef, append, append_raw, ensure_raw_table, replace_partition, with_partition
from adstrata.streaming.codes import append_once, check_joined_streams, check_stream
from adstrata.streaming.ingest import ingest_stream, stream_creatives

S = IngestStatus


def on(first, last, **other):
    return creative(regions=((MARKET, first, last),), **other)


@pytest.fixture
def target(new_table):
    return ingest.Target(raw=new_table("raw"), market=MARKET, runs=new_table("runs"))


@pytest.fixture
def tracking(spark):
    return spark.createDataFrame([("AR1",), ("AR2",), ("AR2",)], "advertiser_id string")


def stored(spark, target):
    return Counter(tuple(r) for r in target.raw.read(spark).select("advertiser_id", "creative_id").collect())


# --- the raw table ---


def test_table_statuses(spark, new_table):
    table = new_table()
    assert ensure_raw_table(spark, table) is S.TABLE_CREATED
    assert ensure_raw_table(spark, table) is S.TABLE_EXISTS
    assert ensure_raw_table(spark, TableRef("unwritable", "/proc/no-such-folder/t")) is S.TABLE_CREATION_FAILED
    assert table.read(spark).columns == RAW_SCHEMA.names


def test_a_load_with_another_granularity_is_refused(spark, target, tracking):
    ensure_raw_table(spark, target.raw)
    rows = raw(spark, ("AR1", "CR1", "t", "2024-01-05"))
    assert ingest.load_new(rows, target) == 1
    with pytest.raises(ValueError, match="partitioned by day"):
        ingest.load_new(rows, replace(target, granularity="year"))
    assert ingest.load_new(rows, target) == 0 and target.raw.read(spark).count() == 1


def test_append_counts_and_lays_out_rows(spark, new_table):
    table = new_table()
    ensure_raw_table(spark, table)
    rows = [(f"A{i % 5}", f"C{i}", f"t{i}", f"2024-01-0{1 + i % 3}") for i in range(60)]
    assert append_raw(with_partition(raw(spark, *rows)), table) == 60
    assert append_raw(with_partition(raw(spark, *rows)).limit(0), table) == 0
    days = sorted(d for d in os.listdir(table.location) if d.startswith(PARTITION_COLUMN))
    assert days == [f"{PARTITION_COLUMN}=2024-01-0{d}" for d in (1, 2, 3)]
    for day in days:
        files = [f for f in os.listdir(f"{table.location}/{day}") if f.endswith(".parquet")]
        assert len(files) == 1
        import pyarrow.parquet as pq

        written = pq.read_table(f"{table.location}/{day}/{files[0]}", partitioning=None)
        keys = list(zip(written["advertiser_id"].to_pylist(), written["creative_id"].to_pylist()))
        assert keys == sorted(keys)


def rows_scanned(df):
    """The rows that the only scan of a plan gave out, once it has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if hasattr(plan, "isFinalPlan") and "Adaptive" in plan.getClass().getName() else plan
    return plan.collectLeaves().head().metrics().get("numOutputRows").get().value()


def test_a_targeted_read_skips_row_groups(spark, new_table):
    """Every advertiser has creatives of all ranges, so bounds don't help; each creative is in one row group of many."""
    rows = spark.range(60_000).select(
        F.expr("timestamp'2024-01-05'").alias("data_modified"), F.expr("timestamp'2024-02-01'").alias("metadata_time"),
        F.format_string("AR%04d", F.col("id") % 40).alias("advertiser_id"), F.md5(F.col("id").cast("string")).alias("creative_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("raw_data"),
    )
    wanted = [r.creative_id for r in rows.filter("id in (7, 30011)").collect()]
    read = {}
    for bloom in (True, False):
        table = new_table("raw")
        small = {"parquet.block.size": "500000", "parquet.page.row.count.limit": "1000", "parquet.block.row.count.limit": "2000"}
        table.create(spark, RAW_SCHEMA, PARTITION_COLUMN, {**small, **(RAW_OPTIONS if bloom else {})})
        append_raw(with_partition(rows), table)
        found = table.read(spark).filter(F.col("creative_id").isin(wanted))
        read[bloom] = rows_scanned(found)
        assert found.count() == 2
    assert read[True] <= 2 * 2_000 < 20_000 < read[False]


def test_few_creatives_are_named_to_the_reader(spark, target):
    ensure_raw_table(spark, target.raw)
    batch = with_partition(raw(spark, ("AR1", "CR1", "t"), ("AR1", "CR2", "t")))
    plan = relevant_history(target.raw.read(spark), batch)._jdf.queryExecution().executedPlan().toString()
    assert " IN (CR1,CR2)" in plan or " IN (CR2,CR1)" in plan
    many = with_partition(raw(spark, *[("AR1", f"CR{n}", "t") for n in range(150)]))
    assert " IN (CR" not in relevant_history(target.raw.read(spark), many)._jdf.queryExecution().executedPlan().toString()


def test_month_partitions(spark, new_table):
    table = new_table()
    ensure_raw_table(spark, table)
    append_raw(with_partition(raw(spark, ("A", "1", "t", "2024-01-05"), ("A", "2", "t", "2024-01-25")), "month"), table)
    assert [r[0] for r in table.read(spark).select(PARTITION_COLUMN).distinct().collect()] == [date(2024, 1, 1)]


def test_a_table_over_existing_files_has_their_rows(spark, new_table):
    table = new_table()
    ensure_raw_table(spark, table)
    append_raw(with_partition(raw(spark, ("A", "1", "t"))), table)
    again = TableRef(f"{table.name}_again", table.location)
    assert ensure_raw_table(spark, again) is S.TABLE_CREATED
    assert again.read(spark).count() == 1


def test_rows_appended_by_others_are_seen(spark, target):
    """Files that appear in a known partition without this session's doing."""
    df = source(spark, creative(), creative(number="CR2"))
    window = ("AR1", "2024-01-01", "2024-01-31")
    ingest.backfill(spark, source(spark, creative()), target, *window)
    target.raw.read(spark).count()
    records = market_records(df, MARKET)
    unseen = with_partition(raw_rows(records.filter("creative_id = 'CR2'")))
    unseen.write.mode("append").partitionBy(PARTITION_COLUMN).parquet(target.raw.location)
    assert ingest.backfill(spark, df, target, *window).rows_added == 0


@pytest.mark.parametrize("column", RAW_COLUMNS)
def test_append_refuses_nulls(spark, new_table, column):
    table = new_table()
    ensure_raw_table(spark, table)
    good = with_partition(raw(spark, ("A", "1", "t")))
    with pytest.raises(Exception, match="required column"):
        append_raw(good.withColumn(column, F.lit(None).cast(good.schema[column].dataType)), table)
    assert table.read(spark).count() == 0


def test_tables_without_a_location(spark):
    table = TableRef("loads.raw_creatives")
    assert ensure_raw_table(spark, table) is S.TABLE_CREATED
    assert append_raw(with_partition(raw(spark, ("A", "1", "t"))), table) == 1
    assert table.read(spark).count() == 1


# --- loads by window ---


def test_daily(spark, target, tracking):
    df = source(
        spark,
        on("2024-01-05", "2024-01-05", number="yesterday"),
        on("2024-01-05", "2024-01-05", number="untracked", advertiser="AR9"),
        on("2024-01-05", "2024-01-06", number="still-shown"),
        on("2024-01-01", "2024-01-05", number="reshown", advertiser="AR2"),
    )
    when = datetime(2024, 1, 6, 3, tzinfo=timezone.utc)
    result = ingest.daily_ingest(spark, df, tracking, target, as_of=date(2024, 1, 6), ingest_time=when)
    assert (result.status, result.rows_added) == (S.DATA_INSERTED, 2)
    assert stored(spark, target) == Counter([("AR1", "yesterday"), ("AR2", "reshown")])
    again = ingest.daily_ingest(spark, df, tracking, target, as_of=date(2024, 1, 6))
    assert (again.status, again.rows_added) == (S.INCOMPLETE_INSERTION, 0)
    quiet = ingest.daily_ingest(spark, df, tracking, target, as_of=date(2024, 3, 1))
    assert (quiet.status, quiet.rows_added) == (S.NO_DATA_AVAILABLE, 0)
    log = [tuple(r) for r in target.runs.read(spark).orderBy("started_at").select("job", "status", "rows_added").collect()]
    assert log == [("daily", "DATA_INSERTED", 2), ("daily", "INCOMPLETE_INSERTION", 0), ("daily", "NO_DATA_AVAILABLE", 0)]


def test_gates_differ_for_a_window_with_only_reshown_creatives(spark, target):
    df = source(spark, on("2024-01-01", "2024-01-05"))
    window = (spark, df, target, "AR1", "2024-01-05", "2024-01-05")
    assert ingest.backfill(*window).status is S.NO_DATA_AVAILABLE
    assert ingest.backfill(*window, gate="same_as_insert").status is S.DATA_INSERTED
    with pytest.raises(ValueError):
        ingest.backfill(*window, gate="other")


def test_gate_open_without_rows_to_load(spark, target):
    df = source(spark, on("2024-01-05", "2024-01-09"))
    assert ingest.backfill(spark, df, target, "AR1", "2024-01-05", "2024-01-05").status is S.INCOMPLETE_INSERTION


@pytest.mark.parametrize("gate", ["first_shown", "same_as_insert"])
def test_a_window_reads_the_source_once(spark, new_table, gate):
    """Gate open with new rows, with known ones, with none in the window, and closed: every row is read once each time."""
    df = source(spark, *[on(f"2024-01-{d:02}", f"2024-02-{d:02}", number=f"CR{d}") for d in range(1, 29)])
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(advertiser):
        read.add(1)
        return advertiser

    watched = df.withColumn("advertiser_id", counted.asNondeterministic()("advertiser_id"))
    target = ingest.Target(raw=new_table("raw"), market=MARKET)
    statuses = []
    for start, end in (("2024-01-20", "2024-02-10"), ("2024-01-20", "2024-02-10"), ("2024-01-05", "2024-01-09"), ("2024-05-01", "2024-05-02")):
        before = read.value
        statuses.append(ingest.backfill(spark, watched, target, ["AR1"], start, end, gate=gate).status)
        assert read.value - before == 28
    third = S.INCOMPLETE_INSERTION if gate == "first_shown" else S.NO_DATA_AVAILABLE
    assert statuses == [S.DATA_INSERTED, S.INCOMPLETE_INSERTION, third, S.NO_DATA_AVAILABLE]
    assert sum(stored(spark, target).values()) == 10


def test_a_closed_gate_leaves_the_table_as_it_was(spark, target):
    """Re-shown creatives are in the window, but the gate looks at the day first shown."""
    df = source(spark, on("2024-01-01", "2024-01-05"))
    assert ingest.backfill(spark, df, target, "AR1", "2024-01-05", "2024-01-05").status is S.NO_DATA_AVAILABLE
    assert target.raw.read_anew(spark).count() == 0
    assert ingest.backfill(spark, df.limit(0), target, "AR1", "2024-01-05", "2024-01-05").status is S.NO_DATA_AVAILABLE
    with pytest.raises(ValueError, match="written first"):
        ingest.load_new(raw(spark, ("A", "1", "t")), target, prune=False, gate=ingest.Gate(date(2024, 1, 1), date(2024, 1, 2)))


def test_backfill_arguments(spark, target):
    df = source(spark, creative())
    for ids, start, end in (([], "2024-01-01", "2024-01-02"), ("AR1", None, "2024-01-02"), ("AR1", "2024-1-1", "2024-01-02")):
        with pytest.raises(ValueError):
            ingest.backfill(spark, df, target, ids, start, end)
    assert not target.raw.exists(spark)


def test_a_changed_creative_becomes_a_new_version(spark, target):
    def load(topic):
        return ingest.backfill(spark, source(spark, creative(topic=topic)), target, ["AR1"], "2024-01-01", "2024-01-31")

    assert [load(t).rows_added for t in ("cars", "cars", "boats", "cars", "boats")] == [1, 0, 1, 0, 0]
    assert stored(spark, target) == Counter({("AR1", "CR1"): 2})


def test_adjacent_windows_equal_their_union(spark, new_table):
    df = source(spark, *[on("2024-01-01", f"2024-01-{d:02}", number=f"CR{d}") for d in range(1, 29)])
    parts, whole = (ingest.Target(raw=new_table("raw"), market=MARKET) for _ in range(2))
    for start, end in (("2024-01-03", "2024-01-10"), ("2024-01-11", "2024-01-20")):
        ingest.backfill(spark, df, parts, "AR1", start, end, gate="same_as_insert")
    ingest.backfill(spark, df, whole, "AR1", "2024-01-03", "2024-01-20", gate="same_as_insert")
    assert stored(spark, parts) == stored(spark, whole)
    assert sum(stored(spark, whole).values()) == 18


def test_three_months(spark, target):
    df = source(
        spark,
        on("2024-01-01", "2023-12-31", number="first-day"),
        on("2024-01-01", "2024-03-30", number="last-day"),
        on("2024-01-01", "2024-03-31", number="today"),
        on("2023-12-01", "2023-12-30", number="too-old"),
    )
    result = ingest.three_month_backfill(spark, df, target, "AR1", as_of=date(2024, 3, 31))
    assert result.rows_added == 2
    assert stored(spark, target) == Counter([("AR1", "first-day"), ("AR1", "last-day")])


def test_table_that_cannot_be_made(spark):
    broken = ingest.Target(raw=TableRef("unwritable", "/proc/no-such-folder/t"), market=MARKET)
    assert ingest.backfill(spark, source(spark, creative()), broken, "AR1", "2024-01-01", "2024-01-31").status is S.TABLE_CREATION_FAILED


def test_repeats_in_a_batch(spark, new_table):
    df = source(spark, creative(), creative())
    kept = ingest.Target(raw=new_table("raw"), market=MARKET)
    dropped = ingest.Target(raw=new_table("raw"), market=MARKET, drop_repeats=True)
    window = ("AR1", "2024-01-01", "2024-01-31")
    assert ingest.backfill(spark, df, kept, *window).rows_added == 2
    assert ingest.backfill(spark, df, dropped, *window).rows_added == 1


def test_strict_and_lenient_targets(spark, new_table):
    df = source(spark, creative(), on("2024-1-5", "2024-01-09", number="bad"))
    window = ("AR1", "2024-01-01", "2024-01-31")
    lenient = ingest.Target(raw=new_table("raw"), market=MARKET, strict=False)
    assert ingest.backfill(spark, df, lenient, *window).rows_added == 1
    with pytest.raises(Exception, match="not a yyyy-MM-dd"):
        ingest.backfill(spark, df, ingest.Target(raw=new_table("raw"), market=MARKET), *window)


# --- refreshes ---


def test_refresh(spark, target, tracking):
    df = source(
        spark,
        on("2020-01-05", "2020-01-09", number="old"),
        on("2024-01-05", "2024-01-09", number="new", advertiser="AR2"),
        on("2024-01-05", "2024-01-09", number="untracked", advertiser="AR9"),
        on("2024-01-05", "2024-01-09", number="also-untracked", advertiser="AR9"),
    )
    ensure_raw_table(spark, target.raw)
    everything = (spark, "all", df, tracking, target)
    assert refresh.refresh(*everything).rows_added == 2
    again = refresh.refresh(*everything)
    assert (again.status, again.rows_added) == (S.NO_NEW_UPDATES, 0)
    chosen = refresh.refresh(spark, RefreshMode.SPECIFIC, df, tracking, target, ["AR1"], ["untracked"])
    assert (chosen.status, chosen.rows_added) == (S.DATA_INSERTED, 1)
    assert refresh.refresh(spark, "specific", df, tracking, target, creative_ids=["untracked"]).status is S.NO_NEW_UPDATES
    for mode, ids in (("specific", []), ("other", ["AR1"])):
        with pytest.raises(ValueError):
            refresh.refresh(spark, mode, df, tracking, target, ids)


def test_refresh_needs_the_table(spark, target, tracking):
    with pytest.raises(Exception):
        refresh.refresh(spark, "all", source(spark, creative()), tracking, target)


# --- streams ---


def test_stream_equals_batch_and_can_be_replayed(spark, new_table, tracking, tmp_path):
    first = source(spark, creative(number="1"), creative(number="2"), creative(number="3", advertiser="AR9"))
    second = source(spark, creative(number="2"), creative(number="4"))
    folder = str(tmp_path / "source")
    first.coalesce(1).write.mode("append").parquet(folder)
    second.coalesce(1).write.mode("append").parquet(folder)

    streamed, batch = (ingest.Target(raw=new_table("raw"), market=MARKET) for _ in range(2))
    for checkpoint in ("a", "b"):  # The second run starts anew and meets its own rows.
        stream = stream_creatives(spark, folder, first.schema, max_files_per_trigger=1)
        query = ingest_stream(stream, lambda: tracking, streamed, str(tmp_path / checkpoint))
        query.awaitTermination()
        assert query.exception() is None
        assert len([p for p in query.recentProgress if p["numInputRows"]]) == 2

    ensure_raw_table(spark, batch.raw)
    refresh.refresh_all(spark, first, tracking, batch)
    refresh.refresh_all(spark, second, tracking, batch)
    assert stored(spark, streamed) == stored(spark, batch) == Counter([("AR1", "1"), ("AR1", "2"), ("AR1", "4")])


def test_attempts_checked_as_they_arrive(spark, new_table, tmp_path):
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    made = new_table("codes")
    assert code_plans.store_code(spark, made, "a@b.c", "1", start)
    tried = spark.createDataFrame(
        [("a@b.c", "1", start), ("a@b.c", "2", start), ("x@y.z", "1", start)],
        "email string, verification_code string, attempted_at timestamp",
    )
    folder, results = str(tmp_path / "attempts"), new_table("results")
    tried.write.parquet(folder)
    stream = spark.readStream.schema(tried.schema).parquet(folder)
    check_stream(stream, lambda: made.read(spark), results, str(tmp_path / "c")).awaitTermination()
    assert sorted(r.status for r in results.read(spark).collect()) == ["invalid_code", "unknown_email", "verified"]


def test_a_stream_without_a_table_is_not_started(spark, tracking, tmp_path):
    source(spark, creative()).write.parquet(str(tmp_path / "in"))
    stream = stream_creatives(spark, str(tmp_path / "in"), source(spark).schema)
    unmade = ingest.Target(raw=TableRef("unwritable_too", "/proc/no-such-folder/t"), market=MARKET)
    with pytest.raises(RuntimeError, match="could not create"):
        ingest_stream(stream, lambda: tracking, unmade, str(tmp_path / "state"))


def test_codes_and_attempts_as_two_streams(spark, new_table, tmp_path):
    """Results equal the batch check; what is held does not grow with the streams; an attempt that is too late is dropped."""
    at = lambda minutes: datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(minutes=minutes)
    made = [(f"u{i % 30}", str(i % 7), at(5 * i)) for i in range(120)] + [("u1", "0", at(5)), ("u1", "6", at(7))]
    tries = [(i, f"u{i % 30}", str(i % 7 if i % 4 else 9), at(5 * i + i % 25)) for i in range(120)]
    tries += [(200, None, "1", at(30)), (201, "u3", "", at(300)), (202, "nobody", "1", at(301)), (203, "u1", "6", at(8)), (204, "u2", "2", at(20))]
    codes_schema, tries_schema = "email string, verification_code string, created_at timestamp", "attempt_id long, email string, verification_code string, attempted_at timestamp"

    def folder(name, rows, schema, end):
        path = str(tmp_path / name)
        steps = [[r for r in rows if at(150 * n) <= r[-1] < at(150 * (n + 1))] for n in range(5)]
        for part in [*steps, *end]:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)

    late = (300, "u1", "1", at(6))
    attempts = folder("attempts", tries, tries_schema, [[(-1, "end", "", at(5000))], [late], [(-2, "end", "", at(5001))]])
    codes = folder("codes", made, codes_schema, [[("end", "", at(5000))], [("end", "", at(5001))], [("end", "", at(5002))]])
    known = spark.createDataFrame(made, codes_schema)
    results = new_table("checked")
    run = check_joined_streams(attempts, codes, lambda: known, results, str(tmp_path / "state"))
    run.awaitTermination()
    got = Counter((r.attempt_id, r.status) for r in results.read(spark).collect())
    want = Counter((r.attempt_id, r.status) for r in check_codes(spark.createDataFrame(tries, tries_schema), known).collect())
    assert got == want and set(Counter(s for _, s in want)) == {"verified", "invalid_code", "expired", "unknown_email", "missing_input"}
    joins = [op for p in run.recentProgress for op in p["stateOperators"] if op["operatorName"] == "symmetricHashJoin"]
    assert 30 < max(op["numRowsTotal"] for op in joins) < 160  # of 247
    assert sum(op["numRowsDroppedByWatermark"] for op in joins) == 1


def test_a_batch_that_comes_again_is_stored_once(spark, new_table):
    rows, results = spark.range(3), new_table("results")
    assert append_once(rows, results, "s", 0) and not append_once(rows, results, "s", 0)
    assert append_once(rows, results, "s", 1) and append_once(rows, results, "other", 0)
    assert results.read_anew(spark).count() == 9


# --- records that can't be stored ---

DAMAGED = {
    "more than one entry": ((MARKET, "2024-01-05", "2024-01-09"), (MARKET, "2024-02-05", "2024-02-09")),
    "first_shown": ((MARKET, "2024-1-5", "2024-01-09"),),
    "last_shown": ((MARKET, "2024-01-05", "garbage"),),
}


@pytest.mark.parametrize("load", ["window", "refresh"])
@pytest.mark.parametrize("reason", DAMAGED)
def test_what_the_report_lists_is_not_stored(spark, new_table, load, reason):
    df = source(spark, creative(number="bad", regions=DAMAGED[reason]))
    advertisers = df.select("advertiser_id")

    def added(strict):
        target = ingest.Target(new_table("raw"), MARKET, strict=strict)
        ensure_raw_table(spark, target.raw)
        if load == "refresh":
            return refresh.refresh_all(spark, df, advertisers, target).rows_added
        return ingest.backfill(spark, df, target, advertisers, "2024-01-01", "2024-12-31").rows_added

    listed_for = [r.reason for r in unusable_records(df, MARKET, load).collect()]
    if (load, reason) == ("refresh", "last_shown"):
        assert listed_for == [] and added(strict=False) == added(strict=True) == 1
    else:
        assert listed_for == [reason] and added(strict=False) == 0
        with pytest.raises(Exception):
            added(strict=True)


# --- media, codes, marts ---


def test_media_job(spark, new_table):
    pages = spark.createDataFrame(
        [
            ("AR1", "1", "https://p/1", '<iframe src="https://www.youtube.com/embed/v1">'),
            ("AR1", "2", "https://p/2", None),
            ("AR1", "3", "https://p/3", '<iframe src="https://www.youtube.com/watch?v=q">'),
            ("AR1", "4", "", None),
            ("AR2", "5", "https://p/5", None),
        ],
        "Advertiser_ID string, Creative_ID string, Creative_Page_URL string, html string",
    )
    tables = MediaTables(new_table("links"), new_table("timeouts"), new_table("loads"))
    assert media_links_job(spark, pages, tables, "AR1") == MediaResult(4, 4, 2, 1)
    assert [r.creative_id for r in tables.read_links(spark).collect()] == ["1"]
    assert [r.creative_id for r in tables.read_timeouts(spark).collect()] == ["2"]
    assert media_links_job(spark, pages, tables) == MediaResult(5, 5, 2, 2)
    assert tables.read_links(spark).count() == 2 and tables.read_timeouts(spark).count() == 3
    assert media_links_job(spark, pages, tables, "AR-none") == MediaResult(0, 0, 0, 0)


MEDIA_PAGES = [
    ("AR1", "1", "https://p/1", '<iframe src="https://www.youtube.com/embed/v1">'),
    ("AR1", "2", "https://p/2", None),
    ("AR2", "3", "https://p/3", '<iframe src="https://www.youtube.com/embed/v3">'),
    ("AR2", "4", "https://p/4", None),
]


@pytest.fixture
def media(spark, new_table):
    pages = spark.createDataFrame(MEDIA_PAGES, "advertiser_id string, creative_id string, creative_page_url string, html string")
    return pages, MediaTables(new_table("links"), new_table("timeouts"), new_table("loads"))


def seen(spark, tables):
    return [sorted(r.creative_id for r in read(spark).collect()) for read in (tables.read_links, tables.read_timeouts)]


def test_a_media_load_run_again_adds_nothing(spark, media):
    pages, tables = media
    first = media_links_job(spark, pages, tables)
    files = sorted(tables.links.read_anew(spark).inputFiles())
    assert media_links_job(spark, pages.repartition(3), tables) == first == MediaResult(4, 4, 2, 2)
    assert seen(spark, tables) == [["1", "3"], ["2", "4"]] and sorted(tables.links.read_anew(spark).inputFiles()) == files
    # The same pages once more under an id of their own are another load.
    media_links_job(spark, pages.filter("advertiser_id = 'AR1'"), tables, load_id="again")
    assert media_links_job(spark, pages, tables, load_id="again") == MediaResult(2, 2, 1, 1)
    assert seen(spark, tables) == [["1", "1", "3"], ["2", "2", "4"]]
    with pytest.raises(ValueError, match="load id"):
        media_links_job(spark, pages, tables, load_id="a/b'")


@pytest.mark.parametrize("stops_at", ["timeouts", "commit"])
def test_a_failure_between_the_writes_shows_neither(spark, media, monkeypatch, stops_at):
    pages, tables = media
    media_links_job(spark, pages.filter("advertiser_id = 'AR1'"), tables, load_id="first")
    with monkeypatch.context() as patched:
        if stops_at == "timeouts":

            def write(rows, table, *args):
                if table is tables.timeouts:
                    raise OSError("disk full")
                replace_partition(rows, table, *args)

            patched.setattr(commits, "replace_partition", write)
        else:

            def refuse(*_):
                raise OSError("disk full")

            patched.setattr(commits, "append", refuse)
        with pytest.raises(OSError):
            media_links_job(spark, pages.filter("advertiser_id = 'AR2'"), tables, load_id="second")
    assert tables.links.read_anew(spark).count() == 2
    assert seen(spark, tables) == [["1"], ["2"]]
    assert media_links_job(spark, pages.filter("advertiser_id = 'AR2'"), tables, load_id="second") == MediaResult(2, 2, 1, 1)
    assert seen(spark, tables) == [["1", "3"], ["2", "4"]] and tables.links.read_anew(spark).count() == 2


def test_what_uncommitted_loads_left_can_be_removed(spark, media):
    pages, tables = media
    media_links_job(spark, pages, tables, load_id="whole")
    rows = tables.read_links(spark).drop(LOAD_COLUMN)
    replace_partition(rows, tables.links, LOADED_LINK_SCHEMA, LOAD_COLUMN, "lost")
    # Files whose partition the catalog never got, as a crash may leave them.
    rows.write.parquet(f"{tables.timeouts.folder(spark)}/{LOAD_COLUMN}=half")
    replace_partition(rows.limit(1), tables.timeouts, LOADED_LINK_SCHEMA, LOAD_COLUMN, "half")
    assert tables.timeouts.read_anew(spark).filter("load_id = 'half'").count() == 1
    assert tables.sweep(spark) == ["half", "lost"] and tables.sweep(spark) == []
    assert tables.links.read_anew(spark).count() == 2 and seen(spark, tables) == [["1", "3"], ["2", "4"]]


def test_outcomes_do_not_carry_the_page(spark):
    pages = spark.createDataFrame([("a", "b", "c", "d")], "advertiser_id string, creative_id string, creative_page_url string, html string")
    assert "html" not in page_outcomes(pages).columns


def test_advertiser_of_landing_link(spark):
    urls = spark.createDataFrame([("https://h/advertiser/AR1",), ("https://h/a",)], "url string")
    assert [r.advertiser_id for r in advertiser_ids_of_links(urls).collect()] == ["AR1", None]


def test_store_codes(spark, new_table):
    table = new_table("codes")
    assert code_plans.store_code(spark, table, "a@b.c", "1")
    bad = spark.createDataFrame([("a@b.c", "2", None), ("a@b.c", None, None)], CODE_SCHEMA.simpleString()[7:-1].replace(":", " "))
    assert not code_plans.store_codes(bad, table)
    assert table.read(spark).count() == 1


def stored_files(spark, table):
    """Names of the table's files, and the addresses in each, as they are on disk."""
    rows = spark.read.schema(CODE_SCHEMA).parquet(table.folder(spark)).select("email", "_metadata.file_name").collect()
    held = {name: set() for name in os.listdir(table.location) if name.endswith(".parquet")}
    for row in rows:
        held[row.file_name].add(row.email)
    return held


@pytest.fixture
def codes_table(spark, new_table):
    table = new_table("codes")
    made = datetime(2024, 1, 1, tzinfo=timezone.utc)
    for group in ("ab", "cd", "ef", "ca"):
        rows = [(f"{x}@x.y z%20" if x == "f" else f"{x}@x.y", str(i), made) for x in group for i in range(3)]
        assert code_plans.store_codes(spark.createDataFrame(rows, CODE_SCHEMA).coalesce(1), table)
    return table


def emails(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "email string")


def test_forget_codes(spark, codes_table):
    before = stored_files(spark, codes_table)
    assert code_plans.forget_codes(emails(spark, "c@x.y", "c@x.y", None, "unknown"), codes_table) == 2
    after = stored_files(spark, codes_table)
    untouched = {name for name, held in before.items() if "c@x.y" not in held}
    assert len(before) - len(untouched) == 2 and untouched == set(before) & set(after)
    assert not any("c@x.y" in held for held in after.values())
    kept = Counter(r.email for r in code_plans.stored_codes(spark, codes_table).collect())
    assert kept == Counter({"a@x.y": 6, "b@x.y": 3, "d@x.y": 3, "e@x.y": 3, "f@x.y z%20": 3})
    assert code_plans.forget_codes(emails(spark, "c@x.y"), codes_table) == 0
    assert stored_files(spark, codes_table) == after
    assert code_plans.store_code(spark, codes_table, "c@x.y", "2")
    assert code_plans.stored_codes(spark, codes_table).count() == 19
    assert not [n for n in os.listdir(codes_table.location) if n.startswith("_rewrite")]


def test_forget_all_codes(spark, codes_table):
    everyone = codes_table.read(spark).select("email")
    assert code_plans.forget_codes(everyone, codes_table) == 4
    assert code_plans.stored_codes(spark, codes_table).count() == 0
    assert code_plans.store_code(spark, codes_table, "a@x.y", "2") and codes_table.read_anew(spark).count() == 1


@pytest.mark.parametrize("stops_at", ["rows", "files", "first move", "second removal"])
def test_a_delete_that_stops_half_way(spark, codes_table, monkeypatch, stops_at):
    """Before the names are complete nothing has happened; after, the next reader finishes the switch."""
    gone, calls = emails(spark, "c@x.y", "e@x.y"), Counter()

    def failing(original, name, at):
        def call(self, *args):
            calls[name] += 1
            if calls[name] == at:
                raise OSError("stopped")
            return original(self, *args)

        return call

    with monkeypatch.context() as patched:
        if stops_at in ("rows", "files"):
            writer = type(spark.range(1).write)
            original = writer.parquet

            def parquet(self, path, *args, **kwargs):
                if path.endswith(f"/{stops_at}") and "_rewrite-" in path:
                    if stops_at == "files":
                        original(self, path)
                        os.remove(f"{path.removeprefix('file:')}/_SUCCESS")
                    raise OSError("stopped")
                return original(self, path, *args, **kwargs)

            patched.setattr(writer, "parquet", parquet)
        elif stops_at == "first move":
            patched.setattr(rewrite.Folder, "move_up", failing(rewrite.Folder.move_up, "move", 1))
        else:
            patched.setattr(rewrite.Folder, "remove_file", failing(rewrite.Folder.remove_file, "remove", 2))
        with pytest.raises(OSError, match="stopped"):
            code_plans.forget_codes(gone, codes_table)
    left = code_plans.stored_codes(spark, codes_table)
    done = stops_at not in ("rows", "files")
    assert left.count() == (24 - 6 - 3 if done else 24)
    assert (left.filter("email in ('c@x.y', 'e@x.y')").count() == 0) == done
    assert not [n for n in os.listdir(codes_table.location) if n.startswith("_rewrite")]
    assert code_plans.forget_codes(gone, codes_table) == (0 if done else 3)
    assert code_plans.stored_codes(spark, codes_table).count() == 15


def test_staging_of_another_source(spark):
    texts = spark.createDataFrame([('{"page":"p","likes":3}',)], "raw_data string").select(
        F.current_timestamp().alias("data_modified"), F.current_timestamp().alias("metadata_time"), "raw_data"
    )
    schema = spark.createDataFrame([], "page string, likes int").schema
    row = marts.staging(texts, schema, ["page", "likes"]).first()
    assert (row.page, row.likes) == ("p", 3)


def test_staging_and_mart(spark, new_table):
    first = source(spark, on("2024-01-05", "2024-01-09"), on("2024-01-02", "2024-01-03", number="CR2"))
    second = source(spark, on("2024-01-05", "2024-02-01"))
    target = ingest.Target(raw=new_table("raw"), market=MARKET)
    for df in (first, second):
        ingest.backfill(spark, df, target, "AR1", "2024-01-01", "2024-02-28")
    schema = marts.record_schema(first.schema)
    marts.publish_staging(target.raw.read(spark), schema, "stg_creatives")
    staged = spark.table("stg_creatives")
    assert staged.filter("creative_id = 'CR2'").first().audience_selection_approach_info.approach == "all"
    mart = new_table("mart")
    for _ in range(2):
        marts.publish_mart(marts.creatives_mart(staged), mart)
    assert [tuple(r) for r in mart.read(spark).collect()] == [
        ("AR1", "TEXT", 2, 3, date(2024, 1, 2), date(2024, 2, 1), 31)
    ]


# --- environments ---


def test_environments(tmp_path, monkeypatch):
    path = tmp_path / "environments.json"
    dev = {"database": "ads_dev", "raw_table": "raw", "tracking_table": "tracked", "location": "/data/dev/"}
    path.write_text(json.dumps({"dev": dev, "prod": {**dev, "database": "ads", "location": None}}))
    monkeypatch.delenv("ENV", raising=False)
    assert load_environment(str(path)).raw == TableRef("ads_dev.raw", "/data/dev/raw")
    monkeypatch.setenv("ENV", "prod")
    assert load_environment(str(path)).tracking == TableRef("ads.tracked", None)
    assert isinstance(load_environment(str(path), "dev"), Environment)
    with pytest.raises(ValueError):
        load_environment(str(path), "test")


def test_append_is_all_or_nothing(spark, new_table):
    table = new_table()
    df = spark.createDataFrame([("a@b.c", "1"), ("a@b.c", None)], "email string, verification_code string")
    with pytest.raises(Exception, match="required column"):
        append(df.withColumn("created_at", F.current_timestamp()), table, CODE_SCHEMA)
    assert table.read(spark).count() == 0
