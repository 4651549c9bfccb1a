"""The registered queries: each operator and job over the test tables."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstrata import samples
from adstrata.functions.dates import is_day_text, parse_day, utc_day
from adstrata.functions.regions import shown_in
from adstrata.functions.text import is_email
from adstrata.operators import codes, media, projection, required, versions
from adstrata.operators.projection import lower_case_columns, market_records, raw_rows
from adstrata.operators.selection import between_days, listed, lookup, targeted
from adstrata.plans import ingest, marts, refresh
from adstrata.plans.codes import forget_codes, store_code, store_codes, stored_codes
from adstrata.plans.media import MediaTables, advertiser_ids_of_links, media_links_job
from adstrata.plans.models import ModelTables, extend_models
from adstrata.samples import MARKET, REFRESH_TIME
from adstrata.schemas import LOAD_COLUMN, LOADED_LINK_SCHEMA, PARTITION_COLUMN, RECORD_FIELDS
from adstrata.session import stage, staging_path
from adstrata.sources.config import load_environment
from adstrata.sources.tables import TableRef, append, append_raw, ensure_raw_table, replace_partition, with_partition
from adstrata.sources.version_index import VersionIndex
from adstrata.streaming.codes import check_joined_streams, check_stream
from adstrata.streaming.ingest import ingest_stream, stream_creatives

Query = Callable[[SparkSession, str], DataFrame]

_registered: dict[str, Query] = {}

# Parameters of the registered runs.
WINDOW = (date(1998, 1, 1), date(1998, 12, 31))
AS_OF = date(2000, 1, 1)
DAILY_AS_OF = date(1998, 7, 2)
TARGET_ADVERTISERS = ["AR00000000000000000003", "AR00000000000000000010"]
TARGET_CREATIVES = ["CR00000000000000000007"]
SEGMENT = "BUILDING"
PRIORITY = "1-URGENT"
CODE_CUTOFF = "2024-01-30 00:00:00"


def query(function: Query) -> Query:
    _registered[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_registered)


def _day_text(column: str):
    return utc_day(F.col(column)).cast("string").alias(column)


def _raw_output(rows: DataFrame) -> DataFrame:
    return rows.select(_day_text("data_modified"), "advertiser_id", "creative_id", "raw_data")


def _tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = listed(samples.creative_stats(spark, sf_dir), samples.advertisers_tracking(spark, sf_dir))
    return market_records(chosen, MARKET)


def _new(spark: SparkSession, sf_dir: str, records: DataFrame) -> DataFrame:
    incoming = with_partition(raw_rows(records, REFRESH_TIME), "month")
    return versions.new_versions(incoming, samples.raw_history(spark, sf_dir), also=[PARTITION_COLUMN])


@query
def market_projection(spark, sf_dir):
    """Records of the market as raw-table rows."""
    records = market_records(samples.creative_stats(spark, sf_dir), MARKET)
    return _raw_output(raw_rows(records, REFRESH_TIME))


@query
def not_shown_in_market(spark, sf_dir):
    """The negated array test, which must keep records without any region."""
    source = samples.creative_stats(spark, sf_dir)
    return source.filter(~shown_in(F.col("region_stats"), MARKET)).select(
        "creative_id", F.size(F.coalesce("region_stats", F.array())).cast("long").alias("regions")
    )


@query
def repeated_entries(spark, sf_dir):
    """Records with two entries for the market have no day; the others keep theirs."""
    twice = F.when(F.col("is_funded_by_google_ad_grants"), F.concat("region_stats", "region_stats"))
    source = samples.creative_stats(spark, sf_dir).withColumn("region_stats", F.coalesce(twice, "region_stats"))
    return market_records(source, MARKET, strict=False).select(
        "creative_id",
        F.size("region_stats").cast("long").alias("entries"),
        F.col("first_shown_date").cast("string").alias("first_shown"),
    )


def _damaged_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source with repeated entries, unpadded first days and missing last days."""
    status = F.col("advertiser_verification_status")

    def damaged(entry):
        first = F.when(status == "F", F.replace(entry["first_shown"], F.lit("-0"), F.lit("-")))
        last = F.when(status != "P", entry["last_shown"])
        return F.struct(
            entry["region_code"].alias("region_code"),
            F.coalesce(first, entry["first_shown"]).alias("first_shown"),
            last.alias("last_shown"),
        )

    regions = F.transform("region_stats", damaged)
    twice = F.when(F.col("is_funded_by_google_ad_grants"), F.concat(regions, regions))
    return samples.creative_stats(spark, sf_dir).withColumn("region_stats", F.coalesce(twice, regions))


@query
def unusable_records(spark, sf_dir):
    """Records that no window load stores."""
    unusable = projection.unusable_records(_damaged_source(spark, sf_dir), MARKET)
    return unusable.select("advertiser_id", "creative_id", "reason")


@query
def unusable_for_refresh(spark, sf_dir):
    """Records that no refresh stores."""
    unusable = projection.unusable_records(_damaged_source(spark, sf_dir), MARKET, "refresh")
    return unusable.select("advertiser_id", "creative_id", "reason")


@query
def refresh_lenient(spark, sf_dir):
    """What a lenient refresh of the damaged source does store."""
    target = ingest.Target(raw=_scratch_table(spark, "raw"), market=MARKET, strict=False)
    ensure_raw_table(spark, target.raw)
    source = _damaged_source(spark, sf_dir)
    refresh.refresh(spark, "all", source, source.select("advertiser_id").distinct(), target)
    return target.raw.read(spark).select(_day_text("data_modified"), "advertiser_id", "creative_id")


@query
def parsed_days(spark, sf_dir):
    """Day texts, good and bad, parsed without failing."""
    day, case = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 6
    text = (
        F.when(case == 0, day)
        .when(case == 1, F.date_format("o_orderdate", "yyyy-M-d"))
        .when(case == 2, F.concat(day, F.lit(" ")))
        .when(case == 3, F.overlay(day, F.lit("13"), F.lit(6)))
        .when(case == 4, F.concat(day, F.lit("T00")))
    )
    orders = samples.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("day_text"))
    return orders.withColumns(
        {
            "parsed": parse_day(F.col("day_text"), strict=False).cast("string"),
            "shaped": F.coalesce(is_day_text(F.col("day_text")), F.lit(False)).cast("int"),
        }
    )


@query
def ingest_tracked_all(spark, sf_dir):
    """New versions of all tracked advertisers' creatives."""
    return _raw_output(_new(spark, sf_dir, _tracked(spark, sf_dir)))


@query
def ingest_window_last_shown(spark, sf_dir):
    """New versions of tracked creatives last shown in the window."""
    return _raw_output(_new(spark, sf_dir, between_days(_tracked(spark, sf_dir), "last_shown_date", *WINDOW)))


@query
def gate_first_shown(spark, sf_dir):
    """What the availability gate sees, as a count."""
    return between_days(_tracked(spark, sf_dir), "first_shown_date", *WINDOW).agg(F.count(F.lit(1)).alias("n"))


def _loaded(spark: SparkSession, sf_dir: str, load: Callable[[ingest.Target], object]) -> DataFrame:
    """What a job adds to a raw table that holds the history."""
    target = ingest.Target(raw=_scratch_table(spark, "raw"), market=MARKET, granularity="month")
    ensure_raw_table(spark, target.raw)
    append_raw(samples.raw_history(spark, sf_dir), target.raw)
    load(target)
    return _raw_output(target.raw.read(spark).filter(F.col("metadata_time") > F.lit(samples.HISTORY_TIME)))


@query
def ingest_id_list(spark, sf_dir):
    """Back-fill of a list of advertisers, held in a table."""
    source, ids = samples.creative_stats(spark, sf_dir), samples.segment_advertisers(spark, sf_dir, SEGMENT)
    return _loaded(spark, sf_dir, lambda target: ingest.backfill(spark, source, target, ids, *WINDOW, gate="same_as_insert"))


@query
def ingest_three_month(spark, sf_dir):
    """Back-fill of the 90 days up to the day before a given day."""
    source, ids = samples.creative_stats(spark, sf_dir), samples.segment_advertisers(spark, sf_dir, SEGMENT)
    return _loaded(spark, sf_dir, lambda target: ingest.three_month_backfill(spark, source, target, ids, AS_OF, gate="same_as_insert"))


@query
def ingest_targeted(spark, sf_dir):
    """New versions of named advertisers and named creatives."""
    chosen = targeted(samples.creative_stats(spark, sf_dir), TARGET_ADVERTISERS, TARGET_CREATIVES)
    return _raw_output(_new(spark, sf_dir, market_records(chosen, MARKET)))


@query
def ingest_targeted_tables(spark, sf_dir):
    """The same with both lists held in tables."""
    chosen = targeted(
        samples.creative_stats(spark, sf_dir),
        samples.segment_advertisers(spark, sf_dir, SEGMENT),
        samples.priority_creatives(spark, sf_dir, PRIORITY),
    )
    return _raw_output(_new(spark, sf_dir, market_records(chosen, MARKET)))


@query
def batch_repeats(spark, sf_dir):
    """Equal rows of one batch: all kept by the load, one kept when repeats are dropped."""
    rows = raw_rows(_tracked(spark, sf_dir), REFRESH_TIME)
    history = samples.raw_history(spark, sf_dir)
    batch = rows.unionAll(rows)
    kept = versions.new_versions(batch, history).withColumn("repeats", F.lit("kept"))
    dropped = versions.new_versions(versions.drop_repeats(batch), history).withColumn("repeats", F.lit("dropped"))
    return kept.unionAll(dropped).groupBy("repeats", "advertiser_id").agg(F.count(F.lit(1)).alias("n"))


def _scratch_table(spark: SparkSession, label: str) -> TableRef:
    return TableRef(f"{label}_{uuid.uuid4().hex}", staging_path(spark, label))


@query
def run_status(spark, sf_dir):
    """The jobs run one after another into a new raw table, and what each reported."""
    target = ingest.Target(
        raw=_scratch_table(spark, "raw"), market=MARKET, runs=_scratch_table(spark, "runs")
    )
    source = samples.creative_stats(spark, sf_dir)
    tracking = samples.advertisers_tracking(spark, sf_dir)
    segment = samples.segment_advertisers(spark, sf_dir, SEGMENT)
    ingest.daily_ingest(spark, source, tracking, target, as_of=DAILY_AS_OF)
    ingest.backfill(spark, source, target, tracking, *WINDOW, job="backfill")
    ingest.backfill(spark, source, target, tracking, *WINDOW, job="backfill_again")
    ingest.backfill(spark, source, target, tracking, "2090-01-01", "2090-12-31", job="backfill_empty")
    ingest.three_month_backfill(spark, source, target, segment, as_of=AS_OF)
    refresh.refresh(spark, "all", source, tracking, target)
    refresh.refresh(spark, "specific", source, tracking, target, advertiser_ids=segment)
    ingest.backfill(spark, source, target, segment, *WINDOW, job="backfill_known", gate="same_as_insert")
    return target.runs.read(spark).select("job", "status", "rows_added")


@query
def refresh_status(spark, sf_dir):
    """What making a table and refreshing it reports: made, there already, impossible; new updates, none, none again."""
    target = ingest.Target(raw=_scratch_table(spark, "raw"), market=MARKET, runs=_scratch_table(spark, "runs"))
    made = [ensure_raw_table(spark, target.raw), ensure_raw_table(spark, target.raw)]
    # A file stands where the folder should be.
    made.append(ensure_raw_table(spark, TableRef("unmade", f"{sf_dir}/region.parquet/raw")))
    source, tracking = samples.creative_stats(spark, sf_dir), samples.advertisers_tracking(spark, sf_dir)
    refresh.refresh(spark, "all", source, tracking, target)
    refresh.refresh(spark, "all", source, tracking, target)
    tracked = listed(source, tracking)
    refresh.refresh(spark, "specific", tracked, tracking, target, creative_ids=samples.priority_creatives(spark, sf_dir, PRIORITY))
    tables = spark.createDataFrame([("table", f"{n}-{status.name}", 0) for n, status in enumerate(made)], "job string, status string, rows_added long")
    return target.runs.read(spark).select("job", "status", "rows_added").unionByName(tables)


@query
def ingest_by_environment(spark, sf_dir):
    """A back-fill into the tables that an environment names, for the advertisers of its tracking table."""
    database = f"env_{uuid.uuid4().hex}"
    settings = {"database": database, "raw_table": "creatives", "tracking_table": "tracked", "location": staging_path(spark, "env")}
    with tempfile.TemporaryDirectory() as folder:
        path = os.path.join(folder, "environments.json")
        with open(path, "w", encoding="utf-8") as file:
            json.dump({"dev": {"database": "unused", "raw_table": "x", "tracking_table": "y"}, "trial": settings}, file)
        env = load_environment(path, "trial")
    append(samples.advertisers_tracking(spark, sf_dir), env.tracking, T.StructType([T.StructField("advertiser_id", T.StringType(), False)]))
    target = ingest.Target(raw=env.raw, market=MARKET, runs=env.runs)
    ingest.backfill(spark, samples.creative_stats(spark, sf_dir), target, env.tracking.read(spark), *WINDOW)
    return _raw_output(spark.table(f"{database}.creatives"))


@query
def raw_layout(spark, sf_dir):
    """Rows of the raw table by month, and those that come before a smaller advertiser or creative in their file."""
    raw = _scratch_table(spark, "raw")
    ensure_raw_table(spark, raw)
    append_raw(samples.raw_versions(spark, sf_dir), raw)
    place = Window.partitionBy("file").orderBy("at")
    key = F.struct("advertiser_id", "creative_id")
    rows = raw.read(spark).select(
        PARTITION_COLUMN, key.alias("key"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    rows = rows.withColumn("misplaced", (F.lag("key").over(place) > F.col("key")).cast("long"))
    return rows.groupBy(F.col(PARTITION_COLUMN).cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum("misplaced"), F.lit(0).cast("long")).alias("misplaced")
    )


@query
def stream_ingest(spark, sf_dir):
    """The refresh of all tracked advertisers, fed file by file from a stream."""
    target = ingest.Target(raw=_scratch_table(spark, "raw"), market=MARKET)
    ensure_raw_table(spark, target.raw)
    append_raw(with_partition(samples.raw_history(spark, sf_dir), target.granularity), target.raw)
    source = samples.creative_stats(spark, sf_dir)
    stream = stream_creatives(
        spark,
        samples.creative_stats_path(spark, sf_dir),
        source.schema,
        max_files_per_trigger=max(1, len(source.inputFiles()) // 3),
    )
    checkpoint = staging_path(spark, "stream")
    ingest_stream(
        stream, lambda: samples.advertisers_tracking(spark, sf_dir), target, checkpoint
    ).awaitTermination()
    loaded = target.raw.read(spark).filter(F.col("metadata_time") > F.lit(samples.HISTORY_TIME))
    return _raw_output(loaded)


@query
def ingest_indexed(spark, sf_dir):
    """New versions of all tracked advertisers' creatives, found by the raw table's index, in two loads run twice."""
    raw = _scratch_table(spark, "raw")
    target = ingest.Target(raw=raw, market=MARKET, granularity="month", index=VersionIndex(raw, _scratch_table(spark, "digests"), 8))
    ensure_raw_table(spark, raw)
    append_raw(samples.raw_history(spark, sf_dir), raw)
    source, tracking = samples.creative_stats(spark, sf_dir), samples.advertisers_tracking(spark, sf_dir)
    for _ in range(2):
        ingest.backfill(spark, source, target, tracking, *WINDOW, gate="same_as_insert")
        refresh.refresh(spark, "all", source, tracking, target)
    return _raw_output(raw.read(spark).filter(F.col("metadata_time") > F.lit(samples.HISTORY_TIME)))


@query
def raw_row_count(spark, sf_dir):
    """Rows of the raw table per month partition."""
    return (
        samples.raw_versions(spark, sf_dir)
        .groupBy(F.col(PARTITION_COLUMN).cast("string").alias("month"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.page_outcomes(media.pages_to_read(samples.creative_pages(spark, sf_dir)))


@query
def media_outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir)


@query
def media_links(spark, sf_dir):
    return media.links(_outcomes(spark, sf_dir))


@query
def media_of_advertiser(spark, sf_dir):
    """The outcomes of one advertiser's pages."""
    pages = media.pages_to_read(samples.creative_pages(spark, sf_dir), "AR00000000000000000007")
    return media.page_outcomes(pages)


@query
def media_frames(spark, sf_dir):
    """Outcomes of pages that write a frame in many ways, hide one, or have an empty address."""
    outcomes = media.page_outcomes(media.pages_to_read(samples.framed_pages(spark, sf_dir)))
    return outcomes.select("creative_id", "youtube_video_url", "youtube_watch_url", "outcome")


@query
def media_timeouts(spark, sf_dir):
    return media.timeouts(_outcomes(spark, sf_dir))


@query
def media_counters(spark, sf_dir):
    return media.counters(_outcomes(spark, sf_dir), "advertiser_id")


def _media_tables(spark: SparkSession) -> MediaTables:
    return MediaTables(*(_scratch_table(spark, label) for label in ("links", "timeouts", "loads")))


def _routed(tables: MediaTables, spark: SparkSession) -> DataFrame:
    return tables.read_links(spark).withColumn("routed_to", F.lit("links")).unionByName(
        tables.read_timeouts(spark).withColumn("routed_to", F.lit("timeouts"))
    )


@query
def media_routed(spark, sf_dir):
    """The whole media job: the rows it put in each table, and its counters."""
    tables = _media_tables(spark)
    result = media_links_job(spark, samples.creative_pages(spark, sf_dir), tables)
    return _routed(tables, spark).select(
        "creative_id",
        "youtube_watch_url",
        "routed_to",
        F.lit(result.successful_scrapes).cast("long").alias("found"),
    )


@query
def media_loads(spark, sf_dir):
    """Loads advertiser by advertiser: one run again, one of all the rest, and one that stopped before its commit."""
    tables, pages = _media_tables(spark), samples.creative_pages(spark, sf_dir)
    first, second = "AR00000000000000000001", "AR00000000000000000002"
    for _ in range(2):
        media_links_job(spark, pages, tables, advertiser_id=first)
    media_links_job(spark, pages.filter(~F.col("advertiser_id").isin(first, second)), tables, load_id="rest")
    stopped = media.links(media.page_outcomes(media.pages_to_read(pages, second)))
    replace_partition(stopped, tables.links, LOADED_LINK_SCHEMA, LOAD_COLUMN, "stopped")
    return _routed(tables, spark).groupBy("advertiser_id", "routed_to").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct(LOAD_COLUMN).alias("loads")
    )


@query
def advertiser_from_url(spark, sf_dir):
    urls = samples.creative_stats(spark, sf_dir).select(F.col("creative_page_url").alias("url"))
    return advertiser_ids_of_links(urls)


@query
def lowercase_columns(spark, sf_dir):
    customers = samples.table(spark, sf_dir, "customer")
    upper = customers.toDF(*[c.upper() for c in customers.columns])
    return lower_case_columns(upper.select("*", F.upper("C_NAME").alias("c_name")))


@query
def valid_email(spark, sf_dir):
    """The shape check over good addresses and several kinds of bad ones."""
    name, case = F.col("c_name"), F.col("c_custkey") % 6
    plain = F.replace(name, F.lit("#"), F.lit("."))
    email = (
        F.when(case == 0, F.concat(plain, F.lit("@example.com")))
        .when(case == 1, F.concat(plain, F.lit("@example")))
        .when(case == 2, F.concat(name, F.lit("@example.com")))
        .when(case == 3, F.concat(plain, F.lit("@exa mple.com")))
        .when(case == 4, F.concat(plain, F.lit("+tag@mail.example-site.co.uk")))
        .otherwise(plain)
    )
    customers = samples.table(spark, sf_dir, "customer").select("c_custkey", email.alias("email"))
    return customers.withColumn("valid", is_email(F.col("email")).cast("int"))


@query
def code_latest(spark, sf_dir):
    """The newest code per address."""
    return codes.latest_codes(samples.verification_codes(spark, sf_dir), "code_id").select(
        "email", "code_id", "verification_code"
    )


@query
def code_check(spark, sf_dir):
    """Each attempt checked against the newest code made up to then."""
    checked = codes.check_codes(
        samples.verification_attempts(spark, sf_dir), samples.verification_codes(spark, sf_dir), "code_id"
    )
    return checked.select("attempt_id", "email", "status")


@query
def code_check_partial(spark, sf_dir):
    """The same for attempts of which some lack the address or the code."""
    checked = codes.check_codes(samples.partial_attempts(spark, sf_dir), samples.verification_codes(spark, sf_dir), "code_id")
    return checked.select("attempt_id", "email", "status")


ASKED_ADDRESS = "user7@example.com"


@query
def code_lookup(spark, sf_dir):
    """All codes of one address."""
    return lookup(samples.verification_codes(spark, sf_dir), "email", ASKED_ADDRESS).select("code_id", "email", "verification_code")


@query
def account_lookup(spark, sf_dir):
    """The accounts of one address."""
    return lookup(samples.accounts(spark, sf_dir), "email", ASKED_ADDRESS)


@query
def code_stored(spark, sf_dir):
    """The table of codes after many were stored, then one, and then some that are refused whole because one has no address."""
    table = _scratch_table(spark, "codes")
    known = samples.verification_codes(spark, sf_dir).withColumn("created_at", F.col("created_at").cast("timestamp"))
    done = [store_codes(known, table), store_code(spark, table, ASKED_ADDRESS, "0000", samples.REFRESH_TIME)]
    done.append(store_codes(known.withColumn("email", F.when(F.col("code_id") % 2 == 0, F.col("email"))), table))
    counted = table.read_anew(spark).groupBy("email").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("verification_code") == "0000").alias("late"))
    return counted.withColumn("stored", F.lit(",".join(map(str, done))))


@query
def stream_code_check(spark, sf_dir):
    """The same check of attempts that arrive as a stream of files."""
    folder, results = staging_path(spark, "attempts"), _scratch_table(spark, "checked")
    attempts = samples.verification_attempts(spark, sf_dir)
    attempts.repartition(4, "email").write.parquet(folder)
    stream = spark.readStream.schema(attempts.schema).option("maxFilesPerTrigger", 2).parquet(folder)
    known = samples.verification_codes(spark, sf_dir)
    check_stream(
        stream, lambda: known, results, staging_path(spark, "stream"), tiebreak="code_id"
    ).awaitTermination()
    return results.read(spark).select("attempt_id", "email", "status")


def _in_time_order(rows: DataFrame, column: str, last: dict[str, str]) -> DataFrame:
    """A stream of the rows in three files by time. A row long after all others, which lets the stream finish those, is the last."""
    spark, folder = rows.sparkSession, staging_path(rows.sparkSession, "in-order")
    rows = rows.withColumn(column, F.col(column).cast("timestamp"))
    for start, end in (("2000-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2100-01-01")):
        rows.filter((F.col(column) >= start) & (F.col(column) < end)).coalesce(1).write.mode("append").parquet(folder)
    sentinel = [F.expr(last.get(name, "null")).cast(kind).alias(name) for name, kind in rows.dtypes]
    spark.range(1).select(*sentinel).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query
def stream_code_join(spark, sf_dir):
    """The check of attempts that arrive as a stream, joined with the codes, which arrive as another."""
    results, known = _scratch_table(spark, "checked"), samples.verification_codes(spark, sf_dir)
    # With an address: rows without one are left out before the stream of codes notes how far it is.
    end = {"email": "'end'", "attempted_at": "timestamp'2100-01-01'", "created_at": "timestamp'2100-01-01'"}
    attempts = _in_time_order(samples.verification_attempts(spark, sf_dir), "attempted_at", end)
    made = _in_time_order(known, "created_at", end)
    stored = known.withColumn("created_at", F.col("created_at").cast("timestamp"))
    check_joined_streams(
        attempts, made, lambda: stored, results, staging_path(spark, "stream"), tiebreak="code_id", delay="1 hour"
    ).awaitTermination()
    return results.read(spark).select("attempt_id", "email", "status")


@query
def code_delete(spark, sf_dir):
    """The codes left once the addresses of accounts with a late error are deleted."""
    gone = samples.failed_accounts(spark, sf_dir, CODE_CUTOFF)
    left = codes.delete_codes(samples.verification_codes(spark, sf_dir), gone)
    return left.select("code_id", "email", "verification_code")


@query
def code_forgotten(spark, sf_dir):
    """The table of codes, stored and read again, before and after the same addresses are deleted from its files."""
    table = _scratch_table(spark, "codes")
    known = samples.verification_codes(spark, sf_dir).withColumn("created_at", F.col("created_at").cast("timestamp"))
    store_codes(known.repartitionByRange("email"), table)
    before = stored_codes(spark, table).groupBy("email").agg(F.count(F.lit(1)).alias("stored"))
    before = stage(before, "stored")
    forget_codes(samples.failed_accounts(spark, sf_dir, CODE_CUTOFF), table)
    after = stored_codes(spark, table).groupBy("email").agg(F.count(F.lit(1)).alias("n_left"))
    return before.join(after, "email", "left").select("email", "stored", F.coalesce("n_left", F.lit(0).cast("long")).alias("n_left"))


REQUIRED = ["advertiser_id", "creative_id", "advertiser_legal_name", "region_stats"]


@query
def required_columns_quarantine(spark, sf_dir):
    """Records that lack required columns, with the names of those."""
    _, incomplete = required.split(samples.creative_stats(spark, sf_dir), REQUIRED)
    return incomplete.select("advertiser_id", "creative_id", "missing")


def _staged(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    schema = marts.record_schema(samples.creative_stats(spark, sf_dir).schema)
    return marts.staging(samples.raw_versions(spark, sf_dir), schema, fields or RECORD_FIELDS)


@query
def stg_creatives(spark, sf_dir):
    """The stored texts as typed columns."""
    return _staged(spark, sf_dir).select(
        "advertiser_id",
        "creative_id",
        "creative_page_url",
        "ad_format_type",
        "advertiser_legal_name",
        "topic",
        F.col("is_funded_by_google_ad_grants").cast("int").alias("funded"),
        F.col("first_shown_date").cast("string").alias("first_shown"),
        F.col("last_shown_date").cast("string").alias("last_shown"),
        F.col("audience_selection_approach_info.approach").alias("approach"),
        "advertiser_disclosed_name",
        "advertiser_location",
        "advertiser_verification_status",
        F.to_json("region_stats").alias("region_stats"),
        utc_day(F.col("metadata_time")).cast("string").alias("loaded"),
    )


@query
def latest_version(spark, sf_dir):
    """The newest version per creative."""
    newest = versions.latest_version(samples.raw_versions(spark, sf_dir))
    return newest.select(_day_text("data_modified"), _day_text("metadata_time"), "advertiser_id", "creative_id", "raw_data")


@query
def version_history(spark, sf_dir):
    """The versions of each creative, numbered."""
    history = versions.version_history(samples.raw_versions(spark, sf_dir))
    return history.select(
        "advertiser_id",
        "creative_id",
        _day_text("metadata_time"),
        "version_no",
        F.col("changed").cast("int").alias("changed"),
        "copies",
        "digest",
    )


@query
def published_models(spark, sf_dir):
    """The staging view and the mart's table, published and read by name; the mart replaces one published before."""
    name = uuid.uuid4().hex
    raw, mart = samples.raw_versions(spark, sf_dir), _scratch_table(spark, "mart")
    schema = marts.record_schema(samples.creative_stats(spark, sf_dir).schema)
    marts.publish_staging(raw, schema, f"stg_{name}")
    whole = marts.creatives_mart(spark.table(f"stg_{name}"))
    for part in (whole.limit(1), whole):
        marts.publish_mart(part, mart)
    return spark.sql(
        f"""select m.advertiser_id, m.ad_format_type, m.versions, s.n as staged
        from {mart.name} m join (select advertiser_id, ad_format_type, count(*) n from stg_{name} group by all) s
        on m.advertiser_id <=> s.advertiser_id and m.ad_format_type <=> s.ad_format_type"""
    )


@query
def stg_second_source(spark, sf_dir):
    """Records of a source without a given schema, some of whose fields have other types, staged as columns without loss."""
    turn = F.col("turn")
    record = F.concat(
        F.lit('{"conv_id":'),
        F.when(F.col("conv_id") % 5 == 0, F.concat(F.lit('"c'), F.col("conv_id"), F.lit('"'))).otherwise(F.col("conv_id").cast("string")),
        F.lit(',"turn":'),
        F.when(turn % 3 == 2, F.concat(turn, F.lit(".5"))).otherwise(turn.cast("string")),
        F.lit(',"'),
        F.when(turn % 2 == 0, "role").otherwise("speaker"),
        F.lit('":"'),
        F.col("role"),
        F.lit('"}'),
    )
    text = F.when((F.col("conv_id") % 11 == 0) & (turn == 0), F.lit("no record")).otherwise(record)
    raw = samples.table(spark, sf_dir, "conversations").select(
        F.lit(samples.HISTORY_TIME).alias("data_modified"), F.lit(samples.REFRESH_TIME).alias("metadata_time"), text.alias("raw_data")
    )
    staged = marts.variant_staging(raw, {"conv_id": "bigint", "turn": "int", "role": "string"})
    return staged.select(
        "conv_id",
        "turn",
        "role",
        F.col("misfits")["conv_id"].alias("other_id"),
        F.col("misfits")["turn"].alias("other_turn"),
        F.col("others")["speaker"].alias("speaker"),
        "unparsed",
    )


def _extended(spark: SparkSession, sf_dir: str) -> ModelTables:
    """History and mart of the raw table, built load by load; the last one is offered twice."""
    models = ModelTables(*(_scratch_table(spark, label) for label in ("history", "state", "parts", "loads")))
    schema = marts.record_schema(samples.creative_stats(spark, sf_dir).schema)
    raw = samples.raw_versions(spark, sf_dir)
    for load_id, loaded in (("first", samples.HISTORY_TIME), ("second", samples.REFRESH_TIME), ("second", samples.REFRESH_TIME)):
        extend_models(spark, models, raw.filter(F.col("metadata_time") == F.lit(loaded)), load_id, schema)
    return models


@query
def version_history_extended(spark, sf_dir):
    """The same, each load continuing the numbers of the one before."""
    return _extended(spark, sf_dir).read_history(spark).select(
        "advertiser_id",
        "creative_id",
        _day_text("metadata_time"),
        "version_no",
        F.col("changed").cast("int").alias("changed"),
        "copies",
        "digest",
    )


@query
def mart_creatives_merged(spark, sf_dir):
    """The mart added up from the parts of each load."""
    mart = _extended(spark, sf_dir).read_mart(spark)
    days = {c: F.col(c).cast("string") for c in ("first_shown_date", "last_shown_date")}
    return mart.withColumns(days)


@query
def mart_creatives(spark, sf_dir):
    """Creatives, versions and days shown per advertiser and format."""
    mart = marts.creatives_mart(_staged(spark, sf_dir, *marts.MART_FIELDS))
    return mart.withColumns(
        {
            "first_shown_date": F.col("first_shown_date").cast("string"),
            "last_shown_date": F.col("last_shown_date").cast("string"),
        }
    )
