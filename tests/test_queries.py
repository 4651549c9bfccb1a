"""The registered queries against their SQL, and the shape of their plans."""

import re

import pytest
from compare import driver, duckdb_over, spark_rows, sql_rows
from conftest import SF
from pyspark.sql import functions as F

from adstrata import oracles, queries, samples
from adstrata.operators.pruning import relevant_history
from adstrata.schemas import PARTITION_COLUMN

SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duckdb_over(SF)


def test_every_query_has_sql():
    assert set(queries.registered()) == set(SQL)
    assert set(SQL) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, connection, name):
    columns, got = spark_rows(driver.queries()[name](spark, SF))
    assert (columns, got) == sql_rows(connection, SQL[name])
    assert sum(got.values()) > 0


def test_expected_row_counts(spark):
    """The counts given for the smallest tables."""
    counts = {
        "market_projection": 200,
        "ingest_tracked_all": 37,
        "ingest_window_last_shown": 6,
        "ingest_targeted": 9,
        "latest_version": 119,
        "stg_creatives": 133,
    }
    assert {n: driver.queries()[n](spark, SF).count() for n in counts} == counts
    assert queries.gate_first_shown(spark, SF).first().n == 10
    outcomes = dict(queries.media_outcomes(spark, SF).groupBy("outcome").count().collect())
    assert outcomes == {"video": 19, "no_video": 9, "convert_failed": 10, "timeout": 9}
    statuses = dict(queries.code_check(spark, SF).groupBy("status").count().collect())
    assert statuses == {"verified": 67, "invalid_code": 61, "expired": 51, "unknown_email": 20}


def plan(df) -> str:
    execution = df._jdf.queryExecution()
    return execution.executedPlan().toString()


# The others read what their jobs wrote.
JOBS = {
    "run_status", "stream_ingest", "media_routed", "media_loads", "stream_code_check", "code_forgotten", "ingest_indexed",
    "version_history_extended", "mart_creatives_merged", "refresh_status", "ingest_by_environment", "raw_layout", "code_stored",
    "published_models", "stream_code_join", "ingest_id_list", "ingest_three_month",
}
LAZY = sorted(set(SQL) - JOBS)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_pairs_in_plans(spark, name):
    text = plan(driver.queries()[name](spark, SF))
    for word in ("Python", "CartesianProduct", "NestedLoop", "ArrowEval", "SinglePartition, ENSURE"):
        if name == "gate_first_shown" and word.startswith("SinglePartition"):
            continue  # One row of partial counts per task.
        assert word not in text


def test_source_scan_pushes_the_market_down(spark):
    text = plan(queries.ingest_tracked_all(spark, SF))
    assert "EqualTo(advertiser_location,EUROPE)" in text
    history = next(line for line in text.splitlines() if "raw_history" in line)
    assert "metadata_time" not in history and "data_modified" not in history


def test_named_ids_reach_the_scan(spark):
    assert "Or(In(advertiser_id, [AR" in plan(queries.ingest_targeted(spark, SF))


def test_gate_reads_few_columns(spark):
    scan = next(line for line in plan(queries.gate_first_shown(spark, SF)).splitlines() if "creative_stats" in line)
    read = re.search(r"FileScan parquet \[([^\]]*)\]", scan).group(1)
    assert {c.split("#")[0] for c in read.split(",")} == {"advertiser_id", "advertiser_location", "region_stats"}


def test_newest_rows_are_picked_before_the_shuffle(spark):
    for name in ("latest_version", "code_latest"):
        text = plan(driver.queries()[name](spark, SF))
        assert text.index("Partial") > text.index("Exchange hashpartitioning")


def test_history_is_pruned_to_the_days_and_advertisers_of_a_batch(spark):
    history = samples.raw_history(spark, SF)
    day = history.agg(F.min(PARTITION_COLUMN)).first()[0]
    batch = history.filter(F.col(PARTITION_COLUMN) == F.lit(day))
    text = plan(relevant_history(history, batch))
    assert f"PartitionFilters: [(data_date#" in text or str(day) in text
    assert "GreaterThanOrEqual(advertiser_id" in text
    assert "BroadcastHashJoin" in text and "LeftSemi" in text


def test_entry(spark):
    assert driver.entry(spark).count() == 37
