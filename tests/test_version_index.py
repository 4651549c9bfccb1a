"""Loads by the index of stored versions against loads by the raw table itself."""

import os
import shutil
from collections import Counter
from dataclasses import replace

import pytest
from builders import MARKET, creative, raw, source
from pyspark.sql import functions as F

from adstrata.plans import ingest, refresh
from adstrata.sources.tables import append_raw, ensure_raw_table, with_partition
from adstrata.sources.version_index import YEAR, VERSION, VersionIndex, version_digest


@pytest.fixture
def indexed(spark, new_table):
    table = new_table("raw")
    ensure_raw_table(spark, table)
    return ingest.Target(raw=table, market=MARKET, index=VersionIndex(table, new_table("digests"), buckets=4))


@pytest.fixture
def plain(spark, new_table):
    target = ingest.Target(raw=new_table("raw"), market=MARKET)
    ensure_raw_table(spark, target.raw)
    return target


def creatives(spark, *numbers, topic="cars", year=2024):
    day = f"{year}-01-05"
    return source(spark, *[creative(number=f"CR{n}", topic=topic, regions=((MARKET, day, day),)) for n in numbers])


def held(spark, target):
    return Counter(tuple(r) for r in target.raw.read_anew(spark).select("advertiser_id", "creative_id", "raw_data").collect())


def load(spark, target, df):
    return refresh.refresh(spark, "specific", df, None, target, advertiser_ids=["AR1"]).rows_added


def test_three_loads_equal_those_without_an_index(spark, indexed, plain):
    batches = [creatives(spark, 1, 2, 3), creatives(spark, 2, 3, 4, topic="boats"), creatives(spark, 1, 2, 2, 5, year=2023)]
    added = [(load(spark, indexed, df), load(spark, plain, df)) for df in [*batches, *batches]]
    assert added == [(3, 3), (3, 3), (4, 4), (0, 0), (0, 0), (0, 0)]
    assert held(spark, indexed) == held(spark, plain)
    versions = indexed.index.table.read_anew(spark)
    assert versions.count() == len(held(spark, indexed)) and versions.select(YEAR).distinct().count() == 2


def test_all_kinds_of_loads_use_it(spark, indexed):
    df = creatives(spark, 1, 2)
    tracking = spark.createDataFrame([("AR1",)], "advertiser_id string")
    window = ("AR1", "2024-01-01", "2024-01-31")
    assert ingest.backfill(spark, df, indexed, *window).rows_added == 2
    assert ingest.backfill(spark, df, indexed, *window).rows_added == 0
    assert refresh.refresh(spark, "all", df, tracking, indexed).rows_added == 0
    assert refresh.refresh(spark, "all", creatives(spark, 1, topic="boats"), tracking, indexed).rows_added == 1
    assert not indexed.index.ensure(spark)


def test_the_stored_side_is_not_shuffled(spark, indexed):
    load(spark, indexed, creatives(spark, *range(20)))
    rows = with_partition(raw(spark, *[("AR1", f"CR{n}", "t", "2024-01-05") for n in range(50)]))
    plan = indexed.index.known(rows)._jdf.queryExecution().executedPlan().toString()
    stored = plan[plan.index("SortMergeJoin"):].splitlines()
    scan = next(n for n, line in enumerate(stored) if "FileScan parquet" in line)
    depth = stored[scan].index("FileScan")
    above = []  # the operators between the scan and the join
    for line in reversed(stored[:scan]):
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            above.append(line)
            depth = at
    assert "SelectedBucketsCount: 4 out of 4" in stored[scan] and "2024-01-01)]" in stored[scan]
    assert above and not any("Exchange" in line for line in above)


@pytest.mark.parametrize("lost", ["table", "folder", "file", "half a load", "foreign rows"])
def test_it_is_built_again_if_it_is_out_of_step(spark, indexed, lost):
    index, df = indexed.index, creatives(spark, 1, 2, 3)
    assert load(spark, indexed, df) == 3 and not index.ensure(spark)
    if lost == "table":
        spark.sql(f"DROP TABLE {index.table.name}")
    elif lost == "folder":
        shutil.rmtree(index.table.location)
    elif lost == "file":
        found = [os.path.join(d, f) for d, _, names in os.walk(index.table.location) for f in names if f.endswith(".parquet")]
        os.remove(found[0])
    elif lost == "half a load":  # appended to the raw table, but not to the index
        assert load(spark, replace(indexed, index=None), creatives(spark, 4)) == 1
        df = creatives(spark, 1, 4)
    else:
        append_raw(with_partition(raw(spark, ("AR1", "CR9", "t", "2024-03-05"))), indexed.raw)
    assert load(spark, indexed, df) == 0
    assert not index.ensure(spark)
    assert index.table.read_anew(spark).select(VERSION).distinct().count() == indexed.raw.read_anew(spark).count()


def test_digests_tell_parts_of_the_key_apart(spark):
    rows = spark.createDataFrame(
        [("a", "bc", "t"), ("ab", "c", "t"), ("a", "b", "ct"), ("a", "bc", "u"), (None, "bc", "t"), ("a", None, "t"), ("a", "bc", None)],
        "advertiser_id string, creative_id string, raw_data string",
    )
    found = [r[0] for r in rows.select(version_digest()).collect()]
    assert len(set(found[:4])) == 4 and {len(f) for f in found[:4]} == {16} and found[4:] == [None] * 3


def test_rows_without_a_key_are_new(spark, indexed):
    load(spark, indexed, creatives(spark, 1))
    rows = with_partition(raw(spark, ("AR1", "CR1", "t", "2024-01-05"), ("AR1", "CR1", "t", "2024-01-05"))).withColumn("creative_id", F.lit(None).cast("string"))
    assert indexed.index.new_versions(rows).count() == 2
