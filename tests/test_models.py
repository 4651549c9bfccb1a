"""History and mart kept up to date load by load, against the full computation."""

import json
import os
import shutil
from collections import Counter

import pytest
from builders import SOURCE_SCHEMA
from pyspark.sql import functions as F

from adstrata.operators.versions import version_history
from adstrata.plans import marts, models
from adstrata.schemas import LOAD_COLUMN, RAW_COLUMNS
from adstrata.sources import commits

ROW = "data_modified timestamp, metadata_time timestamp, advertiser_id string, creative_id string, raw_data string"
HISTORY = ["advertiser_id", "creative_id", "metadata_time", "data_modified", "digest", "copies", "version_no", "changed"]
MART = ["advertiser_id", "ad_format_type", "creatives", "versions", "first_shown_date", "last_shown_date", "active_days"]


def load(spark, number, *rows):
    """Raw rows of (advertiser, creative, topic[, format[, copies]]) that a load brings; each load is a day."""
    made = []
    for advertiser, creative, topic, *other in rows:
        form, copies = [*other, *("TEXT", 1)[len(other) :]]
        record = {"advertiser_id": advertiser, "creative_id": creative, "topic": topic, "ad_format_type": form}
        record["region_stats"] = [{"region_code": "SE", "first_shown": f"2024-01-{len(topic):02}", "last_shown": f"2024-02-{number:02}"}]
        made += [(advertiser, creative, json.dumps(record), len(topic))] * copies
    df = spark.createDataFrame(made, "advertiser_id string, creative_id string, raw_data string, day int")
    return df.select(
        F.expr("make_timestamp(2024, 1, day, 0, 0, 0)").alias("data_modified"),
        F.expr(f"make_timestamp(2024, 3, {number}, 6, 0, 0)").alias("metadata_time"),
        "advertiser_id", "creative_id", "raw_data",
    ).select(*RAW_COLUMNS)


@pytest.fixture
def tables(spark, new_table):
    return models.ModelTables(*map(new_table, ("history", "state", "parts", "loads")))


@pytest.fixture
def loads(spark):
    return [
        load(spark, 1, ("A", "1", "cars"), ("A", "2", "cars"), ("B", "1", "boats", "IMAGE"), ("C", "9", "x", "TEXT", 3)),
        load(spark, 2, ("A", "1", "cars"), ("A", "2", "ships"), ("A", "3", "cars", "VIDEO"), ("A", "2", "boats"), ("D", "1", "cars")),
        load(spark, 3, ("A", "1", "trains"), ("B", "1", "boats", "IMAGE"), ("B", "1", "boats", "TEXT"), ("D", "2", "x"), ("A", "3", "cars", "VIDEO", 2)),
    ]


@pytest.fixture(scope="module")
def schema(spark):
    return marts.record_schema(spark.createDataFrame([], SOURCE_SCHEMA).schema)


def rows_of(df, columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def check(spark, tables, so_far, schema):
    whole = so_far[0]
    for more in so_far[1:]:
        whole = whole.unionByName(more)
    assert rows_of(tables.read_history(spark), HISTORY) == rows_of(version_history(whole), HISTORY)
    mart = marts.creatives_mart(marts.staging(whole, schema, marts.MART_FIELDS))
    assert rows_of(tables.read_mart(spark), MART) == rows_of(mart, MART)


def test_each_load_gives_what_the_full_computation_gives(spark, tables, loads, schema):
    for n, rows in enumerate(loads):
        assert models.extend_models(spark, tables, rows, f"load-{n}", schema)
        check(spark, tables, loads[: n + 1], schema)
        assert not models.extend_models(spark, tables, rows, f"load-{n}", schema)
    check(spark, tables, loads, schema)
    assert not models.extend_models(spark, tables, loads[0].limit(0), "nothing", schema)
    numbers = [r.number for r in tables.read_state(spark).collect()]
    assert len(numbers) == len(set(numbers)) == 7


def test_old_partitions_are_not_read(spark, tables, loads, schema):
    """The third load needs neither the history of the first two nor their parts of the mart, nor any state but the second's."""
    for n in range(2):
        models.extend_models(spark, tables, loads[n], f"load-{n}", schema)
    assert models.drop_old_states(spark, tables, keep=["load-0"]) == []
    assert models.drop_old_states(spark, tables) == ["load-0"]
    assert not os.path.exists(f"{tables.state.location}/{LOAD_COLUMN}=load-0")
    for table in (tables.history, tables.parts):
        for n in range(2):
            shutil.move(f"{table.folder(spark).removeprefix('file:')}/{LOAD_COLUMN}=load-{n}", f"{table.location}-{n}")
    assert models.extend_models(spark, tables, loads[2], "load-2", schema)
    for table in (tables.history, tables.parts):
        for n in range(2):
            shutil.move(f"{table.location}-{n}", f"{table.folder(spark).removeprefix('file:')}/{LOAD_COLUMN}=load-{n}")
    check(spark, tables, loads, schema)


@pytest.mark.parametrize("at", ["parts", "commit"])
def test_a_load_that_stops_half_way_shows_nothing_and_can_be_run_again(spark, tables, loads, schema, monkeypatch, at):
    models.extend_models(spark, tables, loads[0], "load-0", schema)

    def stop(rows, table, *args):
        if at == "commit" or table is getattr(tables, at):
            raise OSError("stopped")
        return write(rows, table, *args)

    with monkeypatch.context() as patched:
        name = "append" if at == "commit" else "replace_partition"
        write = getattr(commits, name)
        patched.setattr(commits, name, stop)
        with pytest.raises(OSError):
            models.extend_models(spark, tables, loads[1], "load-1", schema)
    check(spark, tables, loads[:1], schema)
    assert models.extend_models(spark, tables, loads[1], "load-1", schema)
    check(spark, tables, loads[:2], schema)


def test_loads_come_in_order(spark, tables, loads, schema):
    models.extend_models(spark, tables, loads[1], "b", schema)
    for rows, load_id in ((loads[0], "a"), (loads[1], "c")):
        with pytest.raises(ValueError, match="rows as old"):
            models.extend_models(spark, tables, rows, load_id, schema)
    with pytest.raises(ValueError, match="load id"):
        models.extend_models(spark, tables, loads[2], "a b", schema)
    check(spark, tables, loads[1:2], schema)


def test_creatives_of_one_advertiser_fill_several_bitmaps(spark, tables, schema):
    """More creatives than a bitmap holds, numbered by several tasks, some of them in both loads."""
    rows = spark.range(70_000).select(
        F.expr("timestamp'2024-01-05'").alias("data_modified"), F.expr("timestamp'2024-03-01'").alias("metadata_time"), F.lit("A").alias("advertiser_id"),
        F.col("id").cast("string").alias("creative_id"), F.to_json(F.struct(F.lit("A").alias("advertiser_id"), F.col("id").cast("string").alias("creative_id"))).alias("raw_data"),
    )
    more = rows.filter("creative_id % 7 = 0").withColumn("creative_id", F.concat("creative_id", F.when(F.col("creative_id") % 2 == 0, "x").otherwise("")))
    more = more.withColumns({
        "metadata_time": F.expr("timestamp'2024-03-02'"),
        "raw_data": F.to_json(F.struct("advertiser_id", "creative_id")),
    })
    models.extend_models(spark, tables, rows, "one", schema)
    models.extend_models(spark, tables, more, "two", schema)
    (mart,) = tables.read_mart(spark).collect()
    assert (mart.creatives, mart.versions) == (75_000, 80_000)
    state = tables.read_state(spark)
    assert state.select("number").distinct().count() == state.count() == 75_000
