"""Parquet tables in the session catalog."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstrata.functions.dates import utc_day
from adstrata.operators.counts import counted
from adstrata.operators.required import enforce
from adstrata.plans.status import IngestStatus
from adstrata.schemas import CREATIVE_KEY, PARTITION_COLUMN, RAW_COLUMNS, RAW_SCHEMA

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class TableRef:
    """A catalog table, and its folder when it is not the warehouse's."""

    name: str
    location: str | None = None

    def exists(self, spark: SparkSession) -> bool:
        return spark.catalog.tableExists(self.name)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def read_anew(self, spark: SparkSession) -> DataFrame:
        """The table with its files listed again, so that what other applications appended is seen."""
        spark.catalog.refreshTable(self.name)
        return self.read(spark)

    def folder(self, spark: SparkSession) -> str:
        """Where the catalog has the table's files."""
        described = spark.sql(f"DESCRIBE FORMATTED {self.name}")
        return described.filter("col_name = 'Location'").first()["data_type"]

    def create(
        self, spark: SparkSession, schema: T.StructType, partitioned_by: str | None = None, options: Mapping[str, str] | None = None
    ) -> None:
        """Create the table if it is absent. Files already in its folder become its rows. All writes to it have the `options`."""
        if "." in self.name:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.name.rsplit('.', 1)[0]}")
        if self.location:
            # Makes the folder; rows that are there already stay.
            writer = spark.createDataFrame([], schema).write.mode("append")
            (writer.partitionBy(partitioned_by) if partitioned_by else writer).parquet(self.location)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        partitions = f"PARTITIONED BY (`{partitioned_by}`)" if partitioned_by else ""
        location = f"LOCATION '{self.location}'" if self.location else ""
        written = ", ".join(f"'{key}' '{value}'" for key, value in (options or {}).items())
        given = f"OPTIONS ({written})" if written else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet {given} {partitions} {location}")
        if partitioned_by and self.location:
            spark.sql(f"MSCK REPAIR TABLE {self.name}")


# Files are sorted by advertiser, so a creative's id lies within the bounds of many row groups; a Bloom filter tells which hold it.
RAW_OPTIONS = {"parquet.bloom.filter.enabled#creative_id": "true"}


def ensure_raw_table(spark: SparkSession, raw: TableRef) -> IngestStatus:
    """Create the raw table, partitioned by day, unless it exists."""
    if raw.exists(spark):
        return IngestStatus.TABLE_EXISTS
    try:
        raw.create(spark, RAW_SCHEMA, PARTITION_COLUMN, RAW_OPTIONS)
    except Exception:
        log.exception("could not create %s", raw.name)
        return IngestStatus.TABLE_CREATION_FAILED
    return IngestStatus.TABLE_CREATED


GRANULARITY = "adstrata.granularity"


def check_granularity(spark: SparkSession, raw: TableRef, granularity: str) -> None:
    """Record how a raw table is partitioned at its first load, and refuse a load that partitions it otherwise.

    The partition is part of the key that tells stored versions, so such a load would store all of them again.
    """
    known = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {raw.name}").collect()}.get(GRANULARITY)
    if known is None:
        spark.sql(f"ALTER TABLE {raw.name} SET TBLPROPERTIES ('{GRANULARITY}' = '{granularity}')")
    elif known != granularity:
        raise ValueError(f"{raw.name} is partitioned by {known}, not by {granularity}")


def with_partition(rows: DataFrame, granularity: str = "day") -> DataFrame:
    """Raw-table rows with the column the table is partitioned by."""
    return rows.select(*RAW_COLUMNS, utc_day(F.col("data_modified"), granularity).alias(PARTITION_COLUMN))


def laid_out(rows: DataFrame) -> DataFrame:
    """Raw-table rows as they should lie in files.

    Small days share a task and a large day is split over several, so neither many small files nor one
    overlong task results. Within a file rows are sorted by advertiser and creative, which lets readers
    skip row groups.
    """
    return rows.hint("rebalance", PARTITION_COLUMN).sortWithinPartitions(PARTITION_COLUMN, *CREATIVE_KEY)


def append_raw(rows: DataFrame, raw: TableRef) -> int:
    """Append rows that have the partition column, and return how many there were.

    The rows are counted in the tasks that write them, after the last shuffle, so a stage that is run
    again does not count twice.
    """
    written = Observation()
    complete = enforce(rows, RAW_COLUMNS).select(*RAW_SCHEMA.names)
    spread = counted(complete.hint("rebalance", PARTITION_COLUMN), written)
    spread.sortWithinPartitions(PARTITION_COLUMN, *CREATIVE_KEY).write.insertInto(raw.name)
    return int(written.get.get("rows", 0))


def append(rows: DataFrame, table: TableRef, schema: T.StructType) -> None:
    """Append a whole DataFrame to an unpartitioned table, all or nothing, creating the table if absent."""
    if not table.exists(rows.sparkSession):
        table.create(rows.sparkSession, schema)
    required = [f.name for f in schema.fields if not f.nullable]
    enforce(rows, required).select(*schema.names).write.insertInto(table.name)


def replace_partition(rows: DataFrame, table: TableRef, schema: T.StructType, column: str, value: str) -> None:
    """Make `rows` all that a partition holds; written again after a failure, it holds them once.

    Only the files of that partition change.
    """
    spark = rows.sparkSession
    wanted = rows.withColumn(column, F.lit(value)).select(*schema.names)
    # Also files that were written but never became a partition of the catalog.
    spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS PARTITION ({column} = '{value}') PURGE")
    delete_folder(spark, f"{table.folder(spark)}/{column}={value}")
    spark.catalog.refreshTable(table.name)
    wanted.write.insertInto(table.name)


def drop_partitions(spark: SparkSession, table: TableRef, column: str, keep: Iterable[str]) -> list[str]:
    """Remove the partitions with other values than those to keep, with their files; returns their values."""
    spark.catalog.refreshTable(table.name)
    held = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table.name}").collect()]
    gone = sorted(set(held) - set(keep))
    for value in gone:
        spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS PARTITION ({column} = '{value}') PURGE")
        delete_folder(spark, f"{table.folder(spark)}/{column}={value}")
    spark.catalog.refreshTable(table.name)
    return gone


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder with all that is in it, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
