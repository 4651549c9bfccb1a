"""A table of the stored versions' digests beside a raw table, bucketed so that a load joins it without shuffling it.

A version is its advertiser, creative and text; its digest is 128 bits of their SHA-256, so digests spread evenly over the
buckets whatever creative has many versions. The index is partitioned by the year first shown, which equal versions share, so
a load reads the years it has. It takes 16 bytes a stored row where the raw table holds texts.

The index follows the raw table: each load adds what it appended, and then notes the files of both. A load that finds other files
than those noted, because one before it stopped half-way, somebody else wrote, or files of the index were lost, builds it anew.
"""

from __future__ import annotations

import hashlib
import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adstrata.schemas import PARTITION_COLUMN
from adstrata.sources.tables import TableRef, delete_folder

log = logging.getLogger(__name__)

VERSION = "version"
YEAR = "first_year"
#: The table property that holds a digest of the names of both tables' files.
FILES = "adstrata.indexed_files"


def version_digest() -> Column:
    """128 bits that tell versions apart; NULL, which matches nothing, if a part of the key is."""
    ids = [F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)) for c in ("advertiser_id", "creative_id")]
    return F.substring(F.unhex(F.sha2(F.concat(*ids, "raw_data"), 256)), 1, 16)


def first_year() -> Column:
    return F.trunc(PARTITION_COLUMN, "year").cast("date")


@dataclass(frozen=True)
class VersionIndex:
    """The index of a raw table. Choose `buckets` so that a bucket of a year's digests fits a task."""

    raw: TableRef
    table: TableRef
    buckets: int = 32

    def _create(self, spark: SparkSession) -> None:
        if "." in self.table.name:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.table.name.rsplit('.', 1)[0]}")
        location = f"LOCATION '{self.table.location}'" if self.table.location else ""
        spark.sql(
            f"CREATE TABLE {self.table.name} ({VERSION} BINARY, {YEAR} DATE) USING parquet PARTITIONED BY ({YEAR}) "
            f"CLUSTERED BY ({VERSION}) INTO {self.buckets} BUCKETS {location}"
        )

    def _files(self, spark: SparkSession) -> str:
        names = sorted(f for table in (self.raw, self.table) for f in table.read_anew(spark).inputFiles())
        return hashlib.sha256("\n".join(names).encode()).hexdigest()

    def _noted(self, spark: SparkSession) -> str | None:
        return {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {self.table.name}").collect()}.get(FILES)

    def note(self, spark: SparkSession) -> None:
        """Note that the index holds all of the raw table as it is now."""
        spark.sql(f"ALTER TABLE {self.table.name} SET TBLPROPERTIES ('{FILES}' = '{self._files(spark)}')")

    def ensure(self, spark: SparkSession) -> bool:
        """Build the index if it doesn't hold the raw table as it is now; returns whether it had to."""
        exists = self.table.exists(spark)
        if exists and self._noted(spark) == self._files(spark):
            return False
        log.info("building the index of %s", self.raw.name)
        if exists:
            folder = self.table.folder(spark)
            spark.sql(f"DROP TABLE {self.table.name}")
            delete_folder(spark, folder)
        elif self.table.location:
            delete_folder(spark, self.table.location)
        self._create(spark)
        self.add(self.raw.read_anew(spark))
        self.note(spark)
        return True

    def add(self, rows: DataFrame) -> None:
        """Add the versions of raw-table rows."""
        versions = rows.select(version_digest().alias(VERSION), first_year().alias(YEAR)).dropna().distinct()
        # A task a bucket, so a year gets one file a bucket and load.
        dealt = versions.repartition(self.buckets, VERSION).sortWithinPartitions(YEAR, VERSION)
        dealt.write.insertInto(self.table.name)

    def known(self, rows: DataFrame) -> DataFrame:
        """The digests of those of the (staged) rows whose version is stored. The index is read in place, by buckets."""
        spark = rows.sparkSession
        keyed = rows.select(version_digest().alias(VERSION), first_year().alias(YEAR)).dropna()
        # Their number is bounded by the years covered.
        years = [r[0] for r in keyed.select(YEAR).distinct().collect()]
        stored = self.table.read_anew(spark).filter(F.col(YEAR).isin(years)).select(VERSION)
        asked = keyed.select(VERSION).distinct().repartition(self.buckets, VERSION)
        return asked.join(stored.hint("merge"), VERSION, "left_semi")

    def new_versions(self, rows: DataFrame) -> DataFrame:
        """The (staged) rows whose version is not stored; equal rows are all kept, and so are rows with a NULL key."""
        keyed = rows.withColumn("_version", version_digest())
        known = self.known(rows).withColumnRenamed(VERSION, "_version")
        return keyed.join(known, "_version", "left_anti").select(rows.columns)
