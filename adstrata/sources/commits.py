"""Loads that fill several tables at once.

A load writes its rows under its own id, one partition of each table, and then one row of the table of commits. Readers keep the
rows of committed loads, so they see all tables with a load or all without it. A load that failed half-way is written again
under the same id; one that is committed is not. One writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstrata.operators.selection import listed
from adstrata.schemas import COMMITTED_AT, LOAD_COLUMN
from adstrata.sources.tables import TableRef, append, drop_partitions, replace_partition


def checked_load_id(load_id: str) -> str:
    """The id, if it can name a partition as it is."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", load_id):
        raise ValueError("a load id has letters, digits, hyphens and underscores")
    return load_id


@dataclass(frozen=True)
class Commits:
    """The table of commits, with a load id first and the time of the commit last."""

    table: TableRef
    schema: T.StructType

    def create(self, spark: SparkSession) -> None:
        if not self.table.exists(spark):
            self.table.create(spark, self.schema)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.table.read_anew(spark)

    def of(self, spark: SparkSession, load_id: str) -> Row | None:
        """The commit of a load; None as long as it has none."""
        rows = self.read(spark).filter(F.col(LOAD_COLUMN) == load_id).limit(1).collect()
        return rows[0] if rows else None

    def last(self, spark: SparkSession) -> Row | None:
        """The latest commit."""
        rows = self.read(spark).orderBy(F.desc(COMMITTED_AT)).limit(1).collect()
        return rows[0] if rows else None

    def add(self, spark: SparkSession, load_id: str, *values) -> None:
        """Commit a load. The row is one file, which is there or is not."""
        row = (load_id, *values, datetime.now(timezone.utc))
        append(spark.createDataFrame([row], self.schema).coalesce(1), self.table, self.schema)

    def rows_of(self, table: TableRef, spark: SparkSession) -> DataFrame:
        """A table's rows that count, by the commits as they are now."""
        loads = self.read(spark).select(LOAD_COLUMN)
        return listed(table.read_anew(spark), loads, LOAD_COLUMN)

    def write(self, rows: DataFrame, table: TableRef, schema: T.StructType, load_id: str) -> None:
        """Make `rows` what a load has in a table. They don't count before the commit."""
        replace_partition(rows, table, schema, LOAD_COLUMN, checked_load_id(load_id))

    def sweep(self, spark: SparkSession, tables: Iterable[TableRef]) -> list[str]:
        """Remove what loads without a commit left in the tables, and return their ids. No load may be running."""
        done = {r[0] for r in self.read(spark).select(LOAD_COLUMN).collect()}
        return sorted({load for table in tables for load in drop_partitions(spark, table, LOAD_COLUMN, keep=done)})
