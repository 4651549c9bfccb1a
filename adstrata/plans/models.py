"""Version history and mart, kept up to date load by load.

A load is extended by the raw rows it brought. Its versions continue the numbers of a state with one row a creative, and its part of
the mart is added to those of earlier loads: counts add up, days are compared, and distinct creatives are united as bitmaps
of their numbers. So neither the raw table nor the history is read again. History, state, parts of the mart and a commit
belong together: readers see a load in all of them or in none.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstrata.operators.skew import broadcast_if_small, fits_broadcast
from adstrata.operators.versions import version_history
from adstrata.plans.marts import MART_FIELDS, staging
from adstrata.schemas import (
    CREATIVE_KEY,
    HISTORY_SCHEMA,
    LOAD_COLUMN,
    MART_PART_SCHEMA,
    MODEL_COMMIT_SCHEMA,
    STATE_SCHEMA,
)
from adstrata.session import stage
from adstrata.sources.commits import Commits, checked_load_id
from adstrata.sources.tables import TableRef, drop_partitions

_KEY = list(CREATIVE_KEY)
#: Numbers in a bitmap, as Spark's bitmap functions have it.
BITMAP = 32_768


@dataclass(frozen=True)
class ModelTables:
    history: TableRef
    state: TableRef
    parts: TableRef
    loads: TableRef

    @property
    def commits(self) -> Commits:
        return Commits(self.loads, MODEL_COMMIT_SCHEMA)

    def create(self, spark: SparkSession) -> None:
        for table, schema in ((self.history, HISTORY_SCHEMA), (self.state, STATE_SCHEMA), (self.parts, MART_PART_SCHEMA)):
            if not table.exists(spark):
                table.create(spark, schema, LOAD_COLUMN)
        self.commits.create(spark)

    def read_history(self, spark: SparkSession) -> DataFrame:
        return self.commits.rows_of(self.history, spark)

    def read_state(self, spark: SparkSession) -> DataFrame:
        """The state after the last load: its partition alone is read."""
        last = self.commits.last(spark)
        state = self.state.read_anew(spark)
        return state.filter(F.col(LOAD_COLUMN) == last[LOAD_COLUMN]) if last else state.limit(0)

    def read_mart(self, spark: SparkSession) -> DataFrame:
        return merged_mart(self.commits.rows_of(self.parts, spark))


def numbered(creatives: DataFrame, after: int) -> DataFrame:
    """`creatives` (distinct ids) with a `number` each, above `after` and different, near for one advertiser's.

    Tasks number what they have, in runs that begin with a bitmap, so an advertiser with very many is numbered by several.
    """
    dealt = creatives.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY)
    start = -(-after // BITMAP) * BITMAP + 1
    return stage(dealt.withColumn("number", F.monotonically_increasing_id() + start), "numbered")


def mart_part(rows: DataFrame, numbers: DataFrame, schema: T.StructType) -> DataFrame:
    """What raw rows add to the mart, given the numbers of their creatives."""
    group = ["advertiser_id", "ad_format_type"]
    staged = staging(rows, schema, MART_FIELDS)
    sums = staged.groupBy(*group).agg(
        F.count(F.lit(1)).alias("versions"),
        F.min("first_shown_date").alias("first_shown_date"),
        F.max("last_shown_date").alias("last_shown_date"),
    )
    number = F.col("number")
    keyed = staged.select(*group, "creative_id").distinct().join(numbers, _KEY)
    sets = keyed.groupBy(*group, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    )
    return sums.unionByName(sets, allowMissingColumns=True)


def merged_mart(parts: DataFrame) -> DataFrame:
    """The mart that parts add up to, with the columns of `creatives_mart`."""
    group = ["advertiser_id", "ad_format_type"]
    united = parts.filter(F.col("bucket").isNotNull()).groupBy(*group, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counted = united.select(*group, F.bitmap_count("bits").alias("creatives"))
    both = parts.filter(F.col("bucket").isNull()).drop("bucket", "bits", LOAD_COLUMN).unionByName(counted, allowMissingColumns=True)
    first, last = F.min("first_shown_date"), F.max("last_shown_date")
    return both.groupBy(*group).agg(
        F.coalesce(F.sum("creatives"), F.lit(0).cast("long")).alias("creatives"),
        F.sum("versions").alias("versions"),
        first.alias("first_shown_date"),
        last.alias("last_shown_date"),
        (F.datediff(last, first) + 1).cast("long").alias("active_days"),
    )


def extend_models(spark: SparkSession, models: ModelTables, rows: DataFrame, load_id: str, schema: T.StructType) -> bool:
    """Add a load's raw rows to history, state and mart; False if the load has no rows or was added before.

    All rows must be newer, by `metadata_time`, than those of the loads before; otherwise numbers given out already would
    change, and the load is refused. `schema` is that of the records in the texts. One that failed half-way is run again.
    """
    checked_load_id(load_id)
    models.create(spark)
    commits = models.commits
    if commits.of(spark, load_id) is not None:
        return False
    versions = stage(version_history(rows), "versions")
    span = versions.agg(F.min("metadata_time").alias("oldest"), F.max("metadata_time").alias("newest")).first()
    if span.newest is None:
        return False
    last = commits.last(spark)
    if last is not None and span.oldest <= last.newest_time:
        raise ValueError(f"load {load_id} has rows as old as those of {last[LOAD_COLUMN]}")

    before = models.read_state(spark).drop(LOAD_COLUMN)
    ends = versions.groupBy(*_KEY).agg(
        F.max("version_no").alias("added"), F.max_by("digest", "version_no").alias("digest")
    )
    touched = stage(ends, "touched")
    keys = broadcast_if_small(touched.select(*_KEY))
    known = stage(before.join(keys, _KEY, "left_semi"), "known")
    new = numbered(touched.select(*_KEY).join(broadcast_if_small(known.select(*_KEY)), _KEY, "left_anti"), last.last_number if last else 0)
    now = touched.join(known.unionByName(new, allowMissingColumns=True), _KEY).select(
        *_KEY, (F.coalesce("last_no", F.lit(0)) + F.col("added")).alias("last_no"), F.col("digest").alias("last_digest"), "number"
    )
    now = stage(now, "ends")
    state = before.join(keys, _KEY, "left_anti").unionByName(now)

    # The first version of a creative in this load follows the last one of the state.
    follows = known.select(*_KEY, "last_no", "last_digest")
    follows = F.broadcast(follows) if fits_broadcast(follows.select(*_KEY)) else follows
    changed = F.when(F.col("version_no") > 1, F.col("changed")).otherwise(F.coalesce(F.col("digest") != F.col("last_digest"), F.lit(False)))
    continued = versions.join(follows, _KEY, "left").select(
        *_KEY,
        "metadata_time",
        "data_modified",
        "digest",
        "copies",
        (F.coalesce("last_no", F.lit(0)) + F.col("version_no")).alias("version_no"),
        changed.alias("changed"),
    )
    commits.write(continued, models.history, HISTORY_SCHEMA, load_id)
    commits.write(state, models.state, STATE_SCHEMA, load_id)
    commits.write(mart_part(rows, now.select(*_KEY, "number"), schema), models.parts, MART_PART_SCHEMA, load_id)
    number = max(now.agg(F.max("number")).first()[0], last.last_number if last else 0)
    commits.add(spark, load_id, span.newest, number)
    return True


def drop_old_states(spark: SparkSession, models: ModelTables, keep: Iterable[str] = ()) -> list[str]:
    """Remove the states that later loads replaced, but for those to keep; returns the loads they were of."""
    last = models.commits.last(spark)
    return drop_partitions(spark, models.state, LOAD_COLUMN, keep=[*keep, *([last[LOAD_COLUMN]] if last else [])])
