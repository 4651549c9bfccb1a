"""Incremental load of arriving source files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from adstrata.operators.projection import market_records, raw_rows
from adstrata.operators.selection import listed
from adstrata.plans.ingest import Target, load_new
from adstrata.plans.status import IngestStatus
from adstrata.sources.tables import ensure_raw_table


def stream_creatives(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int = 1000
) -> DataFrame:
    """New parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def ingest_stream(
    stream: DataFrame,
    tracking: Callable[[], DataFrame],
    target: Target,
    checkpoint: str,
) -> StreamingQuery:
    """Append the new versions of each micro-batch, until the files at hand are used up.

    The tracking table is read anew for every batch. The raw table is the state: a batch that is run
    again after a failure finds its own rows there and adds only the rest, so nothing is kept in memory
    between batches. Nothing is started if the raw table can't be made.
    """
    if ensure_raw_table(stream.sparkSession, target.raw) is IngestStatus.TABLE_CREATION_FAILED:
        raise RuntimeError(f"could not create {target.raw.name}")

    def load(batch: DataFrame, _: int) -> None:
        chosen = listed(batch, tracking().select("advertiser_id"))
        load_new(raw_rows(market_records(chosen, target.market, target.strict)), target)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
