"""Checking arriving verification attempts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adstrata.operators.codes import EXPIRY_MINUTES, check_codes, status_of
from adstrata.session import stage
from adstrata.sources.tables import TableRef, append


def append_once(rows: DataFrame, table: TableRef, stream: str, batch: int) -> bool:
    """Append a micro-batch with the columns `stream` and `batch`, unless it is stored already.

    A stream that fails after the append and before its own commit runs that batch again. An append is all
    or nothing, so one stored row of the batch tells that all are.
    """
    spark = rows.sparkSession
    marks = {"stream": F.lit(stream), "batch": F.lit(batch).cast("long")}
    if table.exists(spark):
        stored = table.read_anew(spark)
        if not stored.filter((F.col("batch") == marks["batch"]) & (F.col("stream") == marks["stream"])).isEmpty():
            return False
    marked = rows.withColumns(marks)
    append(marked, table, marked.schema)
    return True


def check_stream(
    attempts: DataFrame,
    codes: Callable[[], DataFrame],
    results: TableRef,
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """Append the checked attempts of each micro-batch once, against the codes stored by then."""

    def check(batch: DataFrame, number: int) -> None:
        append_once(check_codes(batch, codes(), **options), results, checkpoint, number)

    return (
        attempts.writeStream.foreachBatch(check)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def recent_codes(attempts: DataFrame, codes: DataFrame, tiebreak: str, delay: str, minutes: int = EXPIRY_MINUTES) -> DataFrame:
    """Each attempt of a stream with `_match`, the newest code of another stream that was made in the minutes up to it, or NULL.

    An attempt is given out once, when no code of its time can come any more: both streams are past it by `delay`. Until then
    it is held, and codes are held for as long as an attempt may ask for them, so what is held depends on the rates, not on the
    age, of the streams. Rows that come later than `delay` after newer ones are dropped, and counted in the progress; so an
    attempt so late has no result, and a batch check has to look for it. Codes without an address don't move their stream on.
    """
    known = codes.select(
        F.col("email").alias("_email"),
        F.col("created_at").alias("_made"),
        F.struct("created_at", F.col(tiebreak).alias("tie"), F.col("verification_code").alias("code")).alias("_code"),
    ).withWatermark("_made", delay)
    near = F.expr(f"email = _email and _made <= attempted_at and _made >= attempted_at - interval {minutes} minutes")
    joined = attempts.withWatermark("attempted_at", delay).join(known, near, "left_outer")
    return joined.groupBy(*attempts.columns).agg(F.max("_code").alias("_match"))


def check_joined_streams(
    attempts: DataFrame,
    codes: DataFrame,
    stored: Callable[[], DataFrame],
    results: TableRef,
    checkpoint: str,
    tiebreak: str = "verification_code",
    delay: str = "10 minutes",
    minutes: int = EXPIRY_MINUTES,
) -> StreamingQuery:
    """Append the checked attempts of a stream, joined with the stream of codes.

    Most attempts follow their code within its minutes of validity, and are checked against the stream alone. The table of
    codes is asked only for those without a code so recent, to tell unknown addresses from old codes. Results equal those of
    `check_codes`. Attempts must differ in some column; equal ones count once.
    """

    def check(batch: DataFrame, number: int) -> None:
        # Written out, because the batch comes out of the state anew for each use.
        batch = stage(batch, "matched")
        columns = [c for c in batch.columns if c != "_match"]
        recent = batch.filter(F.col("_match").isNotNull()).withColumn("status", status_of(F.col("_match"), minutes))
        others = check_codes(batch.filter(F.col("_match").isNull()).select(columns), stored(), tiebreak, minutes)
        append_once(recent.select(*columns, "status").unionByName(others), results, checkpoint, number)

    matched = recent_codes(attempts, codes, tiebreak, delay, minutes)
    return matched.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
