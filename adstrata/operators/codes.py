"""Verification codes: the newest per address, checking attempts, deleting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstrata.operators.selection import not_listed
from adstrata.operators.skew import HOT_ROWS, broadcast_if_small, hot_keys
from adstrata.operators.versions import newest_per_key
from adstrata.session import stage

# Fixed value: a code is valid up to and including this many minutes after it was made.
EXPIRY_MINUTES = 10


def latest_codes(codes: DataFrame, tiebreak: str = "verification_code") -> DataFrame:
    """The newest code of each e-mail address."""
    return newest_per_key(codes, ["email"], [F.desc("created_at"), F.desc(tiebreak)])


def delete_codes(codes: DataFrame, emails: DataFrame) -> DataFrame:
    """The codes left once those of the given addresses are deleted."""
    return not_listed(codes, emails.select("email"), "email")


def expired(created_at: Column, now: Column, minutes: int = EXPIRY_MINUTES) -> Column:
    return now > created_at + F.make_dt_interval(mins=F.lit(minutes))


def complete_attempt() -> Column:
    """Whether an attempt has an address and a code."""
    return (F.coalesce(F.length("email"), F.lit(0)) > 0) & (F.coalesce(F.length("verification_code"), F.lit(0)) > 0)


def status_of(match: Column, minutes: int = EXPIRY_MINUTES) -> Column:
    """An attempt's status, given the newest code up to then (`code`, `created_at`), or NULL."""
    return (
        F.when(~complete_attempt(), "missing_input")
        .when(match.isNull(), "unknown_email")
        .when(~match["code"].eqNullSafe(F.col("verification_code")), "invalid_code")
        .when(expired(match["created_at"], F.col("attempted_at"), minutes), "expired")
        .otherwise("verified")
    )


def check_codes(
    attempts: DataFrame,
    codes: DataFrame,
    tiebreak: str = "verification_code",
    minutes: int = EXPIRY_MINUTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The attempts with a status, each checked against the newest code made up to then.

    Codes and attempts of an address are put in one time order and the last code carried forward, so
    no pairs are made. Only codes of addresses with an attempt are read into that order. Addresses with
    more than `hot_rows` rows are carried minute by minute.
    """
    given = complete_attempt()
    incomplete = attempts.filter(~given).withColumn("_match", F.lit(None))
    complete = attempts.filter(given)
    known = codes.filter(F.col("email").isNotNull() & F.col("created_at").isNotNull()).select(
        "email",
        F.col("created_at").alias("_at"),
        F.struct(F.col(tiebreak).alias("tie"), F.col("created_at"), F.col("verification_code").alias("code")).alias("_code"),
    )
    asked = broadcast_if_small(complete.select("email").distinct())
    known = known.join(asked, "email", "left_semi")
    hot = hot_keys(complete.select("email").unionAll(known.select("email")), ["email"], hot_rows)
    if hot is None:
        matched = _carried(complete, known)
    else:
        matched = _carried(
            complete.join(hot, "email", "left_anti"), known.join(hot, "email", "left_anti")
        ).unionByName(
            _carried_by_minute(complete.join(hot, "email", "left_semi"), known.join(hot, "email", "left_semi"))
        )
    status = status_of(F.col("_match"), minutes)
    checked = matched.unionByName(incomplete.withColumn("_match", F.lit(None).cast(matched.schema["_match"].dataType)))
    return checked.select(*attempts.columns, status.alias("status"))


def _carried(attempts: DataFrame, known: DataFrame) -> DataFrame:
    """The attempts with the last code of their address as `_match`."""
    asked = attempts.select("email", F.col("attempted_at").alias("_at"), F.struct(*attempts.columns).alias("_attempt"))
    timeline = known.unionByName(asked, allowMissingColumns=True)
    order = (
        Window.partitionBy("email")
        .orderBy("_at", F.col("_attempt").isNotNull(), "_code")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        timeline.withColumn("_match", F.last("_code", ignorenulls=True).over(order))
        .filter(F.col("_attempt").isNotNull())
        .select("_attempt.*", "_match")
    )


def _carried_by_minute(attempts: DataFrame, known: DataFrame) -> DataFrame:
    """The same for addresses with very many rows.

    Equal instants are collapsed first, so a minute holds at most its number of microseconds, and an
    address at most the minutes it spans. The code is carried within each minute, then from minute to
    minute, and the result joined to the attempts, where the skew join splits instants with very many.
    """
    asked = attempts.select("email", F.col("attempted_at").alias("_at")).dropna().distinct()
    timeline = known.groupBy("email", "_at").agg(F.max("_code").alias("_code")).unionByName(
        asked, allowMissingColumns=True
    )
    # Used twice below, so written out.
    instants = stage(timeline.withColumn("_minute", F.date_trunc("minute", "_at")), "instants")
    within = (
        Window.partitionBy("email", "_minute")
        .orderBy("_at", F.col("_code").isNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = (
        Window.partitionBy("email").orderBy("_minute").rowsBetween(Window.unboundedPreceding, -1)
    )
    newest = F.max_by("_code", F.when(F.col("_code").isNotNull(), F.col("_at")))
    minutes = instants.groupBy("email", "_minute").agg(newest.alias("_end"))
    carried = minutes.withColumn("_carry", F.last("_end", ignorenulls=True).over(before)).drop("_end")
    resolved = (
        instants.withColumn("_here", F.last("_code", ignorenulls=True).over(within))
        .filter(F.col("_code").isNull())
        .join(carried, ["email", "_minute"])
        .select("email", F.col("_at").alias("attempted_at"), F.coalesce("_here", "_carry").alias("_match"))
    )
    return attempts.join(resolved, ["email", "attempted_at"], "left").select(*attempts.columns, "_match")
