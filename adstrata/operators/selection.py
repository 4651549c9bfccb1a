"""Choosing rows by lists of ids and by market."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstrata.functions.dates import as_day
from adstrata.functions.regions import shown_in
from adstrata.operators.skew import BROADCAST_ROWS, fits_broadcast

Ids = str | Iterable[str] | DataFrame | None

# Lists up to this length go into the filter itself, where the parquet reader can use them.
INLINE_IDS = 1_000


def id_list(ids: str | Iterable[str] | None) -> list[str]:
    """One id or many, as a sorted list without repeats or NULLs."""
    if ids is None:
        return []
    if isinstance(ids, str):
        return [ids] if ids else []
    return sorted({i for i in ids if i is not None})


def ids_relation(df: DataFrame, ids: Ids, column: str) -> DataFrame:
    """A list of ids, or the first column of a table, as distinct rows of `column`."""
    if isinstance(ids, DataFrame):
        ids = ids.select(F.col(ids.columns[0]).alias(column))
        return ids.dropna().distinct()
    return df.sparkSession.createDataFrame([(i,) for i in id_list(ids)], f"{column} string")


def listed(
    df: DataFrame, ids: Ids, column: str = "advertiser_id", max_broadcast: int = BROADCAST_ROWS
) -> DataFrame:
    """The rows whose id is in a list or a table of ids.

    Short lists become a filter, counted small tables a broadcast semi-join, and anything larger a
    shuffled one, in which the adaptive skew join splits the rows of an id with very many.
    """
    if _inline(ids):
        return df.filter(F.col(column).isin(id_list(ids)))
    return _joined(df, ids, column, "left_semi", max_broadcast)


def not_listed(df: DataFrame, ids: Ids, column: str, max_broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """The other rows, among them those without an id."""
    if _inline(ids):
        return df.filter(~F.coalesce(F.col(column).isin(id_list(ids)), F.lit(False)))
    return _joined(df, ids, column, "left_anti", max_broadcast)


def _inline(ids: Ids) -> bool:
    return not isinstance(ids, DataFrame) and len(id_list(ids)) <= INLINE_IDS


def _joined(df: DataFrame, ids: Ids, column: str, how: str, max_broadcast: int) -> DataFrame:
    wanted = ids_relation(df, ids, column)
    if fits_broadcast(wanted, max_broadcast):
        wanted = F.broadcast(wanted)
    return df.join(wanted, column, how).select(df.columns)


def _flagged(df: DataFrame, ids: Ids, column: str, flag: str, max_broadcast: int) -> DataFrame:
    if _inline(ids):
        return df.withColumn(flag, F.coalesce(F.col(column).isin(id_list(ids)), F.lit(False)))
    wanted = ids_relation(df, ids, column).withColumn(flag, F.lit(True))
    if fits_broadcast(wanted.select(column), max_broadcast):
        wanted = F.broadcast(wanted)
    return df.join(wanted, column, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def _given(ids: Ids) -> bool:
    return isinstance(ids, DataFrame) or bool(id_list(ids))


def targeted(
    df: DataFrame,
    advertiser_ids: Ids = None,
    creative_ids: Ids = None,
    max_broadcast: int = BROADCAST_ROWS,
) -> DataFrame:
    """The rows of the listed advertisers together with the listed creatives. Either may be left out."""
    columns = df.columns
    if not _given(advertiser_ids) and not _given(creative_ids):
        raise ValueError("advertiser ids or creative ids are required")
    if not _given(creative_ids):
        return listed(df, advertiser_ids, "advertiser_id", max_broadcast)
    if not _given(advertiser_ids):
        return listed(df, creative_ids, "creative_id", max_broadcast)
    if _inline(advertiser_ids) and _inline(creative_ids):
        return df.filter(
            F.col("advertiser_id").isin(id_list(advertiser_ids)) | F.col("creative_id").isin(id_list(creative_ids))
        )
    flagged = _flagged(df, advertiser_ids, "advertiser_id", "_by_advertiser", max_broadcast)
    flagged = _flagged(flagged, creative_ids, "creative_id", "_by_creative", max_broadcast)
    return flagged.filter(F.col("_by_advertiser") | F.col("_by_creative")).select(columns)


def in_market(df: DataFrame, market: str) -> DataFrame:
    """Records of advertisers located in the market that were shown there."""
    return df.filter((F.col("advertiser_location") == market) & shown_in(F.col("region_stats"), market))


def between_days(df: DataFrame, column: str, start: date | str, end: date | str) -> DataFrame:
    """Rows whose day lies in the range, both ends included. A NULL day drops the row."""
    return df.filter(F.col(column).between(F.lit(as_day(start)), F.lit(as_day(end))))


def lookup(df: DataFrame, column: str, value: str) -> DataFrame:
    """The rows with one key value, for example the account or the codes of an e-mail address."""
    return df.filter(F.col(column) == value)
