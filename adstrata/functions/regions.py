"""Expressions over the per-region array of a creative."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shown_in(regions: Column, market: str) -> Column:
    """Whether any entry is of the market. Never NULL, so it can be negated."""
    return F.coalesce(F.exists(regions, lambda r: r["region_code"] == market), F.lit(False))


def market_entries(regions: Column, market: str) -> Column:
    """The market's entries, as whole structs."""
    return F.filter(regions, lambda r: r["region_code"] == market)


def single(entries: Column, strict: bool = True) -> Column:
    """The only element, NULL when there is none.

    More than one fails the job, or gives NULL when not strict.
    """
    first = F.get(entries, F.lit(0))
    if strict:
        return F.when(F.size(entries) > 1, F.raise_error(F.lit("more than one entry for the market"))).otherwise(first)
    return F.when(F.size(entries) <= 1, first)
