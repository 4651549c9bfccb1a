"""Row counts and existence probes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> int:
    return df.count()


def any_rows(df: DataFrame) -> bool:
    """Stops at the first row found."""
    return not df.isEmpty()


def counted(df: DataFrame, observation: Observation) -> DataFrame:
    """The same rows; the observation holds their number once an action has run over them."""
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))
