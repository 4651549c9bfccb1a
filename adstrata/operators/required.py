"""Required columns: stop on a NULL, or set such rows aside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enforce(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail the job when a required column is NULL."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"required column {c} is NULL"))) for c in columns}
    )


def missing_columns(columns: Sequence[str]):
    """The comma-separated names of the required columns that are NULL."""
    return F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])


def split(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The complete rows, and the others with the names of what they lack."""
    incomplete = missing_columns(columns)
    marked = df.withColumn("missing", incomplete)
    return df.dropna(subset=list(columns)), marked.filter(F.col("missing") != "")
