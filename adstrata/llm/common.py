"""What several of the operators share: tables, staged tables, and joins with a side of a checked size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adstrata import session

#: A side is broadcast only if an exact count finds no more rows of a few numbers than this.
BROADCAST_ROWS = 1_000_000
#: Characters that end a word, as in `[^\x20\x09-\x0D]+`.
WORD = r"[^\x20\x09-\x0D]+"
#: Whether the shuffle files of a query go when it ends; else they stay until the driver's garbage collector has been there.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

__all__ = ["BROADCAST_ROWS", "WORD", "ascii_lower", "drop", "one_if_small", "read", "row_key", "stage"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """`session.stage`, after which the shuffle files of the write are gone: nothing reads them again."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return session.stage(df, label)
    finally:
        conf.set(_CLEANUP, before)


def drop(*staged: DataFrame) -> None:
    """Delete the files of staged tables that nothing reads any more."""
    for df in staged:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(conf).delete(path, True)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def row_key(*columns: str) -> Column:
    """A 64-bit key of a row, the same in every run; equal rows share it."""
    return F.xxhash64(*columns)


def one_if_small(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`side`, marked for broadcast if an exact count finds at most `rows` rows; left to a shuffled join otherwise.

    `side` should be staged, for it is counted, and have few and short columns.
    """
    return F.broadcast(side) if side.limit(rows + 1).count() <= rows else side
