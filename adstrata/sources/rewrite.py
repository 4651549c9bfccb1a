"""Deleting keys from parquet tables by writing anew the files that hold them.

A rewrite keeps its work in the table's own folder, in one that readers pass over because its name begins with an underscore:

    _rewrite-<id>/rows/    what is left of the files that hold a key
    _rewrite-<id>/files/   the names of those files; when this is complete, the rewrite counts

Then the switch is made: new files move into the table's folder, and the named ones are removed. Whatever stops it, what the folder
holds tells what is left to do: without the names nothing has changed yet, and the folder is removed; with them the switch is
finished. Until it is, readers may see rows of both, but never miss one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstrata.operators.selection import listed, not_listed
from adstrata.session import stage
from adstrata.sources.tables import TableRef

_PREFIX = "_rewrite-"
_FILE = "_file"


class Folder:
    """A folder of the store that Spark keeps tables in."""

    def __init__(self, spark: SparkSession, location: str) -> None:
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self.path = self._paths(location)
        self._store = self.path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _within(self, *names: str):
        path = self.path
        for name in names:
            path = self._paths(path, name)
        return path

    def names(self, *below: str) -> list[str]:
        path = self._within(*below)
        return sorted(s.getPath().getName() for s in self._store.listStatus(path)) if self._store.exists(path) else []

    def has(self, *names: str) -> bool:
        return self._store.exists(self._within(*names))

    def move_up(self, *names: str) -> None:
        """Move a file from a folder below into this one."""
        if not self._store.rename(self._within(*names), self._within(names[-1])):
            raise OSError(f"could not move {self._within(*names)}")

    def remove(self, *names: str) -> None:
        self._store.delete(self._within(*names), True)

    @staticmethod
    def path_of(spark: SparkSession, uri: str) -> str:
        """The path of a file that `_metadata.file_path` names, where some characters are escaped."""
        jvm = spark._jvm
        return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()

    def remove_file(self, path: str) -> None:
        self._store.delete(self._paths(path), False)


def files_with(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """`_file`: the files of a table that hold one of the keys."""
    return listed(rows.select(column, F.col("_metadata.file_path").alias(_FILE)), keys, column).select(_FILE).distinct()


def delete_keys(table: TableRef, keys: DataFrame, column: str) -> int:
    """Delete the rows of an unpartitioned table whose `column` is one of `keys`; returns how many files were rewritten.

    Rows without a key stay. Sizes of new files follow the session's settings for rebalanced partitions, so what is left of
    several small files shares one. The driver names, moves and removes the files one by one: its work grows with the files
    touched, not with the rows. Nothing else may write to the table meanwhile; readers that listed a file before it was
    removed fail and have to be run again.
    """
    spark = keys.sparkSession
    finish_rewrites(spark, table)
    stored = table.read_anew(spark)
    keys = stage(keys.select(column).dropna().distinct(), "keys")
    touched = stage(files_with(stored, keys, column), "files")
    count = touched.count()
    if not count:
        return 0
    place = f"{_PREFIX}{uuid.uuid4().hex}"
    folder = table.folder(spark)
    paths = [Folder.path_of(spark, row[0]) for row in touched.toLocalIterator()]
    left = not_listed(spark.read.schema(stored.schema).parquet(*paths), keys, column)
    left.hint("rebalance").write.parquet(f"{folder}/{place}/rows")
    touched.write.parquet(f"{folder}/{place}/files")
    finish_rewrites(spark, table)
    return count


def finish_rewrites(spark: SparkSession, table: TableRef) -> int:
    """Finish what was begun, or remove it where it doesn't count yet; returns how many rewrites were finished."""
    location = table.folder(spark)
    folder, finished = Folder(spark, location), 0
    for place in folder.names():
        if not place.startswith(_PREFIX):
            continue
        if folder.has(place, "files", "_SUCCESS"):
            for name in folder.names(place, "rows"):
                if not name.startswith(("_", ".")):
                    folder.move_up(place, "rows", name)
            for row in spark.read.schema(f"{_FILE} string").parquet(f"{location}/{place}/files").toLocalIterator():
                folder.remove_file(Folder.path_of(spark, row[0]))
            finished += 1
        folder.remove(place)
    spark.catalog.refreshTable(table.name)
    return finished
