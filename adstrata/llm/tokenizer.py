"""A byte-level BPE vocabulary, read on the driver and sent to the executors."""

from __future__ import annotations

import base64
from functools import lru_cache

import tiktoken
from pyspark import Broadcast
from pyspark.sql import SparkSession


def ranks_of(lines: bytes) -> dict[bytes, int]:
    """The ranks in a file of lines that hold a token in base 64 and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}


@lru_cache(maxsize=4)
def _encoding(lines: bytes, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks_of(lines), special_tokens={})


class Vocabulary:
    """A rank file and the pattern that splits text before its merges; `encoding` is made once per worker."""

    def __init__(self, spark: SparkSession, path: str, pattern: str) -> None:
        with open(path, "rb") as file:
            self._lines: Broadcast[bytes] = spark.sparkContext.broadcast(file.read())
        self.pattern = pattern

    @property
    def encoding(self) -> tiktoken.Encoding:
        return _encoding(self._lines.value, self.pattern)
