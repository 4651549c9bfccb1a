"""Byte-level BPE encoding and decoding of texts of any length.

A text is cut into chunks of `CHUNK` characters that overlap by `OVERLAP`. Chunks are pre-tokenised in parallel, each from
its own start, which may lie inside a pre-token. Two neighbours agree from the first boundary that both find in their
overlap on, for what the pattern matches depends only on what follows. There the text is cut into pieces, which are
encoded apart, and a text's ids are those of its pieces in order. A text with neighbours that find no common boundary
(a pre-token longer than the overlap) is encoded as one piece. Decoding joins the tokens' bytes.

Ids are held as binary: little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstrata.llm.common import one_if_small, stage
from adstrata.llm.tokenizer import Vocabulary

CHUNK, OVERLAP = 16_384, 512
#: How far a pattern of pre-tokens looks beyond a match: a contraction, or one character after white space.
LOOK_AHEAD = 2


def boundaries(pattern: regex.Pattern, text: str) -> list[int]:
    """Where matches end, as far as text that may follow can't change them, after a character that isn't white space.

    What precedes such a boundary is matched in the same way if the text ends there.
    """
    return [e for m in pattern.finditer(text) if (e := m.end()) <= len(text) - LOOK_AHEAD and not text[e - 1].isspace()]


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for key, text in zip(batch["key"], batch["text"]):
            starts = range(0, len(text), CHUNK)
            for some in (starts[i : i + 64] for i in range(0, len(starts), 64)):
                parts = [text[s : s + CHUNK + OVERLAP] for s in some]
                yield pd.DataFrame({"key": key, "chunk": [s // CHUNK for s in some], "part": parts})


def _pre_tokenised(pattern: str):
    """Of each chunk the boundaries in the overlap with the chunk before, and in that with the chunk after."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = regex.compile(pattern)
        for batch in batches:
            found = [np.array(boundaries(compiled, part), np.int32) for part in batch["part"]]
            yield batch[["key", "chunk"]].assign(
                head=[e[e <= OVERLAP] for e in found], tail=[e[e >= CHUNK] - CHUNK for e in found]
            )

    return run


def _encoded_pieces(vocabulary: Vocabulary):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # The last chunk has no end: it goes on to the end of its part.
            ends = [CHUNK + int(e) if e >= 0 else None for e in batch["end"]]
            pieces = [p[int(s) : e] for p, s, e in zip(batch["part"], batch["start"], ends)]
            yield batch[["key", "chunk"]].assign(ids=[_ids(vocabulary, piece) for piece in pieces])

    return run


def _ids(vocabulary: Vocabulary, text: str | None) -> bytes:
    return np.asarray(vocabulary.encoding.encode_to_numpy(text or "", disallowed_special=()), "<u4").tobytes()


def _joined(pieces: pd.DataFrame) -> pd.DataFrame:
    """The ids of one text, which came as one row and are one row again. Equal texts give equal pieces."""
    pieces = pieces.drop_duplicates("chunk").sort_values("chunk")
    return pd.DataFrame({"key": [pieces["key"].iloc[0]], "__ids": [b"".join(pieces["ids"])]})


def _long_texts(texts: DataFrame, vocabulary: Vocabulary, whole: Callable[[Column], Column]) -> DataFrame:
    """`key`, `__ids` for texts of several chunks, one row for a key; those that can't be stitched go through `whole`."""
    chunks = texts.mapInPandas(_chunks, "key string, chunk long, part string")
    chunks = stage(chunks.repartition("key", "chunk"), "chunks")
    found = chunks.mapInPandas(_pre_tokenised(vocabulary.pattern), "key string, chunk long, head array<int>, tail array<int>")
    found = stage(found.distinct(), "boundaries")
    next_ = found.select("key", (F.col("chunk") - 1).alias("chunk"), F.col("head").alias("next"))
    common = F.array_min(F.array_intersect("tail", "next"))
    last = F.col("next").isNull()
    cuts = found.join(next_, ["key", "chunk"], "left").select("key", "chunk", F.when(last, -1).otherwise(common).alias("end"))
    cuts = stage(cuts, "cuts")
    starts = cuts.select("key", (F.col("chunk") + 1).alias("chunk"), F.col("end").alias("start"))
    pieces = cuts.join(starts, ["key", "chunk"], "left").withColumn("start", F.coalesce("start", F.lit(0)))
    unstitched = cuts.filter("end is null").select("key").distinct()
    pieces = pieces.join(unstitched, "key", "left_anti")
    schema = "key string, chunk long, ids binary"
    # The cuts go to the chunks, if there are few, so that the texts aren't shuffled again.
    pieces = one_if_small(stage(pieces, "pieces"))
    ids = chunks.join(pieces, ["key", "chunk"]).mapInPandas(_encoded_pieces(vocabulary), schema)
    stitched = ids.groupBy("key").applyInPandas(_joined, "key string, __ids binary")
    rest = texts.join(one_if_small(stage(unstitched, "unstitched")), "key", "left_semi").dropDuplicates(["key"])
    return stage(stitched.union(rest.select("key", whole(F.col("text")))), "long")


def encode(documents: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """`documents` with `ids` (binary) and `n_tokens`, replacing columns so named; a null text has no ids.

    Rows keep their number, repeated ones too, and no key is needed. Special tokens are ordinary text.
    """

    @F.pandas_udf("binary")
    def whole(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([_ids(vocabulary, t) for t in batch], dtype=object)

    columns = [c for c in documents.columns if c not in ("ids", "n_tokens")]
    long_ = F.coalesce(F.length(text) > CHUNK + OVERLAP, F.lit(False))
    short = documents.filter(~long_).select(*columns, whole(F.col(text)).alias("ids"))
    keyed = documents.filter(long_).select(*columns, F.sha2(text, 256).alias("__key"))
    ids = _long_texts(keyed.select(F.col("__key").alias("key"), F.col(text).alias("text")), vocabulary, whole)
    # Only the columns that are asked for later are shuffled here, so a text need not be.
    done = keyed.join(ids.withColumnRenamed("key", "__key"), "__key").select(*columns, F.col("__ids").alias("ids"))
    return short.union(done).withColumn("n_tokens", (F.length("ids") / 4).cast("long"))


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """`encoded` with `decoded`, the bytes of the tokens joined; null for null."""

    @F.pandas_udf("binary")
    def joined(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            decode_bytes = vocabulary.encoding.decode_bytes
            yield pd.Series([None if b is None else decode_bytes(np.frombuffer(b, "<u4").tolist()) for b in batch], dtype=object)

    return encoded.withColumn("decoded", joined(F.col(ids)))
