"""Alignment of two tokenizers over the same texts, by the spans they report.

A is a byte-level BPE of the `tokenizers` library, read over a space and the text; B a `sentencepiece` model, which puts that
space there itself. A reports the characters a token covers, B the bytes of a piece. These spans are the coarse cuts: a token
whose span starts where the one before ended, and is as long as its bytes, ends there. Tokens that hold a part of a
character (several then report the whole of it) and byte-fallback pieces end where their decoded bytes end.

Offsets where tokens of both end cut them into groups. No token is empty, so exactly one token of each ends at such an offset:
the last ones of the group are its link.

Texts are read in pieces, from the space or line feed after a visible character to the next. A splits texts there before it merges,
and B has no piece with a space or line feed after another character (`_Pair` looks whether both are so), so no token lies across
such a place: pieces are read alone, and each worker remembers those it met before. Otherwise a text is one piece.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, chain, repeat

import numpy as np
import pandas as pd
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adstrata.llm.common import stage

#: When a worker has met so many pieces, it forgets those it had not met since that happened before. And their greatest length.
REMEMBERED = 250_000
LONGEST = 64
#: New pieces that are read as one text.
READ = 2_000
#: Texts a worker holds at a time, in characters; one longer text is held alone.
HELD = 2_000_000
#: Pairs of ids that hold at least this share of all links are looked up in a broadcast table: there are no more than its inverse.
FREQUENT = 1 / 500_000

_SPACE = "▁"
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_COUNTED = "doc_id string, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<bigint>, times array<int>"


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones stand for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


def _ends(spans: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where each token ends: as its span says if that is exact, else by the bytes of the tokens up to it."""
    starts, ends = spans.T
    exact = (ends - starts == sizes) & (starts == np.concatenate(([0], ends[:-1])))
    return np.where(exact, ends, np.cumsum(sizes))


class _Pair:
    """Both tokenizers in one worker, and the pieces they have read."""

    def __init__(self, a: bytes, b: bytes) -> None:
        self.a = Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        letters = _byte_of_letter()
        of_a = {i: bytes(letters.get(c, 0) for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_a = [of_a.get(i, b"") for i in range(max(of_a) + 1)]
        self.bytes_b = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.sizes_a, self.sizes_b = (np.array(list(map(len, x))) for x in (self.bytes_a, self.bytes_b))
        # Ids as text, with what may follow them in a group.
        self.text_a = {end: np.array([f"{i}{end}" for i in range(len(self.bytes_a))], object) for end in ",|"}
        self.text_b = {end: np.array([f"{i}{end}" for i in range(len(pieces))], object) for end in ",;\n"}
        inner = [p.lstrip(_SPACE) for i, p in enumerate(pieces) if not self.b.is_control(i)]
        splits = json.loads(a)
        before_merges = splits["pre_tokenizer"] or {}
        self.cut = splits["normalizer"] is None and before_merges.get("type") == "ByteLevel" and before_merges.get("use_regex", True)
        self.cut = self.cut and not any(_SPACE in p or "\n" in p for p in inner)
        self.recent: dict[str, tuple | None] = {}
        self.earlier: dict[str, tuple | None] = {}

    def pieces(self, text: str) -> list[str]:
        return _CUT.split(" " + text) if self.cut else [" " + text]

    def learn(self, pieces: list[str]) -> dict[str, tuple | None]:
        """What is known of these pieces: counts, groups as text and links; None where the bytes of one differ."""
        if len(self.recent) > REMEMBERED:
            self.earlier, self.recent = self.recent, {}
        found, new, alone = {}, [], []
        for piece in dict.fromkeys(pieces):
            for known in (self.recent, self.earlier):
                if piece in known:
                    found[piece] = self.recent[piece] = known[piece]
                    break
            else:
                (alone if piece[-1].isspace() or len(piece) > LONGEST else new).append(piece)
        together = [new[n : n + READ] for n in range(0, len(new), READ)] + [[piece] for piece in alone]
        for some in together:
            read = dict(zip(some, self._read(some)))
            found.update(read)
            if len(some[0]) <= LONGEST:
                self.recent.update(read)
        return found

    def _read(self, pieces: list[str]) -> list[tuple | None]:
        """Reads pieces as one text; all but the last end with a visible character, so none changes another."""
        lead = "" if pieces[0].startswith(" ") else " a"
        text = lead + "".join(pieces)
        whole = text.encode()
        of_a = self.a.encode(text, add_special_tokens=False)
        of_b = self.b.encode(text[1:], return_type="proto", num_threads=1).pieces
        list_a, list_b = of_a.ids, [p.id for p in of_b]
        if text == " ":  # B reads nothing where it is given nothing
            list_b = [self.b.piece_to_id(_SPACE)]
        spelt = b"".join([self.bytes_a[i] for i in list_a]) == whole == b"".join([self.bytes_b[i] for i in list_b])
        if not spelt:
            return [None] if len(pieces) == 1 else list(chain.from_iterable(self._read([p]) for p in pieces))
        ids_a, ids_b = np.array(list_a, np.int64), np.array(list_b, np.int64)
        spans_a = np.array(list(chain.from_iterable(of_a.offsets))).reshape(-1, 2)
        # The space before the text is the first piece's.
        spans_b = np.array([[0] + [p.begin + 1 for p in of_b][1:], [p.end + 1 for p in of_b] or [1]]).T
        if len(whole) > len(text):  # characters to bytes
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            spans_a = np.concatenate(([0], np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF))))[spans_a]
        ends_a, ends_b = _ends(spans_a, self.sizes_a[ids_a]), _ends(spans_b, self.sizes_b[ids_b])
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, both), np.searchsorted(ends_b, both)
        links = (ids_a[last_a] << 32 | ids_b[last_b]).tolist()
        after = np.searchsorted(both, np.cumsum([len(lead), *(len(p.encode()) for p in pieces)]), side="right")

        # Tokens as text, those of a group next to each other, A's first.
        first_a, first_b = np.concatenate(([0], last_a + 1)), np.concatenate(([0], last_b + 1))
        text_a, text_b = self.text_a[","][ids_a], self.text_b[","][ids_b]
        text_a[last_a], text_b[last_b] = self.text_a["|"][ids_a[last_a]], self.text_b[";"][ids_b[last_b]]
        closing = last_b[after[1:] - 1]
        text_b[closing] = self.text_b["\n"][ids_b[closing]]
        out = np.empty(len(ids_a) + len(ids_b), object)
        out[np.arange(len(ids_a)) + first_b[np.searchsorted(both, ends_a)]] = text_a
        out[np.arange(len(ids_b)) + first_a[np.searchsorted(both, ends_b) + 1]] = text_b
        start = first_a[after[0]] + first_b[after[0]]
        groups = "".join(out[start:].tolist()).split("\n")
        edges, sums_a, sums_b = after.tolist(), first_a[after].tolist(), first_b[after].tolist()
        return [
            (sums_a[n + 1] - sums_a[n], sums_b[n + 1] - sums_b[n], groups[n], tuple(links[edges[n] : edges[n + 1]]))
            for n in range(len(pieces))
        ]


@lru_cache(maxsize=2)
def _pair(a: bytes, b: bytes) -> _Pair:
    return _Pair(a, b)


class Tokenizers:
    """The files of both tokenizers, read on the driver and sent to the executors."""

    def __init__(self, spark: SparkSession, a: str, b: str) -> None:
        with open(a, "rb") as one, open(b, "rb") as two:
            self._files: Broadcast[tuple[bytes, bytes]] = spark.sparkContext.broadcast((one.read(), two.read()))

    @property
    def pair(self) -> _Pair:
        return _pair(*self._files.value)


def _held(texts: list[str | None]) -> Iterator[slice]:
    """Runs of texts of about `HELD` characters."""
    first, size = 0, 0
    for n, text in enumerate(texts):
        if size and size + len(text or "") > HELD:
            yield slice(first, n)
            first, size = n, 0
        size += len(text or "")
    if first < len(texts):
        yield slice(first, len(texts))


def _aligned_texts(tokenizers: Tokenizers) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    nothing = (0, 0, 0, "", [], [])

    def one(pieces: list[str], known: dict) -> tuple:
        found = [known[p] for p in pieces]
        if not found or None in found:
            return nothing
        counts_a, counts_b, groups, links = zip(*found)
        links = np.fromiter(chain.from_iterable(links), np.int64)
        pairs, times = np.unique(links, return_counts=True)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        return sum(counts_a), sum(counts_b), len(links), digest, pairs, times.astype(np.int32)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = tokenizers.pair
        gc.disable()  # what is remembered is much and has no cycles; looking through it again and again takes a fifth of the time
        try:
            for frame in frames:
                gc.collect()
                texts = frame["text"].tolist()
                for held in _held(texts):
                    split = [pair.pieces(t) if t else [] for t in texts[held]]
                    known = pair.learn(list(chain.from_iterable(split)))
                    rows = list(map(one, split, repeat(known)))
                    out = pd.DataFrame(rows, columns=["n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])
                    out.insert(0, "doc_id", frame["doc_id"].iloc[held].to_numpy())
                    yield out
        finally:
            gc.enable()

    return run


def pair_counts(aligned: DataFrame) -> DataFrame:
    """`pair`, `count` and `best` (whether no other pair of the same B id has more links), staged."""
    links = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.pairs", "x.times")
    counts = links.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    counts = stage(counts, "pairs")
    most = counts.groupBy(F.expr("pair & 4294967295L").alias("b")).agg(F.max("count").alias("most"))
    both = counts.withColumn("b", F.expr("pair & 4294967295L")).join(most, "b")
    return stage(both.select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "counts")


def aligned(documents: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """Every row's tokens, groups and links: `doc_id`, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum`, `groups_sha256`.

    `documents` has `doc_id` and `text`; other columns are not read, whatever their names. A null or empty text, and one whose
    tokens don't spell it, has zeros and an empty digest. Repeated rows are counted and returned as often as they come;
    rows without `doc_id` as well. An empty table gives an empty one.

    `n_best` are the links of a pair that no other pair with its B id exceeds in all documents, ties included; `count_sum`
    adds up the pairs' counts over the links.
    """
    found = documents.select(F.col("doc_id").cast("string"), "text").mapInPandas(_aligned_texts(tokenizers), _COUNTED)
    found = found.withColumns({"doc_id": F.col("doc_id").cast("long"), "row": F.monotonically_increasing_id()})
    found = stage(found, "aligned")
    counts = pair_counts(found)
    total = counts.agg(F.sum("count")).first()[0] or 0
    frequent = F.broadcast(counts.filter(F.col("count") >= total * FREQUENT))
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    links = links.select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    rare = links.join(frequent.select("pair"), "pair", "left_anti")
    rare = rare.join(counts.filter(F.col("count") < total * FREQUENT), "pair")
    weighed = links.join(frequent, "pair").unionByName(rare)
    sums = weighed.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("count") * F.col("times")).alias("count_sum"),
    )
    nothing = F.lit(0).cast("long")
    return found.select("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256").join(sums, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", nothing).alias("n_best"),
        F.coalesce("count_sum", nothing).alias("count_sum"),
        "groups_sha256",
    )
