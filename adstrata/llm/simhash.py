"""Near duplicates by SimHash fingerprints, found through deletion variants of their segments.

Fingerprints of 64 bits are cut into three segments. If two differ in at most four bits, one of the segments differs in at most
one, for three that differ in two each would be six. So every fingerprint is indexed by the variants of its segments with one
bit deleted, 64 in all: two segments share a variant exactly if they differ at most in that bit. Rows of equal variants meet in
one task, which verifies them.

Equal fingerprints are one row from the start. Of a variant with more than a few fingerprints, only links that connect them are
sent on, at most one fewer than there are, never all pairs; a pair of a smaller one is sent by the first variant it shares. A
variant of very many different fingerprints is passed on unread, and cut further: two of its fingerprints differ in at most
four of the other bits, so of five pieces of those one is equal. Where that leaves many still, they are dealt into blocks, and
each pair of blocks is a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstrata.llm.common import stage
from adstrata.llm.components import connected_components

BITS = 64
SEED = 42
#: Fingerprints link at so many differing bits or fewer.
DISTANCE = 4
#: First bits and lengths of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Different fingerprints of one key that a task verifies together.
BLOCK = 4_096
#: Up to so many, every link is sent.
FEW = 32
#: Shingles whose bits are counted at a time.
COUNTED = 1 << 16

_FOUND = "a long, b long, key long, hot boolean"


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprint(text: str | None, words: int) -> int:
    """The SimHash of a text's shingles, repeats included; 0 without words."""
    found = (text or "").encode().lower().split()  # of bytes: ASCII letters and white space alone
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(found) - words + 1)
    lasts = ends[min(words, len(found)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, COUNTED):
        part = zip(starts[at : min(at + COUNTED, n)].tolist(), lasts[at : at + COUNTED])
        hashes = np.array([digest(joined[start:end], SEED) for start, end in part], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame, words: int = 4) -> DataFrame:
    """`doc_id`, `fp` (long, the fingerprint's bits) for every row."""

    @F.pandas_udf("long")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([_signed(fingerprint(t, words)) for t in texts], dtype="int64")

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), of_texts(F.col("text")).alias("fp"))


def variants(fp: str = "fp") -> Column:
    """The keys of a fingerprint: the bit that was deleted, and the segment without it."""
    keys = []
    for first, length in SEGMENTS:
        segment = F.shiftrightunsigned(fp, first).bitwiseAND((1 << length) - 1)
        keys += [segment.bitwiseAND(~(1 << p)).bitwiseOR((first + p) << 32) for p in range(length)]
    return F.array(*keys)


def _others(key: Column, fp: str = "fp") -> Column:
    """Keys of the five pieces of the bits outside the segment of `key`, with the key itself."""
    deleted = F.shiftright(key, 32)
    pieces = []
    for first, length in SEGMENTS:
        high = F.shiftrightunsigned(fp, first + length) if first + length < BITS else F.lit(0).cast("long")
        outside = F.col(fp).bitwiseAND((1 << first) - 1).bitwiseOR(F.shiftleft(high, first))
        bits = BITS - length
        edges = [bits * n // (DISTANCE + 1) for n in range(DISTANCE + 2)]
        cut = [F.shiftrightunsigned(outside, a).bitwiseAND((1 << (b - a)) - 1) for a, b in zip(edges, edges[1:])]
        hashed = F.array(*[F.xxhash64(key, F.lit(n), piece) for n, piece in enumerate(cut)])
        pieces.append(F.when(deleted.between(first, first + length - 1), hashed))
    return F.coalesce(*pieces)


def _tree(members: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect the fingerprints which are connected by links; each joins one to a member found before."""
    links: list[tuple[int, int]] = []
    left = np.unique(members)
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            here = front.pop()
            near = np.bitwise_count(left ^ here) <= distance
            found = left[near]
            links += [(int(here), int(other)) for other in found]
            front += list(found)
            left = left[~near]
    return links


def _first_shared(differing: np.ndarray) -> np.ndarray:
    """The deleted bit of the first variant that two fingerprints share, by their differing bits."""
    out = np.full(len(differing), -1)
    for first, length in reversed(SEGMENTS):
        bits = differing >> np.uint64(first) & np.uint64((1 << length) - 1)
        # Of a power of two, the bits below it tell its place.
        place = np.where(bits == 0, 0, np.bitwise_count(bits - np.uint64(1)))
        out = np.where(np.bitwise_count(bits) <= 1, first + place, out)
    return out


def _near(distance: int, keyed_by_bit: bool, last: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Reads rows sorted by key. Gives links, and as `hot` the rows of keys above `BLOCK`, which it doesn't hold."""

    def links_of(keys: np.ndarray, fps: np.ndarray) -> pd.DataFrame:
        """Small keys: each row with those at a step further on, for as long as any key goes on."""
        one, two, step = [], [], 1
        edges = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
        sizes = np.diff(edges)
        large = sizes > FEW
        for start, size in zip(edges[:-1][large], sizes[large]):
            found = _tree(fps[start : start + size], distance)
            if found:
                a, b = zip(*found)
                one.append(np.array(a, np.uint64))
                two.append(np.array(b, np.uint64))
        small = np.repeat(~large & (sizes > 1), sizes)
        keys, fps = keys[small], fps[small]
        while step < len(keys):
            same = keys[step:] == keys[:-step]
            if not same.any():
                break
            differing = fps[step:] ^ fps[:-step]
            near = same & (np.bitwise_count(differing) <= distance)
            if keyed_by_bit:
                near[near] = _first_shared(differing[near]) == keys[step:][near] >> 32
            one.append(fps[:-step][near])
            two.append(fps[step:][near])
            step += 1
        if not one:
            return pd.DataFrame({"a": [], "b": []})
        both = pd.DataFrame({"a": np.concatenate(one).view(np.int64), "b": np.concatenate(two).view(np.int64)})
        return both.drop_duplicates()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_keys, held, hot = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for frame in frames:
            keys = np.concatenate((held_keys, frame["key"].to_numpy(np.int64)))
            fps = np.concatenate((held, frame["fp"].to_numpy(np.int64).view(np.uint64)))
            if not len(keys):
                continue
            edges = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            sizes = np.diff(np.concatenate((edges, [len(keys)])))
            over = (sizes > BLOCK) | (keys[edges] == hot if hot is not None else False)
            if last:
                over[:] = False
            hot = keys[-1] if over[-1] else None
            passed = np.repeat(over, sizes)
            if passed.any():
                a = fps[passed].view(np.int64)
                yield pd.DataFrame({"a": a, "b": a, "key": keys[passed], "hot": True})
            # The last key may go on in the next frame.
            open_ = len(keys) if over[-1] else edges[-1]
            done = ~passed
            done[open_:] = False
            if done.any():
                yield links_of(keys[done], fps[done]).assign(key=0, hot=False)
            held_keys, held = keys[open_:], fps[open_:]
        if len(held_keys):
            yield links_of(held_keys, held).assign(key=0, hot=False)

    return run


def _meet(rows: DataFrame, distance: int, keyed_by_bit: bool = False, last: bool = False) -> tuple[DataFrame, DataFrame]:
    """Links among the rows (`key`, `fp`) of equal keys, and the rows of keys that are too large to verify in one task."""
    dealt = rows.repartition("key").sortWithinPartitions("key")
    found = stage(dealt.mapInPandas(_near(distance, keyed_by_bit, last), _FOUND), "links")
    return found.filter("not hot").select("a", "b"), found.filter("hot").select("key", F.col("a").alias("fp"))


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """`a`, `b`: links between different fingerprints (`fp`, distinct) that connect all that links connect."""
    near, hot = _meet(fps.select("fp", F.explode(variants()).alias("key")), distance, keyed_by_bit=True)
    if hot.isEmpty():
        return near
    more, hot = _meet(hot.select("fp", F.explode(_others(F.col("key"))).alias("key")), distance)
    near = near.union(more)
    if hot.isEmpty():
        return near
    # Blocks of half the size, so that a pair of them is one task's fill.
    sizes = hot.groupBy("key").agg(F.ceil(F.count("*") * 2 / BLOCK).cast("int").alias("blocks"))
    placed = hot.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    partner = F.expr("explode(sequence(0, blocks - 1))")
    pairs = placed.select("key", "fp", "block", partner.alias("other"))
    pairs = pairs.select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key"), "fp")
    return near.union(_meet(pairs, distance, last=True)[0])


def near_duplicates(documents: DataFrame, words: int = 4, distance: int = DISTANCE) -> DataFrame:
    """`doc_id`, `fp`, `component_id` for every row of `documents` (`doc_id`, `text`; other columns aren't read).

    A null text, and one without words, has the fingerprint zero, which links like any other. Equal fingerprints link. A
    component's id is the smallest `doc_id` in it, null if none has one; rows without `doc_id`, and repeated rows, take part
    and are returned as often as they come. An empty table gives an empty one. `distance` may be up to `DISTANCE`.
    """
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"distance must be from 0 to {DISTANCE}")
    rows = stage(fingerprints(documents, words), "fingerprints")
    least = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    labels = connected_components(stage(links(least.select("fp"), distance), "edges")).withColumnRenamed("node", "fp")
    named = least.join(labels, "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    named = stage(named, "named")
    firsts = named.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = stage(named.join(firsts, "label").select("fp", "component_id"), "components")
    return rows.join(ids, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
