"""Hard negatives by inner product, found through length buckets with sorted coordinate lists.

Rows are dealt into blocks by label and, within a label, by length, longest first. A block holds its vectors, and for each
coordinate its rows sorted by their value there once they are brought to length one. For an anchor of length `q` and a least
score, a row of a block no longer than `p` needs a cosine of at least `score / (q * p)`. A block whose own bound is above one is
left out whole. In the others that cosine bounds the values a row may have at any coordinate: about the anchor's own value there.
The ranges at the anchor's largest coordinates (its focus) are cut out of the sorted lists and intersected, and what is in all of
them is scored exactly.

Positives need a least score that isn't known: the fifth best in the block of the longest rows of the label stands for it.
Negatives have theirs from their positive. Anchors are a stated query set; they meet blocks in blocks of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstrata.llm.common import one_if_small, stage

#: Components in a block of vectors, and rows of a block of anchors.
BLOCK = 1 << 18
ANCHORS = 512
#: Coordinates of an anchor whose ranges are intersected.
FOCUS = 3
#: A block of anchors is sent once for so many blocks of vectors.
BLOCKS_PER_GROUP = 16
#: Least share of a positive's score that a negative has, in percent. The most is 100.
LEAST_PERCENT = 80

#: Slack for lengths and cosines, which are rounded; scores never are.
_SLACK = 1e-9
#: Up to here whole numbers are exact in double precision.
_EXACT = float(2**53)
_BLOCK = "label long, block long, most double, row binary, vec_id binary, dims int, vectors binary, order binary, sorted binary"


def vectors_of(embeddings: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """`vec_id`, `label`, `v` (whole numbers) for the rows that take part: those with a label and a vector of finite numbers."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col(vector).alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    rows = rows.filter(F.col("label").isNotNull() & F.col("x").isNotNull() & finite)
    return rows.select("vec_id", "label", F.transform("x", lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v"))


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors))


def _units(vectors: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.divide(vectors, lengths[:, None], out=np.zeros_like(vectors), where=lengths[:, None] > 0)


def _padded(vectors: list[np.ndarray]) -> np.ndarray:
    """Vectors as rows of one array; shorter ones have zeros at the end."""
    dims = max(map(len, vectors), default=0)
    if all(len(v) == dims for v in vectors):
        return np.array(vectors, float).reshape(len(vectors), dims)
    out = np.zeros((len(vectors), dims))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def _scores(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly: in doubles where all sums are, else in Python's numbers."""
    dims = min(rows.shape[1], len(anchor))
    rows, anchor = rows[:, :dims], anchor[:dims]
    if dims and len(rows) and np.abs(rows).max() * np.abs(anchor).max() * dims >= _EXACT:
        exact = [[int(x) for x in row] for row in rows]
        whole = [int(x) for x in anchor]
        return np.array([sum(x * y for x, y in zip(row, whole)) for row in exact], object)
    return (rows @ anchor).astype(np.int64)


def _built(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by label and length, as blocks with their sorted coordinate lists."""

    def block(rows: pd.DataFrame, number: int) -> pd.DataFrame:
        vectors = _padded(rows["v"].tolist())
        lengths = _lengths(vectors)
        units = _units(vectors, lengths)
        order = np.argsort(units, axis=0, kind="stable").T
        known = {
            "label": rows["label"].iloc[0],
            "block": number,
            "most": lengths.max(),
            "row": rows["row"].to_numpy(np.int64).tobytes(),
            "vec_id": rows["vec_id"].to_numpy(np.int64).tobytes(),
            "dims": vectors.shape[1],
            "vectors": vectors.tobytes(),
            "order": np.ascontiguousarray(order, np.int32).tobytes(),
            "sorted": np.ascontiguousarray(np.take_along_axis(units.T, order, axis=1)).tobytes(),
        }
        return pd.DataFrame([known])

    held, number = None, 0
    for frame in frames:
        held = frame if held is None else pd.concat((held, frame), ignore_index=True)
        while len(held):
            most = max(1, BLOCK // max(1, len(held["v"].iloc[0])))
            size = min(most, int((held["label"].to_numpy() == held["label"].iloc[0]).sum()))
            if size == len(held) and size < most:  # the next frame may go on with this label
                break
            yield block(held.iloc[:size], number)
            held, number = held.iloc[size:].reset_index(drop=True), number + 1
    if held is not None and len(held):
        yield block(held, number)


class _Block:
    """A block as its task reads it."""

    def __init__(self, known) -> None:
        self.rows, self.vec_ids = (np.frombuffer(x, np.int64) for x in (known.row, known.vec_id))
        self.vectors = np.frombuffer(known.vectors).reshape(len(self.rows), known.dims)
        self.order = np.frombuffer(known.order, np.int32).reshape(known.dims, len(self.rows))
        self.sorted = np.frombuffer(known.sorted).reshape(known.dims, len(self.rows))
        self.most = known.most

    def candidates(self, anchor: np.ndarray, length: float, least: float) -> np.ndarray | None:
        """The rows that may score `least` or more with an anchor; None for all."""
        if not least > 0:
            return None
        bound = least / (length * self.most) if length and self.most else np.inf
        if bound > 1 + _SLACK:
            return np.empty(0, np.int64)
        reach = np.arccos(min(bound, 1.0))
        unit = anchor[: len(self.order)] / length
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        ranges = []
        for f in focus:
            angle = np.arccos(np.clip(unit[f], -1, 1))
            low, high = np.cos(min(np.pi, angle + reach)) - _SLACK, np.cos(max(0.0, angle - reach)) + _SLACK
            ranges.append((np.searchsorted(self.sorted[f], low, "left"), np.searchsorted(self.sorted[f], high, "right"), f))
        ranges.sort(key=lambda r: r[1] - r[0])
        if not ranges or ranges[0][1] - ranges[0][0] == len(self.rows):
            return None
        seen = np.zeros(len(self.rows), np.int8)
        for start, stop, f in ranges:
            seen[self.order[f, start:stop]] += 1
        return np.flatnonzero(seen == len(ranges))

    def scored(self, anchor: np.ndarray, length: float, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Places in the block and scores of the candidates."""
        places = self.candidates(anchor, length, least)
        if places is None:
            return np.arange(len(self.rows)), _scores(self.vectors, anchor)
        return places, _scores(self.vectors[places], anchor)


def _first(places: np.ndarray, scores: np.ndarray, vec_ids: np.ndarray, k: int) -> np.ndarray:
    """The first `k` of them by score, then `vec_id`."""
    kept = np.arange(len(scores))
    if scores.dtype == object:
        return np.array(sorted(kept, key=lambda i: (-scores[i], vec_ids[places[i]]))[:k], np.int64)
    if len(scores) > 4 * k:
        kept = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return kept[np.lexsort((vec_ids[places[kept]], -scores[kept]))][:k]


def _positives(k: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Pairs of a block of anchors and a block of vectors of one label: for each anchor the block's first `k` other rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for pair in frame.itertuples(index=False):
                block, out = _Block(pair), []
                for row, v, least in zip(pair.a_row, pair.a_v, pair.a_least):
                    anchor = np.asarray(v, float)
                    length = float(np.sqrt(anchor @ anchor))
                    places, scores = block.scored(anchor, length, least)
                    other = block.rows[places] != row
                    places, scores = places[other], scores[other]
                    best = _first(places, scores, block.vec_ids, k)
                    out += [(row, int(block.vec_ids[places[i]]), int(scores[i])) for i in best]
                yield pd.DataFrame(out, columns=["row", "vec_id", "score"])

    return run


def _negatives(k: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Pairs of a block of anchors and a block of other labels: for each positive the block's first `k` rows of its window."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for pair in frame.itertuples(index=False):
                block, out = _Block(pair), []
                for row, v, label, wanted in zip(pair.a_row, pair.a_v, pair.a_label, pair.a_scores):
                    if label == pair.label:
                        continue
                    anchor = np.asarray(v, float)
                    length = float(np.sqrt(anchor @ anchor))
                    least = min(map(int, wanted)) * LEAST_PERCENT / 100
                    places, scores = block.scored(anchor, length, least - abs(least) * _SLACK)
                    for n, score in enumerate(map(int, wanted)):
                        inside = (100 * scores >= LEAST_PERCENT * score) & (scores <= score)
                        own, near = places[inside], scores[inside]
                        best = _first(own, near, block.vec_ids, k)
                        out += [(row, n, int(block.vec_ids[own[i]]), int(near[i])) for i in best]
                yield pd.DataFrame(out, columns=["row", "n", "negative_id", "negative_score"])

    return run


def _in_blocks(anchors: DataFrame, keys: list[str], fields: dict[str, Column]) -> DataFrame:
    """Anchors gathered in rows of about `ANCHORS`, by `keys` if there are any."""
    if keys:
        sized = anchors.join(anchors.groupBy(*keys).agg(F.ceil(F.count("*") / ANCHORS).alias("__parts")), keys)
    else:
        sized = anchors.withColumn("__parts", F.lit(max(1, -(-anchors.count() // ANCHORS))))
    part = F.pmod(F.xxhash64("row"), F.col("__parts"))
    entry = F.struct(*[column.alias(name) for name, column in fields.items()])
    gathered = sized.groupBy(*keys, part.alias("__part")).agg(F.collect_list(entry).alias("__a"))
    return gathered.select(*keys, *[F.col(f"__a.{name}").alias(name) for name in fields])


def _first_of(rows: DataFrame, keys: list[str], score: str, vec_id: str, k: int) -> DataFrame:
    """The first `k` rows of each key, with their `rank`; tasks drop what can't be among them before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(vec_id))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


_NO_ID = 2**63 - 1


def index(rows: DataFrame) -> DataFrame:
    """Blocks of `rows` (`row`, `vec_id`, `label`, `v`), staged, each with a number and a group of about `BLOCKS_PER_GROUP`."""
    length = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    keyed = rows.select("row", "vec_id", "label", "v", length.alias("__length"))
    # The row is in the order, so rows of one label and length are dealt to several tasks as well.
    dealt = keyed.repartitionByRange("label", F.desc("__length"), "row").sortWithinPartitions("label", F.desc("__length"), "row")
    blocks = dealt.drop("__length").mapInPandas(_built, _BLOCK)
    blocks = stage(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")
    groups = -(-blocks.count() // BLOCKS_PER_GROUP)
    return blocks.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(max(1, groups))))


def nearest_of_label(anchors: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """`row`, `vec_id`, `score`, `rank`: the first `k` other rows of the label of each anchor (`row`, `label`, `v`)."""
    schema = "row long, vec_id long, score long"
    longest = blocks.groupBy("label").agg(F.max_by("block", F.struct("most", "block")).alias("block")).select("block")
    longest = one_if_small(stage(longest, "longest"))
    fields = {"a_row": F.col("row"), "a_v": F.col("v"), "a_least": F.lit(float("-inf"))}
    first = _in_blocks(anchors, ["label"], fields).join(blocks.join(longest, "block"), "label")
    seeds = stage(first.mapInPandas(_positives(k), schema), "seeds")
    kth = seeds.groupBy("row").agg(F.min("score").alias("kth"), F.count("*").alias("n")).filter(F.col("n") >= k)
    known = stage(anchors.join(kth.select("row", "kth"), "row", "left"), "known")
    fields["a_least"] = F.coalesce(F.col("kth").cast("double"), F.lit(float("-inf")))
    others = blocks.join(longest, "block", "left_anti")
    asked = _in_blocks(known, ["label"], fields).join(others.select("label", "group").distinct(), "label")
    more = asked.join(others, ["label", "group"]).mapInPandas(_positives(k), schema)
    return _first_of(seeds.union(more), ["row"], "score", "vec_id", k)


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score` for the anchors among `rows`.

    `rows` has `vec_id`, `label` and `v`, an array of whole numbers, none of them null but for `vec_id`; see `vectors_of`.
    `anchors` tells which rows are anchors. An anchor's positives are its first other rows of the label, by score and
    `vec_id`; a positive's negatives are the first rows of other labels that score from `LEAST_PERCENT` to 100 percent of it.
    Vectors may differ in length: missing components count as zero. Rows that are alike in all three count once; rows
    that share only the `vec_id` are different rows, each with a result of its own. A row without `vec_id` comes after all others
    of its score, and has a null id. Scores must fit in 64 bits. An empty table gives an empty one.
    """
    rows = rows.withColumn("anchor", F.coalesce(anchors, F.lit(False)))
    rows = rows.select(F.coalesce("vec_id", F.lit(_NO_ID)).alias("vec_id"), "label", "v", "anchor").distinct()
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    blocks = index(rows)
    chosen = rows.filter("anchor").select("row", F.col("vec_id").alias("anchor_id"), "label", "v")
    # A positive with a score below zero has no negatives: 80 percent of it are more than all of it.
    found = nearest_of_label(chosen.drop("anchor_id"), blocks, positives).filter("score >= 0")
    found = stage(found.select("row", F.col("rank").alias("n"), "vec_id", "score"), "positives")
    wanted = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("p"))
    asked = stage(chosen.join(wanted, "row"), "asked")
    fields = {"a_row": F.col("row"), "a_v": F.col("v"), "a_label": F.col("label"), "a_scores": F.col("p.score")}
    groups = blocks.agg(F.max("group")).first()[0]
    sent = _in_blocks(asked, [], fields).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups or 0))))
    # Each block of the queries goes once to each group of blocks.
    pairs = sent.join(blocks, "group")
    found = stage(pairs.mapInPandas(_negatives(negatives), "row long, n int, negative_id long, negative_score long"), "negatives")
    ranked = _first_of(found, ["row", "n"], "negative_score", "negative_id", negatives)
    whose = asked.select("row", "anchor_id", F.posexplode("p").alias("n", "x")).select(
        "row", "anchor_id", "n", F.col("x.vec_id").alias("positive_id"), F.col("x.score").alias("positive_score")
    )
    ids = {c: F.nullif(F.col(c), F.lit(_NO_ID)) for c in ("anchor_id", "positive_id", "negative_id")}
    out = ranked.join(whose, ["row", "n"]).withColumns(ids)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
