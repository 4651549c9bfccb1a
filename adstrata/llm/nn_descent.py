"""Approximate nearest neighbours by cosine: a neighbour graph made by NN-descent, and greedy search on it.

Equal vectors are one node. The graph starts from runs of nodes next to each other in the order of random sign codes. Then,
round after round, the neighbours and the reverse neighbours of each node meet at it, and every two of them that are nearer
to each other than a neighbour that one of them has become neighbours: joins of neighbours of neighbours. A search keeps
the `BEAM` nearest nodes it has seen of each query, and in each round joins those not yet expanded with the graph.

Nothing grows with the data in one task: lists have bounded lengths, and reverse neighbours of a hub are limited before
they are shuffled. Vectors travel as half-precision unit vectors; final scores are exact.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adstrata.llm.common import stage

#: Neighbours of a node, reverse neighbours that meet at one, orders at the start, nodes in a run, rounds at most.
NEIGHBOURS, REVERSE, ORDERS, RUN, ROUNDS = 24, 12, 4, 512, 4
#: A round that changes a smaller share of all lists' entries is the last.
FEW = 0.01
#: Nodes that a search keeps, and how many of them it expands in a round.
BEAM, EXPANDED = 96, 32
#: Nodes that a search of a vector that isn't in the graph starts from.
ENTRIES = 64
#: Queries whose beams are kept by one task, about.
QUERIES_AT_ONCE = 64
#: Members of a node that are told apart: as many as a query wants, and itself.
_LIST = "node long, ids array<long>, sims array<float>"


def _groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[int, pd.DataFrame]]:
    """Runs of equal keys in sorted batches; runs may go on in the next batch."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        keys = batch[key].to_numpy()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        for low, high in zip(starts[:-1], starts[1:]):
            yield keys[low], batch.iloc[low:high]
        rest = batch.iloc[starts[-1] :]
    if rest is not None and len(rest):
        yield rest[key].iloc[0], rest


def _best(node: int, ids: np.ndarray, sims: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The `most` nearest distinct ids but `node`, ties to the smaller id."""
    order = np.lexsort((ids, -sims))
    ids, sims = ids[order], sims[order]
    _, first = np.unique(ids, return_index=True)
    keep = np.zeros(len(ids), bool)
    keep[first] = True
    keep &= ids != node
    return ids[keep][:most], sims[keep][:most]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["node", "ids", "sims"])


def _matrix(packed: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float16).astype(np.float32).reshape(len(packed), -1)


def _unit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [np.asarray(v, np.float64) for v in batch["vector"]]
        packed = [(v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max())).astype(np.float16).tobytes() for v in rows]
        yield batch[["node"]].assign(unit=packed)


def _coded(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes = [np.random.default_rng(order).standard_normal((size, 20)).astype(np.float32) for order in range(ORDERS)]
        for batch in batches:
            units = _matrix(batch["unit"]) if len(batch) else np.zeros((0, size), np.float32)
            for order in range(ORDERS):
                yield batch.assign(order=order, code=(units @ planes[order] > 0) @ (1 << np.arange(20, dtype=np.int64)))

    return run


def _run_neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Neighbours in runs of rows that come sorted by order and code; no run goes on into the next order."""
    rest = None
    for batch in batches:
        for _, part in batch.groupby("order"):
            if rest is not None and rest["order"].iloc[0] != part["order"].iloc[0]:
                yield _among(rest)
                rest = None
            rest = part if rest is None else pd.concat([rest, part], ignore_index=True)
            while len(rest) >= 2 * RUN:
                yield _among(rest.iloc[:RUN])
                rest = rest.iloc[RUN:]
    if rest is not None and len(rest):
        yield _among(rest)


def _among(run: pd.DataFrame) -> pd.DataFrame:
    unit, nodes = _matrix(run["unit"]), run["node"].to_numpy()
    sims = unit @ unit.T
    most = min(NEIGHBOURS + 1, len(nodes))
    top = np.argpartition(-sims, most - 1, axis=1)[:, :most]
    return _frame([(n, *_best(n, nodes[t], s[t], NEIGHBOURS)) for n, t, s in zip(nodes, top, sims)])


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One list for each node of the lists that come sorted by node; `fresh` counts entries that were in no `old` list."""
    rows = []
    for node, lists in _groups(batches, "node"):
        ids, sims = _best(node, np.concatenate(list(lists["ids"])), np.concatenate(list(lists["sims"])), NEIGHBOURS)
        old = [i for i, is_old in zip(lists["ids"], lists["old"]) if is_old]
        fresh = int((~np.isin(ids, np.concatenate(old))).sum()) if old else len(ids)
        rows.append((node, ids, sims, fresh))
        if len(rows) >= 5_000:
            yield pd.DataFrame(rows, columns=["node", "ids", "sims", "fresh"])
            rows = []
    yield pd.DataFrame(rows, columns=["node", "ids", "sims", "fresh"])


def _merge(lists: DataFrame) -> DataFrame:
    lists = lists.repartition("node").sortWithinPartitions("node")
    return stage(lists.mapInPandas(_merged, _LIST + ", fresh long"), "lists")


def _met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lists of what members of a node learn of each other there, cut to the nearest ones for several nodes at a time."""
    left, right, near = [], [], []
    waiting = 0

    def learnt() -> pd.DataFrame:
        a, b, s = (np.concatenate(x) for x in (left, right, near))
        order = np.lexsort((b, -s, a))
        a, b, s = a[order], b[order], s[order]
        starts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        return _frame([(a[i], *_best(a[i], b[i:j], s[i:j], NEIGHBOURS)) for i, j in zip(starts, np.r_[starts[1:], len(a)])])

    for _, members in _groups(batches, "center"):
        unit, nodes, farthest = _matrix(members["unit"]), members["node"].to_numpy(), members["farthest"].to_numpy()
        sims = unit @ unit.T
        i, j = np.nonzero((sims > farthest[:, None]) & (nodes[:, None] != nodes[None, :]))
        left.append(nodes[i])
        right.append(nodes[j])
        near.append(sims[i, j])
        waiting += len(i)
        if waiting > 1_000_000:
            yield learnt()
            left, right, near, waiting = [], [], [], 0
    if waiting:
        yield learnt()


def _limited(edges: DataFrame, by: str, most: int, *order) -> DataFrame:
    """At most `most` edges for each value of `by`; Spark limits them before the shuffle too."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return edges.withColumn("rank", rank).filter(F.col("rank") <= most).drop("rank")


def neighbour_graph(units: DataFrame, size: int) -> DataFrame:
    """`node`, `ids`, `sims`: the lists of near neighbours of the nodes in `units` (`node`, `unit`)."""
    coded = units.mapInPandas(_coded(size), "node long, unit binary, order int, code long")
    runs = coded.repartitionByRange("order", "code", "node").sortWithinPartitions("order", "code", "node")
    graph = _merge(runs.mapInPandas(_run_neighbours, _LIST).withColumn("old", F.lit(True)))
    for round_ in range(ROUNDS):
        farthest = F.when(F.size("sims") >= NEIGHBOURS, F.element_at("sims", -1)).otherwise(-2.0).alias("farthest")
        members = stage(units.join(graph.select("node", farthest), "node"), "members")
        edges = graph.select(F.col("node").alias("center"), F.explode("ids").alias("node"))
        back = edges.select(F.col("node").alias("center"), F.col("center").alias("node"))
        back = _limited(back, "center", REVERSE, F.xxhash64("node", F.lit(round_)), "node")
        meeting = edges.union(back).distinct().join(members, "node")
        met = meeting.repartition("center").sortWithinPartitions("center").mapInPandas(_met, _LIST)
        both = graph.select("node", "ids", "sims", F.lit(True).alias("old")).union(met.withColumn("old", F.lit(False)))
        graph = _merge(both)
        counts = graph.agg(F.sum("fresh"), F.sum(F.size("ids"))).first()
        if not counts[1] or counts[0] < FEW * counts[1]:
            break
    return graph.select("node", "ids", "sims")


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = []
    for node, beside in _groups(batches, "node"):
        rows.append((node, beside["other"].to_numpy(), b"".join(beside["unit"])))
        if len(rows) >= 1_000:
            yield pd.DataFrame(rows, columns=["node", "others", "units"])
            rows = []
    yield pd.DataFrame(rows, columns=["node", "others", "units"])


def _seen_from(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What queries see at the nodes they expand: those nearer than the farthest that they keep."""
    for batch in batches:
        rows = []
        for query, unit, worst, others, units in batch[["query", "unit", "worst", "others", "units"]].itertuples(index=False):
            one = np.frombuffer(unit, np.float16).astype(np.float32)
            sims = np.frombuffer(units, np.float16).astype(np.float32).reshape(len(others), -1) @ one
            near = sims > worst
            rows.append((query, np.asarray(others)[near], sims[near]))
        yield pd.DataFrame(rows, columns=["query", "ids", "sims"])


def _beams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The nearest nodes of each query, and which of them are expanded."""
    rows = []
    for query, lists in _groups(batches, "query"):
        ids, sims = _best(-1, np.concatenate(list(lists["ids"])), np.concatenate(list(lists["sims"])), BEAM)
        done = np.concatenate([d for d in lists["done"] if d is not None] or [np.empty(0, np.int64)])
        done = ids[np.isin(ids, done)]
        following = ids[~np.isin(ids, done)][:EXPANDED]
        worst = float(sims[-1]) if len(ids) >= BEAM else -2.0
        rows.append((query, ids, sims, np.concatenate([done, following]), following, worst))
        if len(rows) >= 5_000:
            yield pd.DataFrame(rows, columns=["query", "ids", "sims", "done", "next", "worst"])
            rows = []
    yield pd.DataFrame(rows, columns=["query", "ids", "sims", "done", "next", "worst"])


def search(queries: DataFrame, units: DataFrame, graph: DataFrame) -> DataFrame:
    """`query`, `ids`, `sims`: the nodes that a greedy search finds for each of `queries` (`query`, `unit`, `entries`).

    `entries` are the nodes to start from.
    """
    spark = queries.sparkSession
    tasks = max(1, -(-queries.count() // QUERIES_AT_ONCE))
    edges = graph.select("node", F.posexplode("ids").alias("at", "other"))
    back = graph.select(F.explode(F.arrays_zip("ids", "sims")).alias("x"), F.col("node").alias("other"))
    back = _limited(back.select(F.col("x.ids").alias("node"), "other", F.col("x.sims").alias("sim")), "node", NEIGHBOURS, F.desc("sim"), "other")
    beside = edges.select("node", "other").union(back.select("node", "other")).distinct()
    beside = beside.join(units.withColumnRenamed("node", "other"), "other")
    # Bucketed by node, the graph isn't shuffled again in any round. A task of the write has just one bucket, so it writes one file.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = beside.repartition(buckets, "node").sortWithinPartitions("node")
    packed = packed.mapInPandas(_packed, "node long, others array<long>, units binary")
    name = f"neighbours_{uuid.uuid4().hex}"
    packed.write.bucketBy(buckets, "node").sortBy("node").format("parquet").saveAsTable(name)
    try:
        beside = spark.table(name)
        beam = "query long, ids array<long>, sims array<float>, done array<long>, next array<long>, worst double"
        # The entries are seen first: a list of nodes with their units is looked at like that of an expanded node.
        first = queries.select("query", "unit", F.explode("entries").alias("node")).join(units.toDF("node", "units"), "node")
        first = first.select("query", "unit", F.lit(-2.0).alias("worst"), F.array("node").alias("others"), "units")
        seen = first.mapInPandas(_seen_from, "query long, ids array<long>, sims array<float>").withColumn("done", F.expr("cast(null as array<long>)"))
        state = None
        while True:
            lists = seen if state is None else seen.union(state.select("query", "ids", "sims", "done"))
            # Few queries don't need as many tasks as there are shuffle partitions; many take all of these.
            lists = lists.repartition("query").coalesce(tasks).sortWithinPartitions("query")
            state = stage(lists.mapInPandas(_beams, beam), "beams")
            frontier = state.select("query", "worst", F.explode("next").alias("node")).join(queries.select("query", "unit"), "query")
            if state.filter(F.size("next") > 0).isEmpty():
                return state.select("query", "ids", "sims")
            seen = frontier.join(beside, "node").mapInPandas(_seen_from, "query long, ids array<long>, sims array<float>")
            seen = seen.withColumn("done", F.expr("cast(null as array<long>)"))
    finally:
        spark.sql(f"DROP TABLE {name}")


def _cosine(left: str, right: str) -> str:
    dot = "aggregate(zip_with({0}, {1}, (x, y) -> x * y), 0D, (s, x) -> s + x)"
    return f"{dot.format(left, right)} / (sqrt({dot.format(left, left)}) * sqrt({dot.format(right, right)}))"


def usable(vectors: DataFrame, id_: str, vector: str) -> DataFrame:
    """`vec_id`, `vector` (array of double) of the rows that take part.

    Left out are null ids and vectors, those that are empty, zero, or hold null or a non-finite value, and those of another
    length than most.
    """
    rows = vectors.select(F.col(id_).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = "vec_id is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    rows = rows.filter(fine).filter("exists(vector, x -> x <> 0)")
    most = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vector") == (most["n"] if most else 0))


def nearest(vectors: DataFrame, queries: str, k: int = 5, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: the `k` nearest found for the rows that the SQL condition `queries` on `vec_id` names.

    Candidates are all usable rows but the query's own; repeated rows of one id are one. Ties go to the smaller id.
    """
    rows = stage(usable(vectors, id_, vector).dropDuplicates(["vec_id"]), "vectors")
    keyed = rows.withColumn("key", F.xxhash64("vector"))
    nodes = keyed.groupBy("key").agg(F.min("vec_id").alias("node"))
    keyed = stage(keyed.join(nodes, "key").select("vec_id", "node", "vector"), "nodes")
    own = keyed.filter("vec_id = node").select("node", "vector")
    size = rows.select(F.size("vector")).first()
    units = stage(own.mapInPandas(_unit, "node long, unit binary"), "units")
    graph = stage(neighbour_graph(units, size[0] if size else 0), "graph")
    asked = keyed.filter(queries).select(F.col("vec_id").alias("query"), "node")
    asked = stage(asked.join(units, "node").select("query", "unit", F.array("node").alias("entries")), "asked")
    found = search(asked, units, graph)
    # A node's members are equal: of a large one the smallest ids are enough, picked in slices first.
    slice_ = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    members = _limited(keyed.select("vec_id", "node", F.struct("node", slice_).alias("part")), "part", k + 1, "vec_id")
    members = _limited(members.drop("part"), "node", k + 1, "vec_id")
    near = found.select("query", F.explode("ids").alias("node"))
    mine = keyed.select(F.col("vec_id").alias("query"), F.col("vector").alias("mine"))
    scored = near.join(own, "node").join(mine, "query").select("query", "node", F.expr(_cosine("mine", "vector")).alias("score"))
    # A node of k + 1 members holds k others; more nodes than that are never needed.
    scored = _limited(scored, "query", k + 1, F.desc("score"), "node").join(members, "node").filter("vec_id <> query")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    ranked = scored.select(F.col("query").alias("query_id"), rank.alias("rank"), "vec_id", "score")
    return ranked.filter(F.col("rank") <= k)
