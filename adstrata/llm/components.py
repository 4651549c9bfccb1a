"""Connected components of an edge table, by contracting the graph until no edge is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstrata.llm.common import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """`node`, `label` for every node of `edges` (`a`, `b`, both long, not null); the label is one of the component's nodes.

    Each round renames every node to its smallest neighbour and drops edges that have become loops. Node numbers should
    be hashes: then a round removes a constant share of the names. Every round is written to the shared folder, so
    lineage stays short. Self-loops give single nodes; an empty table gives none.
    """
    edges = stage(edges.select("a", "b").distinct(), "edges")
    single = edges.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("label"))
    rounds: list[DataFrame] = []
    while True:
        edges = edges.filter("a <> b")
        if edges.isEmpty():
            break
        both = edges.union(edges.select("b", "a"))
        smallest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        names = stage(smallest.select("node", F.least("node", "least").alias("name")), "names")
        rounds.append(names)
        edges = stage(
            edges.join(names.toDF("a", "new_a"), "a")
            .join(names.toDF("b", "new_b"), "b")
            .select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
            .filter("a <> b")
            .distinct(),
            "contracted",
        )

    if not rounds:
        return single
    final = rounds[-1].toDF("node", "label")
    for names in reversed(rounds[:-1]):  # a round has a fraction of the names of the one before
        later = final.toDF("name", "label")
        final = names.join(later, "name", "left").select("node", F.coalesce("label", "name").alias("label"))
    return final.union(single.join(rounds[0].select("node"), "node", "left_anti"))
