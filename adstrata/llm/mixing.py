"""Mixing sources to target weights, by capped water-filling and seeded repetitions.

Every source gets a share of the total size by its weight, but no more than `epochs` times its own size. The excess goes
to the other sources by their weights, again and again until no target is above its cap. A source's documents are then
taken whole as often as the target holds its size, and for the rest once more in a seeded order up to the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstrata.llm.common import WORD, one_if_small, stage

EPOCHS = 3
WEIGHTS = (5, 2, 1)
SEED = "mix"
#: A source's documents are dealt to so many slices by their hash. Only the slice in which the target ends is ordered.
SLICES = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_filling(sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """`sources` (`source`, `weight` > 0, `source_size`, long) with `target`, double.

    Only one row of sums comes to the driver in each round, and a round clamps at least one source for good.
    """
    sources = stage(sources.withColumn("cap", (F.col("source_size") * epochs).cast("double")), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    rate = None
    while True:
        held = F.col("cap") <= F.col("weight") * rate if rate is not None else F.lit(False)
        sums = sources.agg(F.sum(F.when(held, F.col("cap"))), F.sum(F.when(~held, F.col("weight")))).first()
        if not sums[1]:
            break
        new = (total - (sums[0] or 0.0)) / sums[1]
        if rate is not None and new <= rate:
            break
        rate = new
    return sources.withColumn("target", F.least("cap", F.col("weight") * F.lit(float(rate or 0.0)))).drop("cap")


def _row(doc_id: str = "doc_id", text: str = "text", source: str = "source") -> Column:
    """128 bits for a row; rows that are equal in all three share them."""
    parts = [F.col(doc_id).cast("string"), F.md5(text), F.md5(F.col(source).cast("string"))]
    return F.unhex(F.md5(F.concat_ws("|", *[F.coalesce(part, F.lit("-")) for part in parts])))


def repetitions(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """`row` (key), `doc_id`, `size`, `source`, `source_size`, `target`, `times` for each row of `documents`.

    `documents` has `doc_id`, `text`, `source`; other columns are unused. Sources take `weights` in turn, by code point,
    null last. Texts without words, and null ones, have size 0 and add nothing wherever they are taken. Equal rows are taken equally often; in the last part
    of a target they count as one row each. A document under several sources is taken from each as that source's target has it. An empty table gives an empty one.
    """
    number = F.md5(F.concat_ws("|", F.lit(SEED), F.col("doc_id").cast("string"), F.md5("text")))
    rows = documents.select(
        _row().alias("row"), "doc_id", "source", n_words(F.col("text")).alias("size"),
        F.conv(F.substring(number, 1, 15), 16, 10).cast("long").alias("place"),
    )
    rows = stage(rows.withColumn("slice", F.pmod("place", F.lit(SLICES))), "sizes")
    # One row for each source: their order is the only thing here that is worked out in one task.
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    targets = water_filling(sizes.withColumn("weight", weight.cast("double")), epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    targets = targets.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    # In which slice of a source the rest of its target ends.
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("in_slice"))
    before = F.sum("in_slice").over(Window.partitionBy("source").orderBy("slice")) - F.col("in_slice")
    slices = slices.withColumn("before", before).withColumnRenamed("source", "s").withColumnRenamed("slice", "p")
    ends = slices.join(targets, F.col("s").eqNullSafe(F.col("source")))
    ends = ends.filter("before < rest").groupBy("source").agg(F.max("p").alias("end"), F.max("before").alias("before"))
    ends = ends.withColumnRenamed("source", "s")
    plan = targets.join(ends, F.col("s").eqNullSafe(F.col("source")), "left").drop("s").withColumnRenamed("source", "s")
    plan = one_if_small(stage(plan, "plan"))
    placed = rows.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    first = placed.filter(F.coalesce(F.col("slice") < F.col("end"), F.lit(False))).withColumn("more", F.lit(1))
    after = placed.filter(F.coalesce(F.col("slice") > F.col("end"), F.lit(True))).withColumn("more", F.lit(0))
    order = Window.partitionBy("source").orderBy("place", "row")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2
    split = placed.filter(F.col("slice") == F.col("end"))
    split = split.withColumn("more", (F.col("before") + upto < F.col("rest")).cast("int"))
    same = Window.partitionBy("source", "row")
    split = split.withColumn("more", F.min("more").over(same))
    out = first.unionByName(after).unionByName(split)
    return out.select("row", "doc_id", "size", "source", "source_size", "target", F.least(F.lit(epochs), F.col("whole") + F.col("more")).alias("times"))


def mixed(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """The rows of `documents`, each as often as the mix takes it from its source."""
    times = repetitions(documents, weights, epochs).filter("times > 0").groupBy("row").agg(F.max("times").alias("__times"))
    rows = documents.withColumn("__row", _row())
    taken = rows.join(times.withColumnRenamed("row", "__row"), "__row")
    columns = [taken[c] for c in documents.columns]
    return taken.select(*columns, F.explode(F.sequence(F.lit(1), "__times")).alias("__copy")).drop("__copy")
