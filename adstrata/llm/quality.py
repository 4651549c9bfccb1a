"""Quality rules with thresholds that adapt to each language and source.

Every document is measured. A sketch of each measure is kept per language and source: whole numbers fall into bins that
are 1/32 of their value wide, and a sketch is the count of each bin. Sketches merge by adding, in any order, so a rerun
gives the same thresholds. A fence is set `FENCE` interquartile ranges beyond a quantile: the quartiles for the length of
words, and a higher one for measures that are zero in most documents, whose quartiles say nothing. Groups of fewer than
`ENOUGH` documents use the sketch of their language, and small languages that of all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstrata.llm.common import one_if_small, stage

FENCE = 4
ENOUGH = 200
_SPACE, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
WINDOW = 5

#: What is counted, per 1000 of what, the percentile from which the upper fence is set, and, if there is a lower fence, the
#: least distance of the fences from the quartiles. In a group where few have a symbol, any symbol is beyond the fence.
MEASURES = {
    "symbols": ("n_symbols", "n_words", 90, None),
    "repeats": ("n_repeat_words", "n_words", 99, None),
    "lines": ("n_dup_lines", "n_lines", 99, None),
    "length": ("word_chars", "n_words", 75, 3000),
}


def _repeated(words: list[bytes]) -> int:
    """Words in windows that occur twice or more."""
    if len(words) <= WINDOW:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    last = len(ids) - WINDOW + 1
    codes, size = ids[:last], len(numbers)
    top = size
    for i in range(1, WINDOW):
        if top * size >= 2**62:  # rank the starts anew, so that codes stay exact
            every, codes = np.unique(codes, return_inverse=True)
            top = len(every)
        codes, top = codes * size + ids[i : last + i], top * size
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    if not same.any():
        return 0
    found = np.zeros(last, bool)
    found[order[1:][same]] = found[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for i in range(WINDOW):
        covered[i : last + i] |= found
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    """Words, characters in words, symbols, lines like an earlier one, words in repeated windows, lines."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, _SPACE))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip(_SPACE)]
    return len(words), len(text or "") - spaces, symbols, len(lines) - len(set(lines)), _repeated(words), len(lines)


_MEASURED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def _measured(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([measure(t) for t in batch], columns=_MEASURED)


def binned(value: Column) -> Column:
    """A whole number >= 0, cut to its six leading bits."""
    spare = F.greatest(F.length(F.conv(value, 10, 2)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, spare), spare)


def _rates() -> dict[str, Column]:
    return {m: F.floor(1000 * F.col(c) / F.greatest(per, F.lit(1))).cast("long") for m, (c, per, _, _) in MEASURES.items()}


def sketches(measured: DataFrame) -> DataFrame:
    """`lang`, `source`, `measure`, `bin`, `n`: the mergeable sketches."""
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), binned(r).alias("bin")) for m, r in _rates().items())))
    return measured.select("lang", "source", pairs.alias("p")).groupBy("lang", "source", "p.measure", "p.bin").agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """For each `keys` and measure: `docs`, `low`, `high`, from the sketches merged over all else."""
    merged = sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    merged = merged.withColumn("upto", F.sum("n").over(group.orderBy("bin"))).withColumn("docs", F.sum("n").over(group))
    top, least = F.lit(75), F.lit(None)
    for name, (_, _, percentile, distance) in MEASURES.items():
        top = F.when(F.col("measure") == name, percentile).otherwise(top)
        least = F.when(F.col("measure") == name, distance).otherwise(least)
    quantile = lambda q: F.min(F.when(F.col("upto") * 100 >= F.col("docs") * q, F.col("bin")))
    found = merged.groupBy(*keys, "measure", "docs").agg(quantile(25).alias("q1"), quantile(75).alias("q3"), quantile(top).alias("top"))
    reach = F.greatest((F.col("q3") - F.col("q1")) * FENCE, least)
    low = F.when(least.isNotNull(), F.col("q1") - reach).otherwise(F.lit(0)).cast("long")
    return found.select(*keys, "measure", "docs", low.alias("low"), (F.col("top") + reach).cast("long").alias("high"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """`lang`, `source`, and `low_<measure>`, `high_<measure>` for every group that has a sketch."""
    own, language, all_ = (fences(sketch, keys) for keys in (["lang", "source"], ["lang"], []))
    language = language.toDF("l", "m", "l_docs", "l_low", "l_high")
    all_ = all_.toDF("am", "a_docs", "a_low", "a_high")
    both = own.join(language, F.col("lang").eqNullSafe(F.col("l")) & (F.col("measure") == F.col("m")))
    both = both.join(all_, F.col("measure") == F.col("am"))
    pick = lambda c: F.when(F.col("docs") >= ENOUGH, F.col(c)).when(F.col("l_docs") >= ENOUGH, F.col(f"l_{c}")).otherwise(F.col(f"a_{c}"))
    chosen = both.select("lang", "source", "measure", pick("low").alias("low"), pick("high").alias("high"))
    of = lambda c, m: F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{c}_{m}")
    return chosen.groupBy("lang", "source").agg(*(of(c, m) for m in MEASURES for c in ("low", "high")))


def judged(documents: DataFrame) -> DataFrame:
    """`doc_id`, the measures, `base_failed` and `kept` for every row of `documents` (`doc_id`, `text`, `lang`, `source`).

    Base rules: at least 10 words, and at most 20 % of the words in repeated windows. Documents that pass them make the
    sketches, and are kept if every measure is within its group's fences. A null text has no words and fails. Null is a
    language and a source of its own. Repeated rows count as often as they are there.
    """
    measured = F.pandas_udf(_measured, ", ".join(f"{c} long" for c in _MEASURED))
    rows = documents.select("doc_id", "lang", "source", measured("text").alias("m")).select("doc_id", "lang", "source", "m.*")
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    rows = stage(rows.withColumn("base_failed", failed), "measured")
    limits = one_if_small(stage(thresholds(sketches(rows.filter("not base_failed"))), "thresholds"))
    limits = limits.withColumnsRenamed({"lang": "l", "source": "s"})
    found = rows.join(limits, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left")
    inside = F.lit(True)
    for name, rate in _rates().items():
        rate = rate if MEASURES[name][3] else binned(rate)  # a quantile is the lower end of a bin, and all of it is inside
        inside = inside & rate.between(F.col(f"low_{name}"), F.col(f"high_{name}"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return found.select("doc_id", "lang", "source", *_MEASURED, "base_failed", kept.alias("kept"))
