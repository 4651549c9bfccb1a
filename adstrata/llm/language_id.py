"""Language ID by word frequencies, with back-off to ever shorter character n-grams for unseen words.

Training counts words per language over labelled texts, and counts the character n-grams of those words. A text's score
for a language is the sum over its words of log frequencies: that of the word itself if any language has it, else the
mean over its known n-grams of the longest length of which at least one is known.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstrata.llm.common import row_key, stage

#: No language: a text without letters, or no language learned.
UNDETERMINED = "und"
LONGEST_GRAM = 4
#: The classifier is fitted on about so many labelled texts, chosen by hash, and all of them if there are fewer. A language of
#: which these hold less than an equal share is represented by such a share, or by all of its texts.
TRAINING_TEXTS = 20_000
#: The words and n-grams that are kept: so many of the most frequent over all languages, and of each language its most
#: frequent up to an equal share of so many. This bounds what is sent to executors, by twice the number.
MOST_WORDS, MOST_GRAMS = 200_000, 100_000
_LETTERS = regex.compile(r"\p{L}+")
_REMEMBERED = 200_000
RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


@dataclass
class LanguageModel:
    """Rows of log frequencies per language: of words, and of n-grams of all lengths."""

    languages: list[str]
    words: list[str]
    word_rows: np.ndarray
    grams: list[str]
    gram_rows: np.ndarray


def _unseen(word: str, grams: dict[str, int], rows: np.ndarray) -> np.ndarray:
    """The mean over the known n-grams of the longest length that has any; nothing if no length has."""
    padded = f"<{word}>"
    for n in range(LONGEST_GRAM, 0, -1):
        known = [row for i in range(len(padded) - n + 1) if (row := grams.get(padded[i : i + n])) is not None]
        if known:
            return rows[known].mean(axis=0)
    return np.zeros(rows.shape[1])


def _bounded(counts: DataFrame, most: int, languages: list[str]) -> pd.DataFrame:
    """`gram`, `label`, `n` of the `most` most frequent grams, and of an equal share per language; ties in order of the grams."""
    chosen = counts.groupBy("gram").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "gram").limit(most).select("gram")
    for language in languages:
        own = counts.filter(F.col("label") == language).orderBy(F.desc("n"), "gram")
        chosen = chosen.union(own.limit(-(-most // len(languages))).select("gram"))
    chosen = F.broadcast(chosen.distinct())
    return counts.join(chosen, "gram").select("gram", "label", "n").toArrow().to_pandas()


def _log_frequencies(counted: pd.DataFrame, languages: list[str]) -> tuple[list[str], np.ndarray]:
    row, grams = pd.factorize(counted["gram"], sort=True)
    table = np.zeros((len(grams), len(languages)))
    table[row, pd.Index(languages).get_indexer(counted["label"])] = counted["n"]
    lengths = np.array([min(len(g), LONGEST_GRAM + 1) for g in grams])
    for length in np.unique(lengths):
        part = table[lengths == length] + 0.5
        table[lengths == length] = np.log(part / part.sum(axis=0))
    return list(grams), table


def _limit(share: float) -> int:
    """Of hashes of 62 bits, those below this are so large a share, however small it is."""
    return int(share * 2**62)


def train(labelled: DataFrame, text: str = "text", label: str = "lang") -> LanguageModel:
    """Fit a model on rows whose `text` and `label` are not null; other rows and columns are unused.

    With no such rows the model has no languages. Repeated rows count as often as they are there.
    """
    labelled = labelled.select(F.col(text).alias("text"), F.col(label).cast("string").alias("label")).dropna()
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if not sizes:
        return LanguageModel([], [], np.zeros((0, 0)), [], np.zeros((0, 0)))
    rows = sum(sizes.values())
    shares = {x: min(1.0, max(TRAINING_TEXTS / rows, TRAINING_TEXTS / len(sizes) / n)) for x, n in sizes.items()}
    limits = labelled.sparkSession.createDataFrame([(x, _limit(s)) for x, s in shares.items()], "label string, most long")
    chosen = labelled.join(F.broadcast(limits), "label").filter(F.shiftrightunsigned(row_key("text"), 2) < F.col("most"))
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)")))
    counts = stage(chosen.select("label", words.alias("gram")).groupBy("label", "gram").agg(F.count("*").alias("n")), "words")
    padded = F.concat(F.lit("<"), "gram", F.lit(">"))
    starts = F.sequence(F.lit(1), F.length(padded))
    every = F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(1), F.lit(LONGEST_GRAM)), lambda n: F.substring(padded, i, n))))
    grams = counts.select("label", "n", F.explode(F.array_distinct(every)).alias("gram"))
    grams = grams.groupBy("label", "gram").agg(F.sum("n").alias("n"))
    # A language is one that has a word, among the texts chosen.
    languages = sorted(r[0] for r in counts.select("label").distinct().collect())
    words, word_rows = _log_frequencies(_bounded(counts, MOST_WORDS, languages), languages)
    return LanguageModel(languages, words, word_rows, *_log_frequencies(_bounded(stage(grams, "grams"), MOST_GRAMS, languages), languages))


def _predictions(model: LanguageModel, texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    known = {word: i for i, word in enumerate(model.words)}
    grams = {gram: i for i, gram in enumerate(model.grams)}
    table = np.vstack([model.word_rows, np.zeros((_REMEMBERED, len(model.languages)))])
    fixed = filled = len(known)
    unseen: dict[str, int] = {}
    for batch in texts:
        out = []
        for text in batch:
            words = _LETTERS.findall(text.lower()) if text else []
            if not words or not model.languages:
                out.append((UNDETERMINED, 0.0))
                continue
            score = np.zeros(len(model.languages))
            rows = []
            for word in words:
                row = known.get(word)
                if row is None:
                    row = unseen.get(word)
                    if row is None:
                        scores = _unseen(word, grams, model.gram_rows)
                        if len(word) > 100:
                            score += scores
                            continue
                        if filled == len(table):  # forget the unseen words, after what was read is counted
                            score += table[rows].sum(axis=0)
                            rows, filled = [], fixed
                            unseen.clear()
                        unseen[word] = row = filled
                        table[row] = scores
                        filled += 1
                rows.append(row)
            score += table[rows].sum(axis=0) if rows else 0
            best = int(np.argmax(score))
            out.append((model.languages[best], float(1 / np.exp(score - score[best]).sum())))
        yield pd.DataFrame(out, columns=["lang_pred", "score"])


def predict(documents: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """`documents` with `lang_pred` and `score`, the posterior of that language among all, replacing columns so named.

    `und` and 0 where the text is null or has no letter, or the model no language. Nothing but the text is used.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def predicted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return _predictions(sent.value, texts)

    kept = [documents[c] for c in documents.columns if c not in ("lang_pred", "score")]
    found = documents.select(*kept, predicted(F.col(text)).alias("__found"))
    return found.select(*[c for c in found.columns if c != "__found"], "__found.lang_pred", "__found.score")
