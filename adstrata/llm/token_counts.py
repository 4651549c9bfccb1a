"""Token counts that follow edits: a segment tree of pre-tokens per document.

A text is cut into leaves of about `LEAF` characters at places that are pre-token boundaries whatever else the text holds:
before a space that follows a character other than white space. Each leaf is encoded apart, and a tree holds the sums of
characters and tokens. An edit re-encodes the leaves that it touches, plus those beside it whose cut it could change, and
updates the sums above them. Nothing else of the text is encoded again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstrata.llm.tokenizer import Vocabulary

LEAF = 512
#: A leaf that has grown to more than so many times `LEAF` is cut again.
GROWN = 4
TREE = "struct<chars: array<int>, tokens: array<int>, char_sums: array<long>, token_sums: array<long>>"
EDITS = "array<struct<start: int, stop: int, new: string>>"


def cuts(text: str, leaf: int) -> list[str]:
    """`text` in leaves."""
    parts, start = [], 0
    while len(text) - start > leaf:
        at = start + leaf
        while (at := text.find(" ", at)) >= 0 and text[at - 1].isspace():
            at += 1
        if at < 0:
            break
        parts.append(text[start:at])
        start = at
    return [*parts, text[start:]]


class CountTree:
    """Leaves in the last half of two heaps, with their sums above them; the root is at 1."""

    def __init__(self, count, chars: np.ndarray, tokens: np.ndarray, leaf: int = LEAF) -> None:
        self.count, self.leaf = count, leaf
        self._fill(chars, tokens)

    @classmethod
    def of(cls, count, text: str, leaf: int = LEAF) -> CountTree:
        parts = cuts(text, leaf)
        return cls(count, np.array([len(p) for p in parts]), np.array([count(p) for p in parts]), leaf)

    def _fill(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.leaves, self.half = len(chars), 1 << max(0, len(chars) - 1).bit_length()
        self.chars, self.tokens = np.zeros(2 * self.half, np.int64), np.zeros(2 * self.half, np.int64)
        for heap, values in ((self.chars, chars), (self.tokens, tokens)):
            heap[self.half : self.half + len(values)] = values
            level = self.half
            while level > 1:
                heap[level // 2 : level] = heap[level : 2 * level : 2] + heap[level + 1 : 2 * level : 2]
                level //= 2

    def _set(self, leaf: int, chars: int, tokens: int) -> None:
        node = self.half + leaf
        more = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more[0]
            self.tokens[node] += more[1]
            node //= 2

    def _at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character (beyond the last one: the last leaf that has any) and where it starts."""
        node, start, place = 1, 0, min(place, int(self.chars[1]) - 1)
        while node < self.half:
            node *= 2
            if place >= start + self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return node - self.half, start

    def edit(self, text: str, start: int, stop: int, new: str) -> tuple[str, int]:
        """Replace `text[start:stop]`; the new text, and how many characters were encoded again."""
        size = len(text)
        start, stop = max(0, min(start, size)), max(0, min(stop, size))
        stop = max(start, stop)
        edited = text[:start] + new + text[stop:]
        if not size:
            self._fill(*self._leaves(edited))
            return edited, len(edited)
        first, low = self._at(start)
        if start == low and low > 0:  # the space that starts this leaf may change
            first, low = self._at(low - 1)
        last, high = self._at(max(start, stop - 1))
        high += int(self.chars[self.half + last])
        shift = len(edited) - size
        while high < size and (high + shift <= low or edited[high + shift - 1].isspace()):
            last, at = self._at(high)
            high = at + int(self.chars[self.half + last])
        region = edited[low : high + shift]
        if len(region) > GROWN * self.leaf and (last - first + 1) * self.leaf < len(region):
            chars, tokens = (h[self.half : self.half + self.leaves] for h in (self.chars, self.tokens))
            more = self._leaves(region)
            self._fill(*(np.concatenate([h[:first], m, h[last + 1 :]]) for h, m in zip((chars, tokens), more)))
        else:
            self._set(first, len(region), self.count(region))
            for leaf in range(first + 1, last + 1):
                self._set(leaf, 0, 0)
        return edited, len(region)

    def _leaves(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        parts = cuts(text, self.leaf)
        return np.array([len(p) for p in parts]), np.array([self.count(p) for p in parts])

    def as_row(self) -> tuple:
        leaves = slice(self.half, self.half + self.leaves)
        return self.chars[leaves], self.tokens[leaves], self.chars[: self.half], self.tokens[: self.half]


def _counter(vocabulary: Vocabulary):
    encode = vocabulary.encoding.encode_to_numpy
    return lambda text: len(encode(text, disallowed_special=()))


def count_trees(documents: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """`documents` with `tree` and `n_tokens`. A null text counts as an empty one: one empty leaf, no tokens."""

    @F.pandas_udf(TREE)
    def trees(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            count = _counter(vocabulary)
            rows = [CountTree.of(count, t or "").as_row() for t in batch]
            yield pd.DataFrame(rows, columns=["chars", "tokens", "char_sums", "token_sums"])

    return with_count(documents.withColumn("tree", trees(F.col(text))))


def with_count(trees: DataFrame) -> DataFrame:
    # The root is the second entry of the sums; a tree of one leaf has none above it.
    root = F.coalesce(F.get("tree.token_sums", F.lit(1)), F.get("tree.tokens", F.lit(0)))
    return trees.withColumn("n_tokens", root.cast("long"))


def apply_edits(trees: DataFrame, vocabulary: Vocabulary, text: str = "text", edits: str = "edits") -> DataFrame:
    """`trees` after the edits in `edits` (`EDITS`), made one after another; places beyond the text are taken as its end.

    `text`, `tree` and `n_tokens` are replaced, `n_encoded` says how many characters were encoded again. A null list, and
    an edit that is null, changes nothing; a null `new` is an empty one, a null place the text's start.
    """

    parts = ["chars", "tokens", "char_sums", "token_sums"]

    @F.pandas_udf("text string, n_encoded long, chars array<int>, tokens array<int>, char_sums array<long>, token_sums array<long>")
    def edited(batches: Iterator[tuple[pd.Series, pd.DataFrame, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, rows, lists in batches:
            count, out = _counter(vocabulary), []
            for body, chars, tokens, list_ in zip(texts, rows["chars"], rows["tokens"], lists):
                tree, body, encoded = CountTree(count, chars, tokens), body or "", 0
                for edit in list_ if list_ is not None else ():
                    if edit is not None:
                        body, n = tree.edit(body, edit["start"] or 0, edit["stop"] or 0, edit["new"] or "")
                        encoded += n
                out.append((body, encoded, *tree.as_row()))
            yield pd.DataFrame(out, columns=["text", "n_encoded", *parts])

    kept = [c for c in trees.columns if c not in (text, "tree", "n_tokens", "n_encoded")]
    done = trees.select(*kept, edited(F.col(text), F.col("tree"), F.col(edits)).alias("__edited"))
    tree = F.struct(*(F.col(f"__edited.{c}").alias(c) for c in parts)).alias("tree")
    return with_count(done.select(*kept, F.col("__edited.text").alias(text), tree, "__edited.n_encoded"))
