"""Hard negatives against brute force, with ties, repeats, nulls, vectors of other lengths and clashing columns."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from adstrata.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<double>, row string, v int, block long"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows: list[tuple], anchors) -> list[tuple]:
    rows = sorted({(i, la, tuple(int(np.floor(x * 256)) for x in v)) for i, la, v in rows}, key=str)
    last = 2**63 - 1
    at = lambda i: last if i is None else i
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in rows:
        if a[0] is None or not anchors(a[0]):
            continue
        same = sorted((-dot(a[2], r[2]), at(r[0])) for r in rows if r is not a and r[1] == a[1])[:5]
        for score, positive in same:
            score = -score
            fits = [(-dot(a[2], r[2]), at(r[0])) for r in rows if r[1] != a[1]]
            fits = sorted((s, i) for s, i in fits if 80 * score <= -100 * s <= 100 * score)[:5]
            out += [(a[0], positive if positive < last else None, n, i if i < last else None, score, -s) for n, (s, i) in enumerate(fits, 1)]
    return out


def found(spark, rows, anchors="vec_id % 10 = 0"):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    return [tuple(r) for r in H.hard_negatives(H.vectors_of(df), F.expr(anchors)).select(*COLUMNS).collect()]


def near(seed: int, n: int, dims: int = 8) -> list[tuple]:
    """Vectors about a few centres, of very different lengths, with copies."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    rows = []
    for i in range(n):
        v = centres[rng.integers(6)] * rng.choice([0.1, 1, 1, 1, 4]) + rng.normal(size=dims) * 0.15
        rows.append((i, int(rng.integers(3)) if i % 3 else 1, v.tolist()))
    return rows + [(n + i, rows[i][1], rows[i][2]) for i in range(0, n, 7)] + rows[:9]


@pytest.mark.parametrize("block", [1 << 18, 64, 8])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(H, "BLOCK", block)
    monkeypatch.setattr(H, "ANCHORS", 4)
    monkeypatch.setattr(H, "BLOCKS_PER_GROUP", 2)
    rows = near(block, 150)
    want = brute(rows, lambda i: i % 10 == 0)
    assert sorted(found(spark, rows)) == sorted(want) and len(want) > 50


def test_ties_other_lengths_and_rows_without_id(spark):
    rows = [(i, i % 2, [1.0, 0.5]) for i in range(24)] + [(30, 0, []), (31, 1, [1.0]), (32, 0, [1.0, 0.5, 9.0]), (None, 1, [1.0, 0.5]), (40, 1, [0.0, 0.0])]
    rows += [(50, 0, [-1.0, -1.0]), (10, 0, [2.0, 2.0])]
    got, want = found(spark, rows), brute(rows, lambda i: i % 10 == 0)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_rows_that_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    bad = [(100, None, [1.0, 1.0]), (110, 1, None), (120, 1, [1.0, None]), (130, 1, [inf, 1.0]), (140, 1, [1.0, nan]), (150, 0, [-inf, 1.0])]
    good = [(10, 1, [1.0, 1.0]), (11, 1, [1.0, 0.9]), (12, 0, [1.0, 0.8])]
    assert sorted(found(spark, bad + good)) == sorted(brute(good, lambda i: i % 10 == 0))
    assert found(spark, bad) == [] and found(spark, []) == []


def test_large_numbers_are_exact(spark):
    rows = [(10, 0, [3e6, 1.0]), (11, 0, [3e6, 2.0]), (12, 1, [3e6, 1.5]), (13, 1, [3e6, 1.25])]
    assert sorted(found(spark, rows)) == sorted(brute(rows, lambda i: i % 10 == 0))


def test_pruned_rows_score_too_little():
    rng = np.random.default_rng(3)
    vectors = np.floor(rng.normal(size=(500, 6)) * 40)
    lengths = H._lengths(vectors)
    units = H._units(vectors, lengths)
    order = np.argsort(units, axis=0).T
    block = H._Block.__new__(H._Block)
    block.rows = block.vec_ids = np.arange(500)
    block.vectors, block.order, block.most = vectors, order, lengths.max()
    block.sorted = np.take_along_axis(units.T, order, axis=1)
    pruned = 0
    for anchor in vectors[:40]:
        length = float(np.sqrt(anchor @ anchor))
        for least in (0.5, 0.8, 0.95):
            places = block.candidates(anchor, length, least * length * block.most)
            inside = set(range(500)) if places is None else set(places.tolist())
            assert set(np.flatnonzero(vectors @ anchor >= least * length * block.most).tolist()) <= inside
            pruned += 500 - len(inside)
    assert pruned > 30_000  # of 60,000
