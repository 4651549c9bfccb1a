"""SimHash near duplicates against brute force, with hot variants, and on nulls, empty and long texts, repeats and clashing columns."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from adstrata.llm import simhash as S
from adstrata.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values: list[int]) -> list[int]:
    """For each value the smallest index that links reach."""
    label = list(range(len(values)))
    bits = np.array(values, np.uint64)
    todo = list(range(len(values)))
    seen = set()
    for i in todo:
        if i in seen:
            continue
        front = [i]
        while front:
            j = front.pop()
            if j in seen:
                continue
            seen.add(j)
            label[j] = i
            front += [k for k in np.flatnonzero(np.bitwise_count(bits ^ bits[j]) <= 4).tolist() if k not in seen]
    return label


def test_documents(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(words, 90)) for _ in range(25)]
    texts = [None, "", " \t\n", "one", "One", "one two three", "one two three four", "x" * 70_000, "ÄÖ É É ß İ", "a b c d " * 30_000]
    texts += base + base[:5] + [b.replace(b.split()[40], "other", 1) for b in base] + [b.upper() for b in base[:3]]
    rows = [(i, t, 7, 1, 2) for i, t in enumerate(texts)] + [(None, base[0], 7, 1, 2), (None, "alone and not like any other text", 7, 1, 2), (10, base[0], 7, 1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int, key int, component_id int")
    got = S.near_duplicates(df).select("doc_id", S.hex_digits().alias("fingerprint"), "component_id").collect()
    prints = [fingerprint(r[1]) for r in rows]
    label = classes(prints)
    least = {}
    for (i, *_), c in zip(rows, label):
        least[c] = min((x for x in (least.get(c), i) if x is not None), default=None)
    want = [(r[0], f"{p:016x}", least[c]) for r, p, c in zip(rows, prints, label)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert any(w[0] != w[2] and w[0] is not None and w[0] >= 35 for w in want)
    assert S.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [4096, 24])
def test_links_connect_what_brute_force_links(spark, monkeypatch, block):
    """Random fingerprints, and dense groups whose variants are too large for a task of 24."""
    monkeypatch.setattr(S, "BLOCK", block)
    monkeypatch.setattr(S, "FEW", 6)
    rng = np.random.default_rng(block)
    values = set(rng.integers(0, 2**63, 200).tolist()) | {0, 2**64 - 1}
    for centre in rng.integers(0, 2**63, 3).tolist() + [0]:
        for _ in range(120):
            flipped = rng.choice(64, rng.integers(0, 6), replace=False).tolist()
            values.add(centre ^ sum(1 << b for b in flipped))
    values = sorted(values)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    links = S.links(df).distinct()
    near = np.bitwise_count(np.array([r.a ^ r.b for r in links.collect()], np.int64).view(np.uint64))
    assert (near <= 4).all() and (near > 0).all()
    label = {r.node: r.label for r in connected_components(links).collect()}
    got = {}
    for v in values:
        signed = v - (1 << 64) if v >> 63 else v
        got.setdefault(label.get(signed, signed), []).append(v)
    want = {}
    for v, c in zip(values, classes(values)):
        want.setdefault(c, []).append(v)
    assert sorted(got.values()) == sorted(want.values())


def test_dense_groups_send_few_links(spark):
    """1,500 fingerprints two bits from one centre: 1.1 million pairs, of which a few thousand links are sent."""
    centre = 0x0123456789ABCDEF
    values = [centre ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)][:1500]
    df = spark.createDataFrame([(v,) for v in values if v < 2**63], "fp long")
    links = S.links(df)
    assert links.count() < 64 * len(values) and connected_components(links).select("label").distinct().count() == 1


def test_two_fingerprints_share_a_variant_exactly_if_a_segment_differs_in_one_bit_at_most(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 400)
    b = np.array([x ^ sum(1 << int(p) for p in rng.choice(63, rng.integers(1, 9), replace=False)) for x in a.tolist()])
    df = spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a long, b long")
    shared = df.select("a", "b", F.arrays_overlap(S.variants("a"), S.variants("b")).alias("s")).collect()
    for r in shared:
        bits = [(r.a ^ r.b) >> first & ((1 << n) - 1) for first, n in S.SEGMENTS]
        assert r.s == any(x.bit_count() <= 1 for x in bits)


def test_distance_is_checked(spark):
    with pytest.raises(ValueError):
        S.near_duplicates(spark.createDataFrame([], "doc_id long, text string"), distance=5)
