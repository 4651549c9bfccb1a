"""Each operator against a brute-force version, and on nulls, empty and long texts, ties, repeats and clashing columns."""

from __future__ import annotations

import base64
import glob
import hashlib
import os
import re
import tempfile
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from adstrata.llm import bpe, language_id, line_dedup, mixing, ngram_join, nn_descent, pii, quality, token_counts, url_filter
from adstrata.llm.common import stage
from adstrata.llm.components import connected_components
from adstrata.llm.queries import edits_of, vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, node long, row long, score double, ids binary"
WORDS = "the of and a in to it is was that for on are with as at by from he she".split()


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + 18]) for i in range(0, n, 18))


TEXTS = [
    None, "", " \n\t", "word", prose(1, 120), prose(1, 120), prose(1, 118) + " two more", prose(2, 300), "x" * 60_000, "a  \r\n b's '" * 4_000,
    prose(3, 9_000), "élan Ünï " * 40, "# $ % & | < >", "same line here that is long enough to count\n" * 3,
]
LANGS = ["en", "de", None]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, t, LANGS[i % 3], [None, "a", "b"][i % 3], 1, 2, 0.5, None) for i, t in enumerate(TEXTS)]
    rows += [rows[4], (None, prose(1, 120), None, None, 1, 2, 0.5, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def words(spark):
    return vocabulary(spark)


@pytest.fixture(scope="module")
def reference():
    lines = open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_is_that_of_the_library_and_decodes(documents, nothing, words, reference):
    rows = bpe.decode(bpe.encode(documents, words), words).collect()
    assert len(rows) == documents.count()
    for r in rows:
        ids = reference.encode_ordinary(r.text or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encode(nothing, words).count() == 0


def test_counts_follow_edits(documents, nothing, words, reference):
    edited = token_counts.apply_edits(token_counts.count_trees(edits_of(documents), words), words)
    for r in edited.collect():
        assert r.n_tokens == len(reference.encode_ordinary(r.text)) == sum(r.tree.tokens)
        assert len(r.text) == sum(r.tree.chars)
    assert token_counts.count_trees(nothing, words).count() == 0


def test_any_edits_keep_the_count(reference):
    def count(text):
        return len(reference.encode_ordinary(text))

    rng = np.random.default_rng(5)
    text = prose(9, 500)
    tree = token_counts.CountTree.of(count, text, leaf=32)
    for _ in range(300):
        start, more = int(rng.integers(0, len(text) + 2)), int(rng.choice([0, 1, 5, 60]))
        new = str(rng.choice(["", " ", "x", "  \n", "'s", " several new words that make the leaf grow and grow " * 6]))
        text, _ = tree.edit(text, start, start + more, new)
        assert tree.tokens[1] == count(text) and tree.chars[1] == len(text)


PLAIN = [
    "mail a.b@c.de, b@x.y.z@q.r. 1.2.3.4.5 300.1.1.1 4111 1111 1111 1111 +1 (555) 555-0100. +12",
    "é 4111111111111111é 010.020.030.040 a@b +1234567890123456 ..@a.b a@b..c@d.e",
    "1" * 20_000, "1." * 20_000, "a@" + "b." * 20_000, "+1" + " " * 20_000,
    " ".join(f"u{i}@example.com" for i in range(1_000)),
]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    def valid(kind: str, value: str) -> bool:
        digits = [int(c) for c in re.sub("[^0-9]", "", value)]
        if kind == "ip":
            return all(int(x) <= 255 for x in value.split("."))
        if kind == "card":
            doubled = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
            return 14 <= len(digits) <= 19 and doubled % 10 == 0
        return kind == "email" or 10 <= len(digits) <= 15

    found = [(m.start(), i, m.end()) for i, (k, p) in enumerate(pii.KINDS.items()) for m in re.finditer(p, text) if valid(k, m[0])]
    return sorted(found)


def test_base_spans_are_those_of_the_plain_patterns(spark, documents, nothing):
    rows = pii.find(spark.createDataFrame([(i, t) for i, t in enumerate(PLAIN)], "doc_id long, text string")).collect()
    names = list(pii.KINDS)
    for r in rows:
        assert r.base == ",".join(f"{names[k]}:{a}:{b}" for a, k, b in base_spans(PLAIN[r.doc_id]))
    assert pii.find(documents).count() == documents.count()
    assert pii.find(nothing).count() == 0


def test_contexts_find_what_the_rules_miss(spark):
    seeds = [(i, f"{prose(i, 5)} please write to user{i}@mail{i}.org now") for i in range(8)]
    rows = spark.createDataFrame([*seeds, (8, "please write to somebody@localhost now"), (9, "the other@localhost2 stays")], "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.find(rows).collect()}
    assert found[8] == "email:16:34" and found[9] == ""


def test_contexts_find_groups_of_digits(spark):
    def luhn(n):
        return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(str(n))))) % 10 == 0

    cards = [str(n) for n in range(4111111111111111, 4111111111111400) if luhn(n)][:20]
    texts = [f"{prose(i, 5)} call me on +1 (555) 555-01{i:02d} today" for i in range(20)]
    texts += [f"{prose(i, 5)} my card is {c[:4]} {c[4:8]} {c[8:12]} {c[12:]} thanks" for i, c in enumerate(cards)]
    values = [("call me on ", "555 0100 123", "phone"), ("call me on ", "(017) 555-7713", "phone"), ("my card is ", "4111 1111 1111 1112", "card")]
    texts += [f"{before}{value} 4th" for before, value, _ in values] + ["nothing like 555 0100 124 here"]
    found = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, (before, value, kind) in enumerate(values):
        assert found[40 + i] == f"{kind}:{len(before)}:{len(before) + len(value)}"
    assert found[43] == ""


def test_measures(documents, nothing):
    rows = quality.judged(documents).collect()
    assert len(rows) == documents.count() and quality.judged(nothing).count() == 0
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in rows:
        if r.doc_id is None:
            continue
        text = texts[r.doc_id] or ""
        found = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
        repeated = {i + j for i in range(len(found) - 4) if windows[tuple(found[i : i + 5])] > 1 for j in range(5)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(found), sum(map(len, found)), len(repeated))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text)) and r.n_dup_lines == len(lines) - len(set(lines))


def test_fences_follow_the_group_for_repeated_lines(spark):
    def text(i, repeats):
        lines = [" ".join(f"{(i * 15 + k) % 997:03d}{j:02d}" for j in range(40)) for k in range(15)]
        return "\n".join(x + ("\nsee also" if k < 5 and repeats else "") for k, x in enumerate(lines))

    rows = [(i, text(i, i < 2), "en", "few") for i in range(300)] + [(1_000 + i, text(i, i < 90), "en", "many") for i in range(300)]
    rows.append((2_000, text(1, False) + " #", "en", "few"))
    kept = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert {i for i, k in kept.items() if not k} == {0, 1, 2_000}


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_bit_parallel_distance():
    rng = np.random.default_rng(3)

    def changed(text):
        letters = list(text)
        for _ in range(rng.integers(0, 5)):
            at = int(rng.integers(0, len(letters)))
            letters[at : at + int(rng.integers(0, 2))] = list(rng.choice(["", "a", "é"]))
        return "".join(letters)

    pairs = [(t := "".join(rng.choice(list("abé"), rng.integers(9, 30))), changed(t)) for _ in range(400)]
    for one, two in (p for p in pairs if len(p[1]) > 4):
        for most in (1, 2, 3):
            assert line_dedup.within(one, two, most) == (distance(one, two) <= most)


def test_lines(spark, documents, nothing):
    base = "a line of some forty characters and a few more"
    texts = [base, base + "!", "keep\n" + base.replace("line", "lime"), "another line that has nothing to do with those above\nkeep", base[:-9] + "XYZXYZXYZ", None]
    left = line_dedup.without_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [(r.text, r.removed) for r in left.orderBy("doc_id").collect()] == [
        (texts[0], []), ("", [0]), ("keep", [1]), (texts[3], []), (texts[4], []), (None, []),
    ]
    assert line_dedup.without_repeats(documents).columns[:2] == ["doc_id", "lang"]
    assert line_dedup.without_repeats(documents).count() == documents.count()
    assert line_dedup.without_repeats(nothing).count() == 0


def test_lines_link_by_a_share_of_their_length(spark):
    rng = np.random.default_rng(4)
    letters = list("etaoin shrdlu é😀")

    def changed(text, edits):
        out = list(text)
        for _ in range(edits):
            at = int(rng.integers(0, len(out)))
            out[at : at + int(rng.integers(0, 2))] = list(rng.choice(["", "q", "xy"]))[:1]
        return "".join(out)

    texts = ["two words", "a b"] * 2
    for n in (20, 25, 39, 40, 41, 59, 99, 130, 400):
        for share in (20, 15, 30):
            base = "z" + "".join(rng.choice(letters, n - 2)) + "z"
            texts += [base, changed(base, max(1, n // share))]
    texts += ["x" * 400, "x" * 410, "x" * 440, "one"] + ["one"]
    found = line_dedup.without_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(texts):
        for j in range(i):
            b, most = texts[j], min(len(a), len(texts[j])) // 20
            if a != "one" and (a == b or abs(len(a) - len(b)) <= most and distance(a, b) <= most):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    assert {r.doc_id for r in found if r.removed} == {i for i in range(len(texts)) if find(i) != i}
    assert sum(1 for r in found if r.removed) > 20


def test_trie_finds_all_links():
    rng = np.random.default_rng(0)
    for _ in range(60):
        base = rng.integers(0, 2**63, 40, dtype=np.uint64)
        sets = {}
        for _ in range(rng.integers(2, 25)):
            kept = base[rng.random(40) < rng.choice([0.95, 0.85, 0.6])]
            one = np.unique(np.r_[kept, rng.integers(0, 2**63, rng.integers(1, 8), dtype=np.uint64)])
            sets[one.tobytes()] = one
        sets = list(sets.values())
        parent = list(range(len(sets)))

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for i in range(len(sets)):
            for j in range(i):
                if ngram_join.linked(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]), 80):
                    low, high = sorted((find(i), find(j)))
                    parent[high] = low
        trie = ngram_join.Trie(sets, 80)
        list(trie.links())
        assert [trie.find(i) for i in range(len(sets))] == [find(i) for i in range(len(sets))]


def test_similar_documents(spark, documents, nothing, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)  # groups of several blocks
    base = prose(11, 200).split()
    texts = [" ".join(base[:i] + ["new"] + base[i + 1 :]) for i in range(5, 190, 9)] + [prose(i, 60) for i in range(50, 60)]
    rows = [(100 + i, t) for i, t in enumerate(texts)] + [(7, "One two"), (3, "one TWO"), (1, None), (2, ""), (7, "One two")]
    found = {r.doc_id: r for r in ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in rows if i >= 100 for w in [t.split()]}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    for i in sets:
        assert (found[i].component_id, found[i].n_shingles) == (find(i), len(sets[i]))
    assert [found[i].component_id for i in (7, 3, 1, 2)] == [3, 3, 1, 2] and found[1].n_shingles == 0
    assert ngram_join.similar_documents(documents).count() == documents.count()
    assert ngram_join.similar_documents(nothing).count() == 0


def test_similar_documents_beside_rows_without_words_or_id(spark):
    """In one batch: numbers of sets and ids stay whole numbers beside nulls."""
    base, first = prose(12, 100).split(), 2**60 + 1
    rows = [(first + 2 * i, " ".join(base[: 50 + i] + ["new"] + base[51 + i :])) for i in range(4)]
    rows += [(first + 20, None), (first + 22, ""), (None, " \n"), (None, prose(13, 40))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = ngram_join.similar_documents(frame).select("doc_id", "n_shingles", "component_id").collect()
    expected = [(first + 2 * i, 96, first) for i in range(4)] + [(first + 20, 0, first + 20), (first + 22, 0, first + 22), (None, 0, None), (None, 36, None)]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_stage_leaves_no_shuffle_files(spark):
    folder = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", tempfile.gettempdir())
    shuffled = spark.range(10_000).select(F.xxhash64("id").alias("h")).groupBy("h").count()
    files = lambda: set(glob.glob(f"{folder}/**/shuffle_*.data", recursive=True))
    before = files()
    assert stage(shuffled, "once").columns == ["h", "count"]
    assert not files() - before
    assert stage(shuffled, "twice").count() == shuffled.count() == 10_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_pipeline_sends_small_batches(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    def sizes(spark, docs, sf_dir):
        return docs.mapInPandas(lambda batches: (b[:1].assign(doc_id=len(b)) for b in batches), docs.schema)

    spark.range(3_000).toDF("doc_id").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first", sizes), ("last", lambda spark, docs, sf_dir: docs)])
    try:
        found = [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sum(found) == 3_000 and max(found) <= 1_000


def test_sets_in_a_row_are_not_all_compared(spark, monkeypatch):
    """Sets that chance connects are compared where they share shingles, not with all others of their group."""
    rng, rows = np.random.default_rng(11), {}
    monkeypatch.setattr(ngram_join, "BLOCK", 20)
    monkeypatch.setattr(ngram_join, "stage", lambda df, label: rows.setdefault(label, []).append(out := stage(df, label)) or out)
    passages = [" ".join(f"p{i}x{j}" for j in range(8)) for i in range(300)]
    texts = [" ".join(passages[int(i)] for i in rng.choice(300, 3, replace=False)) for _ in range(600)]
    texts += [texts[7] + " end", texts[250] + " end"]  # linked with texts of the group
    texts += [t.replace("x3 ", "x3z ") for t in texts[100:103]]  # too many shingles differ
    found = {r.doc_id: r.component_id for r in ngram_join.similar_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert found == {i: {600: 7, 601: 250}.get(i, i) for i in range(len(texts))}
    assert sum(df.count() for df in rows["tokens"]) > 500  # one group, of many blocks
    assert sum(df.count() for df in rows.get("blocks", [])) == 0 and sum(df.count() for df in rows["listed"]) < 100


def test_common_shingles_of_large_groups_are_compared_by_blocks(spark, monkeypatch):
    """Links are those of brute force where some shingles of a large group are listed and others are too common for that."""
    rng, labels = np.random.default_rng(12), []
    monkeypatch.setattr(ngram_join, "BLOCK", 20)
    monkeypatch.setattr(ngram_join, "LISTED", 3)
    monkeypatch.setattr(ngram_join, "BLOCK_PAIRS_A_LISTED", 0)
    monkeypatch.setattr(ngram_join, "stage", lambda df, label: labels.append(label) or stage(df, label))
    passages = [" ".join(f"p{i}x{j}" for j in range(12)) for i in range(20)]
    texts = [" ".join([*(f"own{i}y{j}" for j in range(16)), *(passages[int(x)] for x in rng.choice(20, 2, replace=False))]) for i in range(160)]
    texts += [t.replace("y3 ", "y3z ") for t in texts[:20]] + [t + " end" for t in texts[:30]] + [f"{t} {i}" for i, t in enumerate(texts[40:60])]
    shingler = ngram_join.Shingler(5)
    sets, least = [shingler(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if ngram_join.linked(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]), 80):
                a, b = sorted((least[i], least[j]))
                least = [a if x == b else x for x in least]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.similar_documents(frame).collect()}
    assert found == dict(enumerate(least)) and {"listed", "blocks"} <= set(labels)


def test_segments_drop_what_was_sent(spark, monkeypatch):
    """The shortened segments are done with, and off the disk, before the segments themselves are shuffled."""
    labels = []
    monkeypatch.setattr(line_dedup, "stage", lambda df, label: labels.append(label) or stage(df, label))
    lines = [prose(40, 18), prose(40, 17) + " new words", prose(41, 18)]
    frame = spark.createDataFrame(list(enumerate(lines)), "key long, line string")
    rows = line_dedup.segments(frame).select("line").distinct().collect()
    assert labels == ["packs", "shared"] and {r.line for r in rows} == {0, 1}


def test_search_of_few_queries_takes_few_tasks(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.standard_normal(8)]) for i in range(300)]
    files = []
    plain = nn_descent.stage

    def counted(df, label):
        out = plain(df, label)
        files.append((label, len(out.inputFiles())))
        return out

    monkeypatch.setattr(nn_descent, "stage", counted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = nn_descent.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id % 50 = 0").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    vectors = np.array([r[1] for r in rows])
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    for q in range(0, 300, 50):
        near = [i for i in np.argsort(-(unit @ unit[q]), kind="stable") if i != q][:5]
        assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] == near
    assert {n for label, n in files if label == "beams"} == {1}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 9)] + [(20, 21), (30, 30)]
    labels = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(labels) == {*range(10), 20, 21, 30}
    assert len({labels[i] for i in range(10)}) == 1 and labels[20] == labels[21] != labels[0] and labels[30] == 30


def test_mix(spark, documents, nothing):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 60))), "abcd"[min(3, i % 17)]) for i in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = mixing.repetitions(docs).toPandas()
    assert taken["times"].between(0, 3).all() and len(taken) == len(rows)
    sums = taken.assign(words=taken["size"] * taken["times"]).groupby("source").agg(words=("words", "sum"), target=("target", "first"), own=("source_size", "first"))
    assert ((sums["words"] - sums["target"]).abs() <= 60).all() and (sums["target"] <= 3 * sums["own"]).all()
    assert abs(sums["target"].sum() - taken["size"].sum()) < 1e-3
    again = mixing.repetitions(docs.repartition(3)).toPandas().set_index("doc_id")["times"]
    assert again.sort_index().equals(taken.set_index("doc_id")["times"].sort_index())
    assert mixing.repetitions(documents).count() == documents.count()
    assert mixing.mixed(documents).columns == documents.columns and mixing.mixed(nothing).count() == 0


def test_a_document_under_two_sources_is_taken_from_each(spark):
    """Source a has a tenth of b's words and a larger weight, so its documents are due three times, b's once or not at all."""
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text, "a"), (2, text + " x", "a")] + [(i, text, "b") for i in range(1, 21)] + [(1, text, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    times = {(r.doc_id, r.source): r.times for r in mixing.repetitions(df).collect()}
    taken = Counter((r.doc_id, r.source) for r in mixing.mixed(df).collect())
    assert taken == Counter({k: n for k, n in times.items() if n})
    assert times[1, "a"] == 3 and times[1, "b"] < 3
    repeated = Counter((r.doc_id, r.source) for r in mixing.mixed(df.union(df)).collect())
    again = {(r.doc_id, r.source): r.times for r in mixing.repetitions(df.union(df)).collect()}
    assert repeated == Counter({k: 2 * n for k, n in again.items() if n})


def test_shares_of_the_largest_languages_are_not_nothing():
    assert language_id._limit(1.0) == 2**62 and language_id._limit(20_000 / 1e13) > 0
    assert abs(language_id._limit(1e-7) / 2**62 - 1e-7) < 1e-12


def test_nearest(spark):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((1_500, 16))
    vectors[700:] = vectors[699]  # a large group of equal vectors
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(9_000, None), (9_050, [0.0] * 16), (9_100, [float("nan")] * 16), (9_150, [None] * 16), (None, [1.0] * 16), (0, vectors[0].tolist())]
    found = nn_descent.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id % 50 = 0").toPandas()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1_500, 50):
        sims = unit @ unit[q]
        sims[q] = -9
        sims[700:] = sims[699] if q < 699 else np.where(np.arange(700, 1_500) == q, -9, 1)
        if q >= 699:
            sims[699] = 1
        best = np.lexsort((np.arange(1_500), -sims.round(12)))[:5]
        mine = found[found["query_id"] == q].sort_values("rank")
        assert len(mine) == 5
        hits += len(set(best) & set(mine["vec_id"]))
    assert set(found["query_id"]) == set(range(0, 1_500, 50)) and hits >= 0.9 * 150
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nn_descent.nearest(empty, "vec_id % 50 = 0").count() == 0


def test_urls(spark):
    rules = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "com", "/de/"))
    urls = ["http://A.Example.org/es/x?q#f", "https://example.org/en", "http://bad.net/p/?utm_source=a", "http://www.bad.net/p", "x", None, "http://notorg/", "http://b.com/de/1", "http://bad.net/other"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = spark.createDataFrame([("bad.net/p",), (None,)], "canonical string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judged(pages, listed, rules).collect()}
    assert got == {
        0: ("a.example.org", "/es/x", "example.org/es/", "block"), 1: ("example.org", "/en", "org/", "allow"),
        2: ("bad.net", "/p/", None, "block"), 3: ("www.bad.net", "/p", None, "block"), 4: ("", "", None, "allow"), 5: ("", "", None, "allow"),
        6: ("notorg", "/", None, "allow"), 7: ("b.com", "/de/1", "com/de/", "block"), 8: ("bad.net", "/other", None, "allow"),
    }
    assert url_filter.judged(pages.limit(0), listed.limit(0), rules).count() == 0


def test_languages(spark, documents, nothing):
    english = [(" ".join(np.random.default_rng(i).choice(WORDS, 12)), "en") for i in range(80)]
    other = [(" ".join(np.random.default_rng(i).choice("der die das und ist nicht ein mit auf sie zu von".split(), 12)), "de") for i in range(80)]
    model = language_id.train(spark.createDataFrame([*english, *other, (None, "en"), ("x", None)], "text string, lang string"))
    texts = ["The THAT withs", "nichts dass einmal", "123 %", None, "", "und is die nicht"]
    rows = language_id.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in rows] == ["en", "de", "und", "und", "und", "de"]
    assert all(0 <= r.score <= 1 for r in rows)
    assert language_id.predict(documents, model).count() == documents.count()
    nobody = language_id.train(nothing)
    assert {r.lang_pred for r in language_id.predict(documents, nobody).collect()} == {"und"}


def test_small_languages_keep_their_words(spark, monkeypatch):
    assert language_id.MOST_WORDS >= 200_000 and language_id.MOST_GRAMS >= 100_000
    monkeypatch.setattr(language_id, "MOST_WORDS", 20)
    monkeypatch.setattr(language_id, "TRAINING_TEXTS", 40)
    large = [(f"{' '.join(WORDS)} {i}", "en") for i in range(2_000)]
    model = language_id.train(spark.createDataFrame([*large, ("der die das", "de")], "text string, lang string"))
    assert model.languages == ["de", "en"] and {"der", "die", "das"} <= set(model.words)


def test_digests_are_those_of_the_bytes(spark):
    row = spark.sql("select cast('a' as binary) b").select(F.sha2("b", 256).alias("h")).first()
    assert row.h == hashlib.sha256(b"a").hexdigest()
