"""Alignment against brute force over whole texts, and on nulls, empty and long texts, repeats and clashing columns."""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path
from tokenizers import Tokenizer

from adstrata.llm import alignment as A
from adstrata.llm.queries import tokenizers

ODD = [
    None, "", " ", "  ", "a ", " a", "a  b", "\n a", "a\n", "a\n\n b \n c", "<s>a</s>", "<|endoftext|> x", "é中😀\u0001  a\n\tb ﬁ q ",
    "a ▁x b", "x\r\n y   z  k", "don't 's  's\n's", "İ ǆ́ कि 한국어 \U0001f468‍\U0001f469  x", "   \n   \n  x", "\x00a \x1c b \x85c",
    "tab\t x\t\ty", "。 、\nあ い", "a" * 4000, "word " * 30_000 + "end", "<0x0A> <unk>",
]


class Plain:
    """Both tokenizers over whole texts, by decoded bytes alone."""

    def __init__(self) -> None:
        self.a = Tokenizer.from_file(path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in kept]
        self.letter = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(other)}

    def bytes_b(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def __call__(self, text: str | None) -> tuple[list[int], list[int], list[tuple[list[int], list[int]]]]:
        if not text:
            return [], [], []
        whole = (" " + text).encode()
        encoded = self.a.encode(" " + text, add_special_tokens=False)
        bytes_a = [bytes(self.letter[c] for c in t) for t in encoded.tokens]
        ids_b = self.b.encode(text)
        bytes_b = [self.bytes_b(i) for i in ids_b]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            return [], [], []
        ends_a, ends_b = list(accumulate(map(len, bytes_a))), list(accumulate(map(len, bytes_b)))
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            n, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append((encoded.ids[i:n], ids_b[j:m]))
            i, j = n, m
        return encoded.ids, ids_b, groups


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(2)
    letters = list("etaoin shrdlu\n,.ñéß中1") + [" ", " "]
    prose = ["".join(rng.choice(letters, n)) for n in (40, 400, 4000)]
    return ODD + prose + prose[:1]


@pytest.mark.parametrize("read, remembered", [(2_000, 200_000), (3, 5)])
def test_documents(spark, plain, texts, monkeypatch, read, remembered):
    monkeypatch.setattr(A, "READ", read)
    monkeypatch.setattr(A, "REMEMBERED", remembered)
    rows = [(i, t, 1, 2, "x") for i, t in enumerate(texts)] + [(None, texts[-1], 1, 2, "x"), (3, "again", 1, 2, "x"), (3, "again", 1, 2, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int, n_a int, pair string")
    read_ = [plain(r[1]) for r in rows]
    counts = Counter((a[-1], b[-1]) for _, _, groups in read_ for a, b in groups)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    want = []
    for row, (ids_a, ids_b, groups) in zip(rows, read_):
        links = [(a[-1], b[-1]) for a, b in groups]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        best = sum(counts[x] == most[x[1]] for x in links)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        want.append((row[0], len(ids_a), len(ids_b), len(groups), len(links), best, sum(counts[x] for x in links), digest))
    got = A.aligned(df, tokenizers(spark))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got.columns == columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert A.aligned(df.limit(0), tokenizers(spark)).count() == 0


def test_rare_pairs_are_joined_as_well(spark, texts, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = A.aligned(df, tokenizers(spark)).collect()
    monkeypatch.setattr(A, "FREQUENT", 1 / 50)
    assert sorted(A.aligned(df, tokenizers(spark)).collect(), key=str) == sorted(want, key=str)


def test_texts_are_read_whole_where_pieces_would_not_do(spark, plain):
    with open(path("byte_bpe_50k.json"), "rb") as one, open(path("piece_bpe_32k.model"), "rb") as two:
        pair = A._Pair(one.read(), two.read())
    assert pair.cut
    pair.cut = False
    for text in filter(None, ODD):
        (piece,) = pair.pieces(text)
        found = pair.learn([piece])[piece]
        ids_a, ids_b, groups = plain(text)
        assert (found[:2] if found else (0, 0)) == (len(ids_a), len(ids_b))
        assert len(found[3] if found else ()) == len(groups)
