"""Alignment of two tokenizers against a version that looks at every pair of token ranges of whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from dryspell.llm import alignment, queries

PARTS = [
    "a", "the", " ", "  ", "\n", "é", "́", "中", "\t", "0", "don't", "\x1c", " ", ",", ".", "1234", "<s>",
    "<|endoftext|>", "<0x41>", "𝄞", "ﬁ", "　", "\xa0", "stretches", "Ⅷ", "\r\n", "\0",
]


@pytest.fixture(scope="module")
def brute():
    tokenizer = Tokenizer.from_file(queries.VOCABULARY)
    tokenizer.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    letters = alignment.byte_alphabet()

    def ranges(tokens):
        out, at = [], 0
        for i, data in tokens:
            out.append((i, at, at + len(data)))
            at += len(data)
        return out

    def document(text):
        if not text:
            return (0, 0, 0), "", Counter()
        a = [(i, bytes(letters[c] for c in tokenizer.id_to_token(i))) for i in tokenizer.encode(f" {text}", add_special_tokens=False).ids]
        b = []
        for i in pieces.encode(text):
            piece = pieces.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()))
        data = f" {text}".encode()
        if b"".join(x for _, x in a) != data or b"".join(x for _, x in b) != data:
            return (0, 0, 0), "", Counter()
        a, b = ranges(a), ranges(b)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, start = [], 0
        for cut in cuts:
            sides = [",".join(str(i) for i, s, e in side if start <= s and e <= cut) for side in (a, b)]
            groups.append("|".join(sides))
            start = cut
        links = Counter((i, j) for i, s, e in a for j, f, g in b if s < g and f < e)
        return (len(a), len(b), len(groups)), ";".join(groups), links

    return document


def check(rows, texts, brute):
    """Rows (doc_id, n_a, ..., groups_sha256) against texts [(doc_id, text)]."""
    found = [(d, brute(t)) for d, t in texts]
    held = Counter(link for _, (_, _, links) in found for link in links)
    most = {}
    for (a, _), n in held.items():
        most[a] = max(most.get(a, 0), n)
    expected = []
    for d, (sizes, groups, links) in found:
        best = sum(n for link, n in links.items() if held[link] == most[link[0]])
        total = sum(n * held[link] for link, n in links.items())
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        expected.append((d, *sizes, links.total(), best, total, digest))
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)


@pytest.fixture(scope="module")
def texts():
    drawn = random.Random(5)
    made = ["".join(drawn.choices(PARTS, k=drawn.randint(1, 25))) for _ in range(400)]
    made += ["", None, " ", "a ", "  a", "▁", "a ▁ b", "same words same words", "x" * 3000, "word " * 300]
    return [*enumerate(made), (3, made[3]), (3, made[3]), (None, "no id"), (9, "other text of one id")]


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 50])
def test_against_whole_texts(make, texts, brute, broadcast_pairs):
    docs = make(texts, links=1, row="x", link=2, n_a=3)
    check(alignment.score(docs, queries.VOCABULARY, queries.PIECES, broadcast_pairs).collect(), texts, brute)


def test_groups(make, brute):
    text = "Zusammengesetzte Wörter, unbelievable 12345 tokens"
    row = alignment.aligned(make([(1, text)]), queries.VOCABULARY, queries.PIECES, with_groups=True).first()
    assert row.groups == brute(text)[1]
    assert {(r.link >> 32, r.link & 0xFFFFFFFF): r.times for r in row.links} == brute(text)[2]


def test_query(spark, sf_dir, brute):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op12_alignment(spark, sf_dir).collect()
    cut = {r.doc_id: r for r in rows}
    assert len(cut) == len(docs)
    # The brute version is quadratic in a text: whole texts of up to 3,000 characters are compared by it, the
    # longer ones without any cut into stretches.
    both = alignment.aligner(queries.VOCABULARY, queries.PIECES)
    held = Counter()
    for d, t in docs:
        sizes, groups, links = brute(t) if len(t or "") <= 3000 else whole(both, t)
        r = cut[d]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (*sizes, links.total())
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        held.update(links.keys())
    assert sum(held.values()) > 0


def whole(both, text):
    found = both.whole(text)
    return found[:3], found.groups, Counter((x >> 32, x & 0xFFFFFFFF) for x in found.links)


def test_empty_table(make):
    assert alignment.score(make([]), queries.VOCABULARY, queries.PIECES).collect() == []
