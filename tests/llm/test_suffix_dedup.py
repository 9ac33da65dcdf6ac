"""Repeated byte strings: suffix arrays against sorting, and removal against a look at every string of the texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dryspell.llm import queries, suffix_dedup
from dryspell.llm.suffix_array import lyndon_groups, suffix_array


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40) | st.lists(st.sampled_from([1, 1, 2]), max_size=120))
def test_suffix_array(text):
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=30))
def test_pointers(text):
    _, before = lyndon_groups(text)
    for i, j in enumerate(before):
        smaller = [k for k in range(i) if text[k:] < text[i:]]
        assert j == (smaller[-1] if smaller else -1)


def brute(docs, window):
    data = [((d, (t or "").encode())) for d, t in docs]
    seen = Counter(b[k:k + window] for _, b in data for k in range(len(b) - window + 1))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if seen[b[k:k + window]] > 1:
                gone[k:k + window] = b"\1" * window
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not before for g, before in zip(gone, b"\0" + gone))
        out.append((d, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def documents(seed):
    """Random texts over few letters that share passages, near copies, copies, and periodic texts."""
    r = random.Random(seed)
    word = lambda n: "".join(r.choices("abcdé\n", k=n))
    shared = [word(r.randint(8, 60)) for _ in range(6)]
    texts = ["", None, "a", "a" * 90, "ab" * 40, "x" * 11, "x" * 12]
    for _ in range(60):
        text = word(r.randint(0, 25)) + r.choice(shared) + word(r.randint(0, 25)) + r.choice(shared + [""])
        texts += [text] * r.choice([1, 1, 1, 2, 4])
        if len(text) > 20 and r.random() < 0.4:
            k = r.randrange(len(text))
            texts.append(text[:k] + "Z" + text[k + 1:])
    for _ in range(40):
        texts.append(word(6) + shared[0] + word(9))
    pairs = list(enumerate(texts))
    return [*pairs, (3, texts[3]), (None, "null id " + shared[1]), (5, "another text of an id " + shared[2])]


@pytest.mark.parametrize(("seed", "sizes"), [
    (1, {}), (2, {"most_slots": 3}), (3, {"slot": 1}), (4, {"slot": 10, "gram": 3}), (5, {"symbols": 20, "gram": 1}),
])
def test_small_windows(make, monkeypatch, seed, sizes):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 64)
    monkeypatch.setattr(suffix_dedup, "COMMON", 4)
    pairs = documents(seed)
    docs = make(pairs, rest="mine", owner="mine", kept="old", mark=1)
    docs = docs.withColumn("odd name, with.dot", F.struct(F.lit(1).alias("x y")))
    out = suffix_dedup.remove_repeats(docs, **{"window": 12, "gram": 4, "slot": 4, **sizes})
    assert [c for c in out.columns if c in docs.columns] == ["doc_id", "lang", "source", "n_chars", "rest", "owner", "mark", "odd name, with.dot", "kept"]
    assert out.where((F.col("owner") != "mine") | (F.col("rest") != "mine")).isEmpty()
    rows = out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept").collect()
    found = sorted((repr(tuple(r[:5])), bytes(r.kept)) for r in rows)
    assert found == sorted((repr(x[:5]), x[5]) for x in brute(pairs, 12))


def test_long_text(make):
    """A text of several stretches, once more inside another, and a run of one letter."""
    r = random.Random(9)
    text = "".join(r.choices("abcdefghij ", k=1_300_000))
    pairs = [(1, text), (2, "before" + text[400_000:900_000] + "after"), (3, "q" * 20_000), (4, text[:150])]
    rows = {r.doc_id: r for r in suffix_dedup.remove_repeats(make(pairs)).collect()}
    assert [(rows[k].n_removed, rows[k].n_spans) for k in (1, 2, 3, 4)] == [(500_000, 1), (500_000, 1), (20_000, 1), (0, 0)]
    assert bytes(rows[2].kept) == b"beforeafter"
    assert bytes(rows[1].kept).decode() == text[:400_000] + text[900_000:]


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = sorted(tuple(r) for r in queries.op13_suffix_dedup(spark, sf_dir).collect())
    assert rows == sorted(x[:5] for x in brute(docs, 200))


def test_empty_table(make):
    assert suffix_dedup.remove_repeats(make([])).collect() == []
    assert suffix_dedup.remove_repeats(make([(1, None), (2, "")])).where("n_removed != 0").isEmpty()
