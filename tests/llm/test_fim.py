"""Fill in the middle: the sparse index against plain strings, and every edge of the input."""

from __future__ import annotations

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dryspell.llm import fim


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é€𝄞́", max_size=60))
def test_index(text):
    index = fim.Exceptions(np.frombuffer(text.encode(), np.uint8))
    ends = np.array([len(text[:k].encode()) for k in range(len(text) + 1)])
    assert index.bytes_of(np.arange(len(text) + 1)).tolist() == ends.tolist()
    assert index.chars_of(ends).tolist() == list(range(len(text) + 1))


def plain_version(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in fim.MARKS) or h3 % 100 >= 90:
        return "plain", text, None, None
    if h4 % 100 < 20:
        return "spm", f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}", a, b - a
    return "psm", f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}", a, b - a


def test_edges(make):
    texts = ["", None, "a", "é", "a<P>b", "<S", "<<M>", "x" * 3_000_000 + "é" * 1000, "𝄞\n\t ", "<P<S<M", "ab" * 40]
    pairs = [(k, texts[k % len(texts)]) for k in range(121)] + [(None, "null id"), (7, "again"), (7, "again")]
    docs = make(pairs, form="mine", Output="mine", n=0, parts="kept").withColumn("odd name, with.dot", F.struct(F.lit(1).alias("x y")))
    out = fim.transform(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "parts", "odd name, with.dot", *fim.ADDED.replace(",", "").split()[::2]]
    rows = out.withColumn("restored", fim.restore(F.col("output"), F.col("form"))).collect()
    found = sorted((repr(r.doc_id), repr(r.text), r.form, r.output, r.prefix_chars, r.middle_chars) for r in rows)
    assert found == sorted((repr(d), repr(t), *plain_version(d, t)) for d, t in pairs)
    for r in rows:
        assert r.restored == (r.text or "") and r.n == len(r.text or "") and r.parts == "kept"
        if r.form != "plain":
            data = r.text.encode()
            assert data[:r.prefix_bytes].decode() == r.text[:r.prefix_chars]
            middle = data[r.prefix_bytes:r.prefix_bytes + r.middle_bytes].decode()
            assert middle == r.text[r.prefix_chars:r.prefix_chars + r.middle_chars]
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_empty_table(make):
    assert fim.transform(make([])).collect() == []
