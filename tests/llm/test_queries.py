"""Every query on the given tables: against its SQL, a brute-force version, or held-out truth."""

from __future__ import annotations

import hashlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import brute
import corpus_pipeline
from dryspell.llm import mixing, packing, queries


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "pages", "labels", "embeddings", "conversations"):
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def docs(duck):
    return duck.execute("select doc_id, text from documents order by doc_id").fetchall()


def test_registered():
    names = set(entry_points.queries())
    assert {*queries.QUERIES, "pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, sf_dir, duck, name):
    df = queries.QUERIES[name](spark, sf_dir)
    theirs = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(columns) == sorted(df.columns)
    ours = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(ours, key=repr) == sorted(theirs.fetchall(), key=repr)


def test_op1(spark, sf_dir, duck):
    df = queries.op1_mixing(spark, sf_dir)
    rows = {r.doc_id: r for r in df.collect()}
    meta = duck.execute("select doc_id, source, lang, text from documents").fetchall()
    assert len(rows) == len(meta)
    axes = queries.TARGETS.axes()
    names = [list(a) for a in axes.values()]
    table = np.zeros([len(n) for n in names])
    cell = {}
    for d, source, lang, text in meta:
        r = rows[d]
        assert r.n_tokens == len(brute.WORD.findall(text or ""))
        key = tuple(n.index(v if v in n else "other") for n, v in zip(names, (source, lang, r.topic)))
        cell[d] = key
        table[key] += r.n_tokens
    rate = mixing.rake(table, [np.array(list(a.values())) for a in axes.values()], queries.RATE)
    for d, key in cell.items():
        assert np.isclose(rows[d].keep_rate, rate[key], rtol=1e-9)
        drawn = int(hashlib.md5(f"1:{d}".encode()).hexdigest()[:13], 16) / 16**13
        assert rows[d].kept == (drawn < rows[d].keep_rate)


def test_op2(spark, sf_dir, docs):
    rows = queries.op2_packing(spark, sf_dir).collect()
    tokenizer = Tokenizer.from_file(queries.VOCABULARY)
    expected = [(d, *p) for d, t in docs for p in brute.pieces(t, tokenizer)]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(held) <= -(-sum(r.length for r in rows) // 2048) + 2
    counts = {}
    for r in rows:
        counts[r.length] = counts.get(r.length, 0) + 1
    used, _ = packing.program(counts, packing.SIZE, packing.SHARE)
    assert sum(len(config) * times for config, times in used.items()) >= 0.9 * len(rows)


def test_op3(spark, sf_dir, duck):
    truth = dict(duck.execute("select doc_id, quality from labels").fetchall())
    rows = queries.op3_quality_classifier(spark, sf_dir).collect()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.9 * len(held)


def test_op4(spark, sf_dir, docs):
    rows = queries.op4_ngram_join(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.components(docs)


def test_op6(spark, sf_dir):
    rows = queries.op6_chat(spark, sf_dir).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.role == r.found_role for r in held) >= 0.95 * len(held)


def test_op7(spark, sf_dir, duck):
    table = duck.execute("select vec_id, embedding from embeddings").fetchall()
    ids = np.array([i for i, _ in table])
    x = np.array([v for _, v in table], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = {}
    for r in queries.op7_neighbours(spark, sf_dir).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in ids[ids % 50 == 0]:
        cosine = x @ x[ids == q][0]
        cosine[ids == q] = -9
        hits += len(found[q] & set(ids[np.lexsort((ids, -cosine))[:5]].tolist()))
    assert hits >= 0.9 * 5 * len(found)


def test_op9(spark, sf_dir, docs):
    for r in queries.op9_pii(spark, sf_dir).collect():
        base = brute.personal(dict(docs)[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base) for x in brute.PATTERNS]
        assert not base or set(text.split(",")) <= set(r.spans.split(","))


def test_op10(spark, sf_dir, docs, duck):
    rows = {r.doc_id: r for r in queries.op10_quality_rules(spark, sf_dir).collect()}
    for d, text in docs:
        r = rows[d]
        counted = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert counted == brute.base_counts(text)
        assert not (r.base_failed and r.kept)
    truth = duck.execute("select doc_id, quality from labels").fetchall()
    good = [rows[d].kept for d, q in truth if q == 1 and not rows[d].base_failed]
    bad = [rows[d].kept for d, q in truth if q == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_pipeline(spark, sf_dir):
    """Each stage on what the one before kept, against the plain versions."""
    original = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = original
    texts = {r.doc_id: r.text for r in docs.collect()}
    rules = {r.doc_id: r.kept for r in queries.op10_quality_rules(spark, sf_dir).collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name == "packing":
            break
        assert out.columns == original.columns and out.dtypes == original.dtypes
        rows = out.collect()
        now = {r.doc_id: r.text for r in rows}
        assert len(now) == len(rows)
        if name == "quality_rules":
            assert now == {d: t for d, t in texts.items() if rules[d]}
        elif name == "line_dedup":
            for d, total, dropped, digest in brute.kept_lines(sorted(texts.items())):
                if d in now:
                    assert hashlib.sha256((now[d] or "").encode()).hexdigest() == digest
                else:
                    assert dropped
            assert all(r.n_chars == len(r.text or "") for r in rows)
        elif name == "ngram_join":
            groups = brute.components(sorted(texts.items()))
            assert now == {d: t for d, t in texts.items() if groups[d][1] == d}
        else:
            assert now.items() <= texts.items() and 0 < len(now) < len(texts)
        texts = now
        docs = spark.createDataFrame(rows, original.schema)
    tokenizer = Tokenizer.from_file(queries.VOCABULARY)
    expected = sorted((d, *p) for d, t in texts.items() for p in brute.pieces(t, tokenizer))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out.collect()) == expected
    final = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in final) == expected
