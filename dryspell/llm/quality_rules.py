"""Keeps documents whose lines are content, as a linear-chain conditional random field labels them.

Two counted rules come first: fewer than 50 words, or more than half of the words in repeated windows of
three, fail a document. The others' lines are labelled content or boilerplate by Viterbi decoding, and the
share of words in content lines decides.

The field is fitted on at most ``SAMPLE_DOCS`` labelled documents: the lines of a document labelled 1
count as content, those of one labelled 0 as boilerplate. Without both labels there is nothing to fit, and
every line is content. A null text has no words. Repeated rows are judged alike, each for itself; rows
with a null ``doc_id`` are judged, but not used for fitting.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell.llm.words import Texts, Words, grams, mix, pieces

SAMPLE_DOCS = 4000
EPOCHS = 80
SYMBOLS = b"#*$%&|<>"


def _table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SYMBOL, _SHOUT, _PIPE = _table(SYMBOLS), _table(b"!"), _table(b"|")
_CAPITAL, _SMALL = _table(bytes(range(65, 91))), _table(bytes(range(97, 123)))
_DIGIT, _CLOSE = _table(b"0123456789"), _table(b".!?:;")
_LEAD = np.ones(256, bool)
_LEAD[0x80:0xC0] = False


def _per(flags: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags)))
    return sums[end] - sums[first]


@dataclass
class Lines:
    """Lines of some texts: byte range, row, words, whether they repeat an earlier one, features."""

    first: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    n_words: np.ndarray
    repeated: np.ndarray
    features: np.ndarray


N_FEATURES = 27


def lines_of(words: Words) -> Lines:
    """The lines of all rows; an empty row has one."""
    texts = words.texts
    data, offsets = texts.bytes, texts.offsets
    breaks = np.flatnonzero(data == 10)
    first = np.sort(np.concatenate((offsets[:-1], breaks + 1)), kind="stable")
    doc = np.searchsorted(breaks, offsets, side="left")
    n_lines = np.diff(doc) + 1  # line breaks of the row, and one
    doc = np.repeat(np.arange(len(texts)), n_lines)
    end = np.empty_like(first)
    last = np.cumsum(n_lines) - 1
    end[:-1] = first[1:] - 1
    end[last] = offsets[1:]
    a, b = np.searchsorted(words.first, first), np.searchsorted(words.first, end)
    n_words = b - a

    # Equal lines of one row, by their words' hashes; bytes are compared where these agree.
    repeated = np.zeros(len(first), bool)
    seen = set()
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words.hash)))
    marks = sums[b] - sums[a]
    order = np.lexsort((marks, doc))
    same = np.zeros(len(first), bool)
    close = (marks[order][1:] == marks[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    same[order[1:]] |= close
    same[order[:-1]] |= close
    for i in np.flatnonzero(same & (n_words > 0)):
        key = (doc[i], data[first[i]:end[i]].tobytes())
        repeated[i] = key in seen
        seen.add(key)

    size = np.maximum(_per(_LEAD[data], first, end), 1)
    solid = np.maximum(n_words, 1)
    symbols, shouts = _per(_SYMBOL[data], first, end), _per(_SHOUT[data], first, end)
    pipes, digits = _per(_PIPE[data], first, end), _per(_DIGIT[data], first, end)
    capital, small = _per(_CAPITAL[data], first, end), _per(_SMALL[data], first, end)
    again = np.concatenate(([False], words.hash[1:] == words.hash[:-1]))
    stutter = np.concatenate(([0], np.cumsum(again)))
    stutter = np.where(n_words > 1, stutter[b] - stutter[np.minimum(a + 1, b)], 0)
    tail = np.where(n_words > 0, words.end[np.maximum(b - 1, 0)] - 1, 0) if len(words.end) else np.zeros(len(first), int)
    closed = _CLOSE[data[tail]] & (n_words > 0) if len(data) else np.zeros(len(first), bool)
    shares = [symbols / solid, shouts / solid, pipes / solid, stutter / solid, digits / size]
    columns = [np.ones(len(first), bool), n_words == 0, (n_words > 0) & (n_words <= 3),
               (n_words > 3) & (n_words <= 10), (n_words > 10) & (n_words <= 40), n_words > 40]
    for share in shares:
        columns += [share > 0.02, share > 0.15, share > 0.4]
    columns += [capital > small, capital > 0.3 * size, closed, repeated,
                size > 12 * solid, size < 3 * solid]
    features = np.stack(columns, axis=1)
    assert features.shape[1] == N_FEATURES
    return Lines(first, end, doc, n_words, repeated, features)


@dataclass
class Field:
    """Weights: ``emit`` (features x 2), ``move`` (from, to); label 0 is content, 1 boilerplate."""

    emit: np.ndarray
    move: np.ndarray

    def decode(self, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The best label of every line; ``bounds`` delimits the documents, which run side by side."""
        scores = features @ self.emit
        counts = np.diff(bounds)
        labels = np.zeros(len(features), np.int8)
        order = np.argsort(-counts, kind="stable")
        starts, counts = bounds[:-1][order], counts[order]
        best = np.zeros((len(order), 2))
        back = np.zeros((len(features), 2), np.int8)
        longest = int(counts[0]) if len(counts) else 0
        for t in range(longest):
            live = int(np.searchsorted(-counts, -t, side="left"))
            at = starts[:live] + t
            if t:
                ways = best[:live, :, None] + self.move[None]
                back[at] = ways.argmax(axis=1)
                best[:live] = ways.max(axis=1)
            best[:live] += scores[at]
        state = best.argmax(axis=1).astype(np.int8)
        for t in range(longest - 1, -1, -1):
            live = int(np.searchsorted(-counts, -t, side="left"))
            at = starts[:live] + t
            labels[at] = state[:live]
            state[:live] = back[at, state[:live]]
        return labels


def fit(features: np.ndarray, counts: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS) -> Field:
    """Maximum conditional likelihood with a small quadratic penalty, by Adam; one label a document."""
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    counts, labels = counts[order], labels[order]
    x = features.astype(np.float32)
    share = np.array([max((labels == k).sum(), 1) for k in (0, 1)], float)
    weight = (share.sum() / 2 / share)[labels]
    live = [int(np.searchsorted(-counts, -t, side="left")) for t in range(int(counts[0]))]
    theta = np.zeros(2 * N_FEATURES + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    line_weight = np.zeros(len(x))
    truth = np.zeros(len(x), np.int8)
    for t, n in enumerate(live):
        at = starts[:n] + t
        line_weight[at] = weight[:n]
        truth[at] = labels[:n]
    total = line_weight.sum()
    for epoch in range(1, epochs + 1):
        emit, move = theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)
        scores = x @ emit
        forward, backward = np.zeros((len(x), 2)), np.zeros((len(x), 2))
        for t, n in enumerate(live):
            at = starts[:n] + t
            forward[at] = scores[at]
            if t:
                forward[at] += np.logaddexp.reduce(forward[at - 1][:, :, None] + move[None], axis=1)
        gained = np.zeros((2, 2))
        for t in range(len(live) - 1, 0, -1):
            at = starts[:live[t]] + t
            ahead = scores[at] + backward[at]
            backward[at - 1] = np.logaddexp.reduce(move[None] + ahead[:, None, :], axis=2)
            pair = forward[at - 1][:, :, None] + move[None] + ahead[:, None, :]
            pair -= np.logaddexp.reduce(pair.reshape(len(at), 4), axis=1)[:, None, None]
            gained -= (np.exp(pair) * weight[:live[t], None, None]).sum(axis=0)
            gained[0, 0] += (weight[:live[t]] * (labels[:live[t]] == 0)).sum()
            gained[1, 1] += (weight[:live[t]] * (labels[:live[t]] == 1)).sum()
        belief = forward + backward
        belief = np.exp(belief - np.logaddexp.reduce(belief, axis=1)[:, None])
        wrong = (np.eye(2)[truth] - belief) * line_weight[:, None]
        slope = np.concatenate(((x.T @ wrong).ravel(), gained.ravel())) / total - 1e-3 * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        theta = theta + 0.15 * (first / (1 - 0.9**epoch)) / (np.sqrt(second / (1 - 0.99**epoch)) + 1e-8)
    return Field(theta[:-4].reshape(-1, 2).copy(), theta[-4:].reshape(2, 2).copy())


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field | None:
    """A field from at most ``sample_docs`` labelled documents, or nothing if a label is missing."""
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        (1 - F.max("quality")).cast("int").alias("label")
    )
    known = known.where("crc32(cast(doc_id as string)) % 3 <> 1")
    # Half of the sample for each label, in the order of a hash; label 1 is boilerplate.
    picked = None
    for label in (0, 1):
        half = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs // 2)
        picked = half if picked is None else picked.union(half)
    # As many rows as the sample has at most, so a fixed size.
    chosen = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words = Words(Texts(batch.column("text")), lower=False)
            lines = lines_of(words)
            bounds = np.searchsorted(lines.doc, np.arange(batch.num_rows + 1))
            packed = np.packbits(lines.features, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("doc_id"),
                 pa.array([packed[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary())],
                ["label", "doc_id", "lines"],
            )

    rows = (
        chosen.select("label", F.col("doc_id").cast("long"), "text")
        .mapInArrow(features, "label int, doc_id long, lines binary")
        .orderBy("doc_id", "lines").limit(sample_docs).collect()
    )
    if len({r.label for r in rows}) < 2:
        return None
    width = (N_FEATURES + 7) // 8
    packed = np.concatenate([np.frombuffer(bytes(r.lines), np.uint8).reshape(-1, width) for r in rows])
    counts = np.array([len(r.lines) // width for r in rows])
    return fit(np.unpackbits(packed, axis=1)[:, :N_FEATURES], counts, np.array([r.label for r in rows]))


def judge(
    docs: DataFrame, field: Field | None, min_content: float = 0.5,
    min_words: int = 50, max_repeat_pct: int = 50,
) -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``content_share``, ``content_lines`` and ``kept``.

    ``content_lines`` holds the positions of content lines. Columns of these names are replaced.
    """
    new = [
        ("n_words", pa.int64(), "long"), ("word_chars", pa.int64(), "long"), ("n_symbols", pa.int64(), "long"),
        ("n_dup_lines", pa.int64(), "long"), ("n_repeat_words", pa.int64(), "long"),
        ("base_failed", pa.bool_(), "boolean"), ("content_share", pa.float64(), "double"),
        ("content_lines", pa.list_(pa.int32()), "array<int>"), ("kept", pa.bool_(), "boolean"),
    ]
    docs = docs.drop(*[name for name, _, _ in new])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            n = batch.num_rows
            texts = Texts(batch.column("text"))
            words = Words(texts, lower=False)
            lines = lines_of(words)
            n_words = np.diff(words.bounds)
            chars = np.add.reduceat(np.append(_per(_LEAD[texts.bytes], words.first, words.end), 0), words.bounds[:-1])
            chars[n_words == 0] = 0
            symbols = _per(_SYMBOL[texts.bytes], texts.offsets[:-1], texts.offsets[1:])
            dup = np.bincount(lines.doc[lines.repeated], minlength=n)
            at, h = grams(words, 3)
            owned = h ^ mix(words.doc[at].astype(np.uint64) + np.uint64(1))
            _, which, often = np.unique(owned, return_inverse=True, return_counts=True)
            hit = at[often[which] > 1] if len(at) else at
            covered = np.zeros(len(words.hash) + 3, bool)
            for k in range(3):
                covered[hit + k] = True
            repeat = np.bincount(words.doc[covered[:len(words.hash)]], minlength=n)
            failed = (n_words < min_words) | (100 * repeat > max_repeat_pct * n_words)
            bounds = np.searchsorted(lines.doc, np.arange(n + 1))
            boiler = np.zeros(len(lines.doc), np.int8) if field is None else field.decode(lines.features, bounds)
            good = np.bincount(lines.doc, weights=lines.n_words * (boiler == 0), minlength=n)
            share = np.where(n_words > 0, good / np.maximum(n_words, 1), 0.0)
            kept = ~failed & (share >= min_content)
            content = [np.flatnonzero(boiler[a:b] == 0) for a, b in zip(bounds, bounds[1:])]
            values = [n_words, chars, symbols, dup, repeat, failed, share, content, kept]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(v, t) for v, (_, t, _) in zip(values, new)]],
                [*batch.schema.names, *[name for name, _, _ in new]],
            )

    schema = ", ".join(
        [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields]
        + [f"{name} {kind}" for name, _, kind in new]
    )
    return docs.mapInArrow(label, schema)
