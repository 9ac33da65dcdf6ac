"""Finds personal data: fixed patterns, and identifiers that stand where known ones stand.

Four kinds have a pattern each. Their matches are the seeds of a bootstrap: the words around a seed make
contexts (two words before it, the word before it with the word after it, either of these alone, and what it
follows inside its own token), and everything identifier-like is an instance of the contexts it stands in:
single tokens, what follows a mark such as ``tel:`` in one, and runs of neighbouring groups of digits. Scores go round the graph of contexts and instances: a context
is as good as its instances, as many of which should be of one kind; an instance is as good as the contexts
it stands in. Contexts with enough different instances (more for one word alone, which chance fills sooner)
and a high score then mark what has a like shape and matches no pattern. Of marked spans that overlap the
longest stays.

A null text is empty. Every row is searched, whatever its ``doc_id``, and repeated rows each for itself;
an instance counts once in a context however often it is copied.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dryspell.lineage import materialize
from dryspell.llm.words import pieces

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 4
MIN_INSTANCES, MIN_INSTANCES_ALONE = 5, 20
#: Digits of the longest identifier that a run of groups can be.
RUN_DIGITS = 19
MIN_SCORE = 0.8

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Groups of digits with little between them, on one line.
_RUN = re.compile(r"\+?\(?[0-9]+(?:[\x20().-]{1,3}[0-9]+)+")
_LEAD = re.compile(r"^[^0-9@]*[:=#]")
#: Left by these characters at its ends, a token is the identifier itself.
_EDGES = "\"'`.,;:!?()[]{}<>"
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, at sign and domain, found from the at signs."""
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL_CHARS:
            first -= 1
        domain = _DOMAIN.match(text, at + 1) if first < at else None
        if domain:
            done = domain.end()
            yield first, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind and place."""
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(int(part) <= 255 if len(part) < 5 else not part.strip("0") or int(part.lstrip("0")[:5]) <= 255
               for part in m.group().split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = "".join(_DIGITS.findall(m.group()))
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def like(kind: str, token: str) -> bool:
    """Whether a token has the shape of a kind, far more loosely than the pattern asks."""
    digits = sum(map(len, _DIGITS.findall(token)))
    if kind == "email":
        return "@" in token[1:-1]
    if kind == "ip":
        return digits >= 4 and token.count(".") + token.count(":") >= 3
    if kind == "card":
        return digits >= 12 and digits >= 0.8 * len(token)
    return digits >= 7 and digits >= 0.6 * len(token)


def digit_runs(text: str) -> Iterator[tuple[int, int]]:
    """Runs of two or more neighbouring groups of digits; longer ones are cut where they exceed an identifier."""
    for m in _RUN.finditer(text):
        first, digits, groups, end = m.start(), 0, 0, m.start()
        for g in _DIGITS.finditer(text, m.start(), m.end()):
            size = g.end() - g.start()
            if groups and digits + size > RUN_DIGITS:
                if groups > 1:
                    yield first, end
                first, digits, groups = g.start(), 0, 0
            digits, groups, end = digits + size, groups + 1, g.end()
        if groups > 1:
            yield first, end


def occurrences(text: str) -> Iterator[tuple[str, str, int, int, list[str]]]:
    """(kind, instance, start, end, contexts) of seeds and, with an empty kind, of what else is identifier-like."""
    if "@" not in text and not _DIGIT.search(text):
        return
    seeds = [(a, b, k) for k, a, b in base_spans(text)]
    starts, ends, tokens = [], [], []
    for m in _WORD.finditer(text):
        starts.append(m.start())
        ends.append(m.end())
        tokens.append(m.group())

    def shown(k: int) -> str:
        return _DIGITS.sub("0", tokens[k].lower())

    def around(a: int, b: int) -> list[str]:
        """The contexts of a span, by the tokens it lies in."""
        k, last = bisect_right(starts, a) - 1, bisect_right(starts, b - 1)
        lead = text[starts[k]:a]
        found = [f"in:{_DIGITS.sub('0', lead.lower())}"] if lead.strip(_EDGES) or lead[-1:] in (":", "=", "#") else []
        before, after = shown(k - 1) if k else "^", shown(last) if last < len(tokens) else "$"
        found += [f"around:{before} {after}", f"left:{before}", f"right:{after}"]
        if k > 1:
            found.append(f"before:{shown(k - 2)} {before}")
        return found

    for a, b, kind in seeds:
        yield kind, text[a:b].lower(), a, b, around(a, b)
    others = set()
    for start, raw in zip(starts, tokens):
        core = raw.strip(_EDGES)
        if "@" in core or _DIGIT.search(core):
            a = start + raw.find(core)
            lead = _LEAD.match(core)
            skip = lead.end() if lead and lead.end() < len(core) else 0
            others.add((a + skip, a + len(core)))
    others |= set(digit_runs(text))
    taken = sorted((a, b) for a, b, _ in seeds)
    firsts = [a for a, _ in taken]
    reach = list(accumulate((b for _, b in taken), max))
    for a, b in sorted(others):
        k = bisect_right(firsts, b - 1)
        if not k or reach[k - 1] <= a:
            yield "", text[a:b].lower(), a, b, around(a, b)


def graph(docs: DataFrame) -> DataFrame:
    """(context, instance, kind) once each, with the empty kind for tokens that are no seeds."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = {
                (context, hashlib.md5(instance.encode()).hexdigest(), kind)
                for text in batch.column("text").to_pylist() if text
                for kind, instance, _, _, contexts in occurrences(text)
                for context in contexts
            }
            columns = list(zip(*rows)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string()) for c in columns], ["context", "instance", "kind"]
            )

    edges = docs.where("text is not null").select("text").mapInArrow(
        explode, "context string, instance string, kind string"
    )
    return edges.distinct()


def contexts(
    docs: DataFrame, rounds: int = ROUNDS, min_instances: int = MIN_INSTANCES, min_score: float = MIN_SCORE,
) -> DataFrame:
    """(context, kind, score, instances) of the contexts that mark identifiers.

    A seed is worth 1 to contexts of its kind and 0 to other kinds. A token that is no seed starts at 0 and
    takes, in each round, the mean score of its contexts. The score of a context is the mean worth of its
    instances.
    """
    edges = materialize(graph(docs))
    # Contexts that hold too few seeds of a kind, or none, can mark nothing.
    seeded = edges.where("kind <> ''").groupBy("context", "kind").agg(F.count("*").alias("instances"))
    alone = F.col("context").startswith("left:") | F.col("context").startswith("right:")
    needed = F.when(alone, F.lit(max(min_instances, MIN_INSTANCES_ALONE))).otherwise(F.lit(min_instances))
    seeded = seeded.where(F.col("instances") >= needed).withColumnRenamed("kind", "own")
    live = materialize(edges.join(seeded, "context"))
    worth = F.when(F.col("kind") == F.col("own"), 1.0).otherwise(0.0)
    scores = live.groupBy("context", "own").agg(F.avg(worth).alias("score"), F.max("instances").alias("instances"))
    for _ in range(rounds):
        open_ = live.where("kind = ''").select("context", "own", "instance")
        new = open_.join(scores, ["context", "own"]).groupBy("instance", "own").agg(F.avg("score").alias("taken"))
        joined = live.join(new, ["instance", "own"], "left")
        value = F.when(F.col("kind") == "", F.coalesce("taken", F.lit(0.0))).otherwise(worth)
        scores = materialize(
            joined.groupBy("context", "own").agg(F.avg(value).alias("score"), F.max("instances").alias("instances"))
        )
    return scores.where(F.col("score") >= min_score).select(
        "context", F.col("own").alias("kind"), "score", "instances"
    )


def find(docs: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``base`` and ``found``: arrays of (kind, start, end), code points, end exclusive.

    ``found`` are the spans that the contexts in ``marks`` add; by default those learnt from ``docs``.
    Columns of these names are replaced. Candidates are few, so only they meet the contexts in a join.
    """
    marks = contexts(docs) if marks is None else marks
    marks = materialize(marks.select("context", "kind", "score"))
    docs = docs.drop("base", "found")
    span = "array<struct<kind:string,start:int,end:int>>"
    kind_of = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    kinds = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    as_spans = lambda rows: [{"kind": k, "start": a, "end": b} for k, a, b in rows]

    def base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = [as_spans(base_spans(t or "")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, kind_of)], [*batch.schema.names, "base"]
            )

    result = docs.mapInArrow(base, ", ".join([*kinds, f"base {span}"]))
    if marks.isEmpty():
        return result.withColumn("found", F.array().cast(span))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = [
                (digest, context, kind, a, b)
                for text in batch.column("text").to_pylist() if text
                for own, instance, a, b, around in occurrences(text) if not own
                for kind in KINDS if like(kind, instance)
                for context in around
                for digest in [hashlib.md5(text.encode()).hexdigest()]
            ]
            columns = list(zip(*rows)) if rows else [[]] * 5
            types = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["digest", "context", "kind", "start", "end"]
            )

    seen = docs.where("text is not null").select("text").mapInArrow(
        candidates, "digest string, context string, kind string, start int, end int"
    ).distinct()
    best = seen.join(marks, ["context", "kind"]).groupBy("digest", "start", "end").agg(
        F.max(F.struct("score", "kind")).alias("best")
    )
    spans = best.groupBy("digest").agg(
        F.sort_array(F.collect_list(F.struct(F.col("best.kind").alias("kind"), "start", "end"))).alias("found")
    )
    size = lambda s: s["end"] - s["start"]
    longer = lambda x, y: (
        (y["start"] < x["end"]) & (x["start"] < y["end"])
        & ((size(y) > size(x)) | ((size(y) == size(x)) & (y["start"] < x["start"])))
    )
    spans = spans.withColumn("found", F.filter("found", lambda x: ~F.exists("found", lambda y: longer(x, y))))
    key = "_" * (1 + max(map(len, docs.columns)))  # no other column has this name
    joined = result.withColumn(key, F.md5("text")).join(spans.withColumnRenamed("digest", key), key, "left")
    return joined.withColumn("found", F.coalesce("found", F.array().cast(span))).select(
        *[F.col(f"`{c}`") for c in docs.columns], "base", "found"
    )


def listed(spans: Column) -> Column:
    """The text form of an array of spans: kind:start:end in the order of the kinds, then by start."""
    order = F.create_map(*[F.lit(x) for k, kind in enumerate(KINDS) for x in (kind, k)])
    ranked = F.array_sort(F.transform(
        spans, lambda s: F.struct(order[s["kind"]].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    ))
    return F.array_join(F.transform(
        ranked, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    ), ",")
