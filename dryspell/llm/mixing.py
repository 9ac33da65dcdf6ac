"""Samples documents so that their tokens follow target shares of sources, languages and topics.

Tokens are counted by cell, a (source, language, topic) class. Iterative proportional fitting rakes the
cells to the three marginals in turn until all hold. A cell cannot give more tokens than it has: cells at
that limit are fixed and the others raked on. Every document of a cell is then kept with the probability
that gives the cell its tokens, by a hash of its id.

Classes are those that the targets list, and one for all others, null included: the number of cells is the
product of the lists' lengths, whatever the corpus. A class without tokens takes no part, and the others
share its weight. A null text has no tokens, and its document is kept like the others of its cell. Copies
of a row share its fate. Rows with a null ``doc_id`` are decided by their text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER = "other"
WORD = r"[^\x20\x09-\x0D]+"


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """The form of the content: tables and menus, marked-up text, records with figures, or prose."""
    chars = F.greatest(F.length(text), F.lit(1))
    per_mille = lambda pattern: F.regexp_count(text, F.lit(pattern)) * 1000 / chars
    return (
        F.when(F.coalesce(F.length(text), F.lit(0)) < 200, "note")
        .when(per_mille(r"\|") > 20, "table")
        .when(per_mille(r"[#*$%&<>!]") > 20, "markup")
        .when(per_mille(r"[0-9]") > 5, "record")
        .otherwise("prose")
    )


@dataclass
class Targets:
    """Share of the tokens of every listed class; what is left to 1 falls to all other classes."""

    source: dict[str, float] = field(default_factory=dict)
    lang: dict[str, float] = field(default_factory=dict)
    topic: dict[str, float] = field(default_factory=dict)

    def axes(self) -> dict[str, dict[str, float]]:
        found = {}
        for name in ("source", "lang", "topic"):
            shares = dict(getattr(self, name))
            if any(v < 0 for v in shares.values()) or sum(shares.values()) > 1 + 1e-9:
                raise ValueError(f"the shares of {name} are negative or above 1")
            shares[OTHER] = shares.get(OTHER, 0) + max(0.0, 1 - sum(shares.values()))
            found[name] = shares
        return found


def class_of(c: Column, shares: dict[str, float]) -> Column:
    return F.when(c.isin([s for s in shares if s != OTHER]), c).otherwise(F.lit(OTHER))


def rake(tokens: np.ndarray, shares: list[np.ndarray], rate: float, rounds: int = 500) -> np.ndarray:
    """The share of its tokens that every cell gives, between 0 and 1.

    ``tokens`` has one axis for each marginal. The shares that cannot be reached, because cells are empty
    or exhausted, are approached.
    """
    total = tokens.sum()
    if not total:
        return np.ones(tokens.shape)
    goals = []
    for axis, share in enumerate(shares):
        there = tokens.sum(axis=tuple(i for i in range(tokens.ndim) if i != axis)) > 0
        share = np.where(there, share, 0.0)
        share = share / share.sum() if share.sum() else there / there.sum()
        goals.append(rate * total * share)
    given = tokens * rate
    for _ in range(rounds):
        before = given.copy()
        for axis, goal in enumerate(goals):
            rest = tuple(i for i in range(tokens.ndim) if i != axis)
            full = given >= tokens * (1 - 1e-12)
            fixed = np.where(full, given, 0.0).sum(axis=rest)
            open_ = np.where(full, 0.0, given).sum(axis=rest)
            # Exhausted cells give way again where their class is above its goal.
            over = fixed > goal
            open_ = np.where(over, open_ + fixed, open_)
            fixed = np.where(over, 0.0, fixed)
            factor = np.divide(goal - fixed, open_, out=np.ones_like(goal), where=open_ > 0)
            shape = [-1 if i == axis else 1 for i in range(tokens.ndim)]
            moved = np.where(full & ~over.reshape(shape), given, given * factor.reshape(shape))
            given = np.minimum(moved, tokens)
        if np.abs(given - before).max() <= 1e-9 * total:
            break
    return np.divide(given, tokens, out=np.full(tokens.shape, rate), where=tokens > 0)


def cells(docs: DataFrame, targets: Targets, topic: Column) -> DataFrame:
    axes = targets.axes()
    return docs.select(
        class_of(F.col("source"), axes["source"]).alias("source"),
        class_of(F.col("lang"), axes["lang"]).alias("lang"),
        class_of(topic, axes["topic"]).alias("topic"),
        n_tokens(F.col("text")).alias("tokens"),
    ).groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"))


def keep_rates(docs: DataFrame, targets: Targets, rate: float, topic: Column) -> list[tuple]:
    """(source, lang, topic, tokens, rows, probability) of every cell."""
    axes = targets.axes()
    names = [list(shares) for shares in axes.values()]
    table = np.zeros([len(n) for n in names])
    rows = cells(docs, targets, topic).collect()  # as many as the targets allow, see above
    where = [tuple(n.index(v) for n, v in zip(names, r[:3])) for r in rows]
    for at, r in zip(where, rows):
        table[at] = r.tokens
    given = rake(table, [np.array(list(s.values())) for s in axes.values()], rate)
    return [(*r, float(given[at])) for at, r in zip(where, rows)]


def chance(seed: int) -> Column:
    """A number in [0, 1) from the id, or from the text of rows without one."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def mix(
    docs: DataFrame, targets: Targets, rate: float = 0.5, seed: int = 1, topic: Column | None = None,
) -> DataFrame:
    """All of ``docs`` with ``topic``, ``n_tokens``, ``keep_rate`` and ``kept``; such columns are replaced.

    ``rate`` is the share of the corpus' tokens to draw, as far as the targets allow.
    """
    topic = topic_of(F.col("text")) if topic is None else topic
    axes = targets.axes()
    rates = keep_rates(docs, targets, rate, topic)
    docs = docs.withColumn("__topic", topic).drop("topic", "n_tokens", "keep_rate", "kept")
    docs = docs.withColumnRenamed("__topic", "topic").withColumn("n_tokens", n_tokens(F.col("text")))
    classes = F.concat_ws(
        "\n", *[class_of(F.col(name), axes[name]) for name in ("source", "lang", "topic")]
    )
    if rates:
        table = F.create_map(*[F.lit(x) for r in rates for x in ("\n".join(r[:3]), r[5])])
        keep = F.element_at(table, classes)
    else:
        keep = F.lit(rate)
    return docs.withColumn("keep_rate", keep).withColumn("kept", chance(seed) < F.col("keep_rate"))
