"""Scores texts for quality with a sparse ensemble of rules.

Statistics of a text are SQL expressions. Boosted trees over them are fitted to the labelled rows, and every
path from a root to a node is a rule: a conjunction of comparisons. A logistic regression with an L1 penalty
weighs the rules, most of which drop out. The others are compiled into one SQL expression, the score.

Rows of ``labels`` other than 0 and 1 and rows without an id are left out; a document labelled both ways
counts as 0. Labels are learnt only where crc32 of the id as text, modulo 3, is not 1. Without both labels
there, every score is 0.5. A null text is scored as an empty one. Repeated rows are scored each for itself.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dryspell.lineage import materialize

TREES = 10
DEPTH = 3
PENALTY = 0.002


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text; shares are of words or of characters."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.greatest(F.size(words), F.lit(1)).cast("double")
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    lines = F.split(text, "\n")
    n_lines = F.size(lines).cast("double")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    return {
        "n_words": F.size(words).cast("double"),
        "chars_a_word": chars / n,
        "distinct_words": F.size(F.array_distinct(words)) / n,
        "words_a_line": n / n_lines,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "symbols": count(r"[#*$%&<>]") / n,
        "bars": count(r"\|") / n,
        "shouts": count(r"!") / n,
        "sentence_ends": count(r"[.?](?=[\x20\x09-\x0D]|$)") / n,
        "commas": count(",") / n,
        "capitals": count(r"\p{Lu}") / chars,
        "digits": count(r"[0-9]") / chars,
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is it at most, bound), and its weight."""

    terms: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self) -> Column:
        tests = [F.col(n) <= F.lit(v) if below else F.col(n) > F.lit(v) for n, below, v in self.terms]
        return reduce(lambda a, b: a & b, tests)


_TEST = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def paths(description: str, names: list[str]) -> list[Rule]:
    """The conjunctions on all paths of a tree, from its printed form."""
    found, trail = [], []
    for line in description.splitlines():
        m = _TEST.match(line)
        if m:
            depth, name = len(m[1]), names[int(m[3])]
            trail = [t for t in trail if t[0] < depth] + [(depth, (name, m[4] == "<=", float(m[5])))]
            terms: dict[tuple[str, bool], float] = {}
            for _, (n, below, value) in trail:
                held = terms.get((n, below), value)
                terms[n, below] = min(held, value) if below else max(held, value)
            found.append(Rule(tuple((n, below, v) for (n, below), v in sorted(terms.items()))))
    return found


@dataclass
class Model:
    rules: list[Rule]
    intercept: float

    def score(self) -> Column:
        """The probability of label 1, from columns named like the statistics."""
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + F.when(rule.column(), F.lit(rule.weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> Model:
    known = labels.where("quality in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("double").alias("label"))
    # Only statistics are shuffled to the labels, never texts; the labels grow with the documents.
    stats = statistics(F.col("text"))
    learnt = docs.where("doc_id is not null").where(~held_out(F.col("doc_id")))
    measured = learnt.select("doc_id", *[c.alias(n) for n, c in stats.items()])
    rows = materialize(measured.join(known.hint("merge"), "doc_id").select("label", *stats))
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(n) < 2:
        return Model([], 0.0)
    names = list(stats)
    train = VectorAssembler(inputCols=names, outputCol="features").transform(rows).select("label", "features")
    boosted = GBTClassifier(maxIter=trees, maxDepth=depth, seed=1, stepSize=0.3).fit(train)
    rules = sorted({r for tree in boosted.trees for r in paths(tree.toDebugString, names)}, key=lambda r: r.terms)
    if not rules:
        return Model([], math.log(n[1.0] / n[0.0]))
    fired = [r.column().cast("double").alias(f"r{k}") for k, r in enumerate(rules)]
    table = materialize(rows.select("label", F.array(*fired).alias("fired")).groupBy("label", "fired").count())
    columns = [F.col("fired")[k].alias(f"r{k}") for k in range(len(rules))]
    held = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="features").transform(
        table.select("label", F.col("count").cast("double").alias("weight"), *columns)
    ).select("label", "weight", "features")
    lasso = LogisticRegression(
        weightCol="weight", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=100
    ).fit(held)
    weights = lasso.coefficients.toArray().tolist()
    chosen = [Rule(r.terms, w) for r, w in zip(rules, weights) if abs(w) > 1e-9]
    return Model(chosen, float(lasso.intercept))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; columns of these names are replaced."""
    stats = statistics(F.col("text"))
    own = {n: f"__{n}" for n in stats}
    renamed = Model([Rule(tuple((own[n], b, v) for n, b, v in r.terms), r.weight) for r in model.rules], model.intercept)
    used = {n for r in model.rules for n, _, _ in r.terms}
    held = docs.drop("score", "predicted").withColumns({own[n]: stats[n] for n in stats if n in used})
    return held.withColumn("score", renamed.score()).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)
    ).drop(*own.values())
