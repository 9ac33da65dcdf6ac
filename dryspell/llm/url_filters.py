"""Allow and block rules on urls, by host suffix and path prefix.

Every url is expanded into the expressions a rule could equal: the host cut to its last labels, with the
path cut to a prefix. Only shapes (label count, prefix length) that some rule has are made. Expressions
meet rules in an equi-join on four bytes of a digest; the full digests confirm, the longest rule decides.
Only SQL expressions are used.

A null url, or one without ``://``, has an empty host and path and no rule. Rules that repeat count once;
of an allow and a block rule of one text, block decides. Repeated urls are judged once and returned as
often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def rule_table(rules: DataFrame) -> DataFrame:
    """(host, path, verdict) rules with their text, shape and digest."""
    rules = rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict").where(
        "host <> '' and path is not null and verdict in ('allow', 'block')"
    )
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    full = digest(F.col("host"), F.col("path"))
    return rules.select(
        F.concat("host", "path").alias("rule"),
        "verdict",
        F.size(F.split("host", "\\.")).alias("labels"),
        F.length("path").alias("chars"),
        full.alias("full"),
        F.substring(full, 1, 8).alias("short"),
    )


def judge(
    pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; columns of these names are replaced.

    ``rules`` may be large and of any number of shapes: rules and shapes are joined by their size. A url is
    expanded to its host's suffixes, and these to the prefixes whose length rules of as many labels have.
    """
    rules = rule_table(rules)
    lengths = rules.groupBy(F.col("labels").alias("k")).agg(F.collect_set("chars").alias("lengths"))
    pages = pages.drop("host", "path", "rule", "verdict")
    parsed = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    sites = parsed.select("host", "path").where("host <> ''").distinct()
    labels = F.split("host", "\\.")
    short_enough = F.filter("lengths", lambda n: n <= F.length("path"))
    expanded = (
        sites.withColumn("labels", labels)
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.size("labels"))))
        .join(lengths, "k")
        .withColumn("n", F.explode(short_enough))
        .withColumn("full", digest(
            F.array_join(F.slice("labels", F.size("labels") - F.col("k") + 1, F.col("k")), "."),
            F.substring(F.col("path"), F.lit(1), F.col("n")),
        ))
        .select("host", "path", "full", F.substring("full", 1, 8).alias("short"))
    )
    rules = rules.withColumnRenamed("full", "rule_full")
    decided = (
        expanded.join(rules, "short")
        .where("full = rule_full")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("chars"), "rule", "verdict")).alias("best"))
        .select(F.col("host").alias("__host"), F.col("path").alias("__path"), "best.rule", "best.verdict")
    )
    return (
        parsed.join(decided, F.expr("host = __host and path = __path"), "left")
        .drop("__host", "__path")
        .withColumn("verdict", F.coalesce("verdict", F.lit(otherwise)))
    )
