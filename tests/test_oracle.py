"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from dryspell.plans.catalog import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Rare in the smallest tables, where no nation is its own office.
MAY_BE_EMPTY = {"grain_principal"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(
        (tuple(row[i] for i in order) for row in rows), key=lambda r: tuple(map(repr, r))
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    ours = canonical([tuple(r) for r in df.collect()], df.columns)
    if name not in ORACLES:
        assert ours[1], f"{name} returned no rows"
        return
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    theirs = canonical(result.fetchall(), columns)
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    assert ours[1] == theirs[1]
    if not ours[1] and name in MAY_BE_EMPTY:
        return
    assert ours[1], f"{name} returned no rows"
    kinds = [[type(v) for v in row] for row in (ours[1][0], theirs[1][0])]
    assert kinds[0] == kinds[1]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert os.path.exists(os.path.join(os.path.dirname(__file__), "..", "__spark_entry__.py"))
