"""Every registered query of the reference's operators against its SQL in DuckDB."""

from __future__ import annotations

import math

import duckdb
import pytest

from tidemark.plans import catalogue
from tidemark.plans.registry import ORACLES, QUERIES

catalogue.load()


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(map(normal, value))
    return value


@pytest.fixture(scope="module")
def database(sf_small):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, sf_small, name):
    frame = QUERIES[name](spark, sf_small)
    columns = sorted(frame.columns)
    got = sorted((tuple(normal(r[c]) for c in columns) for r in frame.collect()), key=repr)
    if name not in ORACLES:
        # The two scans of tables as they are: the tables hold none of what the detectors find.
        assert name in ("conversation_scan", "doc_scan") and got == []
        return
    cursor = database.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = sorted((tuple(normal(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr)
    assert sorted(names) == columns and got == want
