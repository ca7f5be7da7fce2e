"""Every registered query against its oracle statement in DuckDB."""

from __future__ import annotations

import math

import duckdb
import pytest

from __spark_entry__ import entry
from meterloom.plans.catalogue import query_functions as queries
from meterloom.plans.oracles import oracle_statements as oracle_sql

TABLES = ("part", "events", "lineitem")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _text(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0 if v else 0.0)
    return "~" if v is None else str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_text(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = queries()[name](spark, sf_dir)
    result = duck.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert _rows(df.columns, df.collect()) == _rows(names, result.fetchall())


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "measurement" in df.columns
