"""The driver's contract, and every query with SQL against DuckDB on the smallest tables."""

import os
import subprocess
import sys
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from playmart.plans.registry import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(value):
    if isinstance(value, Decimal):
        return "decimal", str(value)
    return round(value, 6) if isinstance(value, float) else value


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_names_are_read_without_a_session():
    at = os.path.dirname(os.path.abspath(entry.__file__))
    code = "import __spark_entry__ as e; names = set(e.queries()); assert set(e.oracle_sql()) <= names; print('NAMES', *names)"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=at, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    assert set(said.stdout.rpartition("NAMES")[2].split()) == set(entry.queries())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, tiny, name):
    df = QUERIES[name](spark, tiny)
    found = duck.execute(ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(tuple(map(plain, r)) for r in df.select(names).collect()) == Counter(tuple(map(plain, r)) for r in found.fetchall())
