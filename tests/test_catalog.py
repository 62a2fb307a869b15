"""Every query that has an oracle gives the same rows as DuckDB on the smallest tables."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "None"
    if isinstance(v, float):
        return f"{v + 0.0:.6g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rel = duck.sql(catalog.ORACLES[name])
    assert sorted(rel.columns) == cols
    got = sorted(tuple(_cell(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    want = sorted(tuple(_cell(v) for v in r) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall())
    assert got == want


def test_entry_has_rows_and_every_query_a_plan(spark):
    assert E.entry(spark).count() > 0
    assert set(catalog.ORACLES) <= set(E.queries())
