"""Every query with an oracle gives the oracle's rows on the small tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from sieveline.plans import catalogue

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for p in Path(SMALL).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


def plain(v):
    if v is None or isinstance(v, bool) or (isinstance(v, float) and math.isnan(v)):
        return None if isinstance(v, float) else v
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_equals_oracle(spark, oracle, name):
    df = catalogue.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = oracle.sql(catalogue.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
    assert [tuple(map(str, r)) for r in got] == [tuple(map(str, r)) for r in want]


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_gives_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 20
