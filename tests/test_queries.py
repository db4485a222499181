"""The registered queries: every one of the core runs, and agrees with its SQL, on a small made folder."""

import datetime as dt
import os

import pytest

import __spark_entry__ as entry
from marlstone.plans import catalogue

DATA = "/root/testdata/sf0.001"


def test_contract():
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names and catalogue.FLAGSHIP in names


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    got = catalogue.queries()[name](spark, DATA)
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(DATA):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS FROM '{DATA}/{file}'")
    want = con.sql(catalogue.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in got.columns]
    tidy = lambda v: float(f"{v:.6g}") if isinstance(v, float) else float(v) if type(v).__name__ == "Decimal" else v.date() if isinstance(v, dt.datetime) and v.time() == dt.time() else v
    one = sorted((tuple(map(tidy, r)) for r in got.collect()), key=repr)
    two = sorted((tuple(tidy(r[i]) for i in order) for r in want.fetchall()), key=repr)
    assert one == two
