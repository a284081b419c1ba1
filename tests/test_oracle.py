"""Registered queries against their oracle SQL on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from assetlake.plans.views import TABLES
from tools.check_oracle import canonical

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
SAMPLE = [n for n in ORACLES if n.startswith(("a0", "a2", "a3", "a4", "j", "m0", "p1", "t0", "u0", "w0", "x05_sl", "x08_th"))]
SAMPLE += [n for n in ORACLES if n.startswith(("s01", "s04", "s08", "s10", "s03_s12", "m14", "m15", "m18", "m20", "p20", "w10", "x02"))]


@pytest.fixture(scope="module")
def database():
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return db


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, database, name):
    frame = QUERIES[name](spark, SF)
    result = database.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert canonical(frame.columns, [tuple(r) for r in frame.collect()]) == canonical(columns, result.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 6
