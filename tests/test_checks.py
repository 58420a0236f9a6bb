"""Every registered query gives the answer of its SQL counterpart on the smallest tables."""

from __future__ import annotations

import decimal

import pytest

from checks.registry import CHECKS
from checks.views import BASE_TABLES

duckdb = pytest.importorskip("duckdb")

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield con
    con.close()


def _plain(value):
    return round(float(value), 6) if isinstance(value, (float, decimal.Decimal)) else value


@pytest.mark.parametrize("name", CHECKS)
def test_same_answer(spark, database, name):
    frame = CHECKS[name].spark(spark, FOLDER)
    columns = sorted(frame.columns)
    got = sorted((tuple(_plain(row[c]) for c in columns) for row in frame.collect()), key=repr)
    cursor = database.execute(CHECKS[name].oracle())
    positions = [[d[0] for d in cursor.description].index(c) for c in columns]
    expected = sorted((tuple(_plain(row[i]) for i in positions) for row in cursor.fetchall()), key=repr)
    assert got == expected


def test_entry_point(spark):
    import __spark_entry__ as entry_point

    assert entry_point.entry(spark).count() > 0
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
