"""Source-shaped views: what is stored, what a plan derives by itself, and what travels."""

from __future__ import annotations

from datetime import date

import pytest

from checks.harness import CheckTables
from checks.views import GATHERED, NARROW, VIEWS
from martkit.plans import staged_events

FOLDER = "/root/testdata/sf0.001"


def _files(frame) -> str:
    return " ".join(frame.inputFiles())


@pytest.mark.parametrize("name", ["ips_f_subs_bltn_tran_day", "all_daily_add_churn", "oo_wrkord", "f_mob_rev"])
def test_views_made_row_by_row_are_not_stored(spark, name):
    assert "sf0.001" in _files(CheckTables(spark, FOLDER, stored=True)[name])


@pytest.mark.parametrize("name", ["cust_hist", "oo_btxnpa", "ar_p200"])
def test_views_that_shuffle_are_stored_once(spark, name):
    files = [_files(CheckTables(spark, FOLDER, stored=True)[name]) for _ in range(2)]
    assert files[0] == files[1] and "sf0.001" not in files[0]


def test_every_view_that_gathers_rows_is_listed():
    gathers = {v for v, sql in VIEWS.items() if any(w in sql for w in ("GROUP BY", "DISTINCT", " OVER ", " JOIN "))}
    assert gathers == set(GATHERED)


@pytest.mark.parametrize("name", sorted(NARROW))
def test_narrow_forms_give_the_same_rows_with_nulls_and_copies(spark, name):
    rows = "SELECT CAST(NULLIF(id % 7, 3) AS BIGINT) AS {0}, DATE '1996-01-30' + CAST(id % 4 AS INT) AS l_shipdate FROM range(60)"
    lines = spark.sql(rows.format("l_partkey")).selectExpr("*", "l_partkey + 100 AS l_orderkey")
    lines = lines.unionByName(lines.limit(5)).unionByName(lines.selectExpr("l_partkey", "CAST(NULL AS DATE) AS l_shipdate", "l_orderkey"))
    lines.createOrReplaceTempView("lineitem")
    narrow, plain = (sorted(map(tuple, spark.sql(s).collect()), key=str) for s in (NARROW[name], VIEWS[name]))
    assert narrow == plain and len(plain) > 6


def test_account_addons_of_both_kinds_read_the_tables_once(spark):
    """Before, adds and cancels each joined components, packages and orders again."""
    t = CheckTables(spark, FOLDER, stored=True)
    window, kept = (date(1995, 1, 1), date(2001, 12, 31)), {}
    staged_events.account_addon_events(t, window, date(2002, 1, 2), lambda df, name: kept.setdefault(name, df))
    assert len(kept) == 1
    both = next(iter(kept.values()))
    columns = [c for c in both.columns if c != "kind"]
    parts = [staged_events.account_addons(t, window, k).select(*columns) for k in ("add", "churn")]
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(both.select(*columns)) == rows(parts[0].unionByName(parts[1]))
