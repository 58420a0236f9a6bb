"""Short lists of codes go to the rows of a table; the table is not shuffled to meet them."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import date

import pytest

from checks.harness import CheckTables
from martkit.operators import change, hot
from martkit.plans import base, order_events as oe

FOLDER = "/root/testdata/sf0.001"
DAY = date(1998, 8, 31)


@contextmanager
def settings(spark, **values):
    old = {k.replace("__", "."): spark.conf.get(k.replace("__", ".")) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k.replace("__", "."), v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def merges(spark, build) -> int:
    """Sort-merge joins of a plan where Spark broadcasts nothing of its own accord."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        return build()._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin")


def test_only_the_subscriber_join_shuffles_the_components(spark):
    t = CheckTables(spark, FOLDER, True)
    asked = spark.createDataFrame(
        [("S1", "W1", 1, DAY, "add")], "svc_no string, work_ord_no string, subscr_no int, work_ord_completion_dt date, kind string"
    )
    window = (date(1992, 1, 1), date(1998, 12, 31))
    assert merges(spark, lambda: oe.lookup_basic_plan(t, asked, window)) == 1


def test_only_the_addon_join_shuffles_the_held_components(spark):
    t = CheckTables(spark, FOLDER, True)
    addons = spark.createDataFrame([(1,)], "subscr_no int")
    basics = spark.createDataFrame([(1, "one", 3)], "component_id int, basic_plan_ds string, package_group int")
    assert merges(spark, lambda: base.active_basic_plan(t, DAY, addons, basics)) == 1
    plans = spark.createDataFrame([("1", "one")], "rate_plan_cd string, rate_plan_ds string")
    # Best rows are compared with the best of their key; the codes join nothing by shuffle.
    assert merges(spark, lambda: base.active_addons(t, DAY, plans)) == 1


def test_an_update_from_a_code_list_leaves_its_target_in_place(spark, monkeypatch):
    target = spark.createDataFrame([(1, "a", "old"), (2, "b", "old"), (3, None, "old"), (4, "b", "old")], "n int, cd string, v string")
    codes = spark.createDataFrame([("a", "new"), ("b", None), (None, "never"), ("z", "y"), ("z", "x")], "c string, d string")
    update = lambda: change.update_from(target, codes, [("cd", "c")], {"v": "d"}, codes=True)
    wanted = [(1, "a", "new"), (2, "b", None), (3, None, "old"), (4, "b", None)]
    assert merges(spark, update) == 0
    assert sorted(map(tuple, update().collect())) == wanted
    monkeypatch.setattr(hot, "LISTED_ROWS", 3)  # a longer list is shuffled to meet the target
    assert merges(spark, update) == 1
    assert sorted(map(tuple, update().collect())) == wanted
    monkeypatch.undo()
    twice = codes.union(spark.createDataFrame([("a", "other")], codes.schema))
    with pytest.raises(Exception, match="several source rows"):
        change.update_from(target, twice, [("cd", "c")], {"v": "d"}, codes=True).collect()


def test_basic_plans_are_told_once_however_often_rows_and_names_repeat(spark):
    held = """SELECT 1 AS subscr_no, c AS component_id, 3 AS package_id, TIMESTAMP '1998-01-01' AS product_start,
              CAST(NULL AS TIMESTAMP) AS product_stop, DATE '2899-12-31' AS close_dt FROM VALUES (7), (7), (8), (9) v(c)"""
    names = """SELECT c AS component_id, d AS component_id_dv, d AS short_display, DATE '2899-12-31' AS close_dt
               FROM VALUES (7, 'seven'), (7, 'seven'), (8, 'eight'), (8, 'VIII') v(c, d)"""
    groups = "SELECT 3 AS package_id, 3 AS package_group, DATE '2899-12-31' AS close_dt FROM VALUES (1), (2) v(i)"
    t = {"ar_p200": spark.sql(held), "ar_component_definition_values": spark.sql(names), "ar_package_definition_ref": spark.sql(groups)}
    asked = spark.sql(
        "SELECT 'S1' AS svc_no, 'W1' AS work_ord_no, 1 AS subscr_no, DATE '1998-02-01' AS work_ord_completion_dt, 'add' AS kind"
    )
    found = oe.lookup_basic_plan(t, asked, (date(1998, 1, 1), date(1998, 12, 31)))
    rows = sorted((r.basic_rate_plan_cd, r.component_id_dv) for r in found.collect())
    assert rows == [("7", "seven"), ("8", "VIII"), ("8", "eight")]


def test_copies_of_a_held_component_are_one_basic_plan(spark):
    held = """SELECT 1 AS subscr_no, 2 AS account_no, c AS component_id, 3 AS package_id, TIMESTAMP '1998-01-01' AS product_start,
              CAST(NULL AS TIMESTAMP) AS product_stop, TIMESTAMP '1998-01-01' AS cce_active_dt,
              CAST(NULL AS TIMESTAMP) AS cce_inactive_dt, DATE '1998-01-01' AS open_dt, DATE '2899-12-31' AS close_dt
              FROM VALUES (7), (8), (8), (9) v(c)"""
    addons = spark.createDataFrame([(1,)], "subscr_no int")
    basics = spark.createDataFrame([(7, "seven", 3), (8, "eight", 3), (8, "VIII", 4)], "component_id int, basic_plan_ds string, package_group int")
    found = base.active_basic_plan({"ar_p200": spark.sql(held)}, DAY, addons, basics).collect()
    assert [(r.subscr_no, r.component_id) for r in found] == [(1, 8)]
