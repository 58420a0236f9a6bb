"""One key holds a third of all rows: answers equal a plain computation on the same rows."""

from __future__ import annotations

import bisect
import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from checks.registry import CHECKS
from martkit.operators import change, joins
from martkit.operators.pick import best_rows, earliest, latest

START = date(2000, 1, 1)


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(5)
    out = []
    for i in range(6000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(400)}"
        out.append((i, key, START + timedelta(days=rng.randrange(60)), rng.randrange(4)))
    out += [out[0]] * 500  # copies
    return out, spark.createDataFrame(out, "i int, k string, d date, v int").repartition(6).cache()


@pytest.mark.parametrize("spread", [False, True])
def test_pick_with_a_frequent_key(facts, spread):
    data, df = facts
    best: dict[str, tuple] = {}
    for _, k, d, v in data:
        best[k] = max(best.get(k, (v, -d.toordinal())), (v, -d.toordinal()))
    want = sorted((i, k) for i, k, d, v in data if best[k] == (v, -d.toordinal()))
    got = best_rows(df, ["k"], [latest("v"), earliest("d")], spread_ties=spread)
    assert sorted((r.i, r.k) for r in got.collect()) == want


def test_temporal_join_with_a_frequent_key(spark, facts):
    data, df = facts
    rng = random.Random(6)
    history = []
    for key in {k for _, k, _, _ in data}:
        for n in range(40 if key == "hot" else 2):
            opened = START + timedelta(days=rng.randrange(60))
            closed = date(2899, 12, 31) if rng.random() < 0.2 else opened + timedelta(days=rng.randrange(10))
            history.append((key, n, opened, closed))
    by_key = defaultdict(list)
    for key, n, opened, closed in history:
        by_key[key].append((n, opened, closed))
    want = sorted(
        (i, n) for i, k, d, _ in data for n, o, c in by_key[k] if o - timedelta(days=2) <= d <= c
    )
    right = spark.createDataFrame(history, "k string, n int, open_dt date, close_dt date")
    bounds = (START, START + timedelta(days=59))
    for cut, among in ((False, None), (True, None), (True, df)):
        alive = joins.alive_in(right, bounds, grace=2) if cut else right
        got = joins.temporal_join(df, alive, ["k"], "d", grace=2, among=among)
        assert sorted((r.i, r.n) for r in got.collect()) == want
        outer = joins.temporal_join(df, alive, ["k"], "d", grace=2, how="left", among=among)
        assert outer.count() == len(want) + len(data) - sum(
            1 for i, k, d, _ in data if any(o - timedelta(days=2) <= d <= c for _, o, c in by_key[k])
        )


def test_temporal_join_copies_nothing_and_keeps_far_rows(spark):
    """A row long after all others matches too, and history rows are joined as they are."""
    left = spark.createDataFrame([("a", START), ("a", date(2899, 12, 31))], "k string, d date")
    right = spark.createDataFrame([("a", START - timedelta(days=9), date(2899, 12, 31))], "k string, open_dt date, close_dt date")
    joined = joins.temporal_join(left, right, ["k"], "d")
    assert joined.count() == 2
    assert "Generate" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_asof_with_a_frequent_key(facts):
    data, df = facts
    right = df.filter("v = 3").select("k", F.col("d").alias("r"), F.col("i").alias("j")).distinct()
    days = defaultdict(set)
    rows_at = defaultdict(set)
    for i, k, d, v in data:
        if v == 3:
            days[k].add(d)
            rows_at[k, d].add(i)
    want = []
    for i, k, d, v in data:
        if v != 0:
            continue
        known = sorted(days[k])
        at = bisect.bisect_right(known, d)
        want += [(i, j) for j in rows_at[k, known[at - 1]]] if at else [(i, -1)]
    left = df.filter("v = 0").select("i", "k", "d")
    got = joins.asof_join(left, right, ["k"], "d", "r")
    assert sorted((r.i, -1 if r.j is None else r.j) for r in got.collect()) == sorted(want)


def test_update_and_flag_with_a_frequent_key(spark, facts):
    data, df = facts
    lookup = spark.createDataFrame([("hot", 99), ("k1", None)], "k string, n int")
    got = change.update_from(df, lookup, [("k", "k")], {"v": "n"})
    want = sorted((i, -1 if k == "k1" else 99 if k == "hot" else v) for i, k, _, v in data)
    assert sorted((r.i, -1 if r.v is None else r.v) for r in got.collect()) == want


def test_pick_plan_cuts_before_the_shuffle(facts):
    plan = best_rows(facts[1], ["k"], [latest("v")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    spread = best_rows(facts[1], ["k"], [latest("v")], spread_ties=True)
    text = spread._jdf.queryExecution().executedPlan().toString()
    assert "row_number" in text and "rank(" not in text.replace("row_number", "")


def test_spread_pick_copies_no_best_row(facts):
    """A best row copied for every part of a key made broadcasts many times as large as their estimate."""
    spread = best_rows(facts[1], ["k"], [latest("v")], spread_ties=True)
    assert "Generate" not in spread._jdf.queryExecution().optimizedPlan().toString()


def test_crowded_orders_of_a_day_meet_the_versions_once(spark, monkeypatch):
    """Orders of one key and day share their versions: the pairs of all of them are never written out."""
    placed = [(o, (o or 0) % 2, START + timedelta(days=(o or 0) % 7)) for o in [*range(60), 3, None]]
    orders = spark.createDataFrame(placed, "o_orderkey long, o_custkey long, o_orderdate date")
    lines = [(i, 1, i % 20, START + timedelta(days=i % 11)) for i in range(80)] + [(5, 2, 5, START)]
    lineitem = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_suppkey long, l_shipdate date")
    seen = []
    real = joins.temporal_join
    monkeypatch.setattr(joins, "temporal_join", lambda left, *a, **k: seen.append(left) or real(left, *a, **k))
    got = CHECKS["temporal_join_crowded"].build({"orders": orders, "lineitem": lineitem})
    want: dict = {}
    for o, c, d in placed:
        for i, n, s, a in lines:
            if n == 1 and s % 5 == c % 5 and a - timedelta(days=2) <= d <= a + timedelta(days=s % 17):
                m, last = want.get(o, (0, -1))
                want[o] = (m + 1, max(last, i * 8 + n))
    assert {r.work_ord_no: (r.n, r.last_line) for r in got.collect()} == want
    assert seen[0].count() == seen[0].distinct().count() < orders.count()
