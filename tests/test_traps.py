"""Hand-made rows for the cases where a shortcut gives a different answer."""

from __future__ import annotations

import re
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martkit.functions.dates import HIGH_DATE, prev_month_end, rolling_window, same_month
from martkit.functions.predicates import in_interval, on_days, same_text, valid_at
from martkit.functions.text import mid_token
from martkit.operators import change, joins, names, profile, shape
from martkit.operators.pick import best_rows, earliest, latest
from martkit.sources.schemas import EVENT_FACT

D = date.fromisoformat


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_windows_and_month_ends():
    assert rolling_window(D("1998-09-01")) == (D("1998-08-20"), D("1998-08-30"))
    assert prev_month_end(D("2024-03-31")) == D("2024-02-29")
    assert prev_month_end(D("2024-01-01")) == D("2023-12-31")


@pytest.mark.parametrize("spread", [False, True])
def test_ties_stay(spark, spread):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, "y"), ("a", None, "z"), (None, 2, "n"), (None, 2, "n"), ("b", None, "q")],
        "k string, v int, p string",
    )
    best = best_rows(df, ["k"], [latest("v")], spread_ties=spread)
    assert rows(best.select("p")) == [("n",), ("n",), ("q",), ("x",), ("y",)]


def test_one_row_is_deterministic(spark):
    df = spark.createDataFrame([("a", 1, p) for p in "xyzw"], "k string, v int, p string")
    assert rows(best_rows(df.repartition(4), ["k"], [latest("v")], ties=False)) == [("a", 1, "z")]


def test_missing_values_sort_lowest(spark):
    df = spark.createDataFrame([("a", None), ("a", D("2000-01-01"))], "k string, d date")
    assert rows(best_rows(df, ["k"], [earliest("d")])) == [("a", None)]
    assert rows(best_rows(df, ["k"], [latest("d")])) == [("a", D("2000-01-01"))]
    assert rows(best_rows(df, ["k"], [latest("d", HIGH_DATE)])) == [("a", None)]


def test_grace_edges(spark):
    opened, closed = D("2000-01-10"), D("2000-01-20")
    days = ["2000-01-07", "2000-01-08", "2000-01-20", "2000-01-21"]
    df = spark.createDataFrame([(D(d), opened, closed) for d in days], "d date, o date, c date")
    kept = df.filter(valid_at(F.col("d"), F.col("o"), F.col("c"), 2)).select("d")
    assert rows(kept) == [(D("2000-01-08"),), (D("2000-01-20"),)]


def test_open_ends(spark):
    df = spark.createDataFrame(
        [(1, None), (2, HIGH_DATE), (3, D("2000-01-01")), (4, D("1999-12-29"))], "i int, e date"
    )
    day = F.lit(D("2000-01-01"))
    start = F.lit(D("1999-01-01"))
    assert rows(df.filter(in_interval(day, start, F.col("e"))).select("i")) == [(1,), (2,), (3,)]
    assert rows(df.filter(in_interval(day, start, F.col("e"), 3)).select("i")) == [(1,), (2,), (3,), (4,)]


def test_text_comparison(spark):
    df = spark.createDataFrame([("ORDER ",), ("Order",), (" order",), (None,)], "a string")
    assert rows(df.filter(same_text(F.col("a"), "order"))) == [("ORDER ",), ("Order",)]


def test_mid_token(spark):
    cases = {"A_B_C": "B", "AB": "AB", "A_B": None, None: None, "A__C": "", "A_B_C_D": "B"}
    df = spark.createDataFrame([(k,) for k in cases], "c string")
    got = {r.c: r.t for r in df.select("c", mid_token(F.col("c")).alias("t")).collect()}
    assert got == cases


def test_last_day_is_whole(spark):
    moments = ["2000-01-01 00:00:00", "2000-01-05 23:59:59", "2000-01-06 00:00:00"]
    df = spark.createDataFrame([(datetime.fromisoformat(m),) for m in moments], "ts timestamp_ntz")
    assert df.filter(on_days(F.col("ts"), D("2000-01-01"), D("2000-01-05"))).count() == 2


def test_same_month_needs_same_year(spark):
    df = spark.createDataFrame([(D("1998-08-01"), D("2098-08-31"))], "a date, b date")
    assert df.filter(same_month(F.col("a"), F.col("b"))).count() == 0


def test_null_keys_match_on_the_first_pair_only(spark):
    left = spark.createDataFrame([(None, "p"), (None, None), ("g", "p")], "a string, b string")
    right = spark.createDataFrame([(None, "p"), (None, None), ("g", None)], "x string, y string")
    joined = joins.null_safe_join(left, right, [("a", "x")], [("b", "y")])
    assert [tuple(r) for r in joined.collect()] == [(None, "p", None, "p")]


def test_update_lookup(spark):
    target = spark.createDataFrame([(1, "o"), (2, "o"), (3, "o"), (None, "o")], "k int, v string")
    source = spark.createDataFrame([(1, "n"), (2, None), (9, "a"), (9, "b"), (None, "z")], "k int, v string")
    updated = change.update_from(target, source, [("k", "k")], {"v": "v"})
    assert sorted(((r.k or 0), r.v or "") for r in updated.collect()) == [(0, "o"), (1, "n"), (2, ""), (3, "o")]


def test_update_refuses_several_source_rows(spark):
    target = spark.createDataFrame([(1, "o")], "k int, v string")
    source = spark.createDataFrame([(1, "a"), (1, "a")], "k int, v string")
    with pytest.raises(Exception, match="several source rows"):
        change.update_from(target, source, [("k", "k")], {"v": "v"}).collect()
    # A row that the update does not touch raises nothing.
    kept = change.update_from(target, source, [("k", "k")], {"v": "v"}, when=F.col("v") == "x")
    assert rows(kept) == [(1, "o")]


def test_unknown_condition_keeps_the_row(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, v string")
    assert rows(change.delete_where(df, F.col("v") == "x").select("k")) == [(2,), (3,)]
    assert rows(df.filter(~F.col("v").isin("x")).select("k")) == [(3,)]


def test_flags_only_first_source_rows(spark):
    df = spark.createDataFrame(
        [("s", "ID", "N"), ("s", "ED", "N"), ("t", "ID", "N"), ("u", "ID", "Y"), ("u", "ED", "N"), (None, "ID", "N"),
         (None, "ED", "N")],
        "svc string, src_cd string, bcc_migrated_ind string",
    )
    got = {(r.svc, r.src_cd): r.bcc_migrated_ind for r in change.flag_matched(df, ["svc"]).collect()}
    assert got[("s", "ID")] == "Y" and got[("u", "ID")] == "Y"
    assert {v for k, v in got.items() if k not in {("s", "ID"), ("u", "ID")}} == {"N"}


def test_asof_keeps_all_orders_of_the_day(spark):
    left = spark.createDataFrame([("s", D("2000-01-05")), ("t", D("2000-01-01")), (None, D("2000-01-05"))], "k string, d date")
    right = spark.createDataFrame(
        [("s", D("2000-01-05"), 1), ("s", D("2000-01-05"), 2), ("s", D("2000-01-01"), 3), ("s", D("2000-01-06"), 4),
         ("t", D("2000-01-02"), 5), (None, D("2000-01-01"), 6)],
        "k string, r date, n int",
    )
    got = sorted((r.k or "", r.n or 0) for r in joins.asof_join(left, right, ["k"], "d", "r").collect())
    assert got == [("", 0), ("s", 1), ("s", 2), ("t", 0)]
    first = sorted((r.k or "", r.n or 0) for r in joins.asof_join(left, right, ["k"], "d", "r", "earliest").collect())
    assert first == [("", 0), ("s", 3), ("t", 0)]


def test_conform(spark):
    df = spark.createDataFrame([("s", "12")], "SVC_NO string, subscr_no string")
    out = shape.conform(df, EVENT_FACT, load_date=D("2000-01-01"), src_cd="ID")
    assert out.columns == EVENT_FACT.names and [f.dataType for f in out.schema] == [f.dataType for f in EVENT_FACT]
    row = out.first()
    assert (row.svc_no, row.subscr_no, row.load_date, row.rep_id) == ("s", 12, D("2000-01-01"), None)
    with pytest.raises(ValueError):
        shape.conform(df, EVENT_FACT, no_such_column=1)


def test_column_profile_of_nothing(spark):
    empty = spark.createDataFrame([], "a int")
    assert rows(profile.column_profile(empty, ["a"]).select("row_count", "null_count", "distinct_count")) == [(0, 0, 0)]


def test_statistics_of_a_catalog_table(spark):
    spark.range(10).selectExpr("id", "id % 3 AS g").write.mode("overwrite").saveAsTable("profiled")
    try:
        profile.analyze_columns(spark, "profiled", ["g"])
        info = {r.info_name: r.info_value for r in spark.sql("DESCRIBE EXTENDED profiled g").collect()}
        assert info["distinct_count"] == "3"
    finally:
        spark.sql("DROP TABLE profiled")


def test_name_map(spark):
    cases = {
        "XOABC": "XPABC", "OXABC": "OXABC", "xoxo": "xPxo", "O_TAB": "O_TAB", "OODL": "OPDL", "ABC": "ABC", "AOAO": "APAO",
    }
    df = spark.createDataFrame([(k,) for k in cases], "name string")
    got = {r.old_name: r.new_name for r in names.derive_name_map(df, "o", "p").collect()}
    assert got == cases


@pytest.mark.parametrize("way", ["pattern", "words", "used words", "joined"])
def test_ways_to_rewrite_names_agree(spark, monkeypatch, way):
    """Whatever the size of the dictionary decides, the texts are the same; none is shuffled unless the used names are too many."""
    mark = names.MARK
    mapping = {"a": "B", "b": "c", "ab": "a", "abc": "x$1\\", "a_1": "ab", **{f"never{i}": "no" for i in range(500)}}
    texts = ["a b ab abc ABC a_1 abcd _a a1", "A-B.ab,abc", f"{mark}a{mark} b {mark}", "", None, "none here", "b" * 50_000 + " b", "é a\u0130b ıa B"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    listed = spark.createDataFrame(list(mapping.items()), "old_name string, new_name string")
    if way != "pattern":
        monkeypatch.setattr(names, "PATTERN_ENTRIES", 0)
    monkeypatch.setattr(names, "DICTIONARY_BYTES", {"used words": 200, "joined": 0}.get(way, 1 << 20))
    new = {k.lower(): v for k, v in mapping.items()}
    want = [t if t is None else re.sub("[A-Za-z0-9_]+", lambda m: new.get(m[0].lower(), m[0]), t) for t in texts]
    out = names.rewrite_names(docs, listed)
    assert {r.doc_id: r.text for r in out.collect()} == dict(enumerate(want))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange" in plan) == (way == "joined") and ("Broadcast" not in plan or way == "joined")
    uses = [(i, w.lower()) for i, t in enumerate(texts) for w in re.findall("[A-Za-z0-9_]+", t or "") if w.lower() in new]
    assert {(r.doc_id, r.name): r.uses for r in names.name_usage(docs, listed).collect()} == dict(Counter(uses))
    assert names.rewrite_names(docs, listed.limit(0)).count() == len(texts) and names.name_usage(docs, listed.limit(0)).count() == 0


def test_names_are_whole_words(spark):
    mapping = {"NOSHARE": "NPSHARE", "NOCFG": "NPCFG", "NOSHARE_XY": "NPSHARE_XY"}
    text = "from noshare.t, NOSHARE_XY.u, (nocfg.v) NOSHARES xNOCFG nocfg-NOCFG éNOCFG\n\tNOSHARE"
    want = "from NPSHARE.t, NPSHARE_XY.u, (NPCFG.v) NOSHARES xNOCFG NPCFG-NPCFG éNPCFG\n\tNPSHARE"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "plain")], "doc_id int, text string")
    # A repeated entry and one without a replacement do not matter.
    rows = [*mapping.items(), ("noshare", "NPSHARE"), ("plain", None)]
    listed = spark.createDataFrame(rows, "old_name string, new_name string")
    got = {r.doc_id: r.text for r in names.rewrite_names(df, listed).collect()}
    assert got == {1: want, 2: "", 3: None, 4: "plain"}
    uses = {r.name: r.uses for r in names.name_usage(df, listed).collect()}
    assert uses == {"noshare": 2, "noshare_xy": 1, "nocfg": 4}
    for wrong in ([("two words", "x")], [("abc", "x"), ("ABC", "y")]):
        bad = spark.createDataFrame([*wrong, ("plain", "z")], "old_name string, new_name string")
        with pytest.raises(Exception, match="not a single word|two replacements"):
            names.rewrite_names(df.withColumn("text", F.lit("abc two words")), bad).collect()
            names.checked_names(bad).collect()
