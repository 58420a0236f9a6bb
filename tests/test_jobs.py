"""Slices on disk, scripts, and the whole jobs run twice."""

from __future__ import annotations

import os
from collections.abc import Mapping
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from checks.harness import CheckTables
from martkit.operators.change import days_in, write_slice
from martkit.operators.shape import conform
from martkit.plans import base, jobs, revenue, second_source, staged_events, tv_events
from martkit.plans.second_source import load_second_source_events
from martkit.sources.schemas import BASE_STAGE, COMMISSION_FACT, EVENT_FACT, EVENT_STAGE, MONTH_BASE
from martkit.sources.tables import TEXT_KEYS, ParquetTables, StageArea, fold_keys, read_scripts, stage, stage_root, trim_keys, write_scripts

FOLDER = "/root/testdata/sf0.001"
D = date.fromisoformat


def test_slice_on_disk(spark, tmp_path):
    path = str(tmp_path / "fact")
    window = (D("2000-01-01"), D("2000-01-03"))
    parts = ["src", "day"]

    def load(rows, src="a"):
        new = stage(spark.createDataFrame(rows, "v int, src string, day date"), "new")
        write_slice(new, path, parts, {"src": [src], "day": days_in(window)})
        return sorted((r.v, r.src, r.day.day) for r in spark.read.parquet(path).collect())

    assert load([(1, "a", D("2000-01-01")), (2, "a", D("2000-01-02"))]) == [(1, "a", 1), (2, "a", 2)]
    assert load([(9, "b b", D("2000-01-01"))], "b b") == [(1, "a", 1), (2, "a", 2), (9, "b b", 1)]
    # Day 2 is no longer filled and goes; a rerun changes nothing; the other source stays.
    for _ in range(2):
        assert load([(3, "a", D("2000-01-03"))]) == [(3, "a", 3), (9, "b b", 1)]
    assert load([]) == [(9, "b b", 1)]
    # What is there already is not written again, in whatever order its rows come.
    rows = [(i, "a", D("2000-01-01") if i % 2 else D("2000-01-02")) for i in range(6)]
    assert len(load(rows)) == 7
    files = lambda: {str(f): os.stat(f).st_mtime_ns for f in (tmp_path / "fact").rglob("*.parquet")}
    once = files()
    assert len(load(rows[::-1])) == 7 and files() == once
    load([*rows[1:], (7, "a", D("2000-01-02"))])
    assert {f for f, at in once.items() if files().get(f) == at} == {f for f in once if "day=2000-01-02" not in f}
    load([])
    with pytest.raises(ValueError, match="outside the slice"):
        load([(4, "a", D("2000-02-01"))])


def test_scripts(spark, tmp_path):
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    texts = {
        "a.sql": "select * from XOT.t;\n\n-- end\n", "sub/B.SQL": "xot_y.xot\n", "sub/c.bteq": ".x XOT\n",
        "d.btq": "XOT\n", "e.txt": "XOT\n",
    }
    for name, text in texts.items():
        (root / name).write_text(text)
    assert {r.path: r.text for r in read_scripts(spark, str(root)).collect()} == {
        "a.sql": "select * from XOT.t;\n\n-- end\n", "sub/B.SQL": "xot_y.xot\n", "sub/c.bteq": ".x XOT\n",
    }
    listed = spark.createDataFrame([("XOT",), ("ABC",)], "name string")
    out = tmp_path / "out"
    jobs.run_retarget(spark, str(root), listed, "o", "p", str(out))
    tree = lambda top: {str(p.relative_to(top)): p.read_bytes() for p in top.rglob("*") if p.is_file() and not p.name.startswith(".")}
    want = {"a.sql": b"select * from XPT.t;\n\n-- end\n", "sub/B.SQL": b"xot_y.XPT\n", "sub/c.bteq": b".x XPT\n"}
    assert tree(out) == want
    # Once more over what is there: files of scripts that are gone go.
    (root / "a.sql").write_text("no line break at the end XOT")
    (root / "sub" / "c.bteq").write_text("\n")
    (root / "sub" / "B.SQL").rename(root / "sub" / "new +(1) [x] 50%.sql")
    jobs.run_retarget(spark, str(root), listed, "o", "p", str(out))
    assert tree(out) == {"a.sql": b"no line break at the end XPT", "sub/c.bteq": b"\n", "sub/new +(1) [x] 50%.sql": b"xot_y.XPT\n"}
    assert [p.name for p in tmp_path.iterdir() if "_writing" in p.name] == []
    with pytest.raises(Exception, match="not a path of a script"):
        write_scripts(spark.createDataFrame([("../x.sql", "a")], "path string, text string"), str(out))
    assert len(tree(out)) == 3


def test_script_paths_are_taken_as_they_are(spark, tmp_path):
    root = tmp_path / "in+put (1) [x] 50%"
    for name in ("my dir/a b.sql", "c+d/e.sql", "f.sql"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("from XOT.t")
    assert {r.path for r in read_scripts(spark, str(root)).collect()} == {"my dir/a b.sql", "c+d/e.sql", "f.sql"}
    assert {r.path for r in read_scripts(spark, str(root) + "/").collect()} == {"my dir/a b.sql", "c+d/e.sql", "f.sql"}


def test_table_source(spark, tmp_path):
    spark.createDataFrame([("a  ", 1)], "k string, v int").write.parquet(str(tmp_path / "t.parquet"))
    tables = ParquetTables(spark, str(tmp_path), ["t"])
    assert list(tables) == ["t"] and trim_keys(tables["t"], "k").first().k == "a"
    with pytest.raises(KeyError):
        tables["u"]


def test_keys_meet_whatever_their_case_and_padding(spark, tables, tmp_path):
    """Every other key in small letters, one to three blanks behind: the same revenue as with clean keys."""
    names = ["f_mob_rev", "cfg_rev_ref", "f_mob_mobilebase", "zz_cfg_rate_plan_ref", "md_dlr_hier_ref"]
    for k, name in enumerate(names):
        clean = tables[name]
        seen = [c for c, kind in clean.dtypes if c in TEXT_KEYS and kind == "string"]
        assert seen
        form = F.pmod(F.xxhash64(*clean.columns, F.lit(k)), F.lit(4)).cast("int")
        spoilt = {c: F.concat(F.when(form < 2, F.lower(c)).otherwise(F.col(c)), F.repeat(F.lit(" "), form)) for c in seen}
        clean.withColumns(spoilt).write.parquet(str(tmp_path / f"{name}.parquet"))
    month = D("1998-08-31")
    rows = lambda t: sorted(map(str, revenue.commission_revenue(t, month).collect()))
    expected = rows(tables)
    assert expected and rows(ParquetTables(spark, str(tmp_path), names)) == expected
    assert rows(ParquetTables(spark, str(tmp_path), names, text_keys=())) != expected


def test_folded_keys_keep_all_else(spark):
    df = spark.createDataFrame([("a1 ", 7, " b ", None), (None, 8, "c ", "x")], "svc_no string, acct_no int, note string, DLR_CD string")
    out = fold_keys(df, *TEXT_KEYS)
    assert out.columns == df.columns and out.schema["acct_no"].dataType.simpleString() == "int"
    assert [tuple(r) for r in out.collect()] == [("A1", 7, " b ", None), (None, 8, "c ", "X")]
    assert fold_keys(df.limit(0), *TEXT_KEYS).isEmpty() and fold_keys(df).columns == df.columns


def test_stage_area_cleans_up(spark):
    root = stage_root(spark)
    before = set(os.listdir(root))
    with StageArea(spark) as keep:
        assert keep(spark.range(3), "r").count() == 3
        assert len(set(os.listdir(root)) - before) == 1
    assert set(os.listdir(root)) == before


def test_second_source_load_as_written(spark):
    days = [D("2000-01-01"), D("2000-02-01")]
    fact = conform(
        spark.createDataFrame([("ID", d) for d in days], "src_cd string, work_ord_completion_dt date"), EVENT_FACT
    )
    rows = [("ED", d) for d in days]
    new = conform(spark.createDataFrame(rows, "src_cd string, work_ord_completion_dt date"), EVENT_STAGE)
    window = (D("2000-01-01"), D("2000-01-11"))

    def left(df):
        return sorted((r.src_cd, r.work_ord_completion_dt.month) for r in df.collect())

    assert left(load_second_source_events(fact, new, window)) == [("ED", 1), ("ID", 1), ("ID", 2)]
    # As written: first-source rows of the window are lost, older staging rows come again.
    assert left(load_second_source_events(fact, new, window, faithful=True)) == [("ED", 1), ("ED", 2), ("ID", 2)]


@pytest.fixture(scope="module")
def tables(spark):
    return CheckTables(spark, FOLDER, stored=True)


def _content(df):
    return sorted(map(repr, df.collect()))


def test_daily_load_is_idempotent(spark, tables, tmp_path):
    path = str(tmp_path / "events")
    jobs.run_daily_load(spark, tables, path, D("1999-01-02"), back=62)
    once = jobs.read_fact(spark, path, EVENT_FACT)
    # Rows that another job loads for the same days stay.
    foreign = once.limit(1).withColumn("src_tbl", F.lit("another job")).withColumn(jobs.SOURCE_PART, jobs.source_part())
    stage(foreign, "foreign").write.mode("append").partitionBy(*jobs.EVENT_PARTITIONS).parquet(path)
    first = _content(once.sparkSession.read.schema(EVENT_FACT).parquet(path).select(*EVENT_FACT.names))
    sources = {(r.src_cd, r.src_tbl) for r in once.select("src_cd", "src_tbl").distinct().collect()}
    assert {("ID", "Opom Extract"), ("ID", "adac_fbb"), ("ID", "oo_awkord"), ("ED", None)} <= sources
    assert jobs.read_fact(spark, path, EVENT_FACT).filter("src_tbl = 'another job'").count() == 1
    days = once.agg(F.min("work_ord_completion_dt"), F.max("work_ord_completion_dt")).first()
    assert days[0] >= D("1998-11-01") and days[1] <= D("1998-12-31")
    jobs.run_daily_load(spark, tables, path, D("1999-01-02"), back=62)
    assert _content(jobs.read_fact(spark, path, EVENT_FACT)) == first
    # A later window leaves older days alone.
    jobs.run_daily_load(spark, tables, path, D("1999-02-02"), back=20)
    kept = jobs.read_fact(spark, path, EVENT_FACT).filter(F.col("work_ord_completion_dt") <= F.lit(D("1998-12-31")))
    assert _content(kept) == first


class OddlyTyped(Mapping):
    """The same tables with other letter case and trailing blanks in business texts."""

    COLUMNS = {
        "cfg_sov_ref": ["rate_plan_ds"], "all_daily_add_churn": ["src_tbl", "cfu"], "l_service_event": ["service_event_grp"],
        "cfg_rate_plan_ref": ["prod_grp_lvl_1"], "f_tbc_acct_plans": ["plan_type"], "cfg_rev_ref": ["chrg_type_lvl_3"],
        "md_dlr_hier_ref": ["regn", "report_grp_cd"],
    }

    def __init__(self, tables):
        self._tables = tables

    def __getitem__(self, name):
        frame = self._tables[name]
        return frame.withColumns({c: F.concat(F.upper(c), F.lit("  ")) for c in self.COLUMNS.get(name, [])})

    def __iter__(self):
        return iter(self._tables)

    def __len__(self):
        return len(self._tables)


def test_letter_case_and_blanks_do_not_count(tables):
    odd, window, day, month = OddlyTyped(tables), (D("1992-01-01"), D("2001-12-31")), D("2002-01-01"), D("1998-08-31")
    jobs_ = [
        lambda t: staged_events.load_fbb(t, window, day), lambda t: staged_events.load_mobile_data(t, window, day),
        lambda t: staged_events.load_blackberry(t, window, day), lambda t: base.account_plan_base(t, month),
        lambda t: revenue.monthly_revenue(t, month), lambda t: revenue.commission_revenue(t, month),
    ]
    counts = [job(tables).count() for job in jobs_]
    assert counts[0] > 0 and sum(c > 0 for c in counts) >= 4
    assert [job(odd).count() for job in jobs_] == counts


def test_second_source_staging_feeds_both_loads(spark, tables, tmp_path):
    events, month = str(tmp_path / "events"), str(tmp_path / "month")
    for _ in range(2):
        jobs.run_second_source_stage(spark, tables, events, month, D("1999-01-02"), back=62)
    window = (D("1998-11-01"), D("1998-12-31"))
    staged = jobs.read_fact(spark, events, EVENT_STAGE)
    direct = second_source.map_second_source_events(tables, window)
    assert _content(staged) == _content(direct.select(*staged.columns)) != []
    fact = conform(spark.createDataFrame([("ID", D("1998-12-01"))], "src_cd string, work_ord_completion_dt date"), EVENT_FACT)
    for faithful, first in ((False, 1), (True, 0)):
        loaded = load_second_source_events(fact, staged, window, faithful=faithful)
        assert loaded.filter("src_cd = 'ID'").count() == first and loaded.filter("src_cd = 'ED'").count() == staged.count()
    rows = jobs.read_fact(spark, month, BASE_STAGE)
    assert rows.count() == second_source.map_second_source_base(tables, D("1998-12-31")).count()
    base_rows = conform(rows.limit(0), MONTH_BASE)
    assert second_source.load_second_source_base(base_rows, rows, D("1998-12-31"), faithful=True).count() == rows.count()


def test_television_load_of_the_older_kind(spark, tables, tmp_path):
    path = str(tmp_path / "events")
    day = tables["ott_at_transaction"].agg(F.max("transaction_date")).first()[0]
    for _ in range(2):
        jobs.run_television_load(spark, tables, path, day + timedelta(days=2))
    loaded = jobs.read_fact(spark, path, EVENT_FACT)
    days = loaded.agg(F.min("work_ord_completion_dt"), F.max("work_ord_completion_dt")).first()
    assert day - timedelta(days=13) <= days[0] and days[1] == day
    want = tv_events.tv_events_four_way(tables, (day - timedelta(days=13), day), day + timedelta(days=2))
    assert _content(loaded) == _content(want.select(*loaded.columns))


def test_interval_bounds_reach_the_scan(spark, tables):
    """Bare moments against literals: the month-end reads of subscriptions and services can skip row groups."""
    month = D("1998-08-31")
    frames = {
        "product_start": base._held_at(tables, month), "service_start": base.base_service_counts(tables, tables["ar_s100"].withColumnRenamed("account_no", "ar_account_no"), month),
    }
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        for column, frame in frames.items():
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert [line for line in plan.splitlines() if "PushedFilters" in line and f"LessThan({column}" in line]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_misspelt_columns_are_refused(spark):
    frame = spark.createDataFrame([("ID", 1)], "src_cd string, svc_nmbr int")
    assert conform(frame, EVENT_FACT).count() == 1
    with pytest.raises(ValueError, match="svc_nmbr"):
        conform(frame, EVENT_FACT, only=True)


def test_month_end_is_idempotent(spark, tables, tmp_path):
    base_path, plans = str(tmp_path / "base"), str(tmp_path / "plans")
    seen = []
    for _ in range(2):
        jobs.run_month_end(spark, tables, base_path, plans, D("1998-09-01"))
        loaded = jobs.read_fact(spark, base_path, MONTH_BASE)
        seen.append((_content(loaded), spark.read.parquet(plans).count()))
    assert seen[0] == seen[1] and seen[0][1] > 0
    assert {r.src_cd for r in loaded.select("src_cd").distinct().collect()} == {"ID", "ED"}


def test_commission_revenue_load(spark, tables, tmp_path):
    path = str(tmp_path / "commission")
    for _ in range(2):
        jobs.run_commission_revenue(spark, tables, path, D("1998-09-01"))
    rows = jobs.read_fact(spark, path, COMMISSION_FACT)
    assert rows.count() == rows.select("svc_no", "dlr_cd", "rate_plan_cd").distinct().count() > 0
