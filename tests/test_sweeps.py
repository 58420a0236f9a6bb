"""Frequent keys, maps of touched keys, and days against intervals by blocks."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from martkit.operators import hot, intervals, joins

START = date(1996, 1, 1)
HIGH = date(2899, 12, 31)


def test_blocks_cover_an_interval_once(spark):
    rng = random.Random(2)
    rows = [(date(1, 1, 1), date(9999, 12, 31)), (START, START), (START, START - timedelta(days=1)), (START, START - timedelta(days=9))]
    rows += [(START + timedelta(days=a), START + timedelta(days=a + rng.randrange(200))) for a in (rng.randrange(3000) for _ in range(60))]
    spans = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a date, b date")
    blocks = spans.select("i", F.explode(intervals.blocks_of_interval(F.col("a"), F.col("b"))).alias("x")).select("i", "x.*").collect()
    held = Counter()
    for r in blocks:
        assert rows[r.i][0] <= rows[r.i][1]
        held[r.i] += 1 << r.level
    assert all(held[i] == max(0, (b - a).days + 1) for i, (a, b) in enumerate(rows))
    assert max(Counter(r.i for r in blocks).values()) <= 2 * intervals.LEVELS


@pytest.fixture(scope="module")
def crowded(spark):
    """One key with 50,000 events and 5,000 versions among ordinary ones."""
    events = spark.range(50_000).select(
        F.col("id").alias("i"), F.lit("hot").alias("k"), F.date_add(F.lit(START), (F.col("id") * 37 % 2500).cast("int")).alias("d")
    )
    others = spark.range(600).select(
        (F.col("id") + 100_000).alias("i"), F.when(F.col("id") % 9 > 0, F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.when(F.col("id") % 7 > 0, F.date_add(F.lit(START), F.col("id").cast("int"))).alias("d"),
    )
    opened = F.date_add(F.lit(START), (F.col("id") * 53 % 2500).cast("int"))
    closed = F.when(F.col("id") % 500 == 0, F.lit(HIGH)).otherwise(F.date_add(opened, (F.col("id") % 11).cast("int") - 1))
    versions = spark.range(5_000).select(F.col("id").alias("n"), F.lit("hot").alias("k"), opened.alias("open_dt"), closed.alias("close_dt"))
    more = spark.range(120).select(
        (F.col("id") + 10_000).alias("n"), F.when(F.col("id") % 8 > 0, F.concat(F.lit("k"), F.col("id") % 60)).alias("k"), F.lit(START).alias("open_dt"),
        F.when(F.col("id") % 2 == 0, F.lit(HIGH)).alias("close_dt"),
    )
    return events.unionByName(others).cache(), versions.unionByName(more).cache()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_crowded_key_compares_matches_only(crowded, how):
    events, versions = crowded
    heavy = joins.heavy_keys(events, versions, ["k"])
    assert heavy == [events.filter("k = 'hot'").select(hot.key_hash(["k"])).first()[0]]
    plain = joins.temporal_join(events, versions, ["k"], "d", grace=2, how=how)
    swept = joins.temporal_join(events, versions, ["k"], "d", grace=2, how=how, heavy=heavy)
    digest = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("i", "n", "open_dt").cast("decimal(38,0)"))).first()
    assert digest(plain.select("i", "n", "open_dt")) == digest(swept.select("i", "n", "open_dt"))
    assert sorted(swept.columns) == sorted(plain.columns)


def test_crowded_key_counts_its_comparisons(crowded):
    """Days meet versions by equal blocks, with no condition besides: as many pairs as are valid, of 12.5 million."""
    events, versions = (df.filter("k = 'hot'") for df in crowded)
    pairs = intervals.valid_pairs(events, versions, ["k"], "d", "open_dt", "close_dt", 2)
    days = [r.d for r in events.select("d").distinct().collect()]
    spans = [(r.open_dt - timedelta(days=2), r.close_dt) for r in versions.collect()]
    begun = Counter(a for a, b in spans if a <= b)
    ended = Counter(b for a, b in spans if a <= b)
    valid = sum(sum(n for a, n in begun.items() if a <= d) - sum(n for b, n in ended.items() if b < d) for d in days)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "<=" not in join and ">=" not in join and "block" in join
    assert pairs.count() == valid < len(days) * len(spans) / 100


def test_crowded_join_with_a_further_condition(crowded):
    events, versions = crowded
    heavy = joins.heavy_keys(events, versions, ["k"])
    for how in ("inner", "left"):
        plain, swept = (
            joins.temporal_join(events, versions, ["k"], "d", how=how, extra=F.col("n") % 3 == 0, heavy=h).agg(F.count(F.lit(1)), F.sum("n")).first()
            for h in ((), heavy)
        )
        assert plain == swept
    moments = versions.withColumn("open_dt", F.col("open_dt").cast("timestamp"))
    with pytest.raises(ValueError, match="dates"):
        joins.temporal_join(events, moments, ["k"], "d", heavy=heavy)


def test_frequent_keys_are_told(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("a")).when(F.col("id") % 100 == 1, F.lit("b")).when(F.col("id") % 50 != 7, F.col("id").cast("string")).alias("k"),
        F.lit(1).alias("n"),
    )
    of = lambda *keys: {r[0] for r in spark.createDataFrame([(k, 1) for k in keys], "k string, n int").select(hot.key_hash(["k", "n"])).collect()}
    assert set(hot.frequent_keys(rows, ["k", "n"], rows=150)) == of("a", "b")
    assert set(hot.frequent_keys(rows, ["k", "n"], rows=5_000)) == of("a")
    assert hot.frequent_keys(rows.limit(0), ["k"]) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("named", [False, True])
def test_spread_join_copies_frequent_keys_alone(spark, how, named):
    left = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 10 > 0, F.col("id").cast("string")).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("4", 2), (None, 3), ("x", 4)], "k string, v int").groupBy("k").agg(F.max("v").alias("v"))
    frequent = hot.frequent_keys(left, ["k"]) if named else ()
    joined = joins.spread_join(left, right, ["k"], how, frequent)
    plain = left.join(right, ["k"], how)
    assert sorted(map(repr, joined.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert ("Generate" in plan) == named
    if named:
        copied = next(line for line in plan.splitlines() if "Generate explode" in line)
        below = plan[plan.index(copied) :]
        assert "Filter" in below and str(frequent[0]) in below


def test_split_of_a_frequent_key_at_run_time(spark):
    """The grouped side gets an exchange of its own, and the partition of a frequent key is split."""
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(60_000).repartition(16).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        right = spark.range(4_000).select(F.when(F.col("id") == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id").groupBy("k").agg(F.max("id").alias("v"))
        joined = joins.spread_join(left, right, ["k"], "left")
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_touched_keys_are_cut_before_the_shuffle(spark):
    rows = spark.range(50_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")).unionByName(spark.createDataFrame([(None, -1)], "k string, v long"))
    keys = spark.range(0, 50_000, 1_000).select(F.col("id").cast("string").alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    kept = hot.perhaps_touched(rows, hot.key_map(keys, ["k"]), ["k"])
    found = {r.v for r in kept.collect()}
    assert set(range(0, 50_000, 1_000)) <= found and len(found) < 60
    exact = joins.semi_join(rows, keys.withColumnRenamed("k", "other"), "k", "other", early=True)
    assert {r.v for r in exact.collect()} == set(range(0, 50_000, 1_000))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and hot.key_map(keys, ["k"]).count() <= hot.MAP_WORDS
