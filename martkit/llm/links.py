"""Connected classes of near-equal items, from keys that near-equal items share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from martkit.llm.common import cut, release, small_enough
from martkit.operators.joins import spread_join
from martkit.sources.tables import StageArea

# Rows of labels or keys that may be broadcast (16 bytes each, and a hash table's overhead); more are shuffled.
BROADCAST_ROWS = 1_000_000
# Rows of marks that may be broadcast, of up to 200 bytes each.
BROADCAST_MARKS = 200_000
# Pairs of ids that may be broadcast, so that what they are joined to is not shuffled.
BROADCAST_PAIRS = 200_000
# Rounds in which a class tries one other item; what they do not join is compared pair by pair.
ROUNDS = 5
# Words of 64 bits in the map of shared keys: its size does not depend on the data.
MAP_WORDS = 1 << 20


def connected(links: DataFrame) -> DataFrame:
    """``(id, label)``: the smallest id that links ``(a, b)`` lead to, for every linked id but the smallest ones.

    Alternates two steps until all classes are stars: each id hands its larger neighbours to the smallest one, then its
    smaller ones.  A number of rounds that grows with the logarithm of the longest chain is enough.  Ids with very many
    links are joined salted.  Repeated links change nothing.
    """
    with StageArea(links.sparkSession) as stage:
        return cut(_stars(links, stage))


def _stars(links: DataFrame, stage: StageArea) -> DataFrame:
    """The labels of ``connected``, staged: small tables are read back by few tasks, however many wrote them."""
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v"), "edges")
    # No step makes more links than there were, and a link has two ends.
    near = F.broadcast if 2 * edges.count() <= BROADCAST_ROWS else None

    def with_least(rows: DataFrame, least: DataFrame) -> DataFrame:
        return rows.join(near(least), "u") if near else spread_join(rows, least, ["u"], "inner")

    # Stars: every id has one smaller neighbour at most, and none that is one has any; nothing would change any more.
    smaller = F.when(F.col("v") < F.col("u"), F.col("v"))
    joins_two = (F.min(smaller) < F.max(smaller)) | ((F.min("v") < F.col("u")) & (F.max("v") > F.col("u")))
    while True:
        both = _two_rows(edges, ("u", "v"), ("v", "u")).toDF("u", "v")
        around = stage(both.groupBy("u").agg(F.min("v").alias("m"), F.coalesce(joins_two, F.lit(False)).alias("open")), "around")
        if around.filter("open").isEmpty():
            return around.filter("m < u").select(F.col("u").alias("id"), F.col("m").alias("label"))
        least = around.select("u", F.least("u", "m").alias("m"))
        large = stage(with_least(both.filter("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = with_least(large, least)
        edges, old = stage(_two_rows(small, ("v", "m"), ("u", "m")).toDF("u", "v").filter("u <> v").distinct(), "edges"), edges
        stage.drop(old, around, large)


def _two_rows(df: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """Two columns of a row, then two again as a row of its own; ``df`` is read once."""
    pair = lambda names: F.struct(F.col(names[0]).alias("x"), F.col(names[1]).alias("y"))
    return df.select(F.explode(F.array(pair(first), pair(second))).alias("two")).select("two.x", "two.y")


def _with_links(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels of ``(id, label)`` once links ``(a, b)`` are known too: only the classes they join are searched, not their items."""
    of = small_enough(labels, BROADCAST_ROWS)
    ends = links.join(of.toDF("a", "la"), "a", "left").join(of.toDF("b", "lb"), "b", "left")
    joined = connected(ends.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    renamed = small_enough(joined.toDF("label", "now"), BROADCAST_ROWS)
    return labels.join(renamed, "label", "left").select("id", F.coalesce("now", "label").alias("label")).unionByName(joined)


def _perhaps_shared(members: DataFrame, shared: DataFrame) -> DataFrame:
    """Members whose key may be among the shared ones: a map of one bit a key, of fixed size, is broadcast.

    Most keys belong to one item alone and need not travel again.  The more keys are shared, the more others pass too; they
    are sorted out by the join that follows.
    """
    bit = lambda: F.expr(f"pmod(key, {64 * MAP_WORDS})")
    words = shared.select(F.floor(bit() / 64).alias("word"), F.expr("shiftleft(1L, CAST(pmod(key, 64) AS INT))").alias("bit"))
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bits"))  # MAP_WORDS rows at most
    placed = members.withColumn("word", F.floor(bit() / 64)).join(F.broadcast(words), "word")
    return placed.filter("(bits & shiftleft(1L, CAST(pmod(key, 64) AS INT))) <> 0").select(*members.columns)


def classes_by_keys(
    members: DataFrame,
    confirm_among: Callable[[DataFrame], Callable[[DataFrame], DataFrame]],
    stage: StageArea,
    marks_among: Callable[[DataFrame], DataFrame] | None = None,
    close: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    once: bool = False,
) -> DataFrame:
    """Classes of items of which any two that are near share a key: ``(id, label)``, without the smallest id of each.

    ``members`` has ``(key, id, own)`` rows, repeated or not; of two near items one has a shared key as its own.  ``once`` says that
    an item has a key once, which makes the first and widest shuffle narrower.
    ``confirm_among`` is given all items that share a key, as ``(id)``, and returns what keeps the truly near ones of pairs
    ``(a, b)`` of them.  ``marks_among`` is given the same items and returns ``(id, ...)`` with columns of marks; ``close`` tells from the marks
    of two items, each given as a function from a mark's name to its column, whether they can be near, so that others need not meet.

    The pairs of a key are never all written out.  In a few rounds every key names one of its owners, first the one
    whose keys most items share, and every class so far tries the named owner of another class with which it shares most
    keys; this joins the bulk of a large group.
    Only what then still is in different classes of a key meets pair by pair, so that no link is missed: links
    inside a class would change nothing.
    """
    spark = members.sparkSession
    if once:
        # One number tells how many items have the key and whether one owns it.
        owners = 1 << 40
        held_by = members.groupBy("key").agg(F.sum(F.when(F.col("own"), owners + 1).otherwise(1)).alias("n"))
        shared = held_by.filter((F.col("n") > owners) & (F.col("n") % owners > 1))
    else:
        held_by = members.groupBy("key").agg(F.max("own").alias("own"), F.min("id").alias("low"), F.max("id").alias("high"))
        shared = held_by.filter("own AND low < high")
    shared = stage(shared.select("key"), "shared")
    release(spark)
    held = _perhaps_shared(members, shared).join(shared, "key").groupBy("key", "id").agg(F.max("own").alias("own"))
    held = stage(held, "held")
    stage.drop(shared, members)
    release(spark)
    confirm = confirm_among(held.select("id").distinct())
    # How many items share the keys of an item: what copies were made of shares most.
    sizes = stage(held.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "sizes")
    central = stage(held.join(sizes, "key").groupBy("id").agg(F.sum("n").alias("central")), "central")
    held, old = stage(held.join(small_enough(central, BROADCAST_ROWS), "id").select("key", "id", "own", "central"), "held"), held
    stage.drop(old, sizes, central)
    labels = held.select("id", F.col("id").alias("label")).limit(0)
    tried = held.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)

    for turn in range(ROUNDS):
        named = _in_classes(held, labels)
        order = -F.col("central") if turn == 0 else F.xxhash64("id", F.lit(turn))
        pick = F.min(F.when(F.col("own"), F.struct(order.alias("order"), "id", "label"))).alias("pick")
        keys = named.groupBy("key").agg(pick, F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
        keys = stage(keys.select("key", F.col("pick.id").alias("to"), F.col("pick.label").alias("to_label")), "open")
        # Keys whose items have become one class have nothing more to say.
        held, old = stage(held.join(small_enough(keys.select("key"), BROADCAST_ROWS), "key"), "held"), held
        stage.drop(old)
        met = _in_classes(held, labels).join(small_enough(keys, BROADCAST_ROWS), "key").filter("label <> to_label")
        met = met.groupBy("id", "label", "to").agg(F.count(F.lit(1)).alias("n"))
        met = met.select("*", F.least("id", "to").alias("a"), F.greatest("id", "to").alias("b")).join(small_enough(tried, BROADCAST_PAIRS), ["a", "b"], "left_anti")
        best = met.groupBy("label").agg(F.max(F.struct("n", "a", "b")).alias("best"))
        pairs = stage(best.select("best.a", "best.b").distinct(), "star")
        links = stage(confirm(pairs).select("a", "b"), "links")
        tried = tried.unionByName(pairs)
        stage.drop(keys)
        release(spark)
        if links.isEmpty():
            break
        labels = stage(_with_links(labels, links), "labels")

    named = _in_classes(held, labels)
    names: list[str] = []
    if marks_among is not None:
        # They travel with every key of an item that is still open.
        marks = stage(marks_among(held.select("id").distinct()), "marks")
        names = [c for c in marks.columns if c != "id"]
        named = named.join(small_enough(marks, BROADCAST_MARKS), "id")
    named = stage(named, "named")
    stage.drop(held)
    release(spark)
    left = named.select("key", F.col("id").alias("x"), F.col("label").alias("lx"), F.col("own").alias("ox"), *[F.col(m).alias(f"{m}_x") for m in names])
    right = named.filter("own").select("key", F.col("id").alias("y"), F.col("label").alias("ly"), *[F.col(m).alias(f"{m}_y") for m in names])
    # Two owners would meet twice.
    meets = (F.col("lx") != F.col("ly")) & (F.col("x") != F.col("y")) & (~F.col("ox") | (F.col("x") < F.col("y")))
    if close is not None:
        meets = meets & close(lambda m: F.col(f"{m}_x"), lambda m: F.col(f"{m}_y"))
    apart = left.join(right, "key").filter(meets).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    more = stage(confirm(stage(apart.join(small_enough(tried, BROADCAST_PAIRS), ["a", "b"], "left_anti"), "pairs")).select("a", "b"), "more")
    if more.isEmpty():
        return labels
    return _with_links(labels, more)


def _in_classes(held: DataFrame, labels: DataFrame) -> DataFrame:
    near = small_enough(labels, BROADCAST_ROWS)
    return held.join(near, "id", "left").select("key", "id", "own", "central", F.coalesce("label", "id").alias("label"))
